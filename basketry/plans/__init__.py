"""Stage compositions, test-table adapters and the query registry."""
