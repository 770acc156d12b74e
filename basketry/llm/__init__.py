"""Operators for training-data pipelines over text: rules, joins, dedup, masking, scoring, packing, sharding."""
