"""Long lists of literals or columns, built as one SQL expression instead of one call per element."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def strings(values: Sequence[str]) -> Column:
    return F.expr(f"array({', '.join(quoted(v) for v in values)})")


def doubles(values: Sequence[float]) -> Column:
    return F.expr(f"array({', '.join(f'{float(v)!r}D' for v in values)})")


def not_in(column: str, values: Sequence[str]) -> Column:
    if not values:
        return F.lit(True)
    return F.expr(f"`{column}` NOT IN ({', '.join(quoted(v) for v in values)})")


def name(column: str) -> str:
    """A column name as SQL text."""
    return "`" + column.replace("`", "``") + "`"


def lines(rows: Sequence[Sequence[tuple[str, str]]]) -> Column:
    """Rows of (field, SQL value) pairs as a table-valued expression: one output row each."""
    structs = (", ".join(f"{value} AS {name(field)}" for field, value in row) for row in rows)
    return F.expr(f"inline(array({', '.join(f'struct({s})' for s in structs)}))")
