"""Structured queries on declared views: columns, filters, order and a bounded number of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_ROWS, MOST_ROWS = 1000, 50_000
OPERATORS = ("=", "!=", ">", ">=", "<", "<=", "like", "in")


class QueryError(ValueError):
    """The request names a column or operator that isn't there, or an empty list."""


def _condition(column: Column, op: str, value: object) -> Column:
    if op == "in":
        if not value:
            raise QueryError("in needs at least one value")
        return column.isin(list(value))
    compare = {"=": column == value, "!=": column != value, ">": column > value, ">=": column >= value, "<": column < value, "<=": column <= value}
    return column.like(str(value)) if op == "like" else compare[op]


def structured_query(df: DataFrame, columns: list[str] | None = None, filters: list[tuple[str, str, object]] = (), order_by: list[tuple[str, str]] = (), limit: int = DEFAULT_ROWS) -> DataFrame:
    """Filters are joined by and; ``order_by`` has pairs of column and asc or desc; the limit stays within 0 and 50,000."""
    named = [*(columns or []), *[f[0] for f in filters], *[o[0] for o in order_by]]
    unknown = [c for c in named if c not in df.columns]
    if unknown:
        raise QueryError(f"no column {', '.join(map(repr, unknown))}")
    for _, op, _ in filters:
        if op not in OPERATORS:
            raise QueryError(f"no operator {op!r}")
    for c, op, value in filters:
        df = df.where(_condition(F.col(c), op, value))
    if order_by:
        df = df.orderBy(*[F.col(c).desc() if way.lower() == "desc" else F.col(c).asc() for c, way in order_by])
    return df.select(*(columns or df.columns)).limit(max(0, min(int(limit), MOST_ROWS)))
