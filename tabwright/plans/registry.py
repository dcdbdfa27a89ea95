"""Named queries and, where SQL can express them, the equivalent SQL text."""

from __future__ import annotations

import textwrap
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = textwrap.dedent(sql).strip()
        return fn

    return register


def _nudge(digits: int) -> float:
    """Moves an exact tie off the edge, so that the last bit of a sum cannot decide the rounding."""
    return 10.0 ** -(digits + 3)


def rnd(expr: str, digits: int = 4) -> str:
    """SQL rounding that never yields a negative zero."""
    return f"(round({expr} + {_nudge(digits):.0e}, {digits}) + 0.0)"


def rnd_col(col, digits: int = 4) -> Column:
    """The same rounding on a column."""
    value = F.col(col) if isinstance(col, str) else col
    return F.round(value + _nudge(digits), digits)


def union_sql(parts) -> str:
    return "\nunion all\n".join(parts)


def rounded(df: DataFrame, cols, digits: int = 4) -> DataFrame:
    return df.select(*[rnd_col(c, digits).alias(c) if c in cols else c for c in df.columns])
