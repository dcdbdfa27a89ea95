"""Joining a large frame with a table of learned values or counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.session import materialize

BROADCAST_BYTES = 64 << 20  # bytes of the values of a table that is handed to every task


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which a null key equals a null key; right-hand keys are dropped."""
    renamed = right.select(*[F.col(c).alias(f"__r_{c}") if c in keys else F.col(c) for c in right.columns])
    cond = None
    for k in keys:
        c = F.col(k).eqNullSafe(F.col(f"__r_{k}"))
        cond = c if cond is None else cond & c
    return left.join(renamed, cond, how).drop(*[f"__r_{k}" for k in keys])


def measured(side: DataFrame, name: str = "lookup") -> tuple[DataFrame, bool]:
    """The table written once, and whether its counted bytes allow a broadcast.

    Without this a group table built from a very large input is planned as a shuffle join: the
    estimate of an aggregate is as large as its input, so every row of the large side would be
    written to disk and sent by key before the adaptive planner sees how small the table is.
    """
    table = materialize(side, name)
    return table, table_bytes(table) <= BROADCAST_BYTES


def table_bytes(table: DataFrame) -> int:
    """Bytes of all values, eight for each number and a few more for each row and string."""
    row = F.lit(16)
    for field in table.schema.fields:
        kind = field.dataType.typeName()
        if kind in ("string", "binary"):
            row = row + F.coalesce(F.octet_length(F.col(f"`{field.name}`")), F.lit(0)) + 16
        elif kind == "array":
            row = row + 8 * F.greatest(F.size(F.col(f"`{field.name}`")), F.lit(0)) + 16
        else:
            row = row + 8
    return table.agg(F.coalesce(F.sum(row.cast("long")), F.lit(0))).first()[0]


def attach(rows: DataFrame, side: DataFrame, keys: Sequence[str], how: str = "inner", name: str = "lookup") -> DataFrame:
    """`null_safe_join` with a table of unknown size: broadcast when its counted bytes allow.

    Beyond the limit both sides are shuffled by key; a key that holds a large share of the rows is
    then split at run time by the adaptive skew join, which needs no change of the result.
    """
    table, small = measured(side, name)
    return null_safe_join(rows, F.broadcast(table) if small else table, keys, how)
