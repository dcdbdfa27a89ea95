"""What several operators of this package share: the word pattern, slices of batches, row keys."""

from __future__ import annotations

import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.session import materialize

WORD = r"[^\x20\x09-\x0D]+"
BROADCAST_BYTES = 16 << 20  # bytes of the values of a table that is handed to every task


def by_value(name: str) -> None:
    """Functions of this module travel to executors by value: executors need no copy of the package."""
    cloudpickle.register_pickle_by_value(sys.modules[name])


by_value(__name__)


def bounded_batches(df: DataFrame, limit: int = 4 << 20) -> None:
    """Arrow batches of at most about `limit` bytes (one row at least) for the session's Python tasks.

    The session's default counts rows, or 64 MiB, which several Python workers and their JVM hold at once.
    """
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(conf.get(key, str(1 << 26)).rstrip("b")) > limit:
        conf.set(key, str(limit))


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def word_count(col: str = "text") -> Column:
    return F.regexp_count(text_or_empty(col), F.lit(WORD)).cast("long")


def slices(texts: list, limit: int = 2_000_000) -> Iterator[tuple[int, int]]:
    """Index ranges of consecutive texts that hold about `limit` characters together (one text at least)."""
    start, total = 0, 0
    for i, text in enumerate(texts):
        if total and total + len(text) > limit:
            yield start, i
            start, total = i, 0
        total += len(text)
    if start < len(texts):
        yield start, len(texts)


def attach_small(rows: DataFrame, side: DataFrame, on: Column, how: str = "left", name: str = "side") -> DataFrame:
    """Join with a table that is broadcast only if its measured bytes allow it, and shuffled by key otherwise.

    The table is written once; its size is the sum of its values' bytes, counted on the written rows.
    """
    table = materialize(side, name)
    size = None
    for field in table.schema.fields:
        kind = field.dataType.typeName()
        width = F.lit(8)
        if kind in ("string", "binary"):
            width = F.octet_length(F.col(field.name))
        elif kind == "array":  # of numbers
            width = 8 * F.size(F.col(field.name))
        size = F.coalesce(width, F.lit(0)) + 8 if size is None else size + F.coalesce(width, F.lit(0)) + 8
    total = table.agg(F.coalesce(F.sum(size), F.lit(0)).alias("b")).first()["b"]
    return rows.join(F.broadcast(table) if total <= BROADCAST_BYTES else table, on, how)


def copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(text_key, first_id, n_rows) of every text that several rows hold; a null text is an empty one.

    Only digests are shuffled, and they are counted before the shuffle.
    """
    keyed = docs.select(F.col(id_col).alias("id"), text_key(text_col).alias("text_key"))
    return keyed.groupBy("text_key").agg(F.min("id").alias("first_id"), F.count("*").alias("n_rows")).filter("n_rows > 1")


def text_key(text_col: str = "text") -> Column:
    return F.unhex(F.md5(text_or_empty(text_col)))


def with_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with `__first` (smallest id among the rows of the same text) and `__rows`, null for single texts."""
    side = copies(docs, id_col, text_col).select(F.col("text_key").alias("__k"), F.col("first_id").alias("__first"), F.col("n_rows").alias("__rows"))
    return attach_small(docs, side, text_key(text_col) == F.col("__k"), name="copies").drop("__k")
