"""Indicator codes for factors of any width: rows carry the indices of their levels, looked up in a written table.

`operators/learned.py` makes one column per level, which suits a few levels. Here a level is a
row of a table, so neither a plan nor a row grows with their number.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.functions import joins
from tabwright.functions.joins import null_safe_join
from tabwright.functions.order import rank_levels, value_counts
from tabwright.session import materialize

ENTRY = "array<struct<index:long,value:double>>"


class LevelCodes:
    """`(column, level, index, cnt)`: levels of each column in order, columns one after another."""

    def __init__(self, table: DataFrame, cols: Sequence[str]) -> None:
        self.table, self.cols = table, list(cols)
        # one row per column: how many levels it has, where they begin, and what a broadcast would take
        size = F.octet_length("level") + 40
        found = {r["column"]: r for r in table.groupBy("column").agg(F.count("*").alias("n"), F.min("index").alias("start"), F.sum(size).alias("bytes")).collect()}
        self.sizes = {c: found[c]["n"] if c in found else 0 for c in self.cols}
        self.bytes = {c: found[c]["bytes"] if c in found else 0 for c in self.cols}
        self.start, at = {}, 0
        for c in self.cols:
            self.start[c] = at
            at += self.sizes[c]
        self.width = at

    @classmethod
    def fit(cls, df: DataFrame, cols: Sequence[str]) -> LevelCodes:
        """Indices by column in the given order, then by level in byte order; a null is no level."""
        counts = value_counts(df, cols).withColumnRenamed("value", "level")
        ranked = rank_levels(materialize(counts, "levels"))
        totals = {r["column"]: r["n"] for r in ranked.groupBy("column").agg(F.count("*").alias("n")).collect()}
        start, at = [], 0
        for c in cols:
            start.append((c, at))
            at += totals.get(c, 0)
        starts = df.sparkSession.createDataFrame(start, "column string, __start long")
        placed = null_safe_join(ranked, F.broadcast(starts), ["column"])  # one row per column
        return cls(materialize(placed.select("column", "level", (F.col("__start") + F.col("code")).alias("index"), "cnt"), "codes"), cols)

    def save(self, path: str) -> None:
        self.table.write.mode("overwrite").parquet(f"{path}/levels")

    @classmethod
    def load(cls, spark, path: str, cols: Sequence[str]) -> LevelCodes:
        return cls(spark.read.parquet(f"{path}/levels"), cols)

    def attach(self, df: DataFrame, suffix: str = "_index") -> DataFrame:
        """`df` with the index of each column's level (null for null and unseen levels).

        A column's levels are broadcast if their counted bytes allow; otherwise the rows meet them by a shuffle,
        where the adaptive skew join splits a level that holds many rows.
        """
        for c in self.cols:
            side = self.table.filter(F.col("column") == c).select(F.col("level").alias("__level"), F.col("index").alias(f"{c}{suffix}"))
            side = F.broadcast(side) if self.bytes[c] <= joins.BROADCAST_BYTES else side
            df = df.join(side, F.col(c).cast("string") == F.col("__level"), "left").drop("__level")
        return df

    def entries(self, df: DataFrame, out: str = "codes", drop_first: bool = False) -> DataFrame:
        """`df` with `out`: the row's (index, 1.0) entries in index order.

        `drop_first` leaves out the first level of every factor but the first, as reference codes do;
        the indices of the other levels stay as they are.
        """
        coded = self.attach(df, "__index")
        found = [F.col(f"{c}__index") for c in self.cols]
        if drop_first:
            found = [x if i == 0 else F.when(x != self.start[c], x) for i, (c, x) in enumerate(zip(self.cols, found))]
        cells = F.filter(F.array(*found), lambda x: x.isNotNull()) if found else F.array().cast("array<long>")
        made = F.transform(F.sort_array(cells), lambda x: F.struct(x.alias("index"), F.lit(1.0).alias("value"))).cast(ENTRY)
        return coded.withColumn(out, made).drop(*[f"{c}__index" for c in self.cols])
