"""Hold-out splits, folds and samples that depend on row keys only, never on row order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.functions.joins import attach
from tabwright.functions.order import hash_key, hash_order, value_order


def _with_total(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    total = df.groupBy(*by).agg(F.count("*").alias("__total"))
    if by:
        return attach(df, total, list(by), name="totals")
    one = F.broadcast(total.withColumn("__one", F.lit(1)))  # a single row
    return df.withColumn("__one", F.lit(1)).join(one, "__one").drop("__one")


def holdout(df: DataFrame, key: str, share: float, seed: int = 42, out: str = "part") -> DataFrame:
    """Exactly ceil(share * n) rows marked 'val', the rest 'fit'."""
    placed = _with_total(hash_order(df, key, seed, "__rn"))
    part = F.when(F.col("__rn") <= F.ceil(F.col("__total") * share), "val").otherwise("fit")
    return placed.withColumn(out, part).drop("__rn", "__total")


def hash_number(key: str, seed: int) -> Column:
    """The first 32 bits of `md5(seed:key)` as a number."""
    return F.conv(F.substring(hash_key(key, seed), 1, 8), 16, 10).cast("bigint")


def holdout_hash(df: DataFrame, key: str, share: float, seed: int = 42, out: str = "part") -> DataFrame:
    """About `share` of the rows marked 'val' by hash value: no shuffle at all."""
    return df.withColumn(out, F.when(hash_number(key, seed) < int(share * 2**32), "val").otherwise("fit"))


def kfold(df: DataFrame, key: str, k: int, seed: int = 42, out: str = "fold") -> DataFrame:
    """Shuffled folds whose sizes differ by one at most."""
    placed = hash_order(df, key, seed, "__rn")
    return placed.withColumn(out, F.pmod(F.col("__rn") - 1, F.lit(k)).cast("int")).drop("__rn")


def kfold_hash(df: DataFrame, key: str, k: int, seed: int = 42, out: str = "fold") -> DataFrame:
    """Folds of about equal size by hash value: no shuffle, and a row keeps its fold when others come."""
    return df.withColumn(out, F.pmod(hash_number(key, seed + 1), F.lit(k)).cast("int"))


def _tile(position: Column, total: Column, k: int) -> Column:
    """Tile of a 0-based position when `total` rows are cut into k runs, longer runs first."""
    size, extra = F.floor(total / k), total % k
    edge = extra * (size + 1)
    return F.when(position < edge, F.floor(position / (size + 1))).otherwise(extra + F.floor((position - edge) / size)).cast("int")


def contiguous(df: DataFrame, key: str, k: int, out: str = "fold") -> DataFrame:
    """Unshuffled folds: consecutive runs of the key order."""
    placed = _with_total(value_order(df, key, "__rn"))
    return placed.withColumn(out, _tile(F.col("__rn") - 1, F.col("__total"), k)).drop("__rn", "__total")


def stratified(df: DataFrame, key: str, stratum: str, k: int, seed: int = 42, out: str = "fold") -> DataFrame:
    """Folds that cut every stratum evenly."""
    placed = _with_total(hash_order(df, key, seed, "__rn", by=[stratum]), [stratum])
    return placed.withColumn(out, _tile(F.col("__rn") - 1, F.col("__total"), k)).drop("__rn", "__total")


def sample_rows(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    return df.withColumn("__h", hash_key(key, seed)).orderBy("__h", key).limit(n).drop("__h")


