"""Column and row selection, the feature registry, alignment joins and unions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.functions.joins import measured
from tabwright.functions.order import value_counts
from tabwright.operators.profile import level_summary, missing, numeric_columns, string_columns


@dataclass(frozen=True)
class Registry:
    """Which role every predictor column plays; carried beside the frame."""

    continuous: tuple[str, ...] = ()
    categorical: tuple[str, ...] = ()
    ordinal: tuple[str, ...] = ()
    aside: tuple[str, ...] = field(default=(), compare=False)  # key, split, target: not predictors

    @property
    def columns(self) -> tuple[str, ...]:
        return self.continuous + self.categorical + self.ordinal

    def without(self, cols: Sequence[str]) -> Registry:
        keep = lambda names: tuple(c for c in names if c not in cols)
        return replace(self, continuous=keep(self.continuous), categorical=keep(self.categorical),
                       ordinal=keep(self.ordinal))

    def plus_continuous(self, cols: Sequence[str]) -> Registry:
        return replace(self, continuous=self.continuous + tuple(c for c in cols if c not in self.columns))

    def verify(self, df: DataFrame) -> None:
        present = set(df.columns) - set(self.aside)
        listed = set(self.columns)
        if present - listed:
            raise ValueError(f"columns without a role: {sorted(present - listed)}")
        if listed - present:
            raise ValueError(f"registered columns not in the frame: {sorted(listed - present)}")

    def as_frame(self, spark) -> DataFrame:
        rows = [(g, c) for g in ("continuous", "categorical", "ordinal") for c in getattr(self, g)]
        return spark.createDataFrame(rows, "feature_group string, column string")


def feature_groups(df: DataFrame, ordinal: Sequence[str], aside: Sequence[str]) -> Registry:
    """Numeric columns are continuous and strings categorical unless listed as ordinal."""
    ords = tuple(c for c in ordinal if c in df.columns)
    skip = set(ords) | set(aside)
    return Registry(
        continuous=tuple(c for c in numeric_columns(df) if c not in skip),
        categorical=tuple(c for c in string_columns(df) if c not in skip),
        ordinal=ords,
        aside=tuple(aside),
    )


def columns_by_class(df: DataFrame, kind: str) -> DataFrame:
    """Projection on one type class: numeric, integer, fractional or string."""
    classes = {"numeric": T.NumericType, "integer": T.IntegralType, "fractional": T.FractionalType, "string": T.StringType}
    return df.select(*[f.name for f in df.schema if isinstance(f.dataType, classes[kind])])


def near_constant(
    df: DataFrame, threshold: float, null_is_value: bool = True, share_of_rows: bool = False
) -> DataFrame:
    """Columns whose most frequent value has a share strictly above `threshold`.

    `null_is_value` counts missing as a value. Otherwise the mode skips nulls, and the share is
    taken over non-null rows, or over all rows with `share_of_rows`.
    """
    s = level_summary(df)
    top = F.coalesce("freq", F.lit(0))
    if null_is_value:
        top, base = F.greatest(top, F.col("n_null")), F.col("n")
    elif share_of_rows:
        base = F.col("n")
    else:
        base = F.col("n") - F.col("n_null")
    return s.select("column", (top / F.nullif(base, F.lit(0))).alias("share")).filter(F.col("share") > threshold)


def drop_listed(df: DataFrame, report: DataFrame) -> DataFrame:
    """Drop the columns named in a per-column report (one row per column at most)."""
    return df.drop(*[r["column"] for r in report.select("column").collect()])


def drop_high_missing(df: DataFrame, more_than: int, then_complete: Sequence[str]) -> DataFrame:
    """Drop columns with more than `more_than` nulls, then rows null in the listed columns."""
    wide = missing(df).filter(F.col("n_missing") > more_than)
    kept = drop_listed(df, wide)
    return kept.dropna(subset=[c for c in then_complete if c in kept.columns])


def rare_levels(df: DataFrame, cols: Sequence[str], split: str, min_train: int) -> DataFrame:
    """Indicator columns to drop: level absent from test, absent from train, or rare in train.

    Counted on the un-encoded columns, so no indicator column has to exist.
    """
    counts = value_counts(df, cols, keep=[split])
    side = lambda s: F.coalesce(F.sum(F.when(F.col(split) == s, F.col("cnt"))), F.lit(0))
    per = counts.groupBy("column", "value").agg(side("train").alias("n_train"), side("test").alias("n_test"))
    reason = (
        F.when(F.col("n_test") == 0, "absent in test")
        .when(F.col("n_train") == 0, "absent in train")
        .when(F.col("n_train") < min_train, "rare in train")
    )
    return per.withColumn("reason", reason).filter(F.col("reason").isNotNull())


def outlier_flag(df: DataFrame, thresholds: Mapping[str, float]) -> Column:
    """Any listed column above its threshold. A null compares false; absent columns are skipped."""
    tests = [F.coalesce(F.col(c) > t, F.lit(False)) for c, t in thresholds.items() if c in df.columns]
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def outlier_keys(df: DataFrame, key: str, thresholds: Mapping[str, float]) -> DataFrame:
    return df.filter(outlier_flag(df, thresholds)).select(key)


def drop_train_outliers(df: DataFrame, raw: DataFrame, key: str, thresholds: Mapping[str, float]) -> DataFrame:
    """Remove rows flagged on the raw columns from the training part only."""
    flagged = outlier_keys(raw.filter(F.col("split") == "train"), key, thresholds)
    return df.join(flagged, key, "left_anti")


def drop_keys(df: DataFrame, key: str, values: Sequence) -> DataFrame:
    return df.filter(~F.col(key).isin(list(values)))


def clip_floor(col: str | Column, low: float = 1.0) -> Column:
    value = F.col(col) if isinstance(col, str) else col
    return F.when(value.isNotNull(), F.greatest(value, F.lit(low)))


def align(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Column-wise concat by row key."""
    return left.join(right, key)


def rows_in(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return df.join(keys.select(key), key, "left_semi")


def rows_not_in(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return df.join(keys.select(key), key, "left_anti")


def lookup(df: DataFrame, params: DataFrame, key: str, value: str, fallback: Column, out: str) -> DataFrame:
    """Map a key to a learned statistic; a null or unseen key takes the fallback.

    The lookup is written and counted first: broadcast when small, else joined by shuffle with hot
    keys split at run time.
    """
    params, small = measured(params)
    side = params.select(F.col(key).alias("__k"), F.col(value).alias("__v")).filter(F.col("__k").isNotNull())
    return (
        df.join(F.broadcast(side) if small else side, F.col(key) == F.col("__k"), "left")
        .withColumn(out, F.coalesce("__v", fallback))
        .drop("__k", "__v")
    )


def stack(train: DataFrame, test: DataFrame) -> DataFrame:
    """Train on test by column name; columns of one side only become null on the other."""
    return train.unionByName(test, allowMissingColumns=True)


def average_predictions(frames: Sequence[DataFrame], weights: Sequence[float], key: str, value: str) -> DataFrame:
    """Weighted mean of several prediction tables, matched by key.

    One union and one aggregate instead of a chain of joins: a single shuffle for any number of
    tables. A key missing from a table fails the count check and is left out, as in an inner join.
    """
    tagged = [f.select(key, (F.col(value) * w).alias("__p")) for f, w in zip(frames, weights)]
    both = reduce(DataFrame.unionByName, tagged)
    return (
        both.groupBy(key)
        .agg(F.sum("__p").alias(value), F.count("*").alias("__n"))
        .filter(F.col("__n") == len(frames))
        .drop("__n")
    )


