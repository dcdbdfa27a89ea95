"""Profiling and data-quality reports.

Reports that need only counts, extremes or moments are one wide aggregate (one row per input
partition is shuffled). Reports that need levels go through `value_counts`, which combines equal
values map-side and then shuffles on (column, value), so no level lands on one task with its rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.functions.joins import null_safe_join
from tabwright.functions.order import exact_quantiles, rank_counted, rank_levels, value_counts, wide_quantiles


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def _per_column(df: DataFrame, cols: Sequence[str], measures: Mapping[str, object]) -> DataFrame:
    """One wide aggregate, then one row per column: `measures` maps name -> fn(column name)."""
    row = F.array(
        *[F.struct(F.lit(c).alias("column"), *[fn(c).alias(n) for n, fn in measures.items()]) for c in cols]
    )
    return df.agg(row.alias("r")).select(F.inline("r"))


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows")).withColumn("n_cols", F.lit(len(df.columns)))


def schema_report(df: DataFrame) -> DataFrame:
    types = F.create_map(*[F.lit(x) for pair in df.dtypes for x in pair])
    counts = _per_column(df, df.columns, {"non_null": F.count})
    return counts.withColumn("type", F.element_at(types, F.col("column")))


def duplicate_rows(df: DataFrame, key: Sequence[str] = ()) -> DataFrame:
    """Rows equal to an earlier row over everything but the key; null equals null."""
    cols = [c for c in df.columns if c not in key]
    groups = df.groupBy(*cols).agg(F.count("*").alias("c"))
    return groups.agg(
        F.coalesce(F.sum(F.col("c") - 1), F.lit(0)).alias("duplicates"), F.count("*").alias("distinct_rows")
    )


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    groups = df.groupBy(*key).agg(F.count("*").alias("c"))
    return groups.agg(
        F.coalesce(F.sum("c"), F.lit(0)).alias("n_rows"),
        F.count("*").alias("n_keys"),
        F.coalesce(F.sum(F.col("c") - 1), F.lit(0)).alias("surplus"),
    )


def missing(df: DataFrame) -> DataFrame:
    """Columns with nulls: count and percentage, highest first."""
    report = _per_column(
        df, df.columns, {"n_missing": lambda c: F.count_if(F.col(c).isNull()), "n": lambda c: F.count("*")}
    )
    return (
        report.filter(F.col("n_missing") > 0)
        .select("column", "n_missing", F.round(100 * F.col("n_missing") / F.col("n"), 4).alias("pct"))
        .orderBy(F.desc("pct"), "column")
    )


def missing_pattern(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows per joint null pattern; the mask has one character per column, 1 = null."""
    mask = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in cols])
    width = len(cols)
    return (
        df.select(mask.alias("mask")).groupBy("mask").agg(F.count("*").alias("n"))
        .withColumn("kind", F.when(~F.col("mask").contains("1"), "none")
                    .when(F.col("mask") == "1" * width, "all").otherwise("some"))
    )


def level_summary(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Per column: distinct non-null values, null count, most frequent value and its count."""
    cols = list(cols or df.columns)
    counts = value_counts(df, cols, nulls=True)
    best = F.min(F.when(F.col("value").isNotNull(), F.struct((-F.col("cnt")).alias("m"), F.col("value").alias("v"))))
    return counts.groupBy("column").agg(
        F.count("value").alias("n_levels"),
        F.sum("cnt").alias("n"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("cnt"))), F.lit(0)).alias("n_null"),
        best.alias("b"),
    ).select("column", "n_levels", "n", "n_null", F.col("b.v").alias("top"), (-F.col("b.m")).alias("freq"))


def constant_columns(df: DataFrame) -> DataFrame:
    return level_summary(df).filter(F.col("n_levels") <= 1).select("column", "n_levels")


def mixed_types(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """String columns: how many values read as a number, how many do not, and whether both occur."""
    cols = list(cols or string_columns(df))
    num = lambda c: F.count(F.expr(f"try_cast(`{c}` as double)"))
    report = _per_column(df, cols, {"n_numeric": num, "n_values": F.count})
    return report.select(
        "column", "n_numeric", (F.col("n_values") - F.col("n_numeric")).alias("n_text"),
        ((F.col("n_numeric") > 0) & (F.col("n_numeric") < F.col("n_values"))).alias("mixed"),
    )


def negative_columns(df: DataFrame) -> DataFrame:
    report = _per_column(df, numeric_columns(df), {
        "n_negative": lambda c: F.count_if(F.col(c) < 0), "lowest": lambda c: F.min(F.col(c).cast("double"))})
    return report.filter(F.col("n_negative") > 0)


def levels(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row per distinct non-null numeric value, its 1-based position and a whole-number flag.

    Long form on purpose: the number of levels of a column is not bounded, an array would be.
    """
    counts = value_counts(df, cols)
    number = F.col("value").cast("double")
    return counts.select("column", number.alias("level"), "cnt", (number == F.floor(number)).alias("whole"))


def level_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """`(column, position, number, level)`: every distinct value at its 1-based place in its column's order.

    Numbers are in number order (`level` null), strings in code point order (`number` null). Places come
    from bucket offsets, so a column may have any number of levels.
    """
    numbers = [c for c in cols if c in numeric_columns(df)]
    strings = [c for c in cols if c not in numbers]
    parts = []
    if numbers:
        distinct = value_counts(df, numbers).select("column", F.col("value").cast("double").alias("value")).distinct().withColumn("cnt", F.lit(1).cast("bigint"))
        parts.append(rank_counted(distinct).select("column", (F.col("before") + 1).cast("bigint").alias("position"), F.col("value").alias("number"), F.lit(None).cast("string").alias("level")))
    if strings:
        distinct = value_counts(df, strings).select("column", F.col("value").alias("level"))
        parts.append(rank_levels(distinct).select("column", (F.col("code") + 1).cast("bigint").alias("position"), F.lit(None).cast("double").alias("number"), "level"))
    return reduce(DataFrame.unionByName, parts)


def case_variants(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Distinct values against distinct lower-cased values, per string column."""
    counts = value_counts(df, list(cols or string_columns(df)))
    lowered = counts.groupBy("column", F.lower("value").alias("low")).agg(F.count("*").alias("spellings"))
    return lowered.groupBy("column").agg(
        F.sum("spellings").alias("n_levels"), F.count("*").alias("n_lower"),
        F.max(F.col("spellings") > 1).alias("case_variants"),
    )


def rule_violations(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows that break each cross-column rule; one pass for all rules."""
    row = F.array(*[F.struct(F.lit(n).alias("rule"), F.count_if(c).alias("n_rows")) for n, c in rules.items()])
    return df.agg(row.alias("r")).select(F.inline("r"))


def describe_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    d = lambda c: F.col(c).cast("double")
    basic = _per_column(df, cols, {
        "n": F.count, "mean": lambda c: F.avg(d(c)), "std": lambda c: F.stddev_samp(d(c)),
        "min": lambda c: F.min(d(c)), "max": lambda c: F.max(d(c))})
    quart = wide_quantiles(exact_quantiles(df, cols, [0.25, 0.5, 0.75]), {0.25: "q25", 0.5: "q50", 0.75: "q75"}, ["column"])
    return basic.join(quart, "column", "left")


def describe_categorical(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return level_summary(df, cols).select(
        "column", (F.col("n") - F.col("n_null")).alias("count"), F.col("n_levels").alias("unique"), "top", "freq")


def frequency(df: DataFrame, cols: Sequence[str], nulls: bool = False) -> DataFrame:
    """Value counts and share per column. Totals are per column: one row each."""
    counts = value_counts(df, cols, nulls=nulls)
    totals = counts.groupBy("column").agg(F.sum("cnt").alias("total"))
    return counts.join(totals, "column").select(
        "column", "value", "cnt", (F.col("cnt") / F.col("total")).alias("share"))


def group_stat(df: DataFrame, group: str, target: str) -> DataFrame:
    """Mean, median and row count of the target per group."""
    med = exact_quantiles(df.withColumn("y", F.col(target)), ["y"], [0.5], by=[group]).select(
        group, F.col("value").alias("median"))
    base = df.groupBy(group).agg(F.avg(target).alias("mean"), F.count(target).alias("n"))
    return null_safe_join(base, med, [group], "left").orderBy("median")


def extremes(df: DataFrame, key: str, col: str, n: int) -> DataFrame:
    """The n lowest and n highest standardised values (population deviation), ties by key; null if the column is constant."""
    stats = df.agg(F.avg(col).alias("m"), F.stddev_pop(col).alias("s"))
    present = df.filter(F.col(col).isNotNull())
    low = present.orderBy(col, key).limit(n).withColumn("tail", F.lit("low"))
    high = present.orderBy(F.desc(col), key).limit(n).withColumn("tail", F.lit("high"))
    # 2n rows against one row of moments
    both = low.unionByName(high).select(key, col, "tail").withColumn("one", F.lit(1))
    return both.join(F.broadcast(stats.withColumn("one", F.lit(1))), "one").select(
        key, "tail", F.try_divide(F.col(col) - F.col("m"), F.col("s")).alias("z"))


def top_rows(df: DataFrame, col: str, key: str, n: int) -> DataFrame:
    return df.orderBy(F.desc_nulls_last(col), key).limit(n)


def lookup_rows(df: DataFrame, key: str, values: Sequence) -> DataFrame:
    return df.filter(F.col(key).isin(list(values)))
