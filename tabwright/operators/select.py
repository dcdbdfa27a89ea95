"""Feature scores and filters. Every score is a closed form over one aggregate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabwright.functions.joins import attach
from tabwright.functions.order import CELL, exact_quantiles, melt_numeric, rank_counted
from tabwright.operators.stats import correlation_pairs, correlation_with
from tabwright.session import materialize

STRIDE = 4096  # distinct values per range of the neighbour search


def variances(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    row = F.array(*[F.struct(F.lit(c).alias("column"), F.var_pop(F.col(c).cast("double")).alias("variance")) for c in cols])
    return df.agg(row.alias("a")).select(F.inline("a"))


def low_variance(df: DataFrame, cols: Sequence[str], threshold: float = 0.0) -> DataFrame:
    """Columns whose population variance does not exceed the threshold."""
    return variances(df, cols).filter(F.col("variance") <= threshold)


def element_variances(df: DataFrame, col: str) -> DataFrame:
    """Population variance per position of an array column."""
    long = df.select(F.posexplode(col).alias("position", "value"))
    return long.groupBy("position").agg(F.var_pop(F.col("value").cast("double")).alias("variance"))


def f_regression(df: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    """F statistic of the one-feature regression, ranked; null for a constant side and for a perfect fit."""
    s = correlation_with(df, cols, target)
    r2 = F.col("r") * F.col("r")
    return s.select("column", "n", "r", F.try_divide(r2 * (F.col("n") - 2), 1 - r2).alias("f")).orderBy(F.desc_nulls_last("f"), "column")


def target_bins(df: DataFrame, target: str, bins: int) -> DataFrame:
    """Adds `__bin`: the number of inner quantile edges below the target. Edges are `bins - 1` values."""
    q = exact_quantiles(df, [target], [i / bins for i in range(1, bins)])
    edges = q.agg(F.sort_array(F.collect_list("value")).alias("__e")).withColumn("__one", F.lit(1))
    rows = df.filter(F.col(target).isNotNull()).withColumn("__one", F.lit(1)).join(F.broadcast(edges), "__one")
    below = F.size(F.filter("__e", lambda e: e < F.col(target)))
    return rows.withColumn("__bin", below).drop("__e", "__one")


def mutual_information(df: DataFrame, cols: Sequence[str], target: str, bins: int = 10) -> DataFrame:
    """Plug-in mutual information (nats) of each discrete column with the binned target, ranked."""
    binned = target_bins(df, target, bins)
    strings = [F.col(c).cast("string").alias(c) for c in cols]
    return _mutual(binned.select("__bin", *strings), cols, "__bin")


def information_gain(df: DataFrame, cols: Sequence[str], label: str) -> DataFrame:
    """Entropy of the label less its entropy given the column (nats), ranked."""
    strings = [F.col(c).cast("string").alias(c) for c in cols]
    return _mutual(df.filter(F.col(label).isNotNull()).select(F.col(label).alias("__bin"), *strings), cols, "__bin")


def _mutual(df: DataFrame, cols: Sequence[str], label: str) -> DataFrame:
    cells = (
        df.unpivot([label], list(cols), "column", "level").filter(F.col("level").isNotNull())
        .groupBy("column", "level", label).agg(F.count("*").alias("c"))
    )
    n_x = cells.groupBy("column", "level").agg(F.sum("c").alias("nx"))
    n_y = cells.groupBy("column", label).agg(F.sum("c").alias("ny"))
    n = cells.groupBy("column").agg(F.sum("c").alias("n"))
    j = cells.join(n_x, ["column", "level"]).join(n_y, ["column", label]).join(n, "column")
    c, total = F.col("c"), F.col("n")
    return (
        j.groupBy("column")
        .agg(F.sum(c / total * F.log(c * total / (F.col("nx") * F.col("ny")))).alias("mi"))
        .orderBy(F.desc("mi"), "column")
    )


def digamma(n: Column) -> Column:
    """The digamma function of a positive number: five steps up, then the asymptotic series."""
    n = n.cast("double")
    x = n + 5
    tail = F.log(x) - 1 / (2 * x) - 1 / (12 * x**2) + 1 / (120 * x**4) - 1 / (252 * x**6) + 1 / (240 * x**8) - 1 / (132 * x**10)
    for i in range(5):
        tail = tail - 1 / (n + i)
    return tail


def neighbour_radii(values: DataFrame, by: Sequence[str], k: int, stride: int = STRIDE, cell: int = CELL) -> DataFrame:
    """`values` with `k` and `radius`: the distance of each value to the nearest `k` others of its `(by..., column)`.

    `values` are distinct values `(by..., column, value, cnt)`; other rows of the same value are at distance 0. Groups
    with fewer than k + 1 rows use all their rows, those with one row are left out. The values of a group are dealt by
    position to ranges of `stride`; each range borrows the k values beyond its borders, so a large group is many tasks.
    """
    stride = max(stride, k)
    keys = [*by, "column"]
    counted = materialize(values, "neighbours")
    places = rank_counted(counted.withColumn("cnt", F.lit(1).cast("long")), by, cell=cell).select(*keys, "value", F.col("before").alias("pos"))
    sizes = counted.groupBy(*keys).agg(F.sum("cnt").alias("rows")).filter("rows > 1")
    placed = places.join(counted.select(*keys, "value", "cnt"), [*keys, "value"])
    placed = attach(placed, sizes, keys, name="sizes").withColumn("k", F.least(F.lit(k), F.col("rows") - 1))
    home, at = F.floor(F.col("pos") / stride), F.col("pos") % stride
    lends = F.array_compact(F.array(home, F.when(at < k, home - 1), F.when(at >= stride - k, home + 1)))
    dealt = placed.withColumn("home", home).withColumn("range", F.explode(lends))
    w = W.partitionBy(*keys, "range").orderBy("value")
    near = [F.struct(F.lit(0.0).alias("d"), (F.col("cnt") - 1).alias("c"))]
    for step in range(1, k + 1):
        for there, sign in ((F.lag, 1), (F.lead, -1)):
            gap = (F.col("value") - there("value", step).over(w)) * sign
            near.append(F.when(gap.isNotNull(), F.struct(gap.alias("d"), there("cnt", step).over(w).alias("c"))))
    listed = dealt.withColumn("near", F.array_sort(F.array_compact(F.array(*near)))).filter(F.col("range") == F.col("home"))
    start = F.struct(F.lit(0).cast("long").alias("seen"), F.lit(0.0).alias("d"))
    reached = F.aggregate("near", start, lambda a, x: F.when(a["seen"] >= F.col("k"), a).otherwise(
        F.struct((a["seen"] + x["c"]).alias("seen"), x["d"].alias("d"))))
    return listed.select(*keys, "value", "cnt", "rows", "k", reached["d"].alias("radius"))


def mutual_information_neighbours(
    df: DataFrame, cols: Sequence[str], target: str, k: int = 3, stride: int = STRIDE, cell: int = CELL
) -> DataFrame:
    """Nearest-neighbour mutual information (nats) of each discrete column with a continuous target, ranked.

    Ross's estimator: each row's distance to its k-th neighbour among rows of its level, and the rows of any level that
    lie nearer (itself included; strictly between `value - radius` and `value + radius`, or equal at radius 0).
    Rows without a level or a finite target and levels of one row take no part; no negative estimates; a column without
    rows gives none. Nothing is drawn at random: ties stay ties. Neighbours come from ranges with borrowed borders, rows
    within a radius from the running sums of one value order in which each interval's ends stand among the values.
    """
    parts = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("level"), F.col(target).cast("double").alias("value")) for c in cols]
    finite = F.abs("value") < float("inf")  # a NaN is the largest number
    long = df.select(F.inline(F.array(*parts))).filter(F.col("level").isNotNull() & finite)
    counted = long.groupBy("column", "level", "value").agg(F.count("*").alias("cnt"))
    points = materialize(neighbour_radii(counted, ["level"], k, stride, cell), "radii")
    low, high = F.col("value") - F.col("radius"), F.col("value") + F.col("radius")
    ends = points.select("column", F.explode(F.array(low, high)).alias("value"), F.lit(0).cast("long").alias("cnt"))
    line = points.select("column", "value", "cnt").union(ends).groupBy("column", "value").agg(F.sum("cnt").alias("cnt"))
    sums = materialize(rank_counted(line, cell=cell).select("column", "value", "before", (F.col("before") + F.col("cnt")).alias("upto")), "sums")
    below = sums.select("column", F.col("value").alias("low"), F.col("before").alias("lt"), F.col("upto").alias("le"))
    above = sums.select("column", F.col("value").alias("high"), F.col("before").alias("ht"), F.col("upto").alias("he"))
    met = points.withColumns({"low": low, "high": high}).join(below, ["column", "low"]).join(above, ["column", "high"])
    inside = F.when(F.col("radius") > 0, F.col("ht") - F.col("le")).otherwise(F.col("he") - F.col("lt"))
    term = F.col("cnt") * (digamma(F.col("k")) - digamma(F.col("rows")) - digamma(inside))
    return (
        met.groupBy("column").agg(F.sum(term).alias("s"), F.sum("cnt").alias("n"))
        .select("column", F.greatest(F.lit(0.0), digamma(F.col("n")) + F.col("s") / F.col("n")).alias("mi"))
        .orderBy(F.desc("mi"), "column")
    )


def chi2(df: DataFrame, cols: Sequence[str], label: str) -> DataFrame:
    """Chi-squared of class sums of non-negative features against class shares, ranked; null for a feature that is all zero."""
    rows = df.filter(F.col(label).isNotNull())
    per = rows.groupBy(label).agg(F.count("*").alias("n"), *[F.sum(F.col(c).cast("double")).alias(c) for c in cols])
    long = per.unpivot([label, "n"], list(cols), "column", "observed")
    w = W.partitionBy("column")  # one row per class
    expected = F.try_divide(F.sum("observed").over(w) * F.col("n"), F.sum("n").over(w))
    gap = F.col("observed") - F.col("expected")
    return (
        long.withColumn("expected", expected).groupBy("column")
        .agg(F.sum(F.try_divide(gap * gap, F.col("expected"))).alias("chi2")).orderBy(F.desc_nulls_last("chi2"), "column")
    )


def top_k(scores: DataFrame, score: str, k: int) -> DataFrame:
    return scores.orderBy(F.desc_nulls_last(score), "column").limit(k)


def top_percent(scores: DataFrame, score: str, percent: float) -> DataFrame:
    """Features above the (100 - p)th percentile of the scores; ties at the edge fill up to p percent.

    The score table has one row per feature.
    """
    cut = scores.agg(F.percentile(score, 1 - percent / 100).alias("cut"), F.count("*").alias("n")).withColumn("one", F.lit(1))
    ranked = scores.withColumn("rank", F.row_number().over(W.orderBy(F.desc(score), "column"))).withColumn("one", F.lit(1))
    room = F.floor(F.col("n") * percent / 100)
    return ranked.join(F.broadcast(cut), "one").filter(
        (F.col(score) > F.col("cut")) | ((F.col(score) == F.col("cut")) & (F.col("rank") <= room))).select("column", score)


def anova_f(df: DataFrame, cols: Sequence[str], label: str) -> DataFrame:
    """One-way analysis of variance: F of each numeric feature over the classes; null for one class or no spread within."""
    long = melt_numeric(df.filter(F.col(label).isNotNull()), cols, [label])
    per = long.groupBy("column", label).agg(
        F.count("*").cast("double").alias("n"), F.avg("value").alias("m"), F.var_pop("value").alias("v"))
    n, m, v = F.col("n"), F.col("m"), F.col("v")
    whole = per.groupBy("column").agg((F.sum(n * m) / F.sum(n)).alias("gm"))
    between, within = F.sum(n * (m - F.col("gm")) * (m - F.col("gm"))), F.sum(n * v)
    return per.join(whole, "column").groupBy("column").agg(
        F.try_divide(F.try_divide(between, F.count("*") - 1), F.try_divide(within, F.sum(n) - F.count("*"))).alias("f")).orderBy(F.desc_nulls_last("f"), "column")


def correlated_columns(df: DataFrame, cols: Sequence[str], threshold: float, signed: bool = False) -> DataFrame:
    """Later columns correlated above the threshold with any earlier one."""
    r = F.col("r") if signed else F.abs("r")
    return (
        correlation_pairs(df, cols).filter(r > threshold)
        .groupBy(F.col("right").alias("column")).agg(F.min("i").alias("first_match"))
    )


def array_width(df: DataFrame, col: str) -> int:
    """Length of the longest array of the column, over all rows."""
    return df.agg(F.max(F.size(col))).first()[0] or 0


def array_columns(df: DataFrame, col: str, width: int | None = None, prefix: str = "e") -> DataFrame:
    """One double column per array position, up to the longest array unless a width is given; shorter arrays give nulls."""
    if width is None:
        width = array_width(df, col)
    return df.select(*[F.get(col, F.lit(i)).cast("double").alias(f"{prefix}{i}") for i in range(width)])
