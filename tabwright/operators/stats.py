"""Statistics and the tables behind exploratory charts."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabwright.functions.joins import attach
from tabwright.functions.order import (
    exact_quantiles, hash_key, melt_numeric, rank_counted, rank_values, value_counts, wide_quantiles,
)
from tabwright.functions.scalar import normal_cdf, polynomial, with_normal_quantile
from tabwright.session import few_tasks, materialize


def safe_corr(x: str, y: str) -> Column:
    """Pearson r over the rows where both are present; null for fewer than two rows or a constant side."""
    a, b = F.col(x).cast("double"), F.col(y).cast("double")
    a, b = F.when(b.isNotNull(), a), F.when(a.isNotNull(), b)
    spread = F.var_pop(a) * F.var_pop(b)
    return F.when(spread > 0, F.try_divide(F.covar_pop(a, b), F.sqrt(F.nullif(spread, F.lit(0.0)))))


def moments(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Per column: n, population skewness g1 and excess kurtosis g2, and the bias-corrected G1, G2."""
    d = lambda c: F.col(c).cast("double")
    row = F.array(*[
        F.struct(F.lit(c).alias("column"), F.count(c).cast("double").alias("n"), F.skewness(d(c)).alias("g1"),
                 F.kurtosis(d(c)).alias("g2")) for c in cols])
    n = F.col("n")
    return df.agg(row.alias("r")).select(F.inline("r")).select(
        "column", n.cast("bigint").alias("n"), "g1", "g2",
        F.when(n > 2, F.col("g1") * F.sqrt(n * (n - 1)) / (n - 2)).alias("skew"),
        F.when(n > 3, ((n + 1) * F.col("g2") + 6) * (n - 1) / ((n - 2) * (n - 3))).alias("kurt"),
    )


NARROW = 8  # columns whose pairs are plain aggregates of one generated stage


def pair_sums(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """`(i, j, n, xx, yy, xy)`: centred sums over the rows where both columns are present, for every pair i < j.

    One pass. Tasks multiply masked matrices around the means of their first batch and emit, per pair, their
    own means and centred sums; these are put together by the pairwise formula, which keeps their digits.
    """
    p = len(cols)
    left, right = np.triu_indices(p, 1)

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, center = None, None
        for batch in batches:
            x = batch.to_numpy(dtype="float64")
            if center is None and len(x):
                present = ~np.isnan(x)
                center = np.where(present, x, 0.0).sum(axis=0) / np.maximum(present.sum(axis=0), 1)
            x = x - center if len(x) else x
            seen = ~np.isnan(x)
            x = np.where(seen, x, 0.0)
            m = seen.astype("float64")
            part = np.stack([m.T @ m, x.T @ m, m.T @ x, (x * x).T @ m, m.T @ (x * x), x.T @ x])
            total = part if total is None else total + part
        if center is not None:
            n, sx, sy, xx, yy, xy = (t[left, right] for t in total)
            some = np.maximum(n, 1.0)
            yield pd.DataFrame({"i": left.astype("int32"), "j": right.astype("int32"), "n": n, "mx": center[left] + sx / some, "my": center[right] + sy / some,
                                "xx": xx - sx * sx / some, "yy": yy - sy * sy / some, "xy": xy - sx * sy / some})

    schema = "i int, j int, n double, mx double, my double, xx double, yy double, xy double"
    rows = few_tasks(df.select(*[F.col(c).cast("double").alias(c) for c in cols]))
    parts = rows.mapInPandas(partial, schema)
    w = W.partitionBy("i", "j")  # one row per task and pair
    n, c = F.col("n"), F.col
    whole = F.nullif(F.sum("n").over(w), F.lit(0.0))
    around = parts.withColumns({"gx": c("mx") - F.sum(n * c("mx")).over(w) / whole, "gy": c("my") - F.sum(n * c("my")).over(w) / whole})
    return around.groupBy("i", "j").agg(
        F.sum("n").alias("n"), F.sum(c("xx") + n * c("gx") * c("gx")).alias("xx"), F.sum(c("yy") + n * c("gy") * c("gy")).alias("yy"),
        F.sum(c("xy") + n * c("gx") * c("gy")).alias("xy"))


def correlation_pairs(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson r for every pair of columns, pairwise complete: `(i, j, left, right, n, r)`.

    r is null where a side is constant over the common rows or fewer than two rows have both. A few columns
    are aggregated in generated code; more are multiplied as matrices inside the tasks. Both read the rows once.
    """
    cols = list(cols)
    if 2 <= len(cols) <= NARROW:
        d = lambda c: F.col(c).cast("double")
        cells = [F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.lit(cols[i]).alias("left"), F.lit(cols[j]).alias("right"),
                          F.count_if(d(cols[i]).isNotNull() & d(cols[j]).isNotNull()).alias("n"), safe_corr(cols[i], cols[j]).alias("r"))
                 for i in range(len(cols)) for j in range(i + 1, len(cols))]
        return df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))
    names, c = F.array(*[F.lit(x) for x in cols]), F.col
    sums = pair_sums(df, cols)
    r = F.when((c("n") > 1) & (c("xx") > 0) & (c("yy") > 0), c("xy") / F.sqrt("xx") / F.sqrt("yy"))
    # what rounding leaves of a constant column is not a spread: its parts have no sum of their own in any task
    return sums.select("i", "j", F.get(names, c("i")).alias("left"), F.get(names, c("j")).alias("right"), c("n").cast("bigint").alias("n"), r.alias("r"))


def correlation_with(df: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    row = F.array(*[F.struct(F.lit(c).alias("column"), safe_corr(c, target).alias("r"),
                             F.count_if(F.col(c).isNotNull() & F.col(target).isNotNull()).alias("n")) for c in cols])
    return df.agg(row.alias("a")).select(F.inline("a"))


def average_ranks(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """`(column, value, cnt, avg_rank)`; tied values share their mean rank."""
    return rank_values(df, cols).withColumn("avg_rank", F.col("before") + (F.col("cnt") + 1) / 2)


def spearman(df: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    """Rank correlation of each column with the target over the rows where both are present.

    Rows are first reduced to distinct (column, x, y) cells with counts, then each side picks up its
    ranks by value. A column with few distinct values has a small rank table, which is broadcast;
    otherwise a value with very many partners is split at run time by the adaptive skew join.
    """
    pairs = df.filter(F.col(target).isNotNull()).select(
        F.col(target).cast("double").alias("y"), *[F.col(c).cast("double").alias(c) for c in cols])
    cells = (
        pairs.unpivot(["y"], list(cols), "column", "x").filter(F.col("x").isNotNull())
        .groupBy("column", "x", "y").agg(F.count("*").alias("c"))
    )
    cells = materialize(cells, "pairs")  # read by both rankings and by the sums
    x_ranks = _ranks_of(cells, "x")
    y_ranks = _ranks_of(cells, "y")
    joined = attach(attach(cells, x_ranks, ["column", "x"], name="ranks"), y_ranks, ["column", "y"], name="ranks")
    c, x, y = F.col("c"), F.col("rank_x"), F.col("rank_y")
    half = (F.col("total") + 1) / 2  # mean rank, ties included
    dx, dy = x - half, y - half
    return joined.groupBy("column").agg(
        F.sum("c").alias("n"),
        F.try_divide(F.sum(c * dx * dy), F.sqrt(F.sum(c * dx * dx) * F.sum(c * dy * dy))).alias("rho"))


def _ranks_of(cells: DataFrame, axis: str) -> DataFrame:
    values = cells.groupBy("column", F.col(axis).alias("value")).agg(F.sum("c").alias("cnt"))
    ranked = rank_counted(values)
    out = ranked.select("column", F.col("value").alias(axis), (F.col("before") + (F.col("cnt") + 1) / 2).alias(f"rank_{axis}"),
                        *(["total"] if axis == "x" else []))
    return out


def line_fit(df: DataFrame, x: str, y: str) -> DataFrame:
    """Least-squares line, its error and the error of the mean."""
    fx, fy = F.col(x).cast("double"), F.col(y).cast("double")
    return df.agg(
        F.regr_slope(fy, fx).alias("slope"), F.regr_intercept(fy, fx).alias("intercept"), F.regr_r2(fy, fx).alias("r2"),
        F.regr_syy(fy, fx).alias("sse_mean"),
    ).withColumn("sse_line", F.col("sse_mean") * (1 - F.col("r2")))


def line_residuals(df: DataFrame, key: str, x: str, y: str) -> DataFrame:
    """Fitted value and residual per row; the fit is one row, attached by a constant key."""
    fit = line_fit(df, x, y).select("slope", "intercept", F.lit(1).alias("__one"))
    rows = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull()).select(key, x, y, F.lit(1).alias("__one"))
    fitted = F.col("intercept") + F.col("slope") * F.col(x)
    return rows.join(F.broadcast(fit), "__one").select(key, fitted.alias("fitted"), (F.col(y) - fitted).alias("residual"))


def jarque_bera(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Normality from one pass of moments; the p-value of chi-squared with 2 degrees is exp(-jb/2)."""
    m = moments(df, cols)
    jb = F.col("n") / 6 * (F.col("g1") * F.col("g1") + F.col("g2") * F.col("g2") / 4)
    return m.select("column", "n", jb.alias("jb"), F.exp(-jb / 2).alias("p")).withColumn("normal", F.col("p") >= 0.01)


def kolmogorov_smirnov(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """`(column, n, d, p)`: largest distance between a column's distribution and the normal one of its mean and deviation.

    Exact ranks give both sides of every step, so the distance is a maximum over distinct values. p is the
    limit distribution's; with an estimated mean and deviation it is too large. A constant column gives nulls.
    """
    ranks = rank_values(df, cols)
    info = melt_numeric(df, cols).groupBy("column").agg(F.avg("value").alias("mean"), F.stddev_samp("value").alias("sd"))
    placed = attach(ranks, info, ["column"], name="moments")  # one row per column
    n = F.col("total").cast("double")
    placed = placed.withColumn("__z", F.try_divide(F.col("value") - F.col("mean"), F.nullif(F.col("sd"), F.lit(0.0)))).withColumn("__at", normal_cdf("__z"))
    at = F.col("__at")
    gap = F.when(at.isNotNull(), F.greatest(at - F.col("before") / n, (F.col("before") + F.col("cnt")) / n - at))
    out = placed.groupBy("column").agg(F.max("total").alias("n"), F.max(gap).alias("d"))
    x = F.col("d") * F.sqrt(F.col("n"))
    terms = [F.lit(2.0 * (-1) ** (i - 1)) * F.exp(-2.0 * i * i * x * x) for i in range(1, 31)]
    p = F.when(F.col("d").isNotNull(), F.when(x < 0.2, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), sum(terms, F.lit(0.0))))))
    return out.select("column", F.col("n").cast("bigint").alias("n"), "d", p.alias("p"))


# Polynomials of the W test (Royston, 1995), highest power first.
_ROYSTON = {
    "last": (-2.706056, 4.434685, -2.07119, -0.147981, 0.221157, 0.0),
    "next": (-3.582633, 5.682633, -1.752461, -0.293762, 0.042981, 0.0),
    "few_mean": (-6.714e-4, 0.025054, -0.39978, 0.544),
    "few_log_sd": (-0.0020322, 0.062767, -0.77857, 1.3822),
    "many_mean": (0.0038915, -0.083751, -0.31082, -1.5861),
    "many_log_sd": (0.0030302, -0.082676, -0.4803),
}
W_ROWS = 5000  # the weights are known up to this size


def shapiro_wilk(df: DataFrame, cols: Sequence[str], key: str, seed: int = 42) -> DataFrame:
    """`(column, n, w, p)` of the W test on the present values of a column; null below three rows or without spread.

    The test's weights are defined for at most 5,000 rows. Of a longer column the rows with the smallest
    hashes of their key are taken: the sample is part of the test, and a second run takes the same one.
    """
    parts = []
    for c in cols:
        one = melt_numeric(df.withColumn("__h", hash_key(key, seed)), [c], ["__h"])
        parts.append(one.orderBy("__h", "value").limit(W_ROWS).drop("__h"))
    long = reduce(DataFrame.unionByName, parts)
    # a few thousand rows per column: positions and sums are windows over one column each
    w = W.partitionBy("column")
    n, i = F.col("n").cast("double"), F.col("i").cast("double")
    placed = long.withColumns({"i": F.row_number().over(w.orderBy("value")), "n": F.count("*").over(w)})
    placed = with_normal_quantile(placed, (i - 0.375) / (n + 0.25), "m").withColumn("mm", F.sum(F.col("m") * F.col("m")).over(w))
    at = lambda place: F.max(F.when(i == place, F.col("m"))).over(w)
    placed = placed.withColumns({"m1": at(n), "m2": at(n - 1)})
    rsn, root = 1 / F.sqrt(n), F.sqrt("mm")
    a1 = F.when(n == 3, F.sqrt(F.lit(0.5))).otherwise(polynomial(_ROYSTON["last"], rsn) + F.col("m1") / root)
    placed = placed.withColumns({"a1": a1, "a2": polynomial(_ROYSTON["next"], rsn) + F.col("m2") / root})
    sq = lambda c: F.col(c) * F.col(c)
    two = F.try_divide(F.col("mm") - 2 * sq("m1") - 2 * sq("m2"), 1 - 2 * sq("a1") - 2 * sq("a2"))
    one = F.try_divide(F.col("mm") - 2 * sq("m1"), 1 - 2 * sq("a1"))
    inner = F.when(n == 3, F.lit(0.0)).otherwise(F.col("m") / F.sqrt(F.when(n > 5, two).otherwise(one)))
    weight = (F.when(i == n, F.col("a1")).when(i == 1, -F.col("a1"))
              .when((n > 5) & (i == n - 1), F.col("a2")).when((n > 5) & (i == 2), -F.col("a2")).otherwise(inner))
    sums = placed.groupBy("column").agg(
        F.max("n").alias("n"), F.sum(weight * F.col("value")).alias("b"), (F.var_pop("value") * F.count("*")).alias("ss"))
    ratio = F.try_divide(sq("b"), F.when((F.col("ss") > 0) & (F.col("n") >= 3), F.col("ss")))
    got = sums.select("column", F.col("n").cast("bigint").alias("n"), ratio.alias("w")).withColumn("w", F.when(F.col("w") > 1, 1.0).otherwise(F.col("w")))
    size, x = F.col("n").cast("double"), F.log(F.nullif(1 - F.col("w"), F.lit(0.0)))
    few = F.try_divide(-F.log(-2.273 + 0.459 * size - x) - polynomial(_ROYSTON["few_mean"], size), F.exp(polynomial(_ROYSTON["few_log_sd"], size)))
    many = F.try_divide(x - polynomial(_ROYSTON["many_mean"], F.log(size)), F.exp(polynomial(_ROYSTON["many_log_sd"], F.log(size))))
    three = 6 / np.pi * (F.asin(F.sqrt("w")) - F.asin(F.sqrt(F.lit(0.75))))
    got = got.withColumn("__z", F.when(size <= 11, few).otherwise(many))
    p = F.when(F.col("w").isNull(), None).when(F.col("w") >= 1, 1.0).when(size == 3, F.greatest(three, F.lit(0.0))).otherwise(1 - normal_cdf("__z"))
    return got.withColumn("p", p).drop("__z")


def qq_points(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Filliben order-statistic medians and normal quantiles, one row per run of equal values.

    `rank` is the last position of the run. Positions 1 and n use 0.5**(1/n).
    """
    r = rank_values(df, cols)
    n = F.col("total")
    rank = F.col("before") + F.col("cnt")
    p = (F.when(rank == n, F.pow(F.lit(0.5), 1 / n)).when(rank == 1, 1 - F.pow(F.lit(0.5), 1 / n))
         .otherwise((rank - 0.3175) / (n + 0.365)))
    points = r.select("column", "value", "cnt", rank.alias("rank"), p.cast("double").alias("position"))
    return with_normal_quantile(points, F.col("position"), "theoretical")


def qq_fit(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Line through all rows of the plot of values against normal quantiles, per column.

    A run of equal values counts with its length at the quantile of its mean position. Null where a column is constant.
    """
    r = rank_values(df, cols)
    n, c = F.col("total"), F.col("cnt").cast("double")
    middle = F.col("before") + (c + 1) / 2
    end = F.pow(F.lit(0.5), 1 / n)
    p = F.when((middle == n) & (c == 1), end).when((middle == 1) & (c == 1), 1 - end).otherwise((middle - 0.3175) / (n + 0.365))
    points = with_normal_quantile(r.select("column", "value", c.alias("w"), p.cast("double").alias("p")), F.col("p"), "z").drop("p")
    mean = points.groupBy("column").agg(F.sum("w").alias("n"), (F.sum(F.col("w") * F.col("value")) / F.sum("w")).alias("mv"),
                                        (F.sum(F.col("w") * F.col("z")) / F.sum("w")).alias("mz"))
    around = attach(points, mean, ["column"], name="means")  # one row per column
    w, v, z = F.col("w"), F.col("value") - F.col("mv"), F.col("z") - F.col("mz")
    sums = around.groupBy("column").agg(F.sum(w * v * z).alias("vz"), F.sum(w * z * z).alias("zz"), F.sum(w * v * v).alias("vv"),
                                        F.max("mv").alias("mv"), F.max("mz").alias("mz"))
    slope = F.when(F.col("vv") > 0, F.try_divide("vz", "zz"))
    return sums.select("column", slope.alias("slope"), (F.col("mv") - slope * F.col("mz")).alias("intercept"),
                       F.try_divide("vz", F.sqrt(F.nullif(F.col("vv") * F.col("zz"), F.lit(0.0)))).alias("r"))


def histogram(df: DataFrame, cols: Sequence[str], bins: int = 50) -> DataFrame:
    """Counts in equal bins between each column's extremes; the top edge belongs to the last bin."""
    long = melt_numeric(df, cols)
    limits = long.groupBy("column").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    width = (F.col("hi") - F.col("lo")) / bins
    bin_no = F.when(width > 0, F.least(F.floor((F.col("value") - F.col("lo")) / width), F.lit(bins - 1))).otherwise(0)
    return (
        long.join(F.broadcast(limits), "column")  # one row per column
        .withColumn("bin", bin_no.cast("int"))
        .groupBy("column", "bin").agg(F.count("*").alias("n"), F.max(F.col("lo") + F.col("bin") * width).alias("left_edge"))
    )


def histogram_width(df: DataFrame, col: str, width: float) -> DataFrame:
    return df.filter(F.col(col).isNotNull()).groupBy((F.floor(F.col(col) / width) * width).alias("left_edge")).agg(F.count("*").alias("n"))


def density_fit(df: DataFrame, col: str) -> DataFrame:
    """Normal and log-normal parameters by maximum likelihood, with the log-likelihood of each."""
    x = F.col(col).cast("double")
    lx = F.when(x > 0, F.log(x))
    m = df.agg(F.count(x).alias("n"), F.avg(x).alias("mu"), F.stddev_pop(x).alias("sigma"),
               F.count(lx).alias("n_pos"), F.avg(lx).alias("log_mu"), F.stddev_pop(lx).alias("log_sigma"))
    const = F.log(F.lit(2 * np.pi)) + 1
    ll = lambda s, n: -n / 2 * (const + 2 * F.log(s))
    return m.select(
        F.inline(F.array(
            F.struct(F.lit("normal").alias("family"), F.col("mu").alias("location"), F.col("sigma").alias("scale"),
                     ll(F.col("sigma"), F.col("n")).alias("log_likelihood")),
            F.struct(F.lit("lognormal").alias("family"), F.col("log_mu").alias("location"), F.col("log_sigma").alias("scale"),
                     (ll(F.col("log_sigma"), F.col("n_pos")) - F.col("n_pos") * F.col("log_mu")).alias("log_likelihood")),
        )))


def density_curve(df: DataFrame, col: str, grid: int = 100, fine: int = 1000) -> DataFrame:
    """Gaussian kernel density on `grid` points from a fine histogram (Scott's bandwidth).

    Rows are reduced to at most `fine` bin counts first; only those meet the grid. A constant column
    has one point at its value and no density. A NaN counts as missing.
    """
    x = F.nanvl(F.col(col).cast("double"), F.lit(None))
    base = df.filter(x.isNotNull()).agg(
        F.min(x).alias("lo"), F.max(x).alias("hi"), F.count("*").alias("n"), F.stddev_samp(x).alias("s"))
    info = F.broadcast(base.withColumn("__one", F.lit(1)))
    width = (F.col("hi") - F.col("lo")) / fine
    counts = (
        df.filter(x.isNotNull()).select(x.alias("x"), F.lit(1).alias("__one")).join(info, "__one")
        .withColumn("bin", F.coalesce(F.least(F.floor(F.try_divide(F.col("x") - F.col("lo"), width)), F.lit(fine - 1)), F.lit(0)))
        .groupBy("bin").agg(F.count("*").alias("c"), *[F.max(c).alias(c) for c in ("lo", "hi", "n", "s")])
    )
    h = F.col("s") * F.pow(F.col("n"), F.lit(-0.2))
    at = F.col("lo") + F.col("g") * (F.col("hi") - F.col("lo")) / (grid - 1)
    mid = F.col("lo") + (F.col("bin") + 0.5) * width
    z = F.try_divide(at - mid, h)
    kernel = F.exp(-z * z / 2) / F.sqrt(F.lit(2 * np.pi))
    return (
        counts.withColumn("g", F.explode(F.sequence(F.lit(0), F.when(F.col("hi") > F.col("lo"), grid - 1).otherwise(0))))
        .groupBy("g").agg(F.max(at).alias("x"), F.sum(F.try_divide(F.col("c") * kernel, F.col("n") * h)).alias("density"))
    )


def box_stats(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Quartiles, whiskers at 1.5 IQR and the number of points beyond them, per column (and group)."""
    by = list(by)
    group = by + ["column"]
    q = wide_quantiles(exact_quantiles(df, cols, [0.25, 0.5, 0.75], by=by), {0.25: "q1", 0.5: "median", 0.75: "q3"}, group)
    iqr = F.col("q3") - F.col("q1")
    fences = q.withColumn("low_fence", F.col("q1") - 1.5 * iqr).withColumn("high_fence", F.col("q3") + 1.5 * iqr)
    rows = attach(melt_numeric(df, cols, by), fences, group, name="fences")
    v = F.col("value")
    inside = (v >= F.col("low_fence")) & (v <= F.col("high_fence"))
    return rows.groupBy(*group).agg(
        F.max("q1").alias("q1"), F.max("median").alias("median"), F.max("q3").alias("q3"),
        F.min(F.when(inside, v)).alias("whisker_low"), F.max(F.when(inside, v)).alias("whisker_high"),
        F.count_if(~inside).alias("n_outliers"))


def box_outliers(df: DataFrame, key: str, col: str) -> DataFrame:
    q = wide_quantiles(exact_quantiles(df, [col], [0.25, 0.75]), {0.25: "q1", 0.75: "q3"}, ["column"])
    rows = df.select(key, F.col(col).cast("double").alias("value"), F.lit(col).alias("column")).filter("value is not null")
    iqr = F.col("q3") - F.col("q1")
    return rows.join(F.broadcast(q), "column").filter(
        (F.col("value") < F.col("q1") - 1.5 * iqr) | (F.col("value") > F.col("q3") + 1.5 * iqr)).select(key, "value")


def bar_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return value_counts(df, cols)


def pair_sample(df: DataFrame, key: str, cols: Sequence[str], n: int, seed: int = 42) -> DataFrame:
    """Rows with the n smallest hashes: the same rows whatever the partitioning."""
    return df.withColumn("__h", hash_key(key, seed)).orderBy("__h", key).limit(n).select(key, *cols)


def pivot_mean(df: DataFrame, index: str, columns: str, value: str, levels: Sequence) -> DataFrame:
    return df.groupBy(index).pivot(columns, list(levels)).agg(F.avg(value))
