"""Learned preparation steps as (fit -> parameter table, apply) pairs.

A parameter table has one row per `([fit_fold], column[, group])`. With a fold column the fit
returns k + 1 sets at once: set f leaves fold f out, set k uses every row. Statistics are
aggregated once per fold and the small per-fold table is what gets expanded, so no row is ever
copied. Applying joins the table on the fold (or on a constant) and is a map over the rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.functions.joins import measured, null_safe_join
from tabwright.functions.order import (
    exact_quantiles, expand_folds, melt_numeric, most_frequent, rank_levels,
    search_sorted, value_counts,
)
from tabwright.functions.scalar import yeo_johnson
from tabwright.operators.stats import moments
from tabwright.session import few_tasks

FIT = "fit_fold"


def _head(fold: str | None) -> list[str]:
    return [FIT] if fold else []


def _spread(df: DataFrame, fold: str | None, k: int) -> DataFrame:
    return expand_folds(df, k, fold) if fold else df


# Fits -----------------------------------------------------------------------------------------


def fit_moments(df: DataFrame, cols: Sequence[str], fold: str | None = None, k: int = 0, by: Sequence[str] = ()) -> DataFrame:
    """`([fit_fold], by..., column, n, mean, m2, lo, hi)`; folds are merged with the pairwise formula."""
    keep = [*by, *([fold] if fold else [])]
    v = F.col("value")
    per = melt_numeric(df, cols, keep).groupBy(*keep, "column").agg(
        F.count("*").cast("double").alias("n"), F.avg(v).alias("mean"), (F.var_pop(v) * F.count("*")).alias("m2"),
        F.min(v).alias("lo"), F.max(v).alias("hi"))
    if not fold:
        return per
    group = [FIT, *by, "column"]
    each = _spread(per, fold, k)
    n, m = F.col("n"), F.col("mean")
    whole = each.groupBy(*group).agg((F.sum(n * m) / F.sum(n)).alias("__mean"))
    return null_safe_join(each, whole, group).groupBy(*group).agg(
        F.sum(n).alias("n"), F.max("__mean").alias("mean"),
        F.sum(F.col("m2") + n * (m - F.col("__mean")) * (m - F.col("__mean"))).alias("m2"),
        F.min("lo").alias("lo"), F.max("hi").alias("hi"))


def fit_mean(df: DataFrame, cols: Sequence[str], fold: str | None = None, k: int = 0, by: Sequence[str] = ()) -> DataFrame:
    return fit_moments(df, cols, fold, k, by).select(*_head(fold), *by, "column", F.col("mean").alias("value"))


def fit_median(df: DataFrame, cols: Sequence[str], fold: str | None = None, k: int = 0, by: Sequence[str] = ()) -> DataFrame:
    return exact_quantiles(df, cols, [0.5], by=by, fold=fold, k=k).select(*_head(fold), *by, "column", "value")


def fit_mode(df: DataFrame, cols: Sequence[str], fold: str | None = None, k: int = 0, by: Sequence[str] = ()) -> DataFrame:
    """Most frequent value, ties to the smallest (numbers in number order)."""
    keep = [*by, *([fold] if fold else [])]
    counts = _spread(value_counts(df, cols, keep), fold, k)
    group = [*_head(fold), *by, "column"]
    if fold:
        counts = counts.groupBy(*group, "value").agg(F.sum("cnt").alias("cnt"))
    numeric = {c for c in cols if isinstance(df.schema[c].dataType, T.NumericType)}
    if not numeric:
        return most_frequent(counts, group).select(*group, "value")
    number = F.when(F.col("column").isin(list(numeric)), F.col("value").cast("double"))
    best = F.min(F.struct((-F.col("cnt")).alias("m"), number.alias("x"), F.col("value").alias("v")))
    return counts.groupBy(*group).agg(best.alias("b")).select(*group, F.col("b.v").alias("value"))


# Applying -------------------------------------------------------------------------------------


def pivot_params(params: DataFrame, cols: Sequence[str], value: str, prefix: str, fold: bool) -> DataFrame:
    """One row per fit (or one row in all), one column per feature."""
    cells = [F.max(F.when(F.col("column") == c, F.col(value))).alias(f"{prefix}{c}") for c in cols]
    return params.groupBy(FIT).agg(*cells) if fold else params.agg(*cells)


def attach_params(df: DataFrame, wide: DataFrame, fold: str | None) -> DataFrame:
    """Join one parameter row per fit; at most k + 1 rows, hence the broadcast."""
    if fold:
        return df.join(F.broadcast(wide.withColumnRenamed(FIT, "__fit")), F.col(fold) == F.col("__fit"), "left").drop("__fit")
    one = F.broadcast(wide.withColumn("__one", F.lit(1)))
    return df.withColumn("__one", F.lit(1)).join(one, "__one", "left").drop("__one")


def fill_with(df: DataFrame, params: DataFrame, cols: Sequence[str], fold: str | None = None) -> DataFrame:
    """Null becomes the column's learned value."""
    wide = pivot_params(params, cols, "value", "__p_", bool(fold))
    out = attach_params(df, wide, fold)
    new = {c: F.coalesce(F.col(c), F.col(f"__p_{c}").cast(_fill_type(df, c, params))) for c in cols}
    return out.withColumns(new).drop(*[f"__p_{c}" for c in cols])


def _fill_type(df: DataFrame, col: str, params: DataFrame) -> T.DataType:
    """Integer columns become double when the learned value is a double (a median may be .5)."""
    if isinstance(params.schema["value"].dataType, T.StringType):
        return df.schema[col].dataType
    return T.DoubleType()


def fill_by_group(
    df: DataFrame, col: str, group: str, params: DataFrame, overall: DataFrame | None = None, fold: str | None = None
) -> DataFrame:
    """Null becomes the group's learned value; null or unseen groups take the overall one."""
    keys = ([FIT] if fold else []) + [group]
    params, small = measured(params)
    side = params.filter(F.col(group).isNotNull()).select(
        *[F.col(x).alias(f"__k_{x}") for x in keys], F.col("value").alias("__g"))
    cond = F.col(group) == F.col(f"__k_{group}")
    if fold:
        cond = cond & (F.col(fold) == F.col(f"__k_{FIT}"))
    out = df.join(F.broadcast(side) if small else side, cond, "left").drop(*[f"__k_{x}" for x in keys])
    parts = [F.col(col), F.col("__g")]
    if overall is not None:
        out = attach_params(out, pivot_params(overall, [col], "value", "__o_", bool(fold)), fold)
        parts.append(F.col(f"__o_{col}"))
    return out.withColumn(col, F.coalesce(*parts)).drop("__g", f"__o_{col}")


def impute_group_median(df: DataFrame, col: str, group: str | None, train: Column | None = None) -> DataFrame:
    """Group median with the overall median behind it; without a group column nothing happens."""
    if group is None or col not in df.columns or group not in df.columns:
        return df
    fit_rows = df if train is None else df.filter(train)
    return fill_by_group(df, col, group, fit_median(fit_rows, [col], by=[group]), fit_median(fit_rows, [col]))


# Encoders -------------------------------------------------------------------------------------

MAX_LEVELS = 10_000


def level_table(df: DataFrame, cols: Sequence[str], fold: str | None = None, k: int = 0) -> DataFrame:
    """`([fit_fold], column, level, cnt)` of the non-null levels."""
    counts = _spread(value_counts(df, cols, [fold] if fold else []), fold, k)
    if fold:
        counts = counts.groupBy(FIT, "column", "value").agg(F.sum("cnt").alias("cnt"))
    return counts.withColumnRenamed("value", "level")


def collect_levels(df: DataFrame, cols: Sequence[str], limit: int = MAX_LEVELS) -> dict[str, list[str]]:
    """Sorted levels per column, for one column per level. More than `limit` is an error: wider factors
    are coded as entries of a row (`operators/codes.py`)."""
    rows = level_table(df, cols).select("column", "level").limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} levels over {list(cols)}")
    out: dict[str, list[str]] = {c: [] for c in cols}
    for r in rows:
        out[r["column"]].append(r["level"])
    return {c: sorted(v) for c, v in out.items()}


def indicator_columns(df: DataFrame, levels: dict[str, list[str]], drop_first: bool = False) -> DataFrame:
    """0/1 column per level; null and unseen levels give zeros everywhere.

    `drop_first` leaves out the first level of every factor but the first.
    """
    new = {}
    for i, (c, values) in enumerate(levels.items()):
        for v in values[1 if drop_first and i else 0:]:
            new[f"{c}={v}"] = F.coalesce((F.col(c).cast("string") == v).cast("int"), F.lit(0))
    return df.withColumns(new)


def fit_ordinal(df: DataFrame, cols: Sequence[str], fold: str | None = None, k: int = 0) -> DataFrame:
    """`([fit_fold], column, level, code)`: rank of the sorted distinct values, 0-based."""
    return rank_levels(level_table(df, cols, fold, k).drop("cnt"), by=_head(fold))


def encode_ordinal(df: DataFrame, col: str, codes: DataFrame, out: str | None = None, fold: str | None = None) -> DataFrame:
    """Code of the level; unseen levels get -1, null stays null."""
    codes, small = measured(codes.filter(F.col("column") == col), "codes")
    side = codes.select(
        *[F.col(FIT).alias("__f")] if fold else [], F.col("level").alias("__l"), F.col("code").alias("__c"))
    cond = F.col(col).cast("string") == F.col("__l")
    if fold:
        cond = cond & (F.col(fold) == F.col("__f"))
    code = F.when(F.col(col).isNotNull(), F.coalesce("__c", F.lit(-1)))
    joined = df.join(F.broadcast(side) if small else side, cond, "left")
    return joined.withColumn(out or col, code).drop("__f", "__l", "__c")


# Scalers --------------------------------------------------------------------------------------


def fit_scaler(df: DataFrame, cols: Sequence[str], method: str, fold: str | None = None, k: int = 0) -> DataFrame:
    """`([fit_fold], column, center, scale)`; a constant column scales by 1."""
    head = [*_head(fold), "column"]
    if method == "standard":
        m = fit_moments(df, cols, fold, k).withColumn("s", F.sqrt(F.col("m2") / F.col("n"))).withColumn("c", F.col("mean"))
    elif method == "minmax":
        m = fit_moments(df, cols, fold, k).withColumn("s", F.col("hi") - F.col("lo")).withColumn("c", F.col("lo"))
    elif method == "robust":
        q = exact_quantiles(df, cols, [0.25, 0.5, 0.75], fold=fold, k=k)
        at = lambda p: F.max(F.when(F.col("prob") == p, F.col("value")))
        m = q.groupBy(*head).agg(at(0.5).alias("c"), (at(0.75) - at(0.25)).alias("s"))
    else:
        raise ValueError(f"unknown scaler {method!r}: standard, minmax, robust or yeo-johnson")
    return m.select(*head, F.col("c").alias("center"), F.when(F.col("s") > 0, F.col("s")).otherwise(1.0).alias("scale"))


def apply_scaler(df: DataFrame, params: DataFrame, cols: Sequence[str], fold: str | None = None) -> DataFrame:
    out = attach_params(df, pivot_params(params, cols, "center", "__c_", bool(fold)), fold)
    out = attach_params(out, pivot_params(params, cols, "scale", "__s_", bool(fold)), fold)
    new = {c: (F.col(c).cast("double") - F.col(f"__c_{c}")) / F.col(f"__s_{c}") for c in cols}
    return out.withColumns(new).drop(*[f"__{p}_{c}" for c in cols for p in "cs"])


# Power transforms -----------------------------------------------------------------------------


def _power_function():
    """Yeo-Johnson or Box-Cox(1 + x) on an array, for the partial sums inside a task.

    Returned from a function so that it travels to executors by value.
    """

    def psi(x, lam, method):
        if method == "boxcox1p":
            return np.log1p(x) if abs(lam) < 1e-12 else np.expm1(lam * np.log1p(x)) / lam
        up, down = np.maximum(x, 0.0), np.maximum(-x, 0.0)
        pos = np.log1p(up) if abs(lam) < 1e-12 else np.expm1(lam * np.log1p(up)) / lam
        rest = 2.0 - lam
        neg = np.log1p(down) if abs(rest) < 1e-12 else np.expm1(rest * np.log1p(down)) / rest
        return np.where(x >= 0, pos, -neg)

    return psi


def _likelihood_sums(
    df: DataFrame, cols: Sequence[str], fold: Column, grid: dict[str, list[float]], method: str, center: dict[str, float],
) -> list:
    """Per (fold, column, candidate): n, sum and sum of squares of psi around psi(center), and the Jacobian sum.

    One scan for all columns, folds and candidates; a task emits a few hundred rows. A NaN counts as missing; a
    value outside the transform's domain ends the job, however the rows are dealt.
    """
    cols, psi = list(cols), _power_function()

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        acc: dict[tuple, np.ndarray] = {}
        for batch in batches:
            folds = batch["__fold"].to_numpy()
            for f in np.unique(folds):
                rows = batch[folds == f]
                for c in cols:
                    x = rows[c].to_numpy(dtype="float64")
                    x = x[~np.isnan(x)]
                    if not len(x):
                        continue
                    if method == "boxcox1p" and x.min() <= -1:
                        raise ValueError(f"boxcox1p needs values above -1, column {c} has {x.min()}")
                    jac = (np.log1p(x) if method == "boxcox1p" else np.sign(x) * np.log1p(np.abs(x))).sum()
                    for lam in grid[c]:
                        p = psi(x, lam, method) - psi(np.array([center[c]]), lam, method)[0]
                        part = np.array([len(x), p.sum(), (p * p).sum(), jac])
                        key = (int(f), c, lam)
                        acc[key] = acc[key] + part if key in acc else part
        if acc:
            yield pd.DataFrame([(*key, *v) for key, v in acc.items()], columns=["fold", "column", "lam", "n", "s1", "s2", "jac"])

    schema = "fold int, column string, lam double, n double, s1 double, s2 double, jac double"
    rows = df.select(fold.cast("int").alias("__fold"), *[F.col(c).cast("double").alias(c) for c in cols])
    sums = few_tasks(rows).mapInPandas(partial, schema).groupBy("fold", "column", "lam")
    return sums.agg(*[F.sum(c).alias(c) for c in ("n", "s1", "s2", "jac")]).collect()


def fit_power(
    df: DataFrame, cols: Sequence[str], fold: str | None = None, k: int = 0, method: str = "yeo-johnson",
    rounds: int = 4, points: int = 21, low: float = -4.0, high: float = 6.0,
    constants: dict[tuple[int, str], list[tuple[float, float]]] | None = None,
) -> dict[tuple[int, str], float]:
    """Maximum-likelihood lambda per (fit, column); fits are numbered as in `fit_fold`.

    Each round scans once for all fits, columns and candidates and then narrows every bracket
    tenfold. What reaches the driver is one row per (fold, column, candidate). `constants` adds
    already imputed cells as (value, weight) pairs, which would otherwise need another scan.
    """
    fits = list(range(k + 1)) if fold else [0]
    bracket = {(f, c): (low, high) for f in fits for c in cols}
    # sums are taken around the transformed mean, so that their difference keeps its digits
    present = lambda c: F.nanvl(F.col(c).cast("double"), F.lit(None))
    means = df.agg(*[F.avg(present(c)).alias(f"m{i}") for i, c in enumerate(cols)]).first() if cols else []
    center = {c: m if m is not None and (method != "boxcox1p" or m > -1) else 0.0 for c, m in zip(cols, means)}
    best: dict[tuple[int, str], float] = {}
    for last in [False] * (rounds - 1) + [True]:
        mine = {fc: np.round(np.linspace(a, b, points), 10).tolist() for fc, (a, b) in bracket.items()}
        grid = {c: sorted({lam for (f, cc), ls in mine.items() if cc == c for lam in ls}) for c in cols}
        sums: dict[tuple[str, float], dict[int, np.ndarray]] = {}
        for r in _likelihood_sums(df, cols, F.col(fold) if fold else F.lit(0), grid, method, center):
            sums.setdefault((r["column"], r["lam"]), {})[r["fold"]] = np.array([r["n"], r["s1"], r["s2"], r["jac"]])
        for (f, c), lams in mine.items():
            scores = []
            for lam in lams:
                use = [v for g, v in sums.get((c, lam), {}).items() if not fold or g != f or f == k]
                total = np.sum(use, axis=0) if use else np.zeros(4)
                for value, weight in (constants or {}).get((f, c), []):
                    psi = _power_function()
                    p = float(psi(np.array([value]), lam, method)[0] - psi(np.array([center[c]]), lam, method)[0])
                    jac = np.sign(value) * np.log1p(abs(value))
                    total = total + weight * np.array([1.0, p, p * p, jac])
                scores.append(_log_likelihood(total, lam))
            i = int(np.argmax(scores))
            lo, hi = lams[max(i - 1, 0)], lams[min(i + 1, len(lams) - 1)]
            bracket[(f, c)] = (lo, hi)
            best[(f, c)] = _vertex(lams, scores, i) if last else lams[i]
    return best


def _log_likelihood(total: np.ndarray, lam: float) -> float:
    n, s1, s2, jac = total
    if n == 0:
        return -np.inf if lam != 1.0 else 0.0
    var = s2 / n - (s1 / n) ** 2
    if not np.isfinite(var) or var <= 0:
        return -np.inf
    return -0.5 * n * np.log(var) + (lam - 1.0) * jac


def _vertex(xs: list[float], ys: list[float], i: int) -> float:
    """Top of the parabola through the best candidate and its neighbours."""
    if 0 < i < len(xs) - 1 and np.all(np.isfinite(ys[i - 1:i + 2])):
        a, b, c = ys[i - 1], ys[i], ys[i + 1]
        bend = a - 2 * b + c
        if bend < 0:
            return float(xs[i] + 0.5 * (a - c) / bend * (xs[i + 1] - xs[i]))
    return float(xs[i])


def power_table(spark, lambdas: dict[tuple[int, str], float]) -> DataFrame:
    rows = [(f, c, lam) for (f, c), lam in lambdas.items()]
    return spark.createDataFrame(rows, f"{FIT} int, column string, lam double")


def apply_yeo_johnson(df: DataFrame, lambdas: DataFrame, cols: Sequence[str], fold: str | None = None) -> DataFrame:
    """psi only; follow with the standard scaler fitted on the result."""
    table = lambdas if fold else lambdas.drop(FIT)
    out = attach_params(df, pivot_params(table, cols, "lam", "__l_", bool(fold)), fold)
    new = {c: yeo_johnson(F.col(c).cast("double"), F.col(f"__l_{c}")) for c in cols}
    return out.withColumns(new).drop(*[f"__l_{c}" for c in cols])


def skewed_columns(df: DataFrame, cols: Sequence[str], limit: float, signed: bool = False) -> list[str]:
    """Columns whose bias-corrected skewness passes the limit: one aggregate, one row per column."""
    skew = F.col("skew") if signed else F.abs("skew")
    return sorted(r["column"] for r in moments(df, cols).filter(skew > limit).collect())


def fit_target_quantiles(df: DataFrame, target: str, points: int = 1000) -> DataFrame:
    """`(prob, value)` reference quantiles of the uniform quantile transform: a fixed number of rows."""
    n = points - 1
    return exact_quantiles(df, [target], [i / n for i in range(points)]).select("prob", "value")


def quantile_transform(df: DataFrame, target: str, table: DataFrame, out: str, size: int = 1024) -> DataFrame:
    """Position of a value among the reference quantiles, interpolated and clipped to [0, 1].

    A value that several quantiles share takes the middle of their positions. `size` is a power of
    two above the number of quantiles.
    """
    pairs = F.sort_array(F.collect_list(F.struct("value", "prob")))
    arr = table.agg(pairs.alias("p")).select(
        F.transform("p", lambda s: s["value"]).alias("__v"), F.transform("p", lambda s: s["prob"]).alias("__q"),
        F.lit(1).alias("__one"))
    rows = df.withColumn("__one", F.lit(1)).join(F.broadcast(arr), "__one")
    rows = search_sorted(rows, "__v", target, size, "__lo")
    rows = search_sorted(rows, "__v", target, size, "__hi", inclusive=True)
    y, lo, hi = F.col(target), F.col("__lo"), F.col("__hi")
    v, q = (lambda i: F.get("__v", i)), (lambda i: F.get("__q", i))
    inner = q(lo - 1) + (y - v(lo - 1)) / (v(lo) - v(lo - 1)) * (q(lo) - q(lo - 1))
    value = (F.when(y.isNull(), None).when(hi > lo, (q(lo) + q(hi - 1)) / 2).when(lo == 0, 0.0)
             .when(lo == F.size("__v"), 1.0).otherwise(inner))
    return rows.withColumn(out, value).drop("__v", "__q", "__lo", "__hi", "__one")
