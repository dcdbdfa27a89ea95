"""Scores, comparison tables, ensembles and blends over long prediction tables.

Predictions are kept as `(row_id, fold, model, y, pred)`. Every score is one aggregate over that
table; nothing is pivoted before it has to be.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.functions.joins import attach
from tabwright.functions.order import exact_quantiles, expand_folds, rank_counted, rank_values
from tabwright.operators.shape import clip_floor


def log_pred(pred: Column | str = "pred") -> Column:
    return F.log1p(clip_floor(pred))


def _sq(c: Column) -> Column:
    return c * c


def rmsle(y: str = "y", pred: str = "pred") -> Column:
    """Root mean squared log error, predictions floored at 1."""
    return F.sqrt(F.avg(_sq(log_pred(pred) - F.log1p(y))))


def regression_scores(df: DataFrame, by: Sequence[str] = (), y: str = "y", pred: str = "pred") -> DataFrame:
    err = F.col(pred) - F.col(y)
    return df.groupBy(*by).agg(
        F.count("*").alias("n"), rmsle(y, pred).alias("rmsle"), F.avg(F.abs(err)).alias("mae"),
        F.sqrt(F.avg(_sq(err))).alias("rmse"), F.avg(_sq(err)).alias("mse"),
        (1 - F.try_divide(F.sum(_sq(err)), F.var_pop(y) * F.count("*"))).alias("r2"))


def error_decomposition(df: DataFrame, by: Sequence[str] = (), features: int = 1, y: str = "y", pred: str = "pred") -> DataFrame:
    """Relative errors and sums of squares around the mean, with adjusted R squared."""
    means = df.groupBy(*by).agg(F.avg(y).alias("__m"))
    if by:
        rows = attach(df, means, list(by), name="means")
    else:
        rows = df.withColumn("__one", F.lit(1)).join(F.broadcast(means.withColumn("__one", F.lit(1))), "__one")
    err, dev = F.col(y) - F.col(pred), F.col(y) - F.col("__m")
    sums = rows.groupBy(*by).agg(
        F.count("*").alias("n"), F.sum(_sq(err)).alias("sse"), F.sum(_sq(dev)).alias("sst"),
        F.sum(_sq(F.col(pred) - F.col("__m"))).alias("ssr"), F.sum(F.abs(err)).alias("__a"), F.sum(F.abs(dev)).alias("__d"))
    n, r2 = F.col("n"), 1 - F.try_divide("sse", "sst")
    return sums.select(
        *by, "n", "sse", "sst", "ssr", F.try_divide("sse", "sst").alias("rse"), F.try_divide("__a", "__d").alias("rae"),
        r2.alias("r2"), (1 - F.try_divide((1 - r2) * (n - 1), n - features - 1)).alias("adj_r2"))


def fold_scores(oof: DataFrame) -> DataFrame:
    """Score per (model, fold)."""
    return oof.groupBy("model", "fold").agg(F.count("*").alias("n"), rmsle().alias("rmsle"))


def cv_score(oof: DataFrame) -> DataFrame:
    """Mean and sample deviation of the fold scores."""
    return fold_scores(oof).groupBy("model").agg(
        F.count("*").alias("folds"), F.avg("rmsle").alias("mean"), F.stddev_samp("rmsle").alias("sd"))


def comparison(oof: DataFrame, validation: DataFrame | None = None) -> DataFrame:
    """Models ranked by out-of-fold RMSLE with the spread of the folds (population deviation).

    The overall score is rebuilt from the fold sums, so the prediction table is read once.
    """
    per = oof.groupBy("model", "fold").agg(
        F.count("*").alias("n"), F.sum(_sq(log_pred() - F.log1p("y"))).alias("se"))
    score = per.groupBy("model").agg(
        F.sqrt(F.sum("se") / F.sum("n")).alias("oof_rmsle"), F.stddev_pop(F.sqrt(F.col("se") / F.col("n"))).alias("fold_std"))
    if validation is not None:
        val = regression_scores(validation, ["model"]).select("model", F.col("rmsle").alias("val_rmsle"), F.col("rmse").alias("val_rmse"))
        score = score.join(val, "model", "left")
    return score.orderBy("oof_rmsle", "model")


def best(table: DataFrame) -> DataFrame:
    return table.orderBy("oof_rmsle", "model").limit(1)


def confusion(df: DataFrame, y: str, pred: str) -> DataFrame:
    return df.groupBy(F.col(y).alias("actual"), F.col(pred).alias("predicted")).agg(F.count("*").alias("n"))


def class_report(df: DataFrame, y: str, pred: str) -> DataFrame:
    """Precision, recall, F1 and support per class, with overall accuracy on every row."""
    cells = confusion(df, y, pred)
    hit = F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0)
    actual = cells.groupBy(F.col("actual").alias("label")).agg(F.sum("n").alias("support"), F.sum(hit).alias("tp"))
    guessed = cells.groupBy(F.col("predicted").alias("label")).agg(F.sum("n").alias("guessed"))
    total = cells.agg((F.sum(hit) / F.sum("n")).alias("accuracy"))
    t = F.broadcast(total.withColumn("__one", F.lit(1)))
    both = actual.join(guessed, "label", "full").fillna(0).withColumn("__one", F.lit(1)).join(t, "__one")
    p = F.coalesce(F.try_divide("tp", "guessed"), F.lit(0.0))
    r = F.coalesce(F.try_divide("tp", "support"), F.lit(0.0))
    return both.select("label", p.alias("precision"), r.alias("recall"),
                       F.coalesce(F.try_divide(2 * p * r, p + r), F.lit(0.0)).alias("f1"), "support", "accuracy")


def auc(df: DataFrame, y: str, score: str) -> DataFrame:
    """Area under the ROC curve by average ranks; ties count one half, null with one class."""
    rows = df.filter(F.col(y).isNotNull() & F.col(score).isNotNull()).withColumn("__s", F.col(score).cast("double"))
    ranks = rank_values(rows, ["__s"]).select(F.col("value").alias("__s"), "cnt", (F.col("before") + (F.col("cnt") + 1) / 2).alias("rank"))
    per = rows.groupBy("__s").agg(F.count_if(F.col(y) == 1).alias("p"), F.count_if(F.col(y) != 1).alias("q"))
    s = per.join(ranks, "__s").agg(
        F.sum("p").alias("n_pos"), F.sum("q").alias("n_neg"), F.sum(F.col("p") * F.col("rank")).alias("r"))
    n, m = F.col("n_pos"), F.col("n_neg")
    return s.select("n_pos", "n_neg", F.try_divide(F.col("r") - n * (n + 1) / 2, n * m).alias("auc"))


def roc_curve(df: DataFrame, y: str, score: str) -> DataFrame:
    """`(threshold, tpr, fpr)`: rates of rows scored at or above each distinct value."""
    rows = df.filter(F.col(y).isNotNull() & F.col(score).isNotNull()).withColumn("__s", F.col(score).cast("double"))
    label = F.when(F.col(y) == 1, "pos").otherwise("neg")
    both = rows.select("__s", label.alias("side"))
    values = both.groupBy("__s").agg(
        F.count_if(F.col("side") == "pos").alias("p"), F.count_if(F.col("side") == "neg").alias("q"))
    def below(cnt: str) -> DataFrame:
        ranked = rank_counted(values.select(F.lit(cnt).alias("column"), F.col("__s").alias("value"), F.col(cnt).alias("cnt")))
        return ranked.select(F.col("value").alias("__s"), (1 - F.try_divide("before", "total")).alias(f"rate_{cnt}"))

    return below("p").join(below("q"), "__s").select(
        F.col("__s").alias("threshold"), F.col("rate_p").alias("tpr"), F.col("rate_q").alias("fpr"))


# Out-of-fold baselines ------------------------------------------------------------------------


def oof_mean(df: DataFrame, key: str, target: str, k: int, fold: str = "fold", group: str | None = None, log: bool = True) -> DataFrame:
    """Each row predicted by the (group) mean of the other folds, in the transformed target.

    Sums per fold are aggregated once; a group unseen outside the fold falls back to the mean.
    """
    z = F.log1p(target) if log else F.col(target)
    back = F.expm1 if log else (lambda c: c)
    rows = df.filter(F.col(target).isNotNull())
    means = _leave_out(rows, z, fold, k, []).withColumnRenamed("__m", "__all")
    out = rows.join(F.broadcast(means), F.col(fold) == F.col("fit_fold")).drop("fit_fold")  # k + 1 rows
    pred = F.col("__all")
    if group:
        per = _leave_out(rows, z, fold, k, [group]).withColumnRenamed("fit_fold", "__f")
        out = attach(out.withColumn("__f", F.col(fold)), per, ["__f", group], "left", name="group_means")
        pred = F.coalesce("__m", "__all")
    name = f"mean_by_{group}" if group else "mean"
    return out.select(key, F.col(fold).alias("fold"), F.lit(name).alias("model"), F.col(target).alias("y"), back(pred).alias("pred"))


def _leave_out(rows: DataFrame, z: Column, fold: str, k: int, by: list[str]) -> DataFrame:
    sums = rows.groupBy(fold, *by).agg(F.count(z).alias("__n"), F.sum(z).alias("__s"))
    return expand_folds(sums, k, fold).groupBy("fit_fold", *by).agg((F.sum("__s") / F.sum("__n")).alias("__m"))


def oof_line(df: DataFrame, key: str, x: str, target: str, k: int, fold: str = "fold") -> DataFrame:
    """Each row predicted by the one-feature line through the other folds (log target).

    A row without the feature gets the mean of the other folds' rows without it or, if there is none, of
    all their rows; a constant feature gives the mean. Sums are taken around the overall means.
    """
    rows = df.filter(F.col(target).isNotNull())
    raw, z = F.col(x).cast("double"), F.log1p(target)
    centre = rows.agg(F.avg(raw).alias("cx"), F.avg(z).alias("cz")).first()
    cx, cz = centre["cx"] or 0.0, centre["cz"] or 0.0
    both = F.col(x).isNotNull()
    xs, zs = F.when(both, raw - cx), z - cz
    zx = F.when(both, zs)
    sums = rows.groupBy(fold).agg(
        F.count(xs).alias("n"), F.sum(xs).alias("sx"), F.sum(zx).alias("sz"), F.sum(xs * xs).alias("sxx"), F.sum(xs * zx).alias("sxz"),
        F.count("*").alias("n_all"), F.sum(zs).alias("s_all"))
    names = ("n", "sx", "sz", "sxx", "sxz", "n_all", "s_all")
    t = expand_folds(sums, k, fold).groupBy("fit_fold").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names])
    n, c = F.col("n"), F.col
    mean_x, mean_z = F.try_divide("sx", "n"), F.try_divide("sz", "n")
    slope = F.coalesce(F.try_divide(c("sxz") - c("sx") * mean_z, c("sxx") - c("sx") * mean_x), F.lit(0.0))
    lacking = F.coalesce(F.try_divide(c("s_all") - F.col("sz"), c("n_all") - n), F.try_divide("s_all", "n_all"))
    line = t.select("fit_fold", slope.alias("__b"), (mean_z - slope * mean_x).alias("__a"), lacking.alias("__m"))
    out = rows.join(F.broadcast(line), F.col(fold) == F.col("fit_fold"))  # k + 1 rows
    fitted = F.coalesce(F.when(both, F.col("__a") + F.col("__b") * (raw - cx)), F.col("__m")) + cz
    return out.select(key, F.col(fold).alias("fold"), F.lit(f"line_{x}").alias("model"), F.col(target).alias("y"), F.expm1(fitted).alias("pred"))


# Ensembles and blends -------------------------------------------------------------------------


def vote(preds: DataFrame, key: Sequence[str], name: str = "voting") -> DataFrame:
    """Unweighted mean of the predictions in log space."""
    return preds.groupBy(*key).agg(F.expm1(F.avg(F.log1p("pred"))).alias("pred")).withColumn("model", F.lit(name))


def soft_vote(preds: DataFrame, key: Sequence[str], prob: str = "prob") -> DataFrame:
    """Mean class probability over models, and the class it gives."""
    p = F.avg(prob)
    return preds.groupBy(*key).agg(p.alias(prob), F.when(p >= 0.5, 1).otherwise(0).alias("label"))


def wide_predictions(preds: DataFrame, models: Sequence[str], key: Sequence[str]) -> DataFrame:
    return preds.groupBy(*key).pivot("model", list(models)).agg(F.first("pred"))


def blend_equations(wide: DataFrame, models: Sequence[str], y: str = "y") -> DataFrame:
    """Normal equations of the log-space blend, `(i, j, value)`; j = number of models is the right side.

    One aggregate; the result has k * (k + 3) / 2 rows for k models.
    """
    a = [log_pred(m) for m in models]
    cells = [(i, j, a[i] * a[j]) for i in range(len(models)) for j in range(i, len(models))]
    cells += [(i, len(models), a[i] * F.log1p(y)) for i in range(len(models))]
    row = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.sum(c).alias("value")) for i, j, c in cells])
    return wide.agg(row.alias("a")).select(F.inline("a"))


def nonnegative_least_squares(gram: np.ndarray, rhs: np.ndarray, tol: float = 1e-12) -> np.ndarray:
    """argmin w'Gw - 2 w'r over w >= 0 (active sets after Lawson and Hanson, 1974); k by k."""
    k = len(rhs)
    w, free = np.zeros(k), np.zeros(k, dtype=bool)
    limit = tol * max(1.0, float(np.abs(rhs).max(initial=0.0)))
    for _ in range(10 * k + 10):
        slope = rhs - gram @ w
        slope[free] = -np.inf
        if free.all() or slope.max() <= limit:
            break
        free[int(np.argmax(slope))] = True
        while True:
            idx = np.flatnonzero(free)
            trial = np.zeros(k)
            trial[idx] = np.linalg.lstsq(gram[np.ix_(idx, idx)], rhs[idx], rcond=None)[0]
            if trial[idx].min() > 0:
                w = trial
                break
            down = idx[trial[idx] <= 0]
            step = np.min(w[down] / (w[down] - trial[down]))
            w = w + step * (trial - w)
            free[down[w[down] <= 1e-15]] = False
            w[~free] = 0.0
            if not free.any():
                break
    return w


def blend_weights(wide: DataFrame, models: Sequence[str], y: str = "y") -> dict[str, float]:
    """Non-negative weights fitted in log space, then scaled to sum to one (equal if all are zero)."""
    k = len(models)
    gram, rhs = np.zeros((k, k)), np.zeros(k)
    for r in blend_equations(wide, models, y).collect():
        if r["j"] == k:
            rhs[r["i"]] = r["value"]
        else:
            gram[r["i"], r["j"]] = gram[r["j"], r["i"]] = r["value"]
    w = nonnegative_least_squares(gram, rhs)
    w = w / w.sum() if w.sum() > 0 else np.full(k, 1.0 / k)
    return dict(zip(models, w.tolist()))


def blend(weights: Mapping[str, float]) -> Column:
    """Weighted geometric blend of wide prediction columns."""
    return F.expm1(reduce(lambda a, b: a + b, [log_pred(m) * w for m, w in weights.items()]))


def blend_arithmetic(weights: Mapping[str, float]) -> Column:
    return reduce(lambda a, b: a + b, [F.col(m) * w for m, w in weights.items()])


# The published quantiles and factors of the tail correction.
TAILS = {"low": 0.005, "high": 0.995, "down": 0.77, "up": 1.1}


def tail_adjust(df: DataFrame, pred: str, by: Sequence[str] = (), low: float = TAILS["low"], high: float = TAILS["high"],
                down: float = TAILS["down"], up: float = TAILS["up"]) -> DataFrame:
    """Scale predictions in the extreme tails; both limits are quantiles of the unadjusted column, per group of `by`."""
    q = exact_quantiles(df, [pred], [low, high], by=by).groupBy(*by).agg(
        F.max(F.when(F.col("prob") == low, F.col("value"))).alias("__lo"),
        F.max(F.when(F.col("prob") == high, F.col("value"))).alias("__hi"), F.lit(1).alias("__one"))
    if by:
        rows = attach(df.withColumn("__one", F.lit(1)), q.drop("__one"), list(by), name="tails")
    else:
        rows = df.withColumn("__one", F.lit(1)).join(F.broadcast(q), "__one")
    p = F.col(pred)
    first = F.when(p > F.col("__lo"), p).otherwise(p * down)
    second = F.when(first < F.col("__hi"), first).otherwise(first * up)
    return rows.withColumn(pred, second).drop("__lo", "__hi", "__one")


def floor_back(pred: Column) -> Column:
    """Whole-number prediction from the log scale."""
    return F.floor(F.expm1(pred))
