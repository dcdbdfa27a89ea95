"""From raw rows to compared predictions: clean, engineer, split, fit per fold, stack, vote, blend."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.models import linear
from tabwright.models.front import Design, FrontEnd, coefficient_table, collect_design, long_predictions, predict_wide
from tabwright.operators import clean as C
from tabwright.operators import metrics as M
from tabwright.operators import shape as S
from tabwright.operators import split as SP
from tabwright.session import materialize
from tabwright.sources.sinks import EnsembleScorer, combined
from tabwright.sources.tables import staged_order_frame

K = 5
ASIDE = ["row_id", "split", "target"]
MONTHS = dict(enumerate("Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec".split(), 1))
PRIORITY = {"5-LOW": 1, "4-NOT SPECIFIED": 2, "3-MEDIUM": 3, "2-HIGH": 4, "1-URGENT": 5}
OUTLIERS = {"qty_outlier": 1000}
CONTINUOUS = ["acctbal", "max_price", "n_returned", "age", "qty_total"]
CATEGORICAL = ["status", "segment_gap", "nation", "month_code"]
ORDINAL = ["priority", "rating_absent", "n_lines"]
GROUP_OF = {"max_price": "nation"}
FAMILIES = ["ridge", "lasso", "elasticnet", "bayesian_ridge"]


def clean(df: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Rule-based cleaning and feature construction: nothing learned, valid for any new row.

    `carry` names columns that pass through and play no part.
    """
    df = C.recode_nominal(df, {"month_code": MONTHS})
    df = C.recode_ordinal(df, {"priority": PRIORITY, "rating_absent": {None: 0, **PRIORITY}})
    registry = S.feature_groups(df, ORDINAL, [*ASIDE, *carry])
    out, registry = C.engineer(
        df.drop("near_const", "segment"), registry.without(["near_const", "segment"]),
        sums={"qty_total": ["sum_qty"]}, weighted={}, differences={"age": ("order_year", "since_year")})
    return out.drop("qty_outlier")


def prepare(raw: DataFrame, k: int = K, seed: int = 42, exact: bool = True) -> DataFrame:
    """Cleaned rows with `part` (fit, val or test) and `fold`.

    Outliers, flagged on the raw columns of the same row, leave the fitting part only. `fold` is k
    outside the fitting part, which makes every row name the fit that may score it: its own
    left-out fold, or the fit on all fitting rows.

    Exact part sizes need ranks: those are found on keys alone, and one join brings them to the
    rows. With `exact=False` parts and folds come from the key's hash and nothing is shuffled.
    """
    rows = clean(raw.withColumn("__out", S.outlier_flag(raw, OUTLIERS)), carry=["__out"])
    train = F.col("split") == "train"
    outlier = (F.col("part") == "fit") & F.col("__out")
    if not exact:
        hashed = SP.kfold_hash(SP.holdout_hash(rows, "row_id", 0.2, seed), "row_id", k, seed)
        part = F.when(train, F.col("part")).otherwise("test")
        named = hashed.withColumn("part", part).filter(~outlier).drop("__out")
        return named.withColumn("fold", F.when(F.col("part") == "fit", F.col("fold")).otherwise(k))
    keys = SP.holdout(rows.filter(train).select("row_id", "__out"), "row_id", 0.2, seed)
    keys = materialize(keys.filter(~outlier).drop("__out"), "parts")
    folds = SP.kfold(keys.filter(F.col("part") == "fit"), "row_id", k, seed)
    placed = folds.unionByName(keys.filter(F.col("part") == "val").withColumn("fold", F.lit(k)))
    test = rows.filter(~train).withColumn("part", F.lit("test")).withColumn("fold", F.lit(k))
    return S.align(rows.filter(train), placed, "row_id").unionByName(test).drop("__out")


_PREPARED: dict = {}
_FRONTS: dict = {}


def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prepared frame, written once per application: every fit and score reads it."""
    slot = (spark.sparkContext.applicationId, sf_dir)
    if slot not in _PREPARED:
        _PREPARED[slot] = materialize(prepare(staged_order_frame(spark, sf_dir)), "prepared")
    return _PREPARED[slot]


def make_front(rows: DataFrame, scaling: str = "yeo-johnson", transform: str = "log") -> FrontEnd:
    design = collect_design(rows.filter(F.col("part") == "fit"), CONTINUOUS, CATEGORICAL, ORDINAL, GROUP_OF)
    return FrontEnd(rows.filter(F.col("part") == "fit"), design, K, "target", scaling=scaling, transform=transform)


def front(spark: SparkSession, sf_dir: str, scaling: str = "standard", transform: str = "log") -> FrontEnd:
    slot = (spark.sparkContext.applicationId, sf_dir, scaling, transform)
    if slot not in _FRONTS:
        _FRONTS[slot] = make_front(prepared(spark, sf_dir), scaling, transform)
    return _FRONTS[slot]


def line_front(rows: DataFrame, column: str, **options) -> FrontEnd:
    """A front end with a single continuous feature."""
    return FrontEnd(rows, Design([column], [], [], {}), K, "target", **options)


# Predictions stay wide, one column per model in the transformed target, so that stack, vote and
# blend are expressions on a row that already exists: no prediction is ever shuffled or joined.

KEEP = ["row_id", "fold", "part", "y"]


def wide_predictions(rows: DataFrame, fr: FrontEnd, chosen: Mapping[str, tuple[str, Mapping]]) -> tuple[DataFrame, list[str]]:
    """`(row_id, fold, part, y, one column per model)` for every row: a map over the rows."""
    coefs = coefficient_table(rows.sparkSession, fr, linear.fit_all(fr, chosen))
    return predict_wide(rows.withColumn("y", F.col("target")), fr.design, coefs, KEEP, "fold")


def base_predictions(rows: DataFrame, fr: FrontEnd, chosen: Mapping[str, tuple[str, Mapping]]) -> DataFrame:
    """The same in long form: `(row_id, fold, part, y, model, z, pred)`."""
    return long_predictions(*wide_predictions(rows, fr, chosen), KEEP, fr.inverse)


def with_stack(wide: DataFrame, models: Sequence[str], fits: Sequence[tuple[int, float, list[float]]], name: str = "stacking") -> DataFrame:
    """Adds the stacked prediction; each row uses the meta fit (fit, intercept, weights) of its own `fold`."""
    by_fit = lambda values: F.get(F.array(*[F.lit(v) for v in values]), F.col("fold"))
    z = by_fit([b for _, b, _ in fits])
    for i, m in enumerate(models):
        z = z + by_fit([w[i] for _, _, w in fits]) * F.col(m)
    return wide.withColumn(name, z)


def with_vote(wide: DataFrame, models: Sequence[str], name: str = "voting") -> DataFrame:
    """Adds the unweighted mean of the base predictions in the transformed target."""
    return wide.withColumn(name, sum((F.col(m) for m in models), F.lit(0.0)) / len(models))


def blend_weights(wide: DataFrame, models: Sequence[str], inverse) -> dict[str, float]:
    """Non-negative weights fitted on out-of-fold rows by one aggregate."""
    return M.blend_weights(wide.filter(F.col("part") == "fit").select("y", *[inverse(F.col(m)).alias(m) for m in models]), models)


def with_blend(wide: DataFrame, weights: Mapping[str, float], pair, name: str = "blend") -> DataFrame:
    """Adds the weighted blend of the given columns; `pair` is the target transform and its inverse."""
    return wide.withColumn(name, combined({"kind": "blend", "weights": weights}, *pair))


def split_scores(preds: DataFrame) -> DataFrame:
    """The comparison table: out-of-fold scores with their spread, and scores on the held-out part."""
    return M.comparison(preds.filter(F.col("part") == "fit"), preds.filter(F.col("part") == "val"))


def _ensemble(spark: SparkSession, sf_dir: str, scaling: str, families: Sequence[str], n_iter: int, transform: str = "log"):
    rows = prepared(spark, sf_dir)
    fr = front(spark, sf_dir, scaling, transform)
    chosen = linear.tuned(fr, families, n_iter)
    coefs = coefficient_table(spark, fr, linear.fit_all(fr, chosen))
    base, models = predict_wide(rows.withColumn("y", F.col("target")), fr.design, coefs, KEEP, "fold")
    fits = linear.nested_meta_fits(fr, {m: chosen[m] for m in models})
    wide = with_vote(with_stack(materialize(base, "base_predictions"), models, fits), models)
    weights = blend_weights(wide, [*models, "stacking", "voting"], fr.inverse)
    return fr, coefs, fits, weights, with_blend(wide, weights, (fr.forward, fr.inverse)), models


def ensemble(
    spark: SparkSession, sf_dir: str, scaling: str = "yeo-johnson", families: Sequence[str] = FAMILIES, n_iter: int = 100, transform: str = "log",
) -> tuple[DataFrame, list[str]]:
    """Tuned base models written once, then stack, vote and blend as further columns, all in the transformed target."""
    *_, wide, models = _ensemble(spark, sf_dir, scaling, families, n_iter, transform)
    return wide, [*models, "stacking", "voting", "blend"]


def composite(
    spark: SparkSession, sf_dir: str, scaling: str = "yeo-johnson", families: Sequence[str] = FAMILIES, n_iter: int = 100, transform: str = "log",
) -> EnsembleScorer:
    """The final fit of the workflow as one model that can be stored: base models, stack, vote, blend, and the best of them.

    The transform is one without a learned lambda: `log`, `boxcox` or `none`.
    """
    fr, coefs, fits, weights, wide, models = _ensemble(spark, sf_dir, scaling, families, n_iter, transform)
    if fr.y_lam:
        raise ValueError("a stored ensemble needs a target transform without a learned lambda")
    names = [*models, "stacking", "voting", "blend"]
    best = split_scores(long_predictions(wide, names, KEEP, fr.inverse)).orderBy("oof_rmsle", "model").first()["model"]
    intercept, stack = next((b, w) for f, b, w in fits if f == fr.k)
    parts = {"stacking": {"kind": "stack", "intercept": intercept, "weights": dict(zip(models, stack))},
             "voting": {"kind": "vote", "weights": {m: 1.0 / len(models) for m in models}},
             "blend": {"kind": "blend", "weights": weights}}
    return EnsembleScorer(fr.design, coefs, transform, fr.k, parts, best)


def all_predictions(
    spark: SparkSession, sf_dir: str, scaling: str = "yeo-johnson", families: Sequence[str] = FAMILIES, n_iter: int = 100, transform: str = "log",
) -> DataFrame:
    """`ensemble` in long form, predictions on the target's own scale."""
    fr, *_, wide, models = _ensemble(spark, sf_dir, scaling, families, n_iter, transform)
    return long_predictions(wide, [*models, "stacking", "voting", "blend"], KEEP, fr.inverse)
