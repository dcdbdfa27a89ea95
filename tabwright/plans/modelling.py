"""Queries: models, searches, ensembles and selection that rest on fitted models."""

from functools import reduce

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.models import linear, trees
from tabwright.models.front import coefficient_table, predict, predict_wide
from tabwright.models.stages import stage_of
from tabwright.operators import split as SP
from tabwright.operators.select import array_columns
from tabwright.plans import workbench as WB
from tabwright.plans.registry import query, rnd, rnd_col, rounded
from tabwright.session import materialize
from tabwright.sources.tables import FOLD_SQL, ORDER_FRAME_SQL, doc_frame, staged_order_frame, table

# One-feature models have closed forms, which SQL can state.

LINE_SQL = f"""with {ORDER_FRAME_SQL}, {FOLD_SQL},
  t as (select o.row_id, o.acctbal as x, o.target as y, f.fold from order_frame o join folds f using (row_id)),
  p as (select avg(x) as m, stddev_pop(x) as s, avg(y) as yb, count(*)::double as n from t),
  r as (select sum((x - m) / s * (y - yb)) as r, any_value(n) as n, any_value(m) as m, any_value(s) as s, any_value(yb) as yb from t, p)"""


_LINE = {}


def line_rows(spark, sf, transform="none"):
    """Folded training rows, and the one-feature front end on them."""
    slot = (spark.sparkContext.applicationId, sf)
    if slot not in _LINE:
        train = staged_order_frame(spark, sf).filter(F.col("split") == "train").select("row_id", "acctbal", "target")
        _LINE[slot] = materialize(SP.kfold(train, "row_id", 5), "line_rows")
    if (*slot, transform) not in _LINE:
        _LINE[(*slot, transform)] = WB.line_front(_LINE[slot], "acctbal", transform=transform)
    return _LINE[slot], _LINE[(*slot, transform)]


def _line_weights(spark, sf, family, params):
    rows, fr = line_rows(spark, sf)
    coef = linear.fit(fr, family, params, fr.k)
    slope, intercept = float(coef[1]), float(coef[0] - coef[1] * fr.prepared[fr.k].shift[0])
    return rows.agg(F.count("*").alias("n")).select(rnd_col(F.lit(slope), 8).alias("slope"), rnd_col(F.lit(intercept), 4).alias("intercept"), "n")


def _weights_sql(w):
    return f"{LINE_SQL} select {rnd(f'{w} / s', 8)} as slope, {rnd(f'yb - {w} / s * m')} as intercept, cast(n as bigint) as n from r"


@query("model_ols", _weights_sql("(r / n)"))
def model_ols(spark, sf):
    return _line_weights(spark, sf, "ols", {})


@query("model_ridge", _weights_sql("(r / (n + 1000))"))
def model_ridge(spark, sf):
    return _line_weights(spark, sf, "ridge", {"alpha": 1000.0})


@query("model_lasso", _weights_sql("(sign(r) * greatest(abs(r / n) - 5, 0))"))
def model_lasso(spark, sf):
    return _line_weights(spark, sf, "lasso", {"alpha": 5.0})


@query("model_elasticnet", _weights_sql("(sign(r) * greatest(abs(r / n) - 5 * 0.9, 0) / (1 + 5 * (1 - 0.9)))"))
def model_elasticnet(spark, sf):
    return _line_weights(spark, sf, "elasticnet", {"alpha": 5.0, "l1_ratio": 0.9})


def _family_scores(spark, sf, family, params=None):
    """Out-of-fold and held-out scores of one family on the full feature set."""
    rows, fr = WB.prepared(spark, sf), WB.front(spark, sf)
    preds = WB.base_predictions(rows, fr, {family: (family, params or linear.DEFAULTS[family])})
    return WB.split_scores(preds)


@query("model_ridge_full")
def model_ridge_full(spark, sf):
    return _family_scores(spark, sf, "ridge")


@query("model_lasso_full")
def model_lasso_full(spark, sf):
    return _family_scores(spark, sf, "lasso")


@query("model_elasticnet_full")
def model_elasticnet_full(spark, sf):
    return _family_scores(spark, sf, "elasticnet")


@query("model_bayesian_ridge")
def model_bayesian_ridge(spark, sf):
    return _family_scores(spark, sf, "bayesian_ridge")


@query("model_scaling_variants")
def model_scaling_variants(spark, sf):
    """The same model behind each of the four scalers."""
    out = None
    for scaling in ("standard", "minmax", "robust", "yeo-johnson"):
        fr = WB.front(spark, sf, scaling)
        preds = WB.base_predictions(WB.prepared(spark, sf), fr, {scaling: ("ridge", linear.DEFAULTS["ridge"])})
        out = preds if out is None else out.unionByName(preds)
    return WB.split_scores(out)


@query("model_target_wrapped", f"""with {ORDER_FRAME_SQL}, {FOLD_SQL},
  t as (select o.row_id, o.acctbal as x, ln(1 + o.target) as y, f.fold from order_frame o join folds f using (row_id)),
  p as (select f.fold as ff, regr_slope(y, x) as b, regr_intercept(y, x) as a from (select distinct fold from folds) f join t on t.fold <> f.fold group by 1)
  select row_id, fold, {rnd('exp(a + b * x) - 1', 3)} as pred from t join p on fold = ff""")
def model_target_wrapped(spark, sf):
    """Transform the target, fit per fold, bring predictions back."""
    rows, fr = line_rows(spark, sf, "log")
    coefs = coefficient_table(spark, fr, linear.fit_all(fr, {"line": ("ols", {})}))
    out = predict(rows, fr.design, coefs, ["row_id", "fold"], "fold", fr.inverse)
    return rounded(out.select("row_id", "fold", "pred"), {"pred"}, 3)


@query("model_front_end")
def model_front_end(spark, sf):
    """Group imputation, encoding, scaling and estimator as one fitted object; scores every row."""
    rows, fr = WB.prepared(spark, sf), WB.front(spark, sf, "yeo-johnson")
    return WB.base_predictions(rows, fr, {"ridge": ("ridge", {"alpha": 1.0})})


# Trees


def _trainer(spark, sf):
    """Trees behind the very preparations of the linear models: group medians, modes and ranked codes of each fit."""
    fr = WB.front(spark, sf)
    return trees.TreeTrainer(WB.prepared(spark, sf), WB.CONTINUOUS, WB.CATEGORICAL, WB.ORDINAL, "target", WB.K,
                             stages={f: stage_of(fr, f) for f in fr.fits})


def _keep():
    return ["row_id", "fold", "part", F.col("target").alias("y")]


TREES = 20  # rounds in the registered queries; the operators take any number
PUBLISHED = 3000  # fixed value: rounds of the published boosted trees, at the step of their preset


def _tree_scores(spark, sf, estimators):
    t = _trainer(spark, sf)
    out = None
    for name, est in estimators.items():
        p = t.predictions(est, name, _keep())
        out = p if out is None else out.unionByName(p)
    return WB.split_scores(out)


@query("model_gbt")
def model_gbt(spark, sf):
    return _tree_scores(spark, sf, {"gbr": trees.boosted("gbr", PUBLISHED)})


@query("model_gbt_alt")
def model_gbt_alt(spark, sf):
    return _tree_scores(spark, sf, {p: trees.boosted(p, TREES, stepSize=0.3) for p in ("catboost", "lgbm")})


@query("model_random_forest")
def model_random_forest(spark, sf):
    return _tree_scores(spark, sf, {"forest": trees.forest(20, 8)})


@query("model_compare")
def model_compare(spark, sf):
    """Every linear family with its defaults in one call, ranked by cross-validation."""
    rows, fr = WB.prepared(spark, sf), WB.front(spark, sf)
    return WB.split_scores(WB.base_predictions(rows, fr, {f: (f, p) for f, p in linear.DEFAULTS.items()}))


def _labelled(spark, sf):
    docs = doc_frame(spark, sf).filter(F.col("quality").isNotNull()).withColumn("label", F.col("quality").cast("double"))
    docs = docs.withColumn("log_chars", F.log1p("n_chars"))
    return SP.stratified(docs, "doc_id", "quality", 5)


def _classifier(spark, sf, estimator):
    rows = _labelled(spark, sf)
    stages = trees.assemble(["log_chars"], ["lang", "source"], [])
    parts = [Pipeline(stages=[*stages, estimator]).fit(rows.filter(F.col("fold") != f)).transform(rows.filter(F.col("fold") == f)) for f in range(5)]
    out = reduce(DataFrame.unionByName, parts)  # every labelled row is scored by the fit that has not seen it
    return out.select("doc_id", "fold", "quality", F.col("prediction").cast("int").alias("pred"), vector_to_array("probability")[1].alias("prob"))


@query("model_logistic")
def model_logistic(spark, sf):
    return _classifier(spark, sf, trees.logistic(regParam=0.01))


@query("model_forest_classifier")
def model_forest_classifier(spark, sf):
    return _classifier(spark, sf, trees.forest_classifier())


# Searches

PATH = [0.0, 1.0, 100.0, 1000.0, 10000.0]


@query("tune_alpha_path", f"""with {ORDER_FRAME_SQL}, {FOLD_SQL},
  t as (select o.acctbal as x, ln(1 + o.target) as y, f.fold from order_frame o join folds f using (row_id)),
  ff as (select distinct fold as ff from folds),
  p as (select ff, avg(x) as m, stddev_pop(x) as s, avg(y) as yb, count(*)::double as n from ff join t on fold <> ff group by 1),
  r as (select p.ff, sum((x - m) / s * (y - yb)) as r from p join t on fold <> p.ff group by 1),
  a as (select unnest([{', '.join(map(str, PATH))}])::double as alpha),
  e as (select alpha, p.ff, avg(power(y - yb - r / (n + alpha) * (x - m) / s, 2)) as mse from a, p join r on p.ff = r.ff join t on t.fold = p.ff group by 1, 2)
  select alpha, {rnd('avg(mse)', 8)} as mse, count(*) as folds from e group by 1""")
def tune_alpha_path(spark, sf):
    _, fr = line_rows(spark, sf, "log")
    scored = linear.search(fr, "ridge", [{"alpha": a} for a in PATH])
    out = spark.createDataFrame([(p["alpha"], m, len(e)) for p, m, e in scored], "alpha double, mse double, folds bigint")
    return rounded(out, {"mse"}, 8)


@query("tune_grid")
def tune_grid(spark, sf):
    fr = WB.front(spark, sf)
    rows = []
    for family in ("ridge", "lasso", "elasticnet"):
        rows += linear.search_rows(family, linear.search(fr, family, linear.candidates(linear.GRIDS[family])))
    return spark.createDataFrame(rows, linear.SEARCH_SCHEMA)


@query("tune_random")
def tune_random(spark, sf):
    fr = WB.front(spark, sf)
    rows = []
    for family, grid in linear.GRIDS.items():
        rows += linear.search_rows(family, linear.search(fr, family, linear.sampled(grid, 100)))
    return spark.createDataFrame(rows, linear.SEARCH_SCHEMA)


@query("tune_zoom")
def tune_zoom(spark, sf):
    """Every step of the published zoom of ridge, lasso and elastic net."""
    fr = WB.front(spark, sf)
    rows = []
    for family in linear.ZOOM:
        for step, scored in linear.zoom(fr, family):
            rows += linear.search_rows(f"{family} {step}", scored)
    return spark.createDataFrame(rows, linear.SEARCH_SCHEMA)


@query("tune_grid_trees")
def tune_grid_trees(spark, sf):
    """Depth and step of the boosted family by cross-validation."""
    t = _trainer(spark, sf)
    grid = [(depth, step) for depth in (3, 4) for step in (0.1, 0.3)]
    errors = trees.grid_errors(t, [trees.boosted("gbr", 10, maxDepth=d, stepSize=s) for d, s in grid])
    return spark.createDataFrame([(d, s, e) for (d, s), e in zip(grid, errors)], "max_depth int, step double, mse double")


ROUNDS = 30  # with a patience of ten rounds


@query("cv_early_stop")
def cv_early_stop(spark, sf):
    t = _trainer(spark, sf)
    est = trees.boosted("gbr", ROUNDS, stepSize=0.3)
    best, errors = trees.mean_stop_rounds(t, est)
    final = trees.refit_at(t, est, best, WB.K)
    kept = final.stages[-1].getNumTrees
    rows = [(i + 1, float(e), i + 1 == best, kept) for i, e in enumerate(errors)]
    return spark.createDataFrame(rows, "round int, mse double, chosen boolean, refitted_rounds int")


@query("learning_curve")
def learning_curve(spark, sf):
    """Held-out score against the share of training folds: folds are prefixes of one hash order."""
    rows = WB.prepared(spark, sf)
    fr = WB.front(spark, sf)
    out = []
    for used in range(1, WB.K):
        errors = []
        for f in range(WB.K):
            train = [(f + i) % WB.K for i in range(1, used + 1)]
            errors.append(linear.partial_error(fr, f, train, "ridge", {"alpha": 1.0}))
        out.append((used / WB.K, float(sum(errors) / len(errors))))
    n = rows.filter(F.col("part") == "fit").count()
    return spark.createDataFrame([(s, int(round(s * n)), e) for s, e in out], "share double, rows bigint, mse double")


# Ensembles


@query("ens_stack")
def ens_stack(spark, sf):
    wide, _ = WB.ensemble(spark, sf, "standard")
    return wide.select(*WB.KEEP, F.expm1("stacking").alias("pred"))


@query("ens_stack_passthrough")
def ens_stack_passthrough(spark, sf):
    """Boosted trees that see the features and the out-of-fold predictions of two linear models; scored out of fold too."""
    rows, fr = WB.prepared(spark, sf), WB.front(spark, sf)
    coefs = coefficient_table(spark, fr, linear.fit_all(fr, {f: (f, linear.DEFAULTS[f]) for f in ("ridge", "lasso")}))
    wide, bases = predict_wide(rows, fr.design, coefs, rows.columns, "fold")  # the rows themselves get the predictions
    wide = materialize(wide, "passthrough")
    t = trees.TreeTrainer(wide, [*WB.CONTINUOUS, *bases], WB.CATEGORICAL, WB.ORDINAL, "target", WB.K, group_of=WB.GROUP_OF)
    return t.predictions(trees.boosted("gbr", TREES, stepSize=0.3), "stack_passthrough", _keep())


@query("met_comparison_models")
def met_comparison_models(spark, sf):
    """The whole workflow: tuned linear families, stack, vote and blend, compared."""
    return WB.split_scores(WB.all_predictions(spark, sf))


@query("met_comparison_transforms")
def met_comparison_transforms(spark, sf):
    """Two linear families, stack, vote and blend behind each target transform; Yeo-Johnson's lambda is refitted in every fold."""
    parts = [WB.split_scores(WB.all_predictions(spark, sf, "standard", ["ridge", "lasso"], transform=t)).withColumn("transform", F.lit(t))
             for t in ("log", "boxcox", "yeojohnson", "none")]
    return reduce(DataFrame.unionByName, parts)


# Selection


def _pool():
    return [*WB.CONTINUOUS, *WB.ORDINAL]


@query("fs_forward")
def fs_forward(spark, sf):
    return spark.createDataFrame(linear.forward(WB.front(spark, sf), _pool(), 4), "step int, column string, r2 double")


@query("fs_backward")
def fs_backward(spark, sf):
    return spark.createDataFrame(linear.backward(WB.front(spark, sf), _pool(), 4), "step int, dropped string, r2 double")


@query("fs_exhaustive")
def fs_exhaustive(spark, sf):
    best = linear.exhaustive(WB.front(spark, sf), _pool(), range(1, len(_pool()) + 1))
    return spark.createDataFrame([(i + 1, ", ".join(s), r) for i, (r, s) in enumerate(best)], "rank int, columns string, r2 double")


@query("fs_best_subsets")
def fs_best_subsets(spark, sf):
    """Best subset of each size over all prepared features, indicators included: branch and bound, no limit on subsets."""
    fr = WB.front(spark, sf)
    names = fr.normal(fr.k).names
    flags = [[c for c in names if c.startswith(f"{factor}=")][1:] for factor in ("status", "segment_gap")]  # one level is implied
    pool = [*_pool(), *flags[0], *flags[1]]
    return spark.createDataFrame([(n, ", ".join(s), a, b) for n, s, a, b in linear.leaps(fr, pool)], "size int, columns string, r2 double, cv_r2 double")


@query("fs_rfe")
def fs_rfe(spark, sf):
    return spark.createDataFrame(linear.eliminate(WB.front(spark, sf), _pool()), "n_features int, weakest string, r2 double")


@query("fs_rfecv")
def fs_rfecv(spark, sf):
    steps = linear.eliminate(WB.front(spark, sf), _pool())
    best = max(steps, key=lambda s: s[2])
    dropped = {s[1] for s in steps if s[0] > best[0]}
    return spark.createDataFrame([(c, c not in dropped) for c in _pool()], "column string, kept boolean")


@query("fs_from_model")
def fs_from_model(spark, sf):
    rows = linear.coefficients(WB.front(spark, sf), "lasso", {"alpha": 0.005})
    return spark.createDataFrame(rows, "feature string, weight double").filter(F.col("weight") != 0)


@query("fs_importance")
def fs_importance(spark, sf):
    rows = linear.coefficients(WB.front(spark, sf), "ridge", {"alpha": 1.0})
    return spark.createDataFrame(rows, "feature string, weight double").withColumn("importance", F.abs("weight")).orderBy(F.desc("importance")).limit(30)


@query("fs_importance_trees")
def fs_importance_trees(spark, sf):
    t = _trainer(spark, sf)
    model = t.fit(trees.boosted("gbr", TREES, stepSize=0.3), WB.K)
    return spark.createDataFrame(trees.importances(model), "feature string, importance double")


@query("fs_importance_permutation")
def fs_importance_permutation(spark, sf):
    t = _trainer(spark, sf)
    model = t.fit(trees.forest(20, 6), WB.K)
    return trees.permutation_importance(model, t.train, [*WB.CONTINUOUS, *WB.CATEGORICAL, *WB.ORDINAL], "row_id")


@query("fs_vif")
def fs_vif(spark, sf):
    return spark.createDataFrame(linear.variance_inflation(WB.front(spark, sf), _pool()), "column string, vif double")


# Structure

COMPONENTS = 30  # fixed value: principal components before clustering


@query("stat_pca")
def stat_pca(spark, sf):
    emb = table(spark, sf, "embeddings")
    flat = array_columns(emb, "embedding")
    model = trees.cluster(flat, flat.columns, COMPONENTS, 5)
    ratios = model.stages[3].explainedVariance.toArray()
    return spark.createDataFrame([(i + 1, float(v), float(ratios[: i + 1].sum())) for i, v in enumerate(ratios)], "component int, share double, cumulative double")


@query("stat_kmeans")
def stat_kmeans(spark, sf):
    emb = table(spark, sf, "embeddings")
    flat = array_columns(emb, "embedding")
    return trees.cluster(flat, flat.columns, COMPONENTS, 5).transform(flat).groupBy("cluster").agg(F.count("*").alias("n"))


