"""Queries: metrics, out-of-fold baselines, votes, blends and prediction adjustments."""

from pyspark.sql import functions as F

from tabwright.operators import metrics as M
from tabwright.operators import split as S
from tabwright.plans.registry import query, rnd, rounded
from tabwright.session import materialize
from tabwright.sources.tables import DOC_FRAME_SQL, FOLD_SQL, ORDER_FRAME_SQL, doc_frame, staged_order_frame

MODELS = ["mean", "mean_by_segment", "line_sum_qty"]

# Out-of-fold predictions of three closed-form models, as SQL.
OOF_SQL = f"""with {ORDER_FRAME_SQL}, {FOLD_SQL},
  t as (select o.*, f.fold, ln(1 + target) as z from order_frame o join folds f using (row_id)),
  ff as (select distinct fold as ff from folds),
  m0 as (select ff, avg(z) as p from ff join t on t.fold <> ff group by ff),
  m1 as (select ff, segment, avg(z) as p from ff join t on t.fold <> ff group by 1, 2),
  m2 as (select ff, regr_slope(z, sum_qty) as b, regr_intercept(z, sum_qty) as a from ff join t on t.fold <> ff where sum_qty is not null group by ff),
  m3 as (select ff, coalesce(avg(z) filter (where sum_qty is null), avg(z)) as p from ff join t on t.fold <> ff group by ff),
  oof as (select row_id, fold, 'mean' as model, target as y, exp(p) - 1 as pred from t join m0 on fold = ff
    union all select row_id, fold, 'mean_by_segment', target, exp(p) - 1 from t join m1 on fold = ff and t.segment = m1.segment
    union all select row_id, fold, 'line_sum_qty', target, exp(case when sum_qty is null then p else a + b * sum_qty end) - 1
      from t join m2 on fold = m2.ff join m3 on m3.ff = m2.ff),
  lp as (select *, ln(1 + greatest(pred, 1)) as lp, ln(1 + y) as ly from oof)"""


def oof(spark, sf):
    rows = staged_order_frame(spark, sf).filter(F.col("split") == "train").select("row_id", "segment", "sum_qty", "target")
    train = materialize(S.kfold(rows, "row_id", 5), "folds")
    return (M.oof_mean(train, "row_id", "target", 5)
            .unionByName(M.oof_mean(train, "row_id", "target", 5, group="segment"))
            .unionByName(M.oof_line(train, "row_id", "sum_qty", "target", 5)))


_KEPT = {}


def kept_oof(spark, sf):
    """The prediction table, written once per application: every score and blend reads it."""
    slot = (spark.sparkContext.applicationId, sf)
    if slot not in _KEPT:
        _KEPT[slot] = materialize(oof(spark, sf), "oof")
    return _KEPT[slot]


@query("oof_predict", f"{OOF_SQL} select row_id, fold, model, {rnd('y')} as y, {rnd('pred')} as pred from oof")
def oof_predict(spark, sf):
    return rounded(oof(spark, sf), {"y", "pred"})


_RMSLE = "sqrt(avg(power(lp - ly, 2)))"


@query("met_rmsle", f"{OOF_SQL} select model, {rnd(_RMSLE, 8)} as rmsle from lp group by model")
def met_rmsle(spark, sf):
    return rounded(kept_oof(spark, sf).groupBy("model").agg(M.rmsle().alias("rmsle")), {"rmsle"}, 8)


@query("met_regression", f"""{OOF_SQL} select model, count(*) as n, {rnd(_RMSLE, 8)} as rmsle, {rnd('avg(abs(pred - y))')} as mae,
    {rnd('sqrt(avg(power(pred - y, 2)))')} as rmse, {rnd('avg(power(pred - y, 2)) / 1e6')} as mse,
    {rnd('1 - sum(power(pred - y, 2)) / (var_pop(y) * count(*))', 8)} as r2 from lp group by model""")
def met_regression(spark, sf):
    s = M.regression_scores(kept_oof(spark, sf), ["model"]).withColumn("mse", F.col("mse") / 1e6)
    return rounded(rounded(s, {"rmsle", "r2"}, 8), {"mae", "rmse", "mse"})


@query("met_extra", f"""{OOF_SQL}, d as (select *, avg(y) over (partition by model) as m from oof),
    s as (select model, count(*) as n, sum(power(y - pred, 2)) as sse, sum(power(y - m, 2)) as sst, sum(power(pred - m, 2)) as ssr,
      sum(abs(y - pred)) as a, sum(abs(y - m)) as d from d group by model)
    select model, n, {rnd('sse / 1e9')} as sse, {rnd('sst / 1e9')} as sst, {rnd('ssr / 1e9')} as ssr, {rnd('sse / sst', 8)} as rse, {rnd('a / d', 8)} as rae,
      {rnd('1 - sse / sst', 8)} as r2, {rnd('1 - sse / sst * (n - 1) / (n - 2)', 8)} as adj_r2 from s""")
def met_extra(spark, sf):
    s = M.error_decomposition(kept_oof(spark, sf), ["model"])
    s = s.withColumns({c: F.col(c) / 1e9 for c in ("sse", "sst", "ssr")})
    return rounded(rounded(s, {"rse", "rae", "r2", "adj_r2"}, 8), {"sse", "sst", "ssr"})


@query("cv_score", f"""{OOF_SQL}, f as (select model, fold, {_RMSLE} as s from lp group by 1, 2)
    select model, count(*) as folds, {rnd('avg(s)', 8)} as mean, {rnd('stddev_samp(s)', 8)} as sd from f group by model""")
def cv_score(spark, sf):
    return rounded(M.cv_score(kept_oof(spark, sf)), {"mean", "sd"}, 8)


_COMPARISON = f"""f as (select model, fold, {_RMSLE} as s from lp group by 1, 2),
    o as (select model, {_RMSLE} as oof_rmsle from lp group by 1),
    c as (select o.model, {rnd('max(oof_rmsle)', 8)} as oof_rmsle, {rnd('stddev_pop(s)', 8)} as fold_std from o join f on o.model = f.model group by 1)"""


@query("met_comparison", f"{OOF_SQL}, {_COMPARISON} select * from c")
def met_comparison(spark, sf):
    return rounded(M.comparison(kept_oof(spark, sf)), {"oof_rmsle", "fold_std"}, 8)


@query("met_best", f"{OOF_SQL}, {_COMPARISON} select * from c order by oof_rmsle, model limit 1")
def met_best(spark, sf):
    return rounded(M.best(M.comparison(kept_oof(spark, sf))), {"oof_rmsle", "fold_std"}, 8)


_CLS = f"with {DOC_FRAME_SQL}, t as (select doc_id, quality, case when n_chars > 1000 then 1 else 0 end as pred, n_chars from doc_frame where quality is not null)"


def _classified(spark, sf):
    return doc_frame(spark, sf).filter(F.col("quality").isNotNull()).withColumn("pred", F.when(F.col("n_chars") > 1000, 1).otherwise(0))


@query("met_confusion", f"{_CLS} select quality as actual, pred as predicted, count(*) as n from t group by 1, 2")
def met_confusion(spark, sf):
    return M.confusion(_classified(spark, sf), "quality", "pred")


@query("met_class_report", f"""{_CLS}, l as (select 0 as label union all select 1),
    c as (select label, sum(case when quality = label and pred = label then 1 else 0 end)::double as tp, sum(case when pred = label then 1 else 0 end)::double as g,
      sum(case when quality = label then 1 else 0 end)::bigint as support, avg(case when quality = pred then 1.0 else 0.0 end) as acc from t, l group by label)
    select cast(label as integer) as label, {rnd('tp / g', 8)} as precision, {rnd('tp / support', 8)} as recall, {rnd('2 * tp / (g + support)', 8)} as f1, support, {rnd('acc', 8)} as accuracy from c""")
def met_class_report(spark, sf):
    return rounded(M.class_report(_classified(spark, sf), "quality", "pred"), {"precision", "recall", "f1", "accuracy"}, 8)


@query("met_auc", f"""{_CLS}, r as (select quality, rank() over (order by n_chars) + (count(*) over (partition by n_chars) - 1) / 2.0 as r from t)
    select cast(sum(quality) as bigint) as n_pos, cast(sum(1 - quality) as bigint) as n_neg,
      {rnd('(sum(case when quality = 1 then r end) - sum(quality) * (sum(quality) + 1) / 2.0) / (sum(quality) * sum(1 - quality))', 8)} as auc from r""")
def met_auc(spark, sf):
    return rounded(M.auc(_classified(spark, sf), "quality", "n_chars"), {"auc"}, 8)


@query("met_roc", f"""{_CLS}, v as (select n_chars as v, sum(quality) as p, sum(1 - quality) as q from t group by 1)
    select cast(v as double) as threshold, {rnd('sum(p) over (order by v desc) / sum(p) over ()::double', 8)} as tpr,
      {rnd('sum(q) over (order by v desc) / sum(q) over ()::double', 8)} as fpr from v""")
def met_roc(spark, sf):
    return rounded(M.roc_curve(_classified(spark, sf), "quality", "n_chars"), {"tpr", "fpr"}, 8)


# Ensembles


@query("ens_vote", f"{OOF_SQL} select row_id, 'voting' as model, {rnd('exp(avg(ln(1 + pred))) - 1')} as pred from oof group by row_id")
def ens_vote(spark, sf):
    return rounded(M.vote(kept_oof(spark, sf), ["row_id"]), {"pred"})


@query("ens_soft_vote", f"""with {DOC_FRAME_SQL}, s as (select doc_id, n_chars / (n_chars + 1000.0) as p from doc_frame
      union all select doc_id, 1000.0 / (1000 + n_chars) from doc_frame union all select doc_id, case when lang = 'en' then 0.8 else 0.3 end from doc_frame)
    select doc_id, {rnd('avg(p)', 8)} as prob, case when avg(p) >= 0.5 then 1 else 0 end as label from s group by doc_id""")
def ens_soft_vote(spark, sf):
    docs = doc_frame(spark, sf)
    n = F.col("n_chars")
    three = F.explode(F.array(n / (n + 1000.0), 1000.0 / (1000 + n), F.when(F.col("lang") == "en", 0.8).otherwise(0.3)))
    return rounded(M.soft_vote(docs.select("doc_id", three.alias("prob")), ["doc_id"]), {"prob"}, 8)


_WIDE = """w as (select row_id, max(y) as y, max(case when model = 'mean' then pred end) as p0, max(case when model = 'mean_by_segment' then pred end) as p1,
    max(case when model = 'line_sum_qty' then pred end) as p2 from oof group by row_id)"""


def _wide(spark, sf):
    return M.wide_predictions(kept_oof(spark, sf), MODELS, ["row_id", "y"])


def _l(c):
    return f"ln(1 + greatest({c}, 1))"


@query("blend_nnls", f"{OOF_SQL}, {_WIDE}, c as (select * from w where p2 is not null) " + " union all ".join(
    f"select cast({i} as integer) as i, cast({j} as integer) as j, {rnd(f'avg({_l(f'p{i}')} * ' + (_l(f'p{j}') if j < 3 else 'ln(1 + y)') + ')', 6)} as value from c"
    for i in range(3) for j in range(i, 4)))
def blend_nnls(spark, sf):
    wide = _wide(spark, sf).filter(F.col("line_sum_qty").isNotNull())
    eq = M.blend_equations(wide, MODELS)
    n = wide.agg(F.count("*").alias("n"), F.lit(1).alias("one"))
    out = eq.withColumn("one", F.lit(1)).join(F.broadcast(n), "one")  # one row
    return rounded(out.select("i", "j", (F.col("value") / F.col("n")).alias("value")), {"value"}, 6)


@query("blend_nnls_weights")
def blend_nnls_weights(spark, sf):
    wide = _wide(spark, sf).filter(F.col("line_sum_qty").isNotNull())
    weights = M.blend_weights(wide, MODELS)
    return wide.agg(*[F.lit(w).alias(m) for m, w in weights.items()], F.sqrt(F.avg(F.pow(F.log1p(M.blend(weights)) - F.log1p("y"), F.lit(2)))).alias("rmsle"))


@query("blend_predict", f"""{OOF_SQL}, {_WIDE} select row_id, {rnd(f"exp(0.2 * {_l('p0')} + 0.3 * {_l('p1')} + 0.5 * {_l('p2')}) - 1")} as pred from w where p2 is not null""")
def blend_predict(spark, sf):
    wide = _wide(spark, sf).filter(F.col("line_sum_qty").isNotNull())
    return rounded(wide.select("row_id", M.blend(dict(zip(MODELS, [0.2, 0.3, 0.5]))).alias("pred")), {"pred"})


@query("blend_fixed", f"{OOF_SQL}, {_WIDE} select row_id, {rnd('0.1 * p0 + 0.3 * p1 + 0.6 * p2')} as pred from w")
def blend_fixed(spark, sf):
    return rounded(_wide(spark, sf).select("row_id", M.blend_arithmetic(dict(zip(MODELS, [0.1, 0.3, 0.6]))).alias("pred")), {"pred"})


@query("post_tail_adjust", f"""{OOF_SQL}, q as (select model, quantile_cont(pred, 0.005) as lo, quantile_cont(pred, 0.995) as hi from oof group by model),
    a as (select row_id, model, case when pred > lo then pred else pred * 0.77 end as p, hi from oof join q using (model))
    select row_id, model, {rnd('case when p < hi then p else p * 1.1 end')} as pred from a""")
def post_tail_adjust(spark, sf):
    return rounded(M.tail_adjust(kept_oof(spark, sf), "pred", ["model"]).select("row_id", "model", "pred"), {"pred"})


@query("post_floor", f"{OOF_SQL} select row_id, model, cast(floor(exp(ln(1 + pred)) - 1) as bigint) as pred from oof")
def post_floor(spark, sf):
    return kept_oof(spark, sf).select("row_id", "model", M.floor_back(F.log1p("pred")).alias("pred"))
