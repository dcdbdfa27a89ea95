"""Queries: readers, sinks, stored models and batch scoring."""

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from tabwright.models import linear, trees
from tabwright.models.front import coefficient_table
from tabwright.models.stages import stage_of
from tabwright.plans import workbench as WB
from tabwright.plans.modelling import LINE_SQL, line_rows
from tabwright.plans.registry import query, rnd, rnd_col, rounded
from tabwright.session import new_path
from tabwright.sources import readers as R
from tabwright.sources import sinks as K
from tabwright.sources.tables import ORDER_FRAME_SQL, order_frame, staged_order_frame, table
from tabwright.streaming.score import score_arrivals

CUSTOMER = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
_NA_SQL = "select c_custkey, c_name, c_nationkey, case when c_acctbal >= 0 then c_acctbal end as c_acctbal, c_mktsegment from customer"


def _csv_with_missing(spark, sf, token):
    path = new_path(spark, "customer_csv")
    customer = table(spark, sf, "customer").withColumn("c_acctbal", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")))
    customer.write.option("header", True).option("nullValue", token).csv(path)
    return path


@query("src_csv", _NA_SQL)
def src_csv(spark, sf):
    return R.read_csv(spark, _csv_with_missing(spark, sf, "NA"), CUSTOMER)


@query("src_csv_inferred", "select c_custkey, c_acctbal, c_mktsegment from (" + _NA_SQL + ")")
def src_csv_inferred(spark, sf):
    df = R.read_csv(spark, _csv_with_missing(spark, sf, "NA"))
    return df.select(F.col("c_custkey").cast("bigint").alias("c_custkey"), "c_acctbal", "c_mktsegment")


@query("src_na_token", _NA_SQL)
def src_na_token(spark, sf):
    return R.read_csv(spark, _csv_with_missing(spark, sf, "#NAME?"), CUSTOMER, missing="#NAME?")


@query("src_head_rows", "select l_orderkey, l_linenumber, l_partkey, l_quantity from lineitem order by l_orderkey, l_linenumber, l_partkey, l_quantity, l_suppkey limit 350")
def src_head_rows(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_suppkey")
    return lines.orderBy("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_suppkey").limit(350).drop("l_suppkey")


@query("src_head_rows_key", "select * from orders order by o_orderkey limit 500")
def src_head_rows_key(spark, sf):
    return R.head_rows(table(spark, sf, "orders"), "o_orderkey", 500)


@query("src_load_split", f"with {ORDER_FRAME_SQL} select row_id, segment, sum_qty, {rnd('target')} as target, split from order_frame")
def src_load_split(spark, sf):
    frame = staged_order_frame(spark, sf).select("row_id", "segment", "sum_qty", rnd_col("target", 4).alias("target"), "split")
    train = frame.filter(F.col("split") == "train").drop("split")
    test = frame.filter(F.col("split") == "test").drop("split", "target")
    return R.load_split(train, test, "row_id", "target")


@query("sink_predictions", "select o_orderkey as row_id, o_totalprice as pred from orders")
def sink_predictions(spark, sf):
    preds = table(spark, sf, "orders").select(F.col("o_orderkey").alias("row_id"), F.col("o_totalprice").alias("pred"))
    path = K.write_predictions(preds, new_path(spark, "predictions"), "ridge", "log")
    return R.read_csv(spark, path, "row_id bigint, pred double")


def _stored(spark, sf):
    """Path of a saved ridge model on the full feature set."""
    fr = WB.front(spark, sf)
    coefs = coefficient_table(spark, fr, linear.fit_all(fr, {"ridge": ("ridge", linear.DEFAULTS["ridge"])}))
    path = new_path(spark, "model")
    K.LinearScorer(fr.design, coefs, "log", WB.K).save(path)
    return path


@query("sink_model")
def sink_model(spark, sf):
    return spark.read.parquet(f"{_stored(spark, sf)}/coefficients").select("model", "fit_fold", F.posexplode("coef").alias("position", "weight"))


@query("src_model")
def src_model(spark, sf):
    scorer = K.LinearScorer.load(spark, _stored(spark, sf))
    test = WB.prepared(spark, sf).filter(F.col("part") == "test")
    return scorer.score(test, ["row_id"])


@query("src_model_trees")
def src_model_trees(spark, sf):
    """Preparation and trees stored as one pipeline, loaded, and applied."""
    fr = WB.front(spark, sf)
    t = trees.TreeTrainer(WB.prepared(spark, sf), WB.CONTINUOUS, WB.CATEGORICAL, WB.ORDINAL, "target", WB.K, stages={f: stage_of(fr, f) for f in fr.fits})
    path = new_path(spark, "tree_model")
    t.fit(trees.forest(5, 5), WB.K).write().overwrite().save(path)
    return t.score(PipelineModel.load(path), WB.K, "forest", ["row_id"])


@query("score_batch")
def score_batch(spark, sf):
    """Raw test rows to a validated prediction file: cleaning is part of scoring."""
    scorer = K.LinearScorer.load(spark, _stored(spark, sf))
    raw = order_frame(spark, sf).filter(F.col("split") == "test")
    scored = scorer.score(WB.clean(raw), ["row_id"])
    path = K.write_predictions(scored, new_path(spark, "scored"), "ridge", "log")
    return R.read_csv(spark, path, "row_id bigint, pred double")


def _two_lines_sql():
    one = "case when p < 1 then 1 else p end"
    return f"""{LINE_SQL},
      w as (select r / n / s as b1, yb - r / n / s * m as a1, r / (n + 1000) / s as b2, yb - r / (n + 1000) / s * m as a2 from r),
      z as (select row_id, a1 + b1 * x as l, a2 + b2 * x as d from t, w),
      v as (select row_id, 5 + 0.25 * l + 0.5 * d as stack, (l + d) / 2 as vote, 0.3 * {one.replace('p', 'l')} + 0.7 * {one.replace('p', 'd')} as blend, d as ridge from z)
      select row_id, {rnd('stack', 4)} as stack, {rnd('vote', 4)} as vote, {rnd('blend', 4)} as blend, {rnd('ridge', 4)} as ridge from v"""


@query("score_batch_ensemble", _two_lines_sql())
def score_batch_ensemble(spark, sf):
    """A stored ensemble of two models: stack, vote, blend and best from one artefact in one map."""
    rows, fr = line_rows(spark, sf)
    coefs = coefficient_table(spark, fr, linear.fit_all(fr, {"line": ("ols", {}), "ridge": ("ridge", {"alpha": 1000.0})}))
    parts = {"stack": {"kind": "stack", "intercept": 5.0, "weights": {"line": 0.25, "ridge": 0.5}},
             "vote": {"kind": "vote", "weights": {"line": 0.5, "ridge": 0.5}},
             "blend": {"kind": "blend", "weights": {"line": 0.3, "ridge": 0.7}}}
    path = new_path(spark, "ensemble")
    K.EnsembleScorer(fr.design, coefs, "none", fr.k, parts, "ridge").save(path)
    wide, _ = K.EnsembleScorer.load(spark, path).wide(rows, ["row_id"])
    return rounded(wide.drop("line"), {"stack", "vote", "blend", "ridge"}, 4)


@query("score_batch_best")
def score_batch_best(spark, sf):
    """The whole workflow stored as one model; raw test rows get the predictions of every combination."""
    path = new_path(spark, "composite")
    WB.composite(spark, sf, "standard").save(path)
    scorer = K.EnsembleScorer.load(spark, path)
    raw = order_frame(spark, sf).filter(F.col("split") == "test")
    return scorer.score(WB.clean(raw), ["row_id"], [*scorer.parts, scorer.best] if scorer.best not in scorer.parts else list(scorer.parts))


@query("score_stream")
def score_stream(spark, sf):
    """The same scoring over a stream of raw files."""
    source, sink = new_path(spark, "arrivals"), new_path(spark, "scored_stream")
    raw = staged_order_frame(spark, sf).filter(F.col("split") == "test")
    raw.write.parquet(source)
    score_arrivals(spark, source, raw.schema, _stored(spark, sf), sink, new_path(spark, "stream_progress"))
    return spark.read.parquet(sink)
