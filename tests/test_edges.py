"""Constant columns, perfect fits, one class, empty frames: ratios are null, nothing aborts."""

import pytest
from pyspark.sql import functions as F

from tabwright.models import trees
from tabwright.operators import metrics as M
from tabwright.operators import profile as P
from tabwright.operators import select as SEL
from tabwright.operators import split as SP
from tabwright.operators import stats as ST


@pytest.fixture(scope="module")
def flat(spark):
    rows = [(i, float(i), 7.0, 2.0 * i + 1, None, 1) for i in range(12)]
    return spark.createDataFrame(rows, "id int, x double, c double, y double, gone double, label int")


@pytest.mark.parametrize("width", [3, 20])
def test_correlation_with_a_constant_is_null_whatever_the_width(flat, width):
    cols = ["x", "c", "gone"] + [f"v{i}" for i in range(width - 3)]
    df = flat.select("x", "c", "gone", *[(F.col("x") * (i + 1) + F.col("x") % (i + 2)).alias(f"v{i}") for i in range(width - 3)])
    got = {(r["left"], r["right"]): (r["n"], r["r"]) for r in ST.correlation_pairs(df, cols).collect()}
    assert len(got) == width * (width - 1) // 2
    assert got["x", "c"] == (12, None) and got["x", "gone"] == (0, None)
    assert all(r is not None for k, (_, r) in got.items() if "c" not in k and "gone" not in k)
    assert ST.correlation_pairs(df.limit(0), cols).filter("r is not null").count() == 0


def test_scores_of_constant_and_perfect_columns(flat):
    f = {r["column"]: r["f"] for r in SEL.f_regression(flat, ["x", "c", "gone"], "y").collect()}
    assert f["c"] is None and f["gone"] is None and (f["x"] is None or f["x"] > 1e12)
    assert {r["column"]: r["r"] for r in ST.correlation_with(flat, ["x", "c"], "y").collect()}["c"] is None
    assert [r["rho"] for r in ST.spearman(flat, ["c"], "y").collect()] == [None]
    assert [r["z"] for r in P.extremes(flat, "id", "c", 1).collect()] == [None, None]
    assert [r["f"] for r in SEL.anova_f(flat, ["x"], "label").collect()] == [None]
    zero = flat.withColumn("zero", F.lit(0))
    assert [r["chi2"] for r in SEL.chi2(zero, ["zero"], "label").collect()] == [None]
    assert SEL.correlated_columns(flat, ["x", "c", "y"], 0.5).collect()[0]["column"] == "y"


def test_metrics_of_constant_targets_and_one_class(spark):
    df = spark.createDataFrame([(5.0, 5.0, 1, 0.2), (5.0, 6.0, 1, 0.3)], "y double, pred double, label int, score double")
    assert M.regression_scores(df).first()["r2"] is None
    row = M.error_decomposition(df).first()
    assert row["rse"] is None and row["rae"] is None and row["adj_r2"] is None
    assert M.auc(df, "label", "score").first()["auc"] is None
    assert [r["fpr"] for r in M.roc_curve(df, "label", "score").collect()] == [None, None]
    empty = df.limit(0)
    assert M.regression_scores(empty).first()["r2"] is None and M.auc(empty, "label", "score").first()["auc"] is None


def test_line_predicts_every_row(spark):
    rows = [(i, None if i % 5 == 0 else float(i), 10.0 + i) for i in range(60)]
    df = SP.kfold(spark.createDataFrame(rows, "k int, x double, t double"), "k", 4)
    got = M.oof_line(df, "k", "x", "t", 4).collect()
    assert len(got) == 60 and all(r["pred"] is not None for r in got)
    constant = M.oof_line(df.withColumn("x", F.lit(3.0)), "k", "x", "t", 4).collect()
    mean = {r["k"]: r["pred"] for r in M.oof_mean(df, "k", "t", 4).collect()}
    assert all(r["pred"] == pytest.approx(mean[r["k"]]) for r in constant)


def test_tail_limits_per_model(spark):
    rows = [("a", float(i)) for i in range(1, 401)] + [("b", 1000.0 + i) for i in range(1, 401)]
    got = M.tail_adjust(spark.createDataFrame(rows, "model string, pred double"), "pred", ["model"]).groupBy("model").agg(F.min("pred"), F.max("pred"))
    assert {r[0]: (r[1], r[2]) for r in got.collect()} == {"a": (pytest.approx(0.77), pytest.approx(440.0)), "b": (pytest.approx(1001 * 0.77), pytest.approx(1540.0))}


def test_level_rows_for_any_number_of_levels(spark):
    df = spark.range(30_000).select(F.col("id").alias("n"), F.concat(F.lit("s"), F.lpad("id", 6, "0")).alias("s"), F.lit("k").alias("c"))
    got = P.level_rows(df, ["n", "s", "c"])
    assert {r["column"]: r["count"] for r in got.groupBy("column").count().collect()} == {"n": 30_000, "s": 30_000, "c": 1}
    assert got.filter("column = 'n' and number <> position - 1").count() == 0
    assert got.filter("column = 's' and cast(substring(level, 2, 6) as int) <> position - 1").count() == 0


def test_vectors_of_mixed_width_and_missing_positions_stay(spark):
    rows = [(i, [float(i), 1.0 + i % 3] if i % 2 else [float(i), 2.0, float(i * i), 1.0]) for i in range(20)] + [(20, [None, 1.0])]
    df = spark.createDataFrame(rows, "id int, v array<double>")
    flat = SEL.array_columns(df, "v")
    assert flat.columns == ["e0", "e1", "e2", "e3"]
    assert trees.cluster(flat, flat.columns, 2, 2).transform(flat).count() == 21


def test_stop_rule():
    assert trees.stop_at([5, 4, 3, 4, 4, 4, 1], patience=3) == 3
    assert trees.stop_at([5, 4, 3, 2], patience=3) == 4
