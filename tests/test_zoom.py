"""The zoom search: every step of the published method, for each of its families."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabwright.models import linear
from tabwright.models.front import Design, FrontEnd
from tabwright.plans import modelling


def test_zoom_refines_the_ratio_then_alpha_with_the_ratio_fixed(spark):
    """Elastic net has three steps; the second keeps every coarse alpha, the third one ratio."""
    rng = np.random.default_rng(2)
    data = [(float(a), float(b), float(2 * a + rng.normal()), i % 3) for i, (a, b) in enumerate(rng.normal(size=(90, 2)))]
    df = spark.createDataFrame(data, "a double, b double, y double, fold int")
    fr = FrontEnd(df, Design(["a", "b"], [], [], {}), 3, "y", transform="none")
    steps = dict(linear.zoom(fr, "elasticnet"))
    assert list(steps) == ["coarse", "ratio", "fine"] and len(steps["coarse"]) == 150 and len(steps["fine"]) == 17
    alphas = {p["alpha"] for p, _, _ in steps["coarse"]}
    first, second = steps["coarse"][0][0], steps["ratio"][0][0]
    ratios = {p["l1_ratio"] for p, _, _ in steps["ratio"]}
    assert ratios == {min(first["l1_ratio"] * s, 1.0) for s in linear.RATIO_STEPS} and len(steps["ratio"]) == len(ratios) * len(alphas)
    assert {p["alpha"] for p, _, _ in steps["ratio"]} == alphas
    assert {p["l1_ratio"] for p, _, _ in steps["fine"]} == {second["l1_ratio"]}
    assert sorted(p["alpha"] for p, _, _ in steps["fine"]) == pytest.approx([second["alpha"] * (0.6 + 0.05 * i) for i in range(17)])
    assert [n for n, _ in linear.zoom(fr, "lasso")] == ["coarse", "fine"]


def test_zoom_query_runs_all_families(spark, sf):
    got = {r["family"]: r["n"] for r in modelling.tune_zoom(spark, sf).groupBy("family").agg(F.count("*").alias("n")).collect()}
    assert set(got) == {"ridge coarse", "ridge fine", "lasso coarse", "lasso fine", "elasticnet coarse", "elasticnet ratio", "elasticnet fine"}
    assert got["elasticnet coarse"] == 150 and got["ridge coarse"] == 12 and got["lasso fine"] == 17
