"""Normal distribution, distribution tests, best subsets, and the faults of constant, missing and forbidden values."""

import math
import time
from itertools import combinations
from statistics import NormalDist

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabwright.functions.scalar import normal_cdf, with_normal_quantile
from tabwright.models import linear
from tabwright.models.front import Design, FrontEnd
from tabwright.operators import learned as L
from tabwright.operators import stats as ST


def test_normal_distribution_in_generated_code(spark):
    zs = [-39.0, -9.5, -7.2, -6.9, -3.0, -1.0, -1e-9, 0.0, 0.4, 2.5, 7.0, 8.0]
    got = spark.createDataFrame([(z,) for z in zs], "z double").select("z", normal_cdf("z").alias("p")).collect()
    for r in got:
        assert r["p"] == pytest.approx(0.5 * math.erfc(-r["z"] / math.sqrt(2)), rel=1e-9, abs=1e-15)
    ps = [1e-300, 1e-15, 1e-6, 0.02, 0.0749, 0.0751, 0.3, 0.5, 0.9, 0.99999, 1 - 1e-12]
    got = with_normal_quantile(spark.createDataFrame([(p,) for p in [*ps, 0.0, 1.0, None]], "p double"), F.col("p"), "z").collect()
    for r in got:
        if r["p"] in ps:
            assert r["z"] == pytest.approx(NormalDist().inv_cdf(r["p"]), rel=1e-13, abs=1e-13)
        else:
            assert r["z"] is None


def test_w_of_known_samples(spark):
    df = spark.createDataFrame([(i, float(i), 5.0, float(i) if i < 4 else None, float(i) if i < 3 else None) for i in range(1, 11)], "id int, a double, c double, three double, two double")
    got = {r["column"]: r for r in ST.shapiro_wilk(df, ["a", "c", "three", "two"], "id").collect()}
    assert got["a"]["w"] == pytest.approx(0.97016, abs=1e-5) and got["a"]["p"] == pytest.approx(0.8924, abs=1e-4)
    assert got["three"]["w"] == pytest.approx(1.0) and got["three"]["p"] == pytest.approx(1.0, abs=1e-6)
    assert (got["c"]["w"], got["c"]["p"], got["two"]["w"]) == (None, None, None)


def test_w_takes_a_stable_sample_of_long_columns(spark):
    df = spark.range(12_000).withColumn("skewed", F.exp(F.rand(1) * 4))
    df = with_normal_quantile(df, (F.pmod(F.xxhash64("id"), F.lit(99_991)) + 0.5) / 99_991, "x")
    a, b = (ST.shapiro_wilk(d, ["x"], "id").first() for d in (df, df.repartition(13)))
    assert a["n"] == 5000 and a["w"] == pytest.approx(b["w"], rel=1e-12) and a["w"] > 0.998 and a["p"] > 0.001
    assert ST.shapiro_wilk(df, ["skewed"], "id").first()["p"] < 1e-6


def test_distance_to_the_normal_distribution(spark):
    rng = np.random.default_rng(8)
    x = np.r_[rng.normal(3, 2, 700), np.full(60, 3.5)]
    df = spark.createDataFrame([(float(v), 4.0) for v in x], "x double, c double")
    got = {r["column"]: r for r in ST.kolmogorov_smirnov(df, ["x", "c"]).collect()}
    s = np.sort(x)
    cdf = np.array([0.5 * math.erfc(-(v - x.mean()) / x.std(ddof=1) / math.sqrt(2)) for v in s])
    want = max((np.arange(1, len(s) + 1) / len(s) - cdf).max(), (cdf - np.arange(len(s)) / len(s)).max())
    assert got["x"]["d"] == pytest.approx(want, abs=1e-12) and got["x"]["n"] == 760 and 0 < got["x"]["p"] < 1
    assert got["c"]["d"] is None and got["c"]["p"] is None


def test_density_of_a_constant_column(spark):
    df = spark.createDataFrame([(4.0,), (4.0,), (float("nan"),), (None,)], "x double")
    assert [(r["x"], r["density"]) for r in ST.density_curve(df, "x").collect()] == [(4.0, None)]
    rows = {r["bin"]: r["n"] for r in ST.histogram(spark.createDataFrame([(0.0,), (1.0,), (2.0,), (float("nan"),)], "x double"), ["x"], 2).collect()}
    assert rows == {0: 1, 1: 2}


@pytest.mark.parametrize("parts", [1, 2, 5])
def test_values_outside_the_domain_end_the_fit(spark, parts):
    rows = [(float(i % 9),) for i in range(80)]
    bad = spark.createDataFrame([*rows, (-1.5,)], "x double").repartition(parts)
    with pytest.raises(Exception, match="above -1"):
        L.fit_power(bad, ["x"], method="boxcox1p")
    good = spark.createDataFrame([*rows, (float("nan"),), (None,)], "x double").repartition(parts)
    lam = L.fit_power(good, ["x"], method="boxcox1p")[0, "x"]
    assert lam == pytest.approx(L.fit_power(spark.createDataFrame(rows, "x double"), ["x"], method="boxcox1p")[0, "x"], abs=1e-6)


def test_lambda_keeps_its_digits_far_from_zero(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(1e7, 1.0, 500)
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    assert np.isfinite(L.fit_power(df, ["x"])[0, "x"])


def test_a_target_outside_the_log_ends_the_fit(spark):
    df = spark.createDataFrame([(float(i), 2.0 * i if i else -3.0, i % 2) for i in range(40)], "x double, y double, fold int")
    with pytest.raises(Exception, match="not defined at"):
        FrontEnd(df, Design(["x"], [], [], {}), 2, "y")


def _sums(p, n=400, seed=0):
    rng = np.random.default_rng(seed)
    X = rng.normal(size=(n, p)) @ (np.eye(p) + 0.3 * rng.normal(size=(p, p)))
    y = X[:, ::4].sum(axis=1) + 0.3 * X[:, 1] + rng.normal(size=n)
    X, y = X - X.mean(axis=0), y - y.mean()
    return X.T @ X, X.T @ y, float(y @ y)


def test_best_subsets_equal_enumeration():
    S, r, yy = _sums(12)
    found = linear.best_subsets(S, r, yy)
    for size in range(1, 13):
        best = min((yy - r[list(c)] @ np.linalg.solve(S[np.ix_(c, c)], r[list(c)]), c) for c in combinations(range(12), size))
        assert found[size - 1][1] == best[1] and found[size - 1][0] == pytest.approx(best[0], rel=1e-8)


def test_thirty_columns_in_seconds():
    S, r, yy = _sums(30, 3000, 4)
    start = time.time()
    found = linear.best_subsets(S, r, yy)
    assert time.time() - start < 60 and [len(c) for _, c in found] == list(range(1, 31))
    errors = [e for e, _ in found]
    assert errors == sorted(errors, reverse=True)
