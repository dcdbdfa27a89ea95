import math

import numpy as np
import pytest

from tabwright.operators import select as S


def _psi(n):
    return -0.5772156649015329 + sum(1 / i for i in range(1, n))


def brute(levels, values, k):
    """The estimator row by row, over all distances."""
    rows = [(a, v) for a, v in zip(levels, values) if a is not None and v is not None and math.isfinite(v)]
    rows = [(a, v) for a, v in rows if sum(b == a for b, _ in rows) > 1]
    if not rows:
        return None
    total = 0.0
    for i, (a, v) in enumerate(rows):
        own = sorted(abs(v - u) for j, (b, u) in enumerate(rows) if b == a and j != i)
        use = min(k, len(own))
        r = own[use - 1]
        m = sum((v - r < u < v + r) if r > 0 else u == v for _, u in rows)
        total += _psi(use) - _psi(len(own) + 1) - _psi(m)
    return max(0.0, _psi(len(rows)) + total / len(rows))


def _frame(spark, digits=1, equal=0.3, seed=3, n=500):
    rng = np.random.default_rng(seed)
    hot = np.where(rng.random(n) < 0.4, "hot", rng.choice(["a", "b", "c"], n)).tolist()
    y = np.round(rng.normal(size=n) + np.array([{"hot": 0, "a": 1, "b": 2, "c": 5}[h] for h in hot]), digits)
    y[rng.random(n) < equal] = 1.5
    rows = [(h, str(i % 7), "same", f"own{i}", float(v)) for i, (h, v) in enumerate(zip(hot, y))]
    rows[0] = ("lonely", *rows[0][1:])
    rows[1] = (None, *rows[1][1:])
    rows[2] = (*rows[2][:4], None)
    rows[3] = (*rows[3][:4], float("nan"))
    rows[4] = (*rows[4][:4], float("-inf"))
    return rows, spark.createDataFrame(rows, "hot string, seven string, same string, own string, y double").repartition(5)


@pytest.mark.parametrize("k,stride,digits,equal", [(3, 8, 1, 0.3), (3, 4096, 3, 0.03), (7, 2, 3, 0.01)])
def test_equals_brute_force_with_ties(spark, k, stride, digits, equal):
    rows, df = _frame(spark, digits, equal)
    cols = ["hot", "seven", "same", "own"]
    got = {r["column"]: r["mi"] for r in S.mutual_information_neighbours(df, cols, "y", k, stride, cell=40).collect()}
    want = {c: brute([r[i] for r in rows], [r[4] for r in rows], k) for i, c in enumerate(cols)}
    assert set(got) == {c for c, v in want.items() if v is not None}
    for c, v in got.items():
        assert v == pytest.approx(want[c], abs=1e-9)
    assert digits == 1 or got["hot"] > 0.2 > got["seven"]  # ties add to the rows within a radius


def test_empty_frame(spark):
    _, df = _frame(spark)
    assert S.mutual_information_neighbours(df.filter("false"), ["hot"], "y").collect() == []


def test_digamma(spark):
    from pyspark.sql import functions as F

    for r in spark.range(1, 60).select("id", S.digamma(F.col("id")).alias("p")).collect():
        assert r["p"] == pytest.approx(_psi(r["id"]), abs=1e-9)
