import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabwright.functions import order as O


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(1)
    n = 3000
    x = np.where(rng.random(n) < 0.35, 7.0, rng.lognormal(3, 2, n))  # one value holds a third of the rows
    x[rng.random(n) < 0.1] = np.nan
    g = np.where(rng.random(n) < 0.4, "hot", rng.choice(["a", "b", "c"], n)).astype(object)
    g[:50] = None
    pdf = pd.DataFrame({"id": np.arange(n), "g": g, "x": x, "y": rng.normal(size=n), "fold": rng.integers(0, 3, n)})
    rows = [tuple(None if pd.isna(v) else (v.item() if hasattr(v, "item") else v) for v in r) for r in pdf.itertuples(index=False)]
    return pdf, spark.createDataFrame(rows, "id long, g string, x double, y double, fold int").repartition(5)


def test_quantiles_match_numpy(skewed):
    pdf, df = skewed
    probs = [0.0, 0.005, 0.25, 0.5, 0.9, 1.0]
    got = {(r["column"], r["prob"]): r["value"] for r in O.exact_quantiles(df, ["x", "y"], probs).collect()}
    for c in ("x", "y"):
        for p in probs:
            assert got[(c, p)] == pytest.approx(np.nanquantile(pdf[c], p), abs=1e-12)


def test_group_medians_with_null_group(skewed):
    pdf, df = skewed
    got = {r["g"]: r["value"] for r in O.exact_quantiles(df, ["x"], [0.5], by=["g"]).collect()}
    want = pdf.groupby("g", dropna=False)["x"].median()
    assert len(got) == len(want)
    for g, v in want.items():
        assert got[None if pd.isna(g) else g] == pytest.approx(v, abs=1e-12)


def test_fold_medians_leave_their_fold_out(skewed):
    pdf, df = skewed
    got = {(r["fit_fold"], r["g"]): r["value"] for r in O.exact_quantiles(df, ["x"], [0.5], by=["g"], fold="fold", k=3).collect()}
    for f in range(4):
        part = pdf if f == 3 else pdf[pdf.fold != f]
        for g, v in part.groupby("g", dropna=False)["x"].median().items():
            assert got[(f, None if pd.isna(g) else g)] == pytest.approx(v, abs=1e-12)


def test_changing_a_fold_leaves_its_own_fit_alone(skewed):
    _, df = skewed
    other = df.withColumn("x", F.when(F.col("fold") == 1, F.col("x") * 100 + 5).otherwise(F.col("x")))
    pick = lambda d: {r["fit_fold"]: r["value"] for r in O.exact_quantiles(d, ["x"], [0.5], fold="fold", k=3).collect()}
    a, b = pick(df), pick(other)
    assert a[1] == b[1]
    assert a[3] != b[3]


def test_ranks_match_pandas(skewed):
    pdf, df = skewed
    got = {r["value"]: r["before"] + (r["cnt"] + 1) / 2 for r in O.rank_values(df, ["x"]).collect()}
    want = dict(zip(pdf.x.dropna(), pdf.x.dropna().rank()))
    assert got == pytest.approx(want)


@pytest.fixture(scope="module")
def deep(spark):
    """One column over many powers of ten, with heavy values at both ends and in the middle."""
    rng = np.random.default_rng(5)
    x = np.r_[np.full(400, -9e9), np.full(300, 1e9), np.full(500, 2.5), rng.lognormal(0, 6, 1200).round(3), -rng.lognormal(0, 3, 400)]
    rng.shuffle(x)
    g = np.where(rng.random(len(x)) < 0.7, "hot", "cold")
    pdf = pd.DataFrame({"g": g, "x": x, "fold": rng.integers(0, 3, len(x))})
    return pdf, spark.createDataFrame(pdf).withColumn("fold", F.col("fold").cast("int")).repartition(6)


def test_tiny_cells_are_split_again_and_ranks_stay_exact(deep):
    pdf, df = deep
    got = {r["value"]: (r["before"], r["cnt"], r["total"]) for r in O.rank_values(df, ["x"], buckets=4, cell=8).collect()}
    order = pdf.x.value_counts().sort_index()
    want = {v: (b, c, len(pdf)) for v, b, c in zip(order.index, order.cumsum() - order, order)}
    assert got == want
    by = {(r["g"], r["value"]): (r["before"], r["total"]) for r in O.rank_values(df, ["x"], ["g"], buckets=4, cell=8).collect()}
    for g, part in pdf.groupby("g"):
        order = part.x.value_counts().sort_index()
        for v, b in zip(order.index, order.cumsum() - order):
            assert by[g, v] == (b, len(part))


def test_no_cell_stays_unsplit(deep):
    _, df = deep
    long = O.melt_numeric(df, ["x"], ["g"]).groupBy("g", "column", "value").agg(F.count("*").alias("cnt")).cache()
    rows, _, local = O.cells(long, ["g"], buckets=4, cell=8, weight="cnt")
    sizes = rows.groupBy("g", "bucket").agg(F.count("*").alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi")).collect()
    assert not local and max(r["n"] for r in sizes) <= 8
    digits = max(r["bucket"] for r in sizes).bit_length() / O.DIGIT_BITS
    assert digits > 2  # three splits at least
    ordered = sorted((r["g"], r["bucket"], r["lo"], r["hi"]) for r in sizes)
    assert all(a[3] < b[2] for a, b in zip(ordered, ordered[1:]) if a[0] == b[0])


@pytest.mark.parametrize("by", [[], ["g"]])
def test_quantiles_through_several_splits(deep, by):
    pdf, df = deep
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = {(*[r[c] for c in by], r["prob"]): r["value"] for r in O.exact_quantiles(df, ["x"], probs, by=by, buckets=4, cell=8).collect()}
    for g, part in pdf.groupby("g") if by else [((), pdf)]:
        for p in probs:
            assert got[(*([g] if by else []), p)] == pytest.approx(np.quantile(part.x, p), rel=1e-12)
    folds = O.exact_quantiles(df, ["x"], [0.5], by=by, fold="fold", k=3, buckets=4, cell=8).collect()
    for r in folds:
        part = pdf[(pdf.fold != r["fit_fold"]) & ((pdf.g == r["g"]) if by else True)]
        assert r["value"] == pytest.approx(np.quantile(part.x, 0.5), rel=1e-12) and r["n"] == len(part)
    assert len(folds) == 4 * (2 if by else 1)


def test_value_order_through_several_splits(spark):
    ids = [int(v) for v in np.random.default_rng(2).permutation(np.r_[np.arange(700), 10**12 + np.arange(700) ** 3])]
    df = spark.createDataFrame([(i,) for i in ids], "id long").repartition(4)
    got = {r["id"]: r["rn"] for r in O.value_order(df, "id", buckets=4, cell=8).collect()}
    assert got == {v: i + 1 for i, v in enumerate(sorted(ids))}


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,), (None,)], "x double")
    assert O.exact_quantiles(df, ["x"], [0.5]).first()["value"] == 2.0
    assert {r["value"]: r["total"] for r in O.rank_values(df, ["x"]).collect()} == {1.0: 2, 3.0: 2}


def test_hash_order_is_the_global_order(skewed):
    _, df = skewed
    want = df.withColumn("h", O.hash_key("id", 9)).select(
        "id", F.row_number().over(W.orderBy("h", "id")).alias("rn")).collect()
    got = O.hash_order(df.select("id"), "id", 9).collect()
    assert {r["id"]: r["rn"] for r in got} == {r["id"]: r["rn"] for r in want}


def test_value_order_is_the_key_order(skewed):
    pdf, df = skewed
    got = {r["id"]: r["rn"] for r in O.value_order(df.select("id"), "id").collect()}
    assert got == {i: i + 1 for i in range(len(pdf))}


def test_rank_levels_many_strings(spark):
    names = [f"k{(i * 7919) % 100003:06d}" for i in range(9000)]
    df = spark.createDataFrame([("c", n) for n in set(names)], "column string, level string")
    for cell in (100, 1 << 20):
        got = {r["level"]: r["code"] for r in O.rank_levels(df, cell=cell).collect()}
        assert got == {n: i for i, n in enumerate(sorted(set(names)))}


def test_modes_break_ties_to_the_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), ("c",)], "v string")
    assert O.most_frequent(O.value_counts(df, ["v"]), ["column"]).first()["value"] == "a"


@pytest.mark.parametrize("rows", [[], [(None,)], [(4.5,)], [(2.0,), (2.0,)]])
def test_edge_tables(spark, rows):
    df = spark.createDataFrame(rows, "x double")
    got = [r["value"] for r in O.exact_quantiles(df, ["x"], [0.5]).collect()]
    present = [r[0] for r in rows if r[0] is not None]
    assert got == ([float(np.median(present))] if present else [])
