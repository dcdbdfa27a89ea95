"""Wide designs: level tables in place of literals, tiles in place of a driver matrix."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabwright.functions import joins
from tabwright.models import solvers, tiles
from tabwright.models.wide import WideFront
from tabwright.operators.codes import LevelCodes


def test_fifty_thousand_levels(spark, monkeypatch, tmp_path):
    df = spark.range(60_000).select(F.col("id"), F.concat(F.lit("u"), F.col("id") % 50_000).alias("user"), F.when(F.col("id") % 7 > 0, (F.col("id") % 3).cast("string")).alias("kind"))
    codes = LevelCodes.fit(df, ["user", "kind"])
    assert codes.sizes == {"user": 50_000, "kind": 3} and codes.width == 50_003
    order = {u: i for i, u in enumerate(sorted(f"u{i}" for i in range(50_000)))}
    new = df.limit(50).unionByName(spark.createDataFrame([(-1, "nobody", None), (-2, None, "2")], "id long, user string, kind string"))
    want = {r["id"]: [(order.get(r["user"]), 1.0)] * (r["user"] in order) + [(50_000 + int(r["kind"] or 0), 1.0)] * (r["kind"] is not None) for r in new.collect()}
    got = lambda c: {r["id"]: [tuple(e) for e in r["codes"]] for r in c.entries(new).collect()}
    assert got(codes) == want and want[-1] == [] and want[-2] == [(50_002, 1.0)]
    codes.save(str(tmp_path))
    assert got(LevelCodes.load(spark, str(tmp_path), ["user", "kind"])) == want
    monkeypatch.setattr(joins, "BROADCAST_BYTES", -1)
    assert got(codes) == want
    first = {r["id"]: [e["index"] for e in r["codes"]] for r in codes.entries(new, drop_first=True).collect()}
    assert all(50_000 not in v for v in first.values())


def _prepared(pdf, xs, cats, fit, k, levels):
    """The features of a fit, row by row, for all rows of the frame."""
    mine = (pdf.fold != fit) & (pdf.fold < k)
    cols = []
    for c in xs:
        x = pdf[c].fillna(pdf[c][mine].median())
        cols.append(((x - x[mine].mean()) / x[mine].std(ddof=0)).to_numpy())
    for c in cats:
        counts = pdf[c][mine].value_counts()
        mode = min(counts[counts == counts.max()].index)
        v = pdf[c].fillna(mode)
        cols += [(v == x).to_numpy().astype(float) for x in levels[c] if x in counts.index]
    return np.stack(cols, axis=1), mine.to_numpy()


@pytest.fixture(scope="module")
def wide(spark):
    rng = np.random.default_rng(11)
    n = 9000
    pdf = pd.DataFrame({"id": np.arange(n), "x": rng.normal(50, 9, n), "z": rng.lognormal(1, 1, n), "fold": rng.integers(0, 3, n),
                        "u": [f"u{i}" for i in rng.permutation(n) % 4950], "v": [f"v{i}" for i in rng.integers(0, 60, n)]})
    pdf.loc[rng.random(n) < 0.1, "x"] = np.nan
    pdf.loc[rng.random(n) < 0.05, "v"] = None
    pdf["y"] = 0.2 * pdf.x.fillna(40) + pdf.z + pdf.u.str[1:].astype(int) % 7 + rng.normal(size=n)
    rows = [tuple(None if isinstance(v, float) and np.isnan(v) else v for v in r) for r in pdf.astype(object).itertuples(index=False)]
    df = spark.createDataFrame(rows, "id long, x double, z double, fold int, u string, v string, y double").repartition(4)
    return pdf, df, WideFront(df, ["x", "z"], ["u", "v"], 3, "y", transform="none")


@pytest.mark.parametrize("family, params", [("ridge", {"alpha": 2.0}), ("lasso", {"alpha": 0.001}), ("elasticnet", {"alpha": 0.02, "l1_ratio": 0.7})])
def test_five_thousand_columns_equal_the_dense_solver(wide, family, params):
    pdf, df, front = wide
    assert front.gram.width > 5000
    weights = front.fit(family, params)
    out = front.predict(df, {"m": weights}, ["id", "fold"]).toPandas().set_index("id")["m"]
    levels = {c: sorted(pdf[c].dropna().unique()) for c in ("u", "v")}
    for f in (0, 3):
        Z, mine = _prepared(pdf, ["x", "z"], ["u", "v"], f, 3, levels)
        y, X = pdf.y.to_numpy()[mine], Z[mine]
        mean, ym = X.mean(axis=0), y.mean()
        S, r = X.T @ X - len(y) * np.outer(mean, mean), X.T @ y - len(y) * mean * ym
        w = solvers.ridge(S, r, params["alpha"]) if family == "ridge" else solvers.elastic_net(S, r, len(y), params["alpha"], params.get("l1_ratio", 1.0), tol=1e-11)
        want = ym + (Z - mean) @ w
        if f < 3:
            held = pdf.index[pdf.fold == f]
            assert np.abs(out.loc[pdf.id[held]].to_numpy() - want[held]).max() < 2e-4
        assert front.normal.intercept(f, w) + front.y_shift == pytest.approx(ym - mean @ w, abs=1e-6)
        assert weights[f] @ _base(front, pdf, 0) == pytest.approx(want[0], abs=2e-4)


def _base(front, pdf, i):
    """The base vector of one row."""
    row, out = pdf.iloc[i], np.zeros(front.gram.width)
    out[0] = 1.0
    at = 1 + len(front.continuous)
    for j, c in enumerate(front.continuous):
        if pd.isna(row[c]):
            out[at + j] = 1.0
        else:
            out[1 + j] = row[c] - front.shift[j]
    at += len(front.continuous)
    for j, c in enumerate(front.categorical):
        levels = sorted(pdf[c].dropna().unique())
        out[at + front.codes.start[c] + levels.index(row[c]) if row[c] is not None else at + front.codes.width + j] = 1.0
    return out


def test_tiles_equal_the_whole_matrix(spark, monkeypatch):
    rng = np.random.default_rng(3)
    n, nd, nf = 400, 5, 37
    flags = [sorted(rng.choice(nf, rng.integers(0, 4), replace=False).tolist()) for _ in range(n)]
    dense, y, fold = rng.normal(size=(n, nd)), rng.normal(size=n), rng.integers(0, 2, n)
    B = np.zeros((n, 2 + nd + nf))
    B[:, 0], B[:, 1 : 1 + nd], B[:, -1] = 1.0, dense, y
    for i, f in enumerate(flags):
        B[i, [1 + nd + j for j in f]] = 1.0
    df = spark.createDataFrame([(int(fold[i]), dense[i].tolist(), flags[i], float(y[i])) for i in range(n)], "fold int, dense array<double>, flags array<int>, y double")
    for pending, bytes_ in ((4_000_000, 64 << 20), (50, 8 * 7 * 3)):
        monkeypatch.setattr(tiles, "PENDING", pending)
        monkeypatch.setattr(tiles, "DENSE_BYTES", bytes_)
        gram = tiles.TiledGram(df, nd, nf, 2, tile=8)
        v = rng.normal(size=B.shape[1])
        got = gram.multiply({(0, "a"): v, (2, "a"): v, (2, "b"): 2 * v})
        for f, rows in ((0, fold != 0), (2, fold < 9)):
            assert np.allclose(got[f, "a"], B[rows].T @ (B[rows] @ v))
            assert np.allclose(gram.diagonal()[f], (B[rows] ** 2).sum(axis=0))
            some = np.array([0, 3, 9, 20, 43])
            assert np.allclose(gram.cells(some, f), (B[rows].T @ B[rows])[np.ix_(some, some)])
        assert np.allclose(got[2, "b"], 2 * got[2, "a"])


def test_edges(spark):
    df = spark.createDataFrame([(1.0, None, 0, 2.0), (2.0, "a", 1, 3.0), (None, "a", 0, 4.0), (5.0, "b", 1, None)], "x double, c string, fold int, y double")
    front = WideFront(df, ["x"], ["c"], 2, "y", transform="none")
    out = front.predict(df.withColumn("fold", F.lit(2)), {"m": front.fit("ridge", {"alpha": 1.0})}, ["y"]).collect()
    assert len(out) == 4 and all(np.isfinite(r["m"]) for r in out)
    with pytest.raises(ValueError):
        front.fit("ridge", {"alpha": -1.0})
