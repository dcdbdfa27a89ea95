import itertools

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabwright.functions import scalar as X
from tabwright.models import linear, solvers
from tabwright.models.front import FrontEnd, coefficient_table, collect_design, predict
from tabwright.operators import learned as L
from tabwright.operators import metrics as M
from tabwright.operators import split as SP
from tabwright.plans import workbench as WB

K = 3


@pytest.fixture(scope="module")
def problem():
    rng = np.random.default_rng(3)
    X_ = rng.normal(size=(400, 6))
    X_[:, 5] = X_[:, 0] + 0.1 * rng.normal(size=400)
    y = X_ @ np.array([2.0, 0, -1, 0, 0.5, 0]) + rng.normal(size=400)
    Xc, yc = X_ - X_.mean(0), y - y.mean()
    return Xc, yc, Xc.T @ Xc, Xc.T @ yc


def test_ridge_and_ols(problem):
    Xc, yc, S, r = problem
    assert solvers.ols(S, r) == pytest.approx(np.linalg.lstsq(Xc, yc, rcond=None)[0])
    big = np.vstack([Xc, np.sqrt(5.0) * np.eye(6)])
    want = np.linalg.lstsq(big, np.append(yc, np.zeros(6)), rcond=None)[0]
    assert solvers.ridge(S, r, 5.0) == pytest.approx(want)
    with pytest.raises(ValueError):
        solvers.ridge(S, r, -1.0)


@pytest.mark.parametrize("alpha,ratio", [(0.05, 1.0), (0.3, 0.5), (0.001, 0.9), (2.0, 1.0)])
def test_elastic_net_optimality(problem, alpha, ratio):
    """The subgradient conditions hold, which characterises the optimum."""
    Xc, yc, S, r = problem
    n = len(yc)
    w = solvers.elastic_net(S, r, n, alpha, ratio, tol=1e-12)
    slope = Xc.T @ (yc - Xc @ w) / n - alpha * (1 - ratio) * w
    on = w != 0
    assert slope[on] == pytest.approx(alpha * ratio * np.sign(w[on]), abs=1e-8)
    assert np.all(np.abs(slope[~on]) <= alpha * ratio + 1e-8)


def test_bayesian_ridge_is_a_ridge_solution(problem):
    _, yc, S, r = problem
    w = solvers.bayesian_ridge(S, r, yc @ yc, len(yc))
    ratio = (r - S @ w) / w  # constant for any ridge solution
    assert ratio == pytest.approx(np.full(6, ratio[0]), rel=1e-6)


def test_nnls_against_all_supports():
    rng = np.random.default_rng(5)
    for _ in range(20):
        A, b = rng.normal(size=(30, 4)), rng.normal(size=30)
        best, best_w = b @ b, np.zeros(4)
        for size in range(1, 5):
            for idx in itertools.combinations(range(4), size):
                w = np.linalg.lstsq(A[:, idx], b, rcond=None)[0]
                if (w >= 0).all():
                    loss = np.sum((A[:, idx] @ w - b) ** 2)
                    if loss < best:
                        best, best_w = loss, np.zeros(4)
                        best_w[list(idx)] = w
        assert M.nonnegative_least_squares(A.T @ A, A.T @ b) == pytest.approx(best_w, abs=1e-8)


def test_all_zero_blend_becomes_equal(spark):
    wide = spark.createDataFrame([(0.0, 5.0, 9.0)], "y double, a double, b double")
    assert M.blend_weights(wide, ["a", "b"]) == {"a": 0.5, "b": 0.5}


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(11)
    n = 600
    g = rng.choice(["g1", "g2", "g3"], n, p=[0.5, 0.3, 0.2])
    x = rng.lognormal(1, 1, n) + np.where(g == "g2", 5, 0)
    z = rng.normal(50, 10, n)
    c = rng.choice(["red", "green", "blue"], n).astype(object)
    o = rng.choice(["1", "2", "10"], n).astype(object)
    y = np.exp(2 + 0.1 * x + 0.02 * z + (c == "red") + rng.normal(0, 0.1, n)) - 1
    x[rng.random(n) < 0.2] = np.nan
    z[rng.random(n) < 0.1] = np.nan
    c[rng.random(n) < 0.1] = None
    o[rng.random(n) < 0.1] = None
    fold = np.arange(n) % K
    c[7] = "rare"  # a level only fold 1 has
    pdf = pd.DataFrame({"id": np.arange(n), "fold": fold, "g": g, "x": x, "z": z, "c": c, "o": o, "y": y})
    data = [tuple(None if pd.isna(v) else (v.item() if hasattr(v, "item") else v) for v in r) for r in pdf.itertuples(index=False)]
    df = spark.createDataFrame(data, "id long, fold int, g string, x double, z double, c string, o string, y double")
    return pdf, df.repartition(4)


def psi(x, lam):
    return L._power_function()(np.asarray(x, dtype=float), lam, "yeo-johnson")


def brute(pdf, f, scaling, lam=None):
    """The preparation of fit f done row by row with pandas: (train, held out) matrices and targets."""
    tr = pdf[pdf.fold != f] if f < K else pdf
    te = pdf[pdf.fold == f] if f < K else pdf
    med = tr.groupby("g")["x"].median()
    fill_x = lambda d: d.x.fillna(d.g.map(med)).fillna(tr.x.median())
    cols_tr, cols_te = [], []
    for name, a, b in [("x", fill_x(tr), fill_x(te)), ("z", tr.z.fillna(tr.z.median()), te.z.fillna(tr.z.median()))]:
        a, b = a.to_numpy(), b.to_numpy()
        if scaling == "yeo-johnson":
            a, b = psi(a, lam[(f, name)]), psi(b, lam[(f, name)])
        if scaling in ("standard", "yeo-johnson"):
            m, s = a.mean(), a.std()
        elif scaling == "minmax":
            m, s = a.min(), a.max() - a.min()
        else:
            q = np.quantile(a, [0.25, 0.5, 0.75])
            m, s = q[1], q[2] - q[0]
        cols_tr.append((a - m) / s)
        cols_te.append((b - m) / s)
    mode = lambda s: s.dropna().value_counts().sort_index().idxmax()
    ca, cb = tr.c.fillna(mode(tr.c)), te.c.fillna(mode(tr.c))
    for level in sorted(ca.unique()):
        cols_tr.append((ca == level).to_numpy(float))
        cols_te.append((cb == level).to_numpy(float))
    o_mode = tr.o.dropna().value_counts().sort_index(key=lambda i: i.astype(float)).idxmax()  # ties: smallest number
    oa, ob = tr.o.fillna(o_mode), te.o.fillna(o_mode)
    code = {v: i for i, v in enumerate(sorted(oa.unique(), key=float))}
    cols_tr.append(oa.map(code).to_numpy(float))
    cols_te.append(ob.map(lambda v: code.get(v, -1)).to_numpy(float))
    return np.column_stack(cols_tr), np.log1p(tr.y.to_numpy()), np.column_stack(cols_te), te


@pytest.mark.parametrize("scaling", ["standard", "minmax", "robust", "yeo-johnson"])
def test_front_end_equals_row_by_row_preparation(spark, rows, scaling):
    """Every fold: same ridge predictions as preparing and fitting on the rows themselves."""
    pdf, df = rows
    design = collect_design(df, ["x", "z"], ["c"], ["o"], {"x": "g"})
    assert design.levels["o"] == ["1", "2", "10"]
    fr = FrontEnd(df, design, K, "y", scaling=scaling)
    coefs = coefficient_table(spark, fr, linear.fit_all(fr, {"m": ("ridge", {"alpha": 2.0})}))
    got = {r["id"]: r["z"] for r in predict(df, design, coefs, ["id"], "fold").collect()}
    for f in range(K):
        A, b, B, te = brute(pdf, f, scaling, fr.lam)
        m, bm = A.mean(0), b.mean()
        w = np.linalg.solve((A - m).T @ (A - m) + 2.0 * np.eye(A.shape[1]), (A - m).T @ (b - bm))
        want = bm + (B - m) @ w
        assert [got[i] for i in te.id] == pytest.approx(list(want), abs=1e-7)
        sse, n = fr.held_out_error(f, fr.base_coefficients(f, linear.FAMILIES["ridge"](fr.normal(f), {"alpha": 2.0})))
        assert sse / n == pytest.approx(np.mean((want - np.log1p(te.y)) ** 2), rel=1e-6)


def test_yeo_johnson_lambda_maximises_the_likelihood(rows):
    pdf, df = rows
    lam = L.fit_power(df, ["x"])[(0, "x")]
    x = pdf.x.dropna().to_numpy()
    ll = lambda t: -len(x) / 2 * np.log(psi(x, t).var()) + (t - 1) * np.sum(np.sign(x) * np.log1p(np.abs(x)))
    assert all(ll(lam) >= ll(lam + d) for d in (-0.01, -0.001, 0.001, 0.01))


def test_unknown_options_are_refused(rows):
    _, df = rows
    design = collect_design(df, ["x"], [], [])
    with pytest.raises(ValueError, match="scaling"):
        FrontEnd(df, design, K, "y", scaling="nope")
    with pytest.raises(ValueError, match="imputation"):
        FrontEnd(df, design, K, "y", numeric="nope")
    with pytest.raises(ValueError, match="transform"):
        X.target_pair("nope")
    with pytest.raises(ValueError, match="levels"):
        L.collect_levels(df, ["c", "o"], limit=2)


def test_transforms_invert(spark):
    df = spark.createDataFrame([(v,) for v in (-3.5, -1.0, -0.2, 0.0, 0.4, 1.0, 8.0)], "x double")
    for lam in (0.0, 0.5, 1.0, 2.0, 3.0, -1.0):
        back = df.select("x", X.inv_yeo_johnson(X.yeo_johnson(F.col("x"), lam), lam).alias("b")).collect()
        assert [r["b"] for r in back] == pytest.approx([r["x"] for r in back], abs=1e-9)
    for name in ("log", "boxcox", "none"):
        f, g = X.target_pair(name)
        out = df.filter("x >= 0").select("x", g(f(F.col("x"))).alias("b")).collect()
        assert [r["b"] for r in out] == pytest.approx([r["x"] for r in out], abs=1e-9)


def test_sampled_candidates_are_repeatable():
    grid = linear.GRIDS["bayesian_ridge"]
    assert len(linear.candidates(grid)) == 1280
    assert linear.sampled(grid, 100) == linear.sampled(grid, 100)
    assert len(linear.sampled(linear.GRIDS["ridge"], 100)) == 7


def test_nested_stack_equals_refits(spark):
    """Weights and predictions of the stack against a plain nested refit of a line and a ridge line."""
    rng = np.random.default_rng(5)
    n, k = 600, WB.K
    x = rng.normal(3, 2, n)
    y = np.exp(0.3 * x + rng.normal(0, 0.5, n) + 5)
    rows = SP.kfold(spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(zip(x, y))], "row_id int, x double, target double"), "row_id", k)
    rows = rows.withColumn("part", F.lit("fit"))
    fr = WB.line_front(rows, "x", transform="log", scaling="standard")
    chosen = {"line": ("ols", {}), "flat": ("ridge", {"alpha": 400.0})}
    wide, models = WB.wide_predictions(rows, fr, chosen)
    got = {r["row_id"]: r["stacking"] for r in WB.with_stack(wide, models, linear.nested_meta_fits(fr, {m: chosen[m] for m in models})).collect()}

    fold = {r["row_id"]: r["fold"] for r in rows.collect()}
    fold, z = np.array([fold[i] for i in range(n)]), np.log1p(y)

    def base(train, use, outer):
        m, s = x[outer].mean(), x[outer].std()
        u = (x - m) / s
        out = []
        for alpha in (0.0, 400.0):
            c = u[train] - u[train].mean()
            w = c @ (z[train] - z[train].mean()) / (c @ c + alpha)
            out.append(z[train].mean() + w * (u[use] - u[train].mean()))
        return np.array(out).T

    for f in range(k):
        outer = fold != f
        inner = np.zeros((n, 2))
        for g in range(k):
            if g != f:
                inner[fold == g] = base(outer & (fold != g), fold == g, outer)
        p, t = inner[outer], z[outer]
        c = p - p.mean(axis=0)
        w = np.linalg.solve(c.T @ c + np.eye(2), c.T @ (t - t.mean()))
        want = t.mean() + (base(outer, fold == f, outer) - p.mean(axis=0)) @ w
        assert np.allclose(want, [got[i] for i in np.flatnonzero(fold == f)], atol=1e-7)
