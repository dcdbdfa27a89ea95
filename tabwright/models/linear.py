"""Linear model families, searches and feature selection over a fitted front end.

Every candidate of every family is scored by cross-validation from the fold matrices, so a search
costs no pass over the data however many candidates it tries.
"""

from __future__ import annotations

import random
from collections.abc import Callable, Iterable, Mapping, Sequence
from itertools import combinations, product

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from tabwright.models import solvers
from tabwright.models.front import FrontEnd, Normal

Params = Mapping[str, float]


def _net(q: Normal, alpha: float, l1_ratio: float) -> np.ndarray:
    """Elastic net, started from the last solution of the same mixing ratio; settled to a part of the target's deviation."""
    tol = 1e-7 * max(1.0, float(np.sqrt(q.yy / q.n)))
    q.warm[l1_ratio] = solvers.elastic_net(q.S, q.r, q.n, alpha, l1_ratio, start=q.warm.get(l1_ratio), tol=tol)
    return q.warm[l1_ratio]


FAMILIES: dict[str, Callable[[Normal, Params], np.ndarray]] = {
    "ols": lambda q, p: solvers.ols(q.S, q.r),
    "ridge": lambda q, p: solvers.ridge(q.S, q.r, p["alpha"]),
    "lasso": lambda q, p: _net(q, p["alpha"], 1.0),
    "elasticnet": lambda q, p: _net(q, p["alpha"], p["l1_ratio"]),
    "bayesian_ridge": lambda q, p: solvers.bayesian_ridge(q.S, q.r, q.yy, q.n, spectrum=q.spectrum, **p),
}

# Defaults and search grids of the published configuration.
DEFAULTS: dict[str, dict[str, float]] = {
    "ols": {},
    "ridge": {"alpha": 1.0},
    "lasso": {"alpha": 0.0005},
    "elasticnet": {"alpha": 0.0005, "l1_ratio": 0.9},
    "bayesian_ridge": {"max_iter": 300},
}
_ALPHAS = [0.0001, 0.0003, 0.0005, 0.001, 0.003, 0.005, 0.01, 0.03, 0.1]
_PRIORS = [1e-7, 1e-6, 1e-5, 1e-4]
GRIDS: dict[str, dict[str, list[float]]] = {
    "ridge": {"alpha": [0.1, 0.5, 1.0, 2.0, 5.0, 10.0, 20.0]},
    "lasso": {"alpha": _ALPHAS},
    "elasticnet": {"alpha": _ALPHAS, "l1_ratio": [0.1, 0.3, 0.5, 0.7, 0.9, 0.95, 0.99]},
    "bayesian_ridge": {
        "alpha_1": _PRIORS, "alpha_2": _PRIORS, "lambda_1": _PRIORS, "lambda_2": _PRIORS,
        "max_iter": [100, 200, 300, 400, 500],
    },
}


def candidates(grid: Mapping[str, Sequence[float]]) -> list[dict[str, float]]:
    return [dict(zip(grid, values)) for values in product(*grid.values())]


def sampled(grid: Mapping[str, Sequence[float]], n: int, seed: int = 42) -> list[dict[str, float]]:
    """At most n different candidates, the same ones for the same seed."""
    every = candidates(grid)
    return every if n >= len(every) else random.Random(seed).sample(every, n)


def fit(front: FrontEnd, family: str, params: Params, f: int) -> np.ndarray:
    """Base-vector coefficients of one fit."""
    return front.base_coefficients(f, FAMILIES[family](front.normal(f), params))


def cv_error(front: FrontEnd, family: str, params: Params) -> tuple[float, list[float]]:
    """Mean over folds of the held-out mean squared error, and the folds."""
    errors = []
    for f in range(front.k):
        sse, n = front.held_out_error(f, fit(front, family, params, f))
        errors.append(sse / n)
    return float(np.mean(errors)), errors


SEARCH_SCHEMA = "family string, params string, rank int, mse double, rmse double, fold_sd double"


def search(front: FrontEnd, family: str, tries: Iterable[Params]) -> list[tuple[dict, float, list[float]]]:
    """(params, mean error, fold errors) sorted from best to worst; ties keep the given order."""
    scored = [(dict(p), *cv_error(front, family, p)) for p in tries]
    return sorted(scored, key=lambda t: t[1])


def search_rows(family: str, scored: Sequence[tuple[dict, float, list[float]]]) -> list[tuple]:
    text = lambda p: ", ".join(f"{k}={v:g}" for k, v in p.items())
    return [(family, text(p), i + 1, m, float(np.sqrt(m)), float(np.std(np.sqrt(e)))) for i, (p, m, e) in enumerate(scored)]


def search_table(spark: SparkSession, family: str, scored) -> DataFrame:
    return spark.createDataFrame(search_rows(family, scored), SEARCH_SCHEMA)


# The coarse lists of the published search, and the parts of the best value that are tried next.
ZOOM: dict[str, dict[str, list[float]]] = {
    "ridge": {"alpha": [0.01, 0.03, 0.06, 0.1, 0.3, 0.6, 1, 3, 6, 10, 30, 60]},
    "lasso": {"alpha": [0.0001, 0.0003, 0.0006, 0.001, 0.003, 0.006, 0.01, 0.03, 0.06, 0.1, 0.3, 0.6, 1]},
    "elasticnet": {"alpha": [0.0001, 0.0003, 0.0006, 0.001, 0.003, 0.006, 0.01, 0.03, 0.06, 0.1, 0.3, 0.6, 1, 3, 6],
                   "l1_ratio": [0.1, 0.3, 0.5, 0.6, 0.7, 0.8, 0.85, 0.9, 0.95, 1.0]},
}
ALPHA_STEPS = [0.6 + 0.05 * i for i in range(17)]
RATIO_STEPS = [0.85, 0.9, 0.95, 1.0, 1.05, 1.1, 1.15]


def zoom(front: FrontEnd, family: str = "ridge", start: Mapping[str, Sequence[float]] | None = None) -> list[tuple[str, list]]:
    """(step, scored candidates): a coarse grid, then alphas from 60 to 140 percent of the best one.

    With a mixing ratio there is a step between: ratios from 85 to 115 percent of the best one, 1 at most, each with every
    alpha of the coarse grid; the best of these fixes the ratio, and its alpha is the one refined.
    """
    start = start or ZOOM[family]
    steps = [("coarse", search(front, family, candidates(start)))]
    best = steps[-1][1][0][0]
    if "l1_ratio" in start:
        ratios = sorted({min(best["l1_ratio"] * s, 1.0) for s in RATIO_STEPS})
        steps.append(("ratio", search(front, family, candidates({**start, "l1_ratio": ratios}))))
        best = steps[-1][1][0][0]
    fine = {k: [v * s for s in ALPHA_STEPS] if k == "alpha" else [v] for k, v in best.items()}
    return [*steps, ("fine", search(front, family, candidates(fine)))]


def fit_all(front: FrontEnd, chosen: Mapping[str, tuple[str, Params]]) -> dict[tuple[str, int], np.ndarray]:
    """Coefficients of every named model for every fit: `{name: (family, params)}`."""
    return {(name, f): fit(front, family, p, f) for name, (family, p) in chosen.items() for f in front.fits}


def tuned(front: FrontEnd, families: Sequence[str], n_iter: int = 100, seed: int = 42) -> dict[str, tuple[str, dict]]:
    """Best parameters per family from a seeded search; a family without a grid keeps its defaults."""
    out = {}
    for fam in families:
        grid = GRIDS.get(fam)
        best = search(front, fam, sampled(grid, n_iter, seed))[0][0] if grid else DEFAULTS[fam]
        out[fam] = (fam, best)
    return out


# Selection ------------------------------------------------------------------------------------


def subset_r2(front: FrontEnd, names: Sequence[str]) -> float:
    """Mean held-out R squared of least squares on a subset of the prepared features."""
    scores = []
    for f in range(front.k):
        have = [c for c in names if c in front.prepared[f].names]
        q = front.normal(f).subset(have)
        coef = front.base_coefficients(f, solvers.ols(q.S, q.r), have)
        sse, n = front.held_out_error(f, coef)
        scores.append(1 - sse / n / front.held_out_variance(f))
    return float(np.mean(scores))


def forward(front: FrontEnd, pool: Sequence[str], k: int) -> list[tuple[int, str, float]]:
    """(step, feature added, score)"""
    chosen: list[str] = []
    steps = []
    for step in range(1, k + 1):
        scored = [(subset_r2(front, [*chosen, c]), c) for c in pool if c not in chosen]
        score, c = max(scored, key=lambda t: t[0])
        chosen.append(c)
        steps.append((step, c, score))
    return steps


def backward(front: FrontEnd, pool: Sequence[str], k: int) -> list[tuple[int, str, float]]:
    """(step, feature dropped, score of the rest) until k features are left"""
    rest = list(pool)
    steps = []
    while len(rest) > k:
        scored = [(subset_r2(front, [x for x in rest if x != c]), c) for c in rest]
        score, c = max(scored, key=lambda t: t[0])
        rest.remove(c)
        steps.append((len(steps) + 1, c, score))
    return steps


def exhaustive(front: FrontEnd, pool: Sequence[str], sizes: Iterable[int], limit: int = 5000) -> list[tuple[float, tuple[str, ...]]]:
    """Every subset of the given sizes, best first; refuses a pool with more than `limit` subsets."""
    subsets = [s for size in sizes for s in combinations(pool, size)]
    if len(subsets) > limit:
        raise ValueError(f"{len(subsets)} subsets; use forward or backward selection")
    return sorted(((subset_r2(front, s), s) for s in subsets), key=lambda t: -t[0])


def best_subsets(S: np.ndarray, r: np.ndarray, yy: float) -> list[tuple[float, tuple[int, ...]]]:
    """For each size from 1 to p the subset of least squared error: (error, columns). Branch and bound.

    The error of a set bounds that of all its subsets from below, so a branch ends when its set is
    no better than what is known for every size it leads to (Furnival and Wilson, 1974). Strong
    columns are fixed first: the large branches then start without one of them and end early. Dropping a
    column updates the inverse in place of solving again.
    """
    p = len(r)
    scale = np.sqrt(np.maximum(S.diagonal(), 1e-300))
    S, r = S / np.outer(scale, scale) + 1e-12 * np.eye(p), r / scale
    best: list[tuple[float, tuple[int, ...]]] = [(np.inf, ())] * (p + 1)

    def known(error: float, columns: np.ndarray) -> None:
        if len(columns) and error < best[len(columns)][0]:
            best[len(columns)] = (error, tuple(sorted(int(c) for c in columns)))

    def dropped(V: np.ndarray, b: np.ndarray, error: float, columns: np.ndarray, i: int):
        keep = np.arange(len(b)) != i
        part = V[keep, i] / V[i, i]
        return V[np.ix_(keep, keep)] - np.outer(part, V[i, keep]), b[keep] - part * b[i], error + b[i] ** 2 / V[i, i], columns[keep]

    V = np.linalg.inv(S)
    b = V @ r
    whole = (V, b, max(yy - b @ r, 0.0), np.arange(p))
    known(whole[2], whole[3])
    state = whole  # stepwise elimination gives the first bounds
    while len(state[1]) > 1:
        state = dropped(*state, int(np.argmin(state[1] ** 2 / state[0].diagonal())))
        known(state[2], state[3])

    stack = [(whole, 0)]
    while stack:
        (V, b, error, columns), fixed = stack.pop()
        loss = b**2 / V.diagonal()
        order = np.r_[np.arange(fixed), fixed + np.argsort(-loss[fixed:], kind="stable")]
        V, b, columns, loss = V[np.ix_(order, order)], b[order], columns[order], loss[order]
        for i in range(fixed, len(b)):
            lower = error + loss[i]
            known(lower, np.delete(columns, i))
            if any(best[size][0] > lower for size in range(max(i, 1), len(b) - 1)):
                stack.append((dropped(V, b, error, columns, i), i))
    return best[1:]


def leaps(front: FrontEnd, pool: Sequence[str]) -> list[tuple[int, tuple[str, ...], float, float]]:
    """(size, columns, R squared on all folds, cross-validated R squared) of the best subset of each size."""
    q = front.normal(front.k).subset(pool)
    found = best_subsets(q.S, q.r, q.yy)
    named = [tuple(pool[i] for i in columns) for _, columns in found]
    return [(i + 1, names, float(1 - error / q.yy), subset_r2(front, names)) for i, ((error, _), names) in enumerate(zip(found, named))]


def eliminate(front: FrontEnd, pool: Sequence[str]) -> list[tuple[int, str, float]]:
    """Recursive elimination by the smallest absolute coefficient: (features left, dropped next, CV score)."""
    rest = list(pool)
    steps = []
    while rest:
        q = front.normal(front.k).subset(rest)
        w = np.abs(solvers.ols(q.S, q.r)) * np.sqrt(np.maximum(q.S.diagonal() / q.n, 0.0))
        weakest = rest[int(np.argmin(w))]
        steps.append((len(rest), weakest, subset_r2(front, rest)))
        rest.remove(weakest)
    return steps


def coefficients(front: FrontEnd, family: str, params: Params) -> list[tuple[str, float]]:
    """(feature, weight) of the fit on all rows, largest absolute weight first."""
    q = front.normal(front.k)
    w = FAMILIES[family](q, params)
    return sorted(zip(q.names, w.tolist()), key=lambda t: -abs(t[1]))


def variance_inflation(front: FrontEnd, pool: Sequence[str]) -> list[tuple[str, float]]:
    """Diagonal of the inverse correlation matrix."""
    q = front.normal(front.k).subset(pool)
    sd = np.sqrt(q.S.diagonal())
    return list(zip(pool, np.linalg.inv(q.S / np.outer(sd, sd)).diagonal().tolist()))


def partial_fit(front: FrontEnd, f: int, train: Sequence[int], family: str, params: Params) -> np.ndarray:
    """Base-vector coefficients of a fit on some folds, with the preparation of fit f; no row is read."""
    v = front.variant(f)
    prep, G = front.prepared[f], sum(front.grams[(v, g)] for g in train)
    n = G[0, 0]
    zsum, ysum = prep.T @ G[:-1, 0], G[-1, 0]
    S = prep.T @ G[:-1, :-1] @ prep.T.T - np.outer(zsum, zsum) / n
    r = prep.T @ G[:-1, -1] - zsum * ysum / n
    w = FAMILIES[family](Normal(prep.names, S, r, G[-1, -1] - ysum * ysum / n, n, zsum / n, ysum / n), params)
    coef = w @ prep.T
    coef[0] += ysum / n + front.y_shifts[f] - w @ (zsum / n)
    return coef


def partial_error(front: FrontEnd, f: int, train: Sequence[int], family: str, params: Params) -> float:
    """Held-out error on fold f of a fit on some of the other folds, for a learning curve.

    Preparation stays that of fit f, which never saw fold f; only the normal equations shrink.
    """
    sse, held = front.held_out_error(f, partial_fit(front, f, train, family, params))
    return sse / held


def nested_meta_fits(front: FrontEnd, chosen: Mapping[str, tuple[str, Params]], alpha: float = 1.0) -> list[tuple[int, float, list[float]]]:
    """Ridge over the base models for every fit: (fit, intercept, weights).

    For the fit that leaves out fold f, the base models are refitted without f and each further fold in
    turn, and the meta model sees their predictions of that fold only; so nothing of fold f reaches the
    weights that score it. The sums of the predictions are products of the folds' matrices.
    """
    out = []
    for f in front.fits:
        v = front.variant(f)
        inner = [g for g in range(front.k) if g != f]
        total = 0.0
        for g in inner:
            rest = [h for h in inner if h != g]
            columns = [np.eye(front.design.width + 1)[0]]
            for family, params in chosen.values():
                coef = np.append(partial_fit(front, f, rest, family, params), 0.0)
                coef[0] -= front.y_shifts[f]  # predictions and target are taken around the same constant
                columns.append(coef)
            columns.append(np.eye(front.design.width + 1)[-1])
            B = np.array(columns).T
            total = total + B.T @ front.grams[(v, g)] @ B
        n, mean = total[0, 0], total[0, 1:-1] / total[0, 0]
        y_mean = total[0, -1] / n
        w = solvers.ridge(total[1:-1, 1:-1] - n * np.outer(mean, mean), total[1:-1, -1] - n * mean * y_mean, alpha)
        out.append((f, float(front.y_shifts[f] * (1 - w.sum()) + y_mean - w @ mean), [float(x) for x in w]))
    return out
