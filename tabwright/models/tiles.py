"""Cross-products of wide designs as partitioned tiles, and solvers that only multiply by them.

The driver holds vectors as long as the design is wide; the matrix stays in the cluster, as the
non-zero cells of square tiles, one set per fold. A fit's matrix is the sum over its folds, so every
multiplication serves all fits at once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.models import solvers
from tabwright.session import few_tasks, materialize

TILE = 1024  # rows and columns of a tile
PENDING = 4_000_000  # cells that a task gathers before it sums them
DENSE_BYTES = 64 << 20  # of the dense columns' products that one task holds


class TiledGram:
    """Per fold sums of b b' for rows b = [1, dense columns, flags, target]; upper triangle only.

    `rows` holds `fold` (int), `dense` (array of doubles: all present), `flags` (distinct indices into the
    flag part, ascending) and `y` (double). Products of dense columns are matrix products of batches,
    in as many runs over the rows as their blocks need; cells that a flag takes part in are summed by their place.
    """

    def __init__(self, rows: DataFrame, n_dense: int, n_flags: int, k: int, tile: int = TILE) -> None:
        self.n_dense, self.n_flags, self.k, self.tile = n_dense, n_flags, k, tile
        self.width = 1 + n_dense + n_flags + 1
        self.spark = rows.sparkSession
        self.tiles = materialize(self._build(rows), "tiles")

    def _build(self, rows: DataFrame) -> DataFrame:
        nd, width, tile, first = self.n_dense, self.width, self.tile, 1 + self.n_dense
        inner = np.r_[np.arange(first), width - 1]  # places of the dense part, target included
        per_run = max(1, DENSE_BYTES // (8 * len(inner)))
        runs = [(lo, min(len(inner), lo + per_run)) for lo in range(0, len(inner), per_run)]

        def tiles_of(keys: np.ndarray, values: np.ndarray) -> Iterator[pd.DataFrame]:
            fold, i, j = keys // width // width, keys // width % width, keys % width
            at = np.lexsort((j, i, j // tile, i // tile, fold))
            fold, i, j, values = fold[at], i[at], j[at], values[at]
            ids = np.stack([fold, i // tile, j // tile])
            heads = np.flatnonzero(np.r_[True, (ids[:, 1:] != ids[:, :-1]).any(axis=0)]) if len(at) else at
            place = (i % tile * tile + j % tile).astype(np.int32)
            out = [(int(fold[a]), int(i[a] // tile), int(j[a] // tile), place[a:b].tobytes(), values[a:b].tobytes()) for a, b in zip(heads, [*heads[1:], len(at)])]
            yield pd.DataFrame(out, columns=["fold", "bi", "bj", "place", "value"])

        def summed(keys: list, values: list) -> tuple[np.ndarray, np.ndarray]:
            keys, back = np.unique(np.concatenate(keys), return_inverse=True)
            return keys, np.bincount(back, weights=np.concatenate(values), minlength=len(keys))

        def partial(run: int):
            lo, hi = runs[run]

            def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
                dense: dict[int, np.ndarray] = {}
                keys, values, pending = [], [], 0
                for batch in batches:
                    if not len(batch):
                        continue
                    fold = batch["fold"].to_numpy().astype(np.int64)
                    m = np.empty((len(batch), len(inner)))
                    m[:, 0], m[:, -1] = 1.0, batch["y"].to_numpy()
                    if nd:
                        m[:, 1:-1] = np.stack(batch["dense"].to_numpy())
                    for f in np.unique(fold):
                        part = m[fold == f]
                        g = part[:, lo:hi].T @ part
                        dense[int(f)] = dense[int(f)] + g if int(f) in dense else g
                    if run:
                        continue
                    size = np.array([len(x) for x in batch["flags"]])
                    for n in np.unique(size[size > 0]):
                        some = size == n
                        flags = np.stack(batch["flags"].to_numpy()[some]).astype(np.int64) + first
                        head = fold[some][:, None] * width * width
                        low, high = np.triu_indices(n)
                        keys.append((head + flags[:, low] * width + flags[:, high]).ravel())
                        values.append(np.ones(len(keys[-1])))
                        for f in range(n):
                            # dense columns stand before the flags, the target after them
                            keys.append((head + inner[:-1] * width + flags[:, f : f + 1]).ravel())
                            values.append(m[some][:, :-1].ravel())
                        keys.append((head + flags * width + width - 1).ravel())
                        values.append(np.repeat(m[some][:, -1], n))
                        pending += int(some.sum()) * n * (n + len(inner))
                    if pending > PENDING:
                        k, v = summed(keys, values)
                        keys, values, pending = [k], [v], 0
                        if len(k) > PENDING:
                            yield from tiles_of(k, v)
                            keys, values = [], []
                for f, g in dense.items():
                    i, j = np.repeat(inner[lo:hi], len(inner)), np.tile(inner, hi - lo)
                    upper = (i <= j) & (g.ravel() != 0)
                    yield from tiles_of(f * width * width + (i * width + j)[upper], g.ravel()[upper])
                if keys:
                    yield from tiles_of(*summed(keys, values))

            return work

        def merge(pdf: pd.DataFrame) -> pd.DataFrame:
            place = np.concatenate([np.frombuffer(p, np.int32) for p in pdf["place"]])
            value = np.concatenate([np.frombuffer(v, np.float64) for v in pdf["value"]])
            place, back = np.unique(place, return_inverse=True)
            value = np.bincount(back, weights=value, minlength=len(place))
            return pdf.iloc[:1].assign(place=[place.astype(np.int32).tobytes()], value=[value.tobytes()])

        schema = "fold int, bi int, bj int, place binary, value binary"
        tasks = few_tasks(rows.select("fold", "dense", "flags", "y"))
        parts = tasks.mapInPandas(partial(0), schema)
        for run in range(1, len(runs)):
            parts = parts.unionByName(tasks.mapInPandas(partial(run), schema))
        return parts.groupBy("fold", "bi", "bj").applyInPandas(merge, schema)

    def multiply(self, vectors: Mapping[tuple[int, str], np.ndarray]) -> dict[tuple[int, str], np.ndarray]:
        """G_f v for every (fit, name): fit f sums the folds other than f, and fit k all of them. One job."""
        width, tile = self.width, self.tile
        names = sorted(vectors)
        fits = np.array([f for f, _ in names])
        v = np.stack([vectors[n] for n in names])

        def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            out: dict[int, np.ndarray] = {}
            for batch in batches:
                for fold, bi, bj, place, value in batch.itertuples(index=False):
                    place, value = np.frombuffer(place, np.int32), np.frombuffer(value, np.float64)
                    i, j = place // tile, place % tile
                    off = (bi != bj) | (i != j)  # cells that also stand for their mirror image
                    for a, b, x, y, w in ((bi, bj, i, j, value), (bj, bi, j[off], i[off], value[off])):
                        size = min(tile, width - a * tile)
                        block = out.setdefault(a, np.zeros((len(names), size)))
                        for r in np.flatnonzero(fits != fold):
                            block[r] += np.bincount(x, weights=w * v[r, b * tile + y], minlength=size)
            for b, block in out.items():
                yield pd.DataFrame({"row": np.arange(len(names)), "block": b, "part": [p.tobytes() for p in block]})

        def add(pdf: pd.DataFrame) -> pd.DataFrame:
            total = np.sum([np.frombuffer(p, np.float64) for p in pdf["part"]], axis=0)
            return pdf.iloc[:1].assign(part=[total.tobytes()])

        schema = "row int, block int, part binary"
        found = self.tiles.mapInPandas(work, schema).groupBy("row", "block").applyInPandas(add, schema).collect()
        out = {n: np.zeros(width) for n in names}
        for r in found:
            out[names[r["row"]]][r["block"] * tile :][: tile] = np.frombuffer(r["part"], np.float64)
        return out

    def cells(self, wanted: np.ndarray, fit: int) -> np.ndarray:
        """The dense matrix of one fit over the given places (ascending): for the few that a solver works on."""
        wanted = np.asarray(wanted)
        places, tile = wanted.copy(), self.tile

        def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for fold, bi, bj, place, value in batch.itertuples(index=False):
                    if fold == fit:
                        continue
                    place, value = np.frombuffer(place, np.int32), np.frombuffer(value, np.float64)
                    i, j = bi * tile + place // tile, bj * tile + place % tile
                    a, b = np.searchsorted(places, i), np.searchsorted(places, j)
                    hit = (a < len(places)) & (b < len(places))
                    hit[hit] = (places[a[hit]] == i[hit]) & (places[b[hit]] == j[hit])
                    if hit.any():
                        yield pd.DataFrame({"a": a[hit], "b": b[hit], "s": value[hit]})

        found = self.tiles.mapInPandas(work, "a int, b int, s double").groupBy("a", "b").agg(F.sum("s").alias("s")).toPandas()
        out = np.zeros((len(wanted), len(wanted)))
        a, b, s = found["a"].to_numpy(), found["b"].to_numpy(), found["s"].to_numpy()
        out[a, b] = s
        out[b, a] = s
        return out

    def diagonal(self) -> dict[int, np.ndarray]:
        """The diagonal for every fit."""
        tile, width = self.tile, self.width

        def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for fold, bi, bj, place, value in batch.itertuples(index=False):
                    place, value = np.frombuffer(place, np.int32), np.frombuffer(value, np.float64)
                    on = place // tile == place % tile
                    yield pd.DataFrame({"fold": fold, "i": bi * tile + place[on] // tile, "s": value[on]})

        found = self.tiles.filter("bi = bj").mapInPandas(work, "fold int, i int, s double").toPandas()
        out = {}
        for f in range(self.k + 1):
            part = found[found["fold"] != f]
            out[f] = np.bincount(part["i"], weights=part["s"], minlength=width)
        return out


class Prepared:
    """Features of one fit as sums of weighted base places: `feature`, `place`, `weight` are parallel arrays."""

    def __init__(self, names: Sequence[str], feature: np.ndarray, place: np.ndarray, weight: np.ndarray, width: int) -> None:
        self.names, self.feature, self.place, self.weight, self.width = list(names), feature, place, weight, width

    def base(self, w: np.ndarray) -> np.ndarray:
        """T' w: weights on features as weights on the base."""
        return np.bincount(self.place, weights=self.weight * w[self.feature], minlength=self.width)

    def features(self, g: np.ndarray) -> np.ndarray:
        """T g: sums over the base as sums over features."""
        return np.bincount(self.feature, weights=self.weight * g[self.place], minlength=len(self.names))


class WideNormal:
    """Centred normal equations S w = r of each fit, given only as a product with S."""

    def __init__(self, gram: TiledGram, prepared: Mapping[int, Prepared]) -> None:
        self.gram, self.prepared = gram, prepared
        one, y = np.zeros(gram.width), np.zeros(gram.width)
        one[0], y[-1] = 1.0, 1.0
        sums = gram.multiply({(f, n): v for f in prepared for n, v in (("one", one), ("y", y))})
        self.n = {f: sums[f, "one"][0] for f in prepared}
        self.z_sum = {f: p.features(sums[f, "one"]) for f, p in prepared.items()}
        self.y_mean = {f: sums[f, "one"][-1] / self.n[f] for f in prepared}
        self.r = {f: p.features(sums[f, "y"]) - self.z_sum[f] * self.y_mean[f] for f, p in prepared.items()}

    def apply(self, w: Mapping[int, np.ndarray]) -> dict[int, np.ndarray]:
        """S w for several fits in one job."""
        got = self.gram.multiply({(f, "w"): self.prepared[f].base(x) for f, x in w.items()})
        return {f: self.prepared[f].features(got[f, "w"]) - self.z_sum[f] * (self.z_sum[f] @ x / self.n[f]) for f, x in w.items()}

    def scale(self) -> dict[int, np.ndarray]:
        """A positive diagonal close to that of S, for preconditioning."""
        diagonal = self.gram.diagonal()
        out = {}
        for f, p in self.prepared.items():
            own = np.bincount(p.feature, weights=p.weight**2 * diagonal[f][p.place], minlength=len(p.names))
            out[f] = np.maximum(own - self.z_sum[f] ** 2 / self.n[f], 1e-8 * np.maximum(own, 1e-300))
        return out

    def intercept(self, f: int, w: np.ndarray) -> float:
        return float(self.y_mean[f] - w @ self.z_sum[f] / self.n[f])


def ridge(eq: WideNormal, alpha: float, tol: float = 1e-10, max_iter: int = 500) -> dict[int, np.ndarray]:
    """min ||y - Zw||^2 + alpha ||w||^2 for every fit, by preconditioned conjugate gradients.

    Fits go on together, so that each step is one job; one that has converged takes no part in later ones.
    """
    if alpha < 0:
        raise ValueError("alpha must not be negative")
    inverse = {f: 1.0 / (d + alpha + (d.max(initial=0.0) * 1e-14 if alpha == 0 else 0.0) + 1e-300) for f, d in eq.scale().items()}
    w = {f: np.zeros(len(r)) for f, r in eq.r.items()}
    left = {f: r.copy() for f, r in eq.r.items()}
    z = {f: inverse[f] * left[f] for f in left}
    step, rho = {f: z[f].copy() for f in z}, {f: left[f] @ z[f] for f in z}
    first = dict(rho)
    for _ in range(max_iter):
        going = [f for f in w if rho[f] > tol**2 * first[f] and rho[f] > 0]
        if not going:
            return w
        moved = eq.apply({f: step[f] for f in going})
        for f in going:
            q = moved[f] + alpha * step[f]
            a = rho[f] / (step[f] @ q)
            w[f] += a * step[f]
            left[f] -= a * q
            z = inverse[f] * left[f]
            new = left[f] @ z
            step[f] = z + new / rho[f] * step[f]
            rho[f] = new
    raise RuntimeError(f"conjugate gradients did not settle in {max_iter} steps")


def elastic_net(eq: WideNormal, alpha: float, l1_ratio: float, tol: float = 1e-6, grow: int = 200, rounds: int = 200) -> dict[int, np.ndarray]:
    """min 1/(2n) ||y - Zw||^2 + alpha l1_ratio ||w||_1 + alpha (1 - l1_ratio)/2 ||w||^2 for every fit.

    A working set is solved densely; one multiplication then gives the gradient of all features, and
    those that break their optimality condition most join the set. What the driver holds grows with the features that
    the solution uses, not with the design.
    """
    l1, l2 = alpha * l1_ratio, alpha * (1 - l1_ratio)
    out = {}
    for f, r in eq.r.items():
        n, p = eq.n[f], eq.prepared[f]
        w, used = np.zeros(len(r)), np.empty(0, dtype=int)
        for _ in range(rounds):
            gradient = (r - (eq.apply({f: w})[f] if w.any() else 0.0)) / n - l2 * w
            over = np.abs(gradient) - l1
            over[used] = 0.0
            worst = np.argsort(-over)[:grow]
            worst = worst[over[worst] > tol]
            if not len(worst):
                break
            used = np.sort(np.r_[used, worst])
            mine = np.isin(p.feature, used)
            places = np.unique(p.place[mine])
            t = np.zeros((len(used), len(places)))
            np.add.at(t, (np.searchsorted(used, p.feature[mine]), np.searchsorted(places, p.place[mine])), p.weight[mine])
            s = t @ eq.gram.cells(places, f) @ t.T - np.outer(eq.z_sum[f][used], eq.z_sum[f][used]) / n
            w[used] = solvers.elastic_net(s, r[used], n, alpha, l1_ratio, start=w[used], tol=1e-10)
        else:
            raise RuntimeError("the working set did not settle")
        out[f] = w
    return out


SOLVERS: dict[str, Callable[..., dict[int, np.ndarray]]] = {
    "ridge": lambda eq, p: ridge(eq, p["alpha"]),
    "lasso": lambda eq, p: elastic_net(eq, p["alpha"], 1.0),
    "elasticnet": lambda eq, p: elastic_net(eq, p["alpha"], p["l1_ratio"]),
}
