"""Folded linear models over factors of any width: indices of levels in the rows, tiles in the cluster.

The preparation is that of the front end: continuous columns get the fit's median and are standardised, every
level is an indicator, a null level counts as the fit's most frequent one, an unseen level as none. All
of it is linear in [1, values or 0, null flags, level flags, null flags of factors, target], so
one pass over the rows serves all fits.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.functions.scalar import target_pair
from tabwright.models.tiles import SOLVERS, Prepared, TiledGram, WideNormal
from tabwright.operators import learned as L
from tabwright.operators.codes import LevelCodes
from tabwright.session import materialize


class WideFront:
    """Fits of a frame with a `fold` column in 0..k-1 (k marks rows outside all folds); fit k uses every fold."""

    def __init__(self, df: DataFrame, continuous: Sequence[str], categorical: Sequence[str], k: int, target: str, *,
                 fold: str = "fold", transform: str = "log", tile: int | None = None) -> None:
        self.continuous, self.categorical, self.k, self.target, self.fold = list(continuous), list(categorical), k, target, fold
        self.forward, self.inverse = target_pair(transform)
        rows = df.filter(F.col(target).isNotNull() & (F.col(fold) < k))
        self.codes = LevelCodes.fit(rows, categorical)
        y = self.forward(F.col(target).cast("double"))
        seen = L.fit_moments(rows.withColumn("__y", y), [*self.continuous, "__y"]).collect()
        means = {r["column"]: r["mean"] for r in seen}
        self.y_shift = means["__y"]
        self.shift = [means.get(c, 0.0) for c in self.continuous]
        self.n_flags = len(self.continuous) + self.codes.width + len(self.categorical)
        base = self.base_rows(rows).withColumn("y", y - self.y_shift).withColumn("fold", F.col(fold).cast("int"))
        # the rows' indices are written: every run over the rows reads them instead of looking them up
        base = materialize(base.select("fold", "dense", "flags", "y"), "wide-rows")
        self.gram = TiledGram(base, len(self.continuous), self.n_flags, k, **({"tile": tile} if tile else {}))
        medians = L.fit_median(rows, self.continuous, fold, k).collect() if self.continuous else []
        self.fill = {(r[L.FIT], r["column"]): r["value"] for r in medians}
        self.prepared = self._prepare()
        self.normal = WideNormal(self.gram, self.prepared)

    def base_rows(self, df: DataFrame) -> DataFrame:
        """`df` with `dense` (centred values, 0 for null) and `flags` (ascending indices of the flags that are set)."""
        nc, at = len(self.continuous), len(self.continuous) + self.codes.width
        coded = self.codes.attach(df, "__index")
        xs = [F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None)) - s, F.lit(0.0)) for c, s in zip(self.continuous, self.shift)]
        gone = lambda c: F.col(c).isNull() | F.isnan(F.col(c).cast("double"))
        flags: list[Column] = [F.when(gone(c), i) for i, c in enumerate(self.continuous)]
        flags += [F.col(f"{c}__index") + nc for c in self.categorical]
        flags += [F.when(F.col(c).isNull(), at + i) for i, c in enumerate(self.categorical)]
        cells = [f.cast("int") for f in flags]
        made = F.sort_array(F.filter(F.array(*cells), lambda x: x.isNotNull())) if cells else F.array().cast("array<int>")
        dense = F.array(*xs) if xs else F.array().cast("array<double>")
        return coded.withColumns({"dense": dense, "flags": made}).drop(*[f"{c}__index" for c in self.categorical])

    def _prepare(self) -> dict[int, Prepared]:
        nc, width, first = len(self.continuous), self.gram.width, 1 + len(self.continuous)
        one = np.zeros(width)
        one[0] = 1.0
        counts = self.gram.multiply({(f, "one"): one for f in range(self.k + 1)})
        # squares and value-by-null-flag products of a continuous column lie in the dense part of the matrix
        out = {}
        for f in range(self.k + 1):
            g = counts[f, "one"]
            n = g[0]
            names, feature, place, weight = [], [], [], []
            near = np.arange(first + nc)
            G = self.gram.cells(near, f) if nc else None
            for i, c in enumerate(self.continuous):
                value = self.fill.get((f, c), 0.0) - self.shift[i]
                row = np.zeros(len(near))
                row[1 + i], row[first + i] = 1.0, value
                mean = row @ G[:, 0] / n
                var = row @ G @ row / n - mean * mean
                scale = np.sqrt(var) if var > 1e-20 else 1.0
                names.append(c)
                feature += [i, i, i]
                place += [0, 1 + i, first + i]
                weight += [-mean / scale, 1.0 / scale, value / scale]
            feature, place, weight = np.array(feature, dtype=int), np.array(place, dtype=int), np.array(weight, dtype=float)
            at, begin = nc, first + nc
            for i, c in enumerate(self.categorical):
                size = self.codes.sizes[c]
                here = g[begin : begin + size]
                present = np.flatnonzero(here > 0)
                number = at + np.arange(len(present))
                feature, place, weight = np.r_[feature, number], np.r_[place, begin + present], np.r_[weight, np.ones(len(present))]
                if len(present):
                    mode = int(np.searchsorted(present, np.argmax(here)))
                    feature, place, weight = np.r_[feature, number[mode]], np.r_[place, first + nc + self.codes.width + i], np.r_[weight, 1.0]
                names += [f"{c}#{j}" for j in present]
                at, begin = at + len(present), begin + size
            out[f] = Prepared(names, feature, place, weight, width)
        return out

    def fit(self, family: str, params: Mapping[str, float]) -> dict[int, np.ndarray]:
        """Weights on the base, intercept first, for every fit; the target's place stays 0."""
        found = SOLVERS[family](self.normal, params)
        out = {}
        for f, w in found.items():
            base = self.prepared[f].base(w)
            base[0] += self.normal.intercept(f, w) + self.y_shift
            out[f] = base
        return out

    def predict(self, df: DataFrame, weights: Mapping[str, Mapping[int, np.ndarray]], keep: Sequence[str], fit: str = "fold") -> DataFrame:
        """`keep` and a column per model in the transformed target: a map over the rows once their indices are found."""
        models = sorted(weights)
        tables = {f: np.stack([weights[m][f] for m in models]) for f in weights[models[0]]}
        shared = df.sparkSession.sparkContext.broadcast(tables)  # models x fits vectors of the design's width
        first = 1 + len(self.continuous)

        def score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
            for fits, dense, flags in batches:
                z = np.full((len(fits), len(models)), np.nan)
                for f in np.unique(fits):
                    if f not in shared.value:
                        continue
                    w, idx = shared.value[f], np.flatnonzero(fits.to_numpy() == f)
                    part = np.tile(w[:, 0], (len(idx), 1))
                    if first > 1:
                        part += np.stack(dense.to_numpy()[idx]) @ w[:, 1:first].T
                    sizes = [len(x) for x in flags.to_numpy()[idx]]
                    if sum(sizes):
                        at = np.concatenate(flags.to_numpy()[idx]).astype(int) + first
                        owner = np.repeat(np.arange(len(idx)), sizes)
                        for m in range(len(models)):
                            part[:, m] += np.bincount(owner, weights=w[m, at], minlength=len(idx))
                    z[idx] = part
                yield pd.Series(list(z))

        score.__annotations__ = {"batches": Iterator[tuple[pd.Series, ...]], "return": Iterator[pd.Series]}
        scored = self.base_rows(df).select(*keep, F.pandas_udf(score, "array<double>")(F.col(fit).cast("int"), "dense", "flags").alias("__z"))
        return scored.select(*keep, *[F.get("__z", F.lit(i)).alias(m) for i, m in enumerate(models)])
