"""Folded ridge over factors of any width in which vectors, too, stay in the cluster.

The preparation is that of `models/wide.py`. A level is a row that holds its sums, its weight and the solver's other
values, one column per fit; a step of conjugate gradients is a map over these rows and two sums. The
driver holds the few places that are no level: the intercept, continuous columns, null flags.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.functions import joins
from tabwright.functions.scalar import target_pair
from tabwright.operators import learned as L
from tabwright.session import few_tasks, materialize


class FactorRidge:
    """Fits of a frame with a `fold` column in 0..k-1 (k marks rows outside all folds); fit k uses every fold."""

    def __init__(self, df: DataFrame, continuous: Sequence[str], categorical: Sequence[str], k: int, target: str, *,
                 fold: str = "fold", transform: str = "log") -> None:
        self.continuous, self.categorical, self.k, self.fits = list(continuous), list(categorical), k, range(k + 1)
        self.forward, self.inverse = target_pair(transform)
        rows = df.filter(F.col(target).isNotNull() & (F.col(fold) < k))
        y = self.forward(F.col(target).cast("double"))
        means = {r["column"]: r["mean"] for r in L.fit_moments(rows.withColumn("__y", y), [*self.continuous, "__y"]).collect()}
        self.y_shift = means.get("__y", 0.0)
        self.shift = [means.get(c, 0.0) for c in self.continuous]
        self.width = 1 + 2 * len(self.continuous) + len(self.categorical)  # places that are no level
        levels = [F.col(c).cast("string").alias(f"v{i}") for i, c in enumerate(self.categorical)]
        head = [h.alias(f"h{i}") for i, h in enumerate(self._head())]
        base = materialize(rows.select(F.col(fold).cast("int").alias("fold"), (y - self.y_shift).alias("y"), *head, *levels), "factor-rows")
        medians = L.fit_median(rows, self.continuous, fold, k).collect() if self.continuous else []
        self.fill = {(r[L.FIT], r["column"]): r["value"] for r in medians}
        self._sum_head(base)
        self.levels = materialize(self._level_sums(base), "factor-levels")
        self.cells = materialize(self._cells(base), "factor-cells") if len(self.categorical) > 1 else None
        self._modes()

    def _head(self) -> list[Column]:
        """1, centred values (0 for null), null flags of values and of factors."""
        xs = [F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None)) - s, F.lit(0.0)) for c, s in zip(self.continuous, self.shift)]
        gone = [F.col(c).isNull() | F.isnan(F.col(c).cast("double")) for c in self.continuous]
        return [F.lit(1.0), *xs, *[x.cast("double") for x in gone], *[F.col(c).isNull().cast("double") for c in self.categorical]]

    def _sum_head(self, base: DataFrame) -> None:
        """Products of the places that are no level, and of these with the target, for every fit; T leads from them to features."""
        n, names = self.width, [f"h{i}" for i in range(self.width)]

        def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            sums: dict[int, np.ndarray] = {}
            for batch in batches:
                for f, part in batch.groupby("fold"):
                    m = part[[*names, "y"]].to_numpy()
                    sums[int(f)] = sums.get(int(f), 0.0) + m[:, :n].T @ m
            yield pd.DataFrame({"fold": list(sums), "g": [g.tobytes() for g in sums.values()]})

        def add(pdf: pd.DataFrame) -> pd.DataFrame:
            return pdf.iloc[:1].assign(g=[np.sum([np.frombuffer(g) for g in pdf["g"]], axis=0).tobytes()])

        parts = few_tasks(base.select("fold", *names, "y")).mapInPandas(work, "fold int, g binary")
        found = {r["fold"]: np.frombuffer(r["g"]).reshape(n, n + 1) for r in parts.groupBy("fold").applyInPandas(add, "fold int, g binary").collect()}
        nc = len(self.continuous)
        self.G, self.gy, self.n, self.T = {}, {}, {}, {}
        for f in self.fits:
            g = sum((m for fold, m in found.items() if fold != f), np.zeros((n, n + 1)))
            self.G[f], self.gy[f], self.n[f] = g[:, :n], g[:, n], g[0, 0]
            T = np.zeros((nc, n))
            for i, c in enumerate(self.continuous):
                row = np.zeros(n)
                row[1 + i], row[1 + nc + i] = 1.0, self.fill.get((f, c), 0.0) - self.shift[i]
                mean = row @ g[:, 0] / g[0, 0]
                var = row @ g[:, :n] @ row / g[0, 0] - mean * mean
                T[i] = row / (np.sqrt(var) if var > 1e-20 else 1.0)
                T[i, 0] = -mean / (np.sqrt(var) if var > 1e-20 else 1.0)
            self.T[f] = T

    def _level_sums(self, base: DataFrame) -> DataFrame:
        """`(factor, level)` with, per fit, the sums of the other places and of the target over the level's rows."""
        parts = [base.filter(F.col(f"v{i}").isNotNull()).groupBy(F.lit(i).alias("factor"), F.col(f"v{i}").alias("level"), "fold")
                 .agg(*[F.sum(c).alias(c) for c in [f"h{j}" for j in range(self.width)] + ["y"]]) for i in range(len(self.categorical))]
        if not parts:
            parts = [base.select(F.lit(0).alias("factor"), F.lit("").alias("level"), "fold", *[f"h{j}" for j in range(self.width)], "y").filter("false")]
        of = lambda c, f: F.coalesce(F.sum(F.when(F.col("fold") != f, F.col(c))), F.lit(0.0))
        wanted = [of(f"h{j}", f).alias(f"h{f}_{j}") for f in self.fits for j in range(self.width)]
        return reduce(DataFrame.unionByName, parts).groupBy("factor", "level").agg(*wanted, *[of("y", f).alias(f"y{f}") for f in self.fits])

    def _cells(self, base: DataFrame) -> DataFrame:
        """Rows that two levels share, per fit, in both directions."""
        n = len(self.categorical)
        parts = []
        for a in range(n):
            for b in range(a + 1, n):
                counts = [F.count(F.when(F.col("fold") != f, 1)).cast("double").alias(f"c{f}") for f in self.fits]
                both = base.filter(F.col(f"v{a}").isNotNull() & F.col(f"v{b}").isNotNull()).groupBy(f"v{a}", f"v{b}").agg(*counts)
                for x, y in ((a, b), (b, a)):
                    parts.append(both.select(F.lit(x).alias("factor"), F.col(f"v{x}").alias("level"), F.lit(y).alias("factor2"), F.col(f"v{y}").alias("level2"),
                                             *[f"c{f}" for f in self.fits]))
        return reduce(DataFrame.unionByName, parts)

    def _modes(self) -> None:
        """Each factor's most frequent level (the smallest of equals): what a null counts as."""
        first = [F.min(F.when(F.col(f"h{f}_0") > 0, F.struct((-F.col(f"h{f}_0")).alias("n"), "level"))).alias(f"m{f}") for f in self.fits]
        found = {r["factor"]: r for r in self.levels.groupBy("factor").agg(*first).collect()}
        self.mode = {(f, i): found[i][f"m{f}"]["level"] for f in self.fits for i in found if found[i][f"m{f}"] is not None}

    def _null_place(self, i: int) -> int:
        return 1 + 2 * len(self.continuous) + i

    def _at_mode(self, f: int, values: np.ndarray) -> Column:
        """The entry of a factor's null flag in the row of the level that nulls count as, 0 elsewhere."""
        out = F.lit(0.0)
        for i in range(len(self.categorical)):
            if (f, i) in self.mode:
                here = (F.col("factor") == i) & (F.col("level") == F.lit(self.mode[f, i]))
                out = F.when(here, F.lit(float(values[self._null_place(i)]))).otherwise(out)
        return out

    def _present(self, f: int, x: Column) -> Column:
        return F.when(F.col(f"h{f}_0") > 0, x).otherwise(0.0)

    def _sums(self, df: DataFrame, values: dict[int, Column], others: dict[str, Column]) -> tuple[dict[int, np.ndarray], dict[str, float]]:
        """For a level vector of each fit: its products with the other places and its entries at the modes; and sums of `others`. One job."""
        total = lambda x: F.coalesce(F.sum(x), F.lit(0.0))
        asked = [total(F.col(f"h{f}_{j}") * x).alias(f"p{f}_{j}") for f, x in values.items() for j in range(self.width)]
        asked += [total(F.when((F.col("factor") == i) & (F.col("level") == F.lit(self.mode[f, i])), x)).alias(f"m{f}_{i}")
                  for f, x in values.items() for i in range(len(self.categorical)) if (f, i) in self.mode]
        row = df.agg(*asked, *[total(x).alias(n) for n, x in others.items()]).first().asDict()
        out = {f: np.array([row[f"p{f}_{j}"] for j in range(self.width)] + [row.get(f"m{f}_{i}", 0.0) for i in range(len(self.categorical))]) for f in values}
        return out, {n: row[n] for n in others}

    def _base(self, f: int, head: np.ndarray, sums: np.ndarray) -> np.ndarray:
        """A vector's weights on the places that are no level."""
        base = self.T[f].T @ head
        base[self._null_place(0) :] += sums[self.width :]
        return base

    def fit(self, alpha: float, tol: float = 1e-10, max_iter: int = 500) -> FactorWeights:
        """min ||y - Zw||^2 + alpha ||w||^2 for every fit, by preconditioned conjugate gradients."""
        if alpha < 0:
            raise ValueError("alpha must not be negative")
        fits, T, n = self.fits, self.T, self.n
        y_mean = {f: self.gy[f][0] / n[f] if n[f] else float("nan") for f in fits}
        per = {f: n[f] or 1.0 for f in fits}
        z_head = {f: T[f] @ self.G[f][:, 0] for f in fits}
        z = {f: self._present(f, F.col(f"h{f}_0") + self._at_mode(f, self.G[f][0])) for f in fits}
        own = {f: F.col(f"h{f}_0") + self._at_mode(f, np.diag(self.G[f])) for f in fits}
        close = {f: F.greatest(own[f] - z[f] * z[f] / per[f], 1e-8 * F.greatest(own[f], F.lit(1e-300))) for f in fits}
        own_head = {f: (T[f] ** 2) @ np.diag(self.G[f]) for f in fits}
        close_head = {f: np.maximum(own_head[f] - z_head[f] ** 2 / per[f], 1e-8 * np.maximum(own_head[f], 1e-300)) for f in fits}
        low = {f: 1e-300 for f in fits}
        if alpha == 0:
            most = self.levels.agg(*[F.max(self._present(f, close[f])).alias(f"d{f}") for f in fits]).first()
            low = {f: max(most[f"d{f}"] or 0.0, close_head[f].max(initial=0.0)) * 1e-14 + 1e-300 for f in fits}
        inverse = {f: self._present(f, 1.0 / (close[f] + (alpha + low[f]))) for f in fits}
        inverse_head = {f: 1.0 / (close_head[f] + alpha + low[f]) for f in fits}
        start = {f: self._present(f, F.col(f"y{f}") + self._at_mode(f, self.gy[f]) - z[f] * (y_mean[f] if n[f] else 0.0)) for f in fits}
        left_head = {f: T[f] @ self.gy[f] - z_head[f] * (y_mean[f] if n[f] else 0.0) for f in fits}
        keep = [c for c in self.levels.columns if c[0] != "y"]
        state = self.levels.select(*keep, *[F.lit(0.0).alias(f"w{f}") for f in fits], *[start[f].alias(f"r{f}") for f in fits],
                                   *[(inverse[f] * start[f]).alias(f"s{f}") for f in fits])
        state = materialize(state, "factor-step")
        step_head = {f: inverse_head[f] * left_head[f] for f in fits}
        w_head, w_sums = {f: np.zeros_like(h) for f, h in left_head.items()}, {f: np.zeros(self.width + len(self.categorical)) for f in fits}
        sums, rho = self._sums(state, {f: F.col(f"s{f}") for f in fits}, {f"rho{f}": F.col(f"r{f}") * F.col(f"s{f}") for f in fits})
        rho = {f: rho[f"rho{f}"] + left_head[f] @ step_head[f] for f in fits}
        first = dict(rho)
        for _ in range(max_iter):
            going = [f for f in fits if rho[f] > tol**2 * first[f] and rho[f] > 0]
            if not going:
                return FactorWeights(self, state, w_head, w_sums, y_mean)
            if self.cells is not None:
                state = self._with_shared(state, going)
            moved, moved_head = {}, {}
            for f in going:
                base = self._base(f, step_head[f], sums[f])
                g = self.G[f] @ base + sums[f][: self.width]
                row = F.col(f"h{f}_0") * F.col(f"s{f}") + (F.col(f"o{f}") if self.cells is not None else 0.0) + self._at_mode(f, g)
                for j in np.flatnonzero(base):
                    row = row + F.col(f"h{f}_{j}") * float(base[j])
                moved[f] = self._present(f, row - z[f] * float(g[0] / n[f])) + alpha * F.col(f"s{f}")
                moved_head[f] = T[f] @ g - z_head[f] * (g[0] / n[f]) + alpha * step_head[f]
            _, dots = self._sums(state, {}, {f"d{f}": F.col(f"s{f}") * moved[f] for f in going})
            a = {f: rho[f] / (dots[f"d{f}"] + step_head[f] @ moved_head[f]) for f in going}
            left = {f: F.col(f"r{f}") - float(a[f]) * moved[f] for f in going}
            for f in going:
                w_head[f] = w_head[f] + a[f] * step_head[f]
                w_sums[f] = w_sums[f] + a[f] * sums[f]
                left_head[f] = left_head[f] - a[f] * moved_head[f]
            fresh = {f: inverse[f] * left[f] for f in going}
            found, dots = self._sums(state, fresh, {f"rho{f}": left[f] * fresh[f] for f in going})
            changed = {}
            for f in going:
                fresh_head = inverse_head[f] * left_head[f]
                new = dots[f"rho{f}"] + left_head[f] @ fresh_head
                b = float(new / rho[f])
                changed |= {f"w{f}": F.col(f"w{f}") + float(a[f]) * F.col(f"s{f}"), f"r{f}": left[f], f"s{f}": fresh[f] + b * F.col(f"s{f}")}
                sums[f], step_head[f], rho[f] = found[f] + b * sums[f], fresh_head + b * step_head[f], new
            state = materialize(state.withColumns(changed).drop(*[f"o{f}" for f in fits]), "factor-step")
        raise RuntimeError(f"conjugate gradients did not settle in {max_iter} steps")

    def _with_shared(self, state: DataFrame, going: Sequence[int]) -> DataFrame:
        """The steps of all levels that share rows with a level, times these rows: one join of the cells."""
        other = state.select(F.col("factor").alias("factor2"), F.col("level").alias("level2"), *[f"s{f}" for f in going])
        terms = [F.sum(F.col(f"c{f}") * F.col(f"s{f}")).alias(f"o{f}") for f in going]
        met = self.cells.join(other, ["factor2", "level2"]).groupBy("factor", "level").agg(*terms)
        return materialize(state.join(met, ["factor", "level"], "left").fillna(0.0, [f"o{f}" for f in going]), "factor-shared")


class FactorWeights:
    """Weights of every fit: those of levels in a table of the cluster, the others here."""

    def __init__(self, front: FactorRidge, state: DataFrame, head: dict[int, np.ndarray], sums: dict[int, np.ndarray], y_mean: dict[int, float]) -> None:
        self.front = front
        self.table = state.select("factor", "level", *[f"w{f}" for f in front.fits])  # 0 where a fit has not seen the level
        self.head = {}
        for f in front.fits:
            base = front._base(f, head[f], sums[f])
            # the mean prediction of the fit's rows is the mean of the target
            base[0] += y_mean[f] - (front.G[f][0] @ base + sums[f][0]) / (front.n[f] or 1.0) + front.y_shift
            self.head[f] = base

    def predict(self, df: DataFrame, name: str, keep: Sequence[str], fit: str = "fold") -> DataFrame:
        """`keep` and the prediction in the transformed target: a join per factor, by shuffle if its weights are too many for a broadcast."""
        front = self.front
        weights = materialize(self.table, "factor-weights")
        size = F.octet_length("level") + 40 + 8 * len(front.fits)
        held = {r["factor"]: r["bytes"] for r in weights.groupBy("factor").agg(F.sum(size).alias("bytes")).collect()}
        by_fit = lambda cells: F.get(F.array(*cells), F.col("__fit"))
        z = by_fit([F.lit(float(front_head[0])) for front_head in (self.head[f] for f in front.fits)])
        for j, x in enumerate(front._head()):
            if j and any(self.head[f][j] for f in front.fits):
                z = z + by_fit([F.lit(float(self.head[f][j])) for f in front.fits]) * x
        out = df.withColumns({"__fit": F.col(fit).cast("int"), "__head": z})
        total = F.col("__head")
        for i, c in enumerate(front.categorical):
            side = weights.filter(F.col("factor") == i).select(F.col("level").alias("__level"), F.array(*[f"w{f}" for f in front.fits]).alias(f"__w{i}"))
            side = F.broadcast(side) if held.get(i, 0) <= joins.BROADCAST_BYTES else side
            out = out.join(side, F.col(c).cast("string") == F.col("__level"), "left").drop("__level")
            total = total + F.coalesce(F.get(f"__w{i}", F.col("__fit")), F.lit(0.0))
        return out.select(*keep, F.coalesce(total, F.lit(float("nan"))).alias(name))
