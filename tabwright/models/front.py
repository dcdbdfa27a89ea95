"""Leakage-safe preparation and linear fitting for every fold from one pass over the rows.

Imputing with a learned value, one-hot coding with a learned mode, re-ranking ordinal codes and
standardising are all *linear* in a base vector that needs nothing learned:

    [1, value or 0 per continuous column, null flag per continuous column (and group),
     level flags and a null flag per categorical or ordinal column, target]

So tasks add up the cross-products of that base vector per fold (one Gram matrix per fold), and
the preparation of any fit is a small matrix T applied to sums: T G T'. The Gram of a training set
is the sum over its folds. No row is copied per fold and no fit needs another scan. A power
transform is not linear, so its columns appear once per fit within the same scan.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.functions.order import expand_folds, long_quantiles
from tabwright.functions.scalar import inv_yeo_johnson, target_pair, yeo_johnson
from tabwright.operators import learned as L
from tabwright.session import few_tasks

MAX_WIDTH = 2000  # base columns; the driver holds (folds x fits) matrices of this size


@dataclass
class Design:
    """Which columns enter, how, and where each one sits in the base vector."""

    continuous: list[str]
    categorical: list[str]
    ordinal: list[str]
    levels: dict[str, list[str]]
    group_of: dict[str, str] = field(default_factory=dict)  # continuous column -> imputation group

    def __post_init__(self) -> None:
        self.blocks: list[tuple[str, str, int]] = []  # (kind, column, size)
        for c in self.continuous:
            self.blocks.append(("null", c, len(self.levels[self.group_of[c]]) + 1 if c in self.group_of else 1))
        self.blocks += [("cat", c, len(self.levels[c]) + 1) for c in self.categorical]
        self.blocks += [("ord", c, len(self.levels[c]) + 2) for c in self.ordinal]
        self.start, at = {}, 1 + len(self.continuous)
        for kind, c, size in self.blocks:
            self.start[(kind, c)] = at
            at += size
        self.width = at
        if self.width > MAX_WIDTH:
            raise ValueError(f"design is {self.width} columns wide: models/wide.py keeps the products in the cluster")

    def slot(self, kind: str, c: str) -> Column:
        """Position inside the block, or -1 for none."""
        place = lambda col: F.array_position(F.array(*[F.lit(v) for v in self.levels[col]]), F.col(col).cast("string")) - 1
        x = F.col(c)
        if kind == "null":
            if c not in self.group_of:
                inside = F.lit(0)
            else:
                g = self.group_of[c]
                other = len(self.levels[g])
                found = place(g)
                inside = F.when(F.col(g).isNull() | (found < 0), other).otherwise(found)
            return F.when(x.isNull(), inside).otherwise(-1).cast("int")
        n, found = len(self.levels[c]), place(c)
        unseen = F.lit(-1) if kind == "cat" else F.lit(n + 1)
        return F.when(x.isNull(), n).when(found < 0, unseen).otherwise(found).cast("int")

    def slots(self) -> list[Column]:
        return [self.slot(kind, c).alias(f"__s{i}") for i, (kind, c, _) in enumerate(self.blocks)]

    def named(self) -> list[str]:
        return list(dict.fromkeys([*[self.group_of[c] for c in self.continuous if c in self.group_of], *self.categorical, *self.ordinal]))

    def inputs(self) -> list[Column]:
        """What `finder` reads: a null flag per continuous column, then each column with levels as text."""
        return [*[F.col(c).isNull() for c in self.continuous], *[F.col(c).cast("string") for c in self.named()]]

    def finder(self):
        """`slots` for Arrow columns: a function that travels by value, from `inputs` to an array of positions per block.

        A level is found by one hash look-up for a batch; as expressions the slots cost more than all that follows them.
        """
        named, nc = self.named(), len(self.continuous)
        levels = {c: pa.array(self.levels[c], pa.string()) for c in named}
        steps = []
        for kind, c, _ in self.blocks:
            source = self.group_of.get(c) if kind == "null" else c
            steps.append((kind, self.continuous.index(c) if kind == "null" else -1, source, len(levels[source]) if source is not None else 0))

        def find(cols: Sequence[pa.Array]) -> list[np.ndarray]:
            at = {}
            for c, text in zip(named, cols[nc:]):
                found = pc.index_in(text.cast(pa.string()), value_set=levels[c], skip_nulls=True).fill_null(-1)
                at[c] = found.to_numpy(zero_copy_only=False), text.is_null().to_numpy(zero_copy_only=False)
            out = []
            for kind, i, source, n in steps:
                found, missing = at[source] if source is not None else (None, None)
                if kind == "null":
                    inside = 0 if found is None else np.where(found < 0, n, found)
                    out.append(np.where(cols[i].to_numpy(zero_copy_only=False), inside, -1))
                else:
                    out.append(np.where(missing, n, np.where(found < 0, -1 if kind == "cat" else n + 1, found)))
            return out

        return find


def collect_design(
    df: DataFrame, continuous: Sequence[str], categorical: Sequence[str], ordinal: Sequence[str],
    group_of: Mapping[str, str] | None = None,
) -> Design:
    """Levels of the fitting rows, in number order for numeric columns."""
    group_of = dict(group_of or {})
    named = list(dict.fromkeys([*categorical, *ordinal, *group_of.values()]))
    levels = L.collect_levels(df, named) if named else {}
    for c, values in levels.items():
        if c in ordinal and all(_is_number(v) for v in values):
            levels[c] = sorted(values, key=float)
    return Design(list(continuous), list(categorical), list(ordinal), levels, group_of)


def _is_number(v: str) -> bool:
    try:
        float(v)
    except ValueError:
        return False
    return True


@dataclass
class Prepared:
    """One fit: T maps base sums to prepared features; the rest turns rows into base values."""

    names: list[str]
    T: np.ndarray  # features x base width
    lam: list[float] | None
    shift: list[float]


class FrontEnd:
    """Folded preparation of a frame with a `fold` column in 0..k-1 (k marks rows outside all folds)."""

    def __init__(
        self, df: DataFrame, design: Design, k: int, target: str, *, fold: str = "fold",
        numeric: str = "median", scaling: str = "standard", transform: str = "log", fits: Sequence[int] | None = None,
    ) -> None:
        self.design, self.k, self.fold, self.target = design, k, fold, target
        self.numeric, self.scaling = numeric, scaling
        self.transform, self.y_lam = transform, {}
        self.fits = list(range(k + 1) if fits is None else fits)
        rows = df.filter(F.col(target).isNotNull() & (F.col(fold) < k))
        if transform == "yeojohnson":  # learned like everything else: each fit has a lambda of its own
            self.y_lam = {f: lam for (f, _), lam in L.fit_power(rows, [target], fold, k).items() if f in self.fits}
        self.forward, self.inverse = self.pair()
        self._learn(rows)
        self._sum(rows)
        self.prepared = {f: self._prepare(f) for f in self.fits}
        self._normal: dict[int, Normal] = {}

    def pair(self, fit: str | None = None):
        """Forward and inverse target transform; a learned one is that of the fit that the row's `fit` column names."""
        if not self.y_lam:
            return target_pair(self.transform)
        known = [F.lit(self.y_lam.get(f, 1.0)) for f in range(self.k + 1)]
        lam = F.get(F.array(*known), F.col(fit or self.fold).cast("int"))
        col = lambda c: F.col(c) if isinstance(c, str) else c
        return (lambda y: yeo_johnson(col(y), lam)), (lambda z: inv_yeo_johnson(col(z), lam))

    def variant(self, f: int) -> int:
        """Which set of sums fit f reads: one of its own if a transform differs per fit."""
        return f if self.lam or self.y_lam else 0

    def variants_of_target(self) -> list[int]:
        return self.fits if self.y_lam else [0]

    def variants(self) -> list[int]:
        return self.fits if self.lam or self.y_lam else [0]

    # what cannot be read off the Gram matrices: medians, extremes, quartiles, lambdas

    def _learn(self, rows: DataFrame) -> None:
        d, k = self.design, self.k
        cols = d.continuous
        ys = {f"__y{f}": self._y(f) for f in self.variants_of_target()}
        moments = L.fit_moments(rows.withColumns(ys), [*cols, *ys], self.fold, k).collect()
        self.stats = stats = {(r[L.FIT], r["column"]): r for r in moments}
        # a constant near the mean of each fit's transformed target, and of the one set of sums that fits share
        own = (lambda f: f) if self.y_lam else (lambda f: 0)
        self.y_shifts = {f: stats[(k, f"__y{own(f)}")]["mean"] for f in {*self.fits, *map(own, self.fits)}}
        self.center = {c: stats[(k, c)]["mean"] if (k, c) in stats else 0.0 for c in cols}
        self.fill: dict[tuple[int, str], float] = {}
        self.group_fill: dict[tuple[int, str], dict[str, float]] = {}
        if self.numeric not in ("median", "mean"):
            raise ValueError(f"unknown numeric imputation {self.numeric!r}")
        for r in self._medians(rows):
            if r["member"] is None:
                self.fill[(r[L.FIT], r["column"])] = r["value"]
            else:
                self.group_fill.setdefault((r[L.FIT], r["column"]), {})[r["member"]] = r["value"]
        if self.numeric == "mean":
            plain = {key: r["mean"] for key, r in stats.items() if key[1] not in ys and key[1] not in d.group_of}
            self.fill |= plain
        self.quart: dict[tuple[int, str], tuple[float, float]] = {}
        self.lam: dict[tuple[int, str], float] = {}
        if self.scaling == "robust":
            self._learn_quartiles(rows)
        elif self.scaling == "yeo-johnson":
            self.lam = L.fit_power(rows, cols, self.fold, k, constants=self._null_cells(rows))
        elif self.scaling not in ("standard", "minmax"):
            raise ValueError(f"unknown scaling {self.scaling!r}: standard, minmax, robust or yeo-johnson")

    def _medians(self, rows: DataFrame) -> list:
        """Overall and group medians of all columns and fits from one quantile run."""
        d = self.design
        cell = lambda c, member, value: F.struct(
            F.lit(c).alias("column"), member.cast("string").alias("member"), value.cast("double").alias("value"))
        cells = [cell(c, F.lit(None), F.col(c)) for c in d.continuous]  # member null: the overall median
        cells += [cell(c, F.col(g), F.when(F.col(g).isNotNull(), F.col(c))) for c, g in d.group_of.items()]
        if not cells:
            return []
        long = rows.select(self.fold, F.inline(F.array(*cells))).filter(F.col("value").isNotNull())
        return long_quantiles(long, [0.5], ["member"], self.fold, self.k).collect()

    def _fill_values(self, f: int, c: str) -> list[float]:
        """Imputed value for each slot of the column's null block."""
        base = self.fill.get((f, c), 0.0)
        if c not in self.design.group_of:
            return [base]
        per = self.group_fill.get((f, c), {})
        return [per.get(g, base) for g in self.design.levels[self.design.group_of[c]]] + [base]

    def _null_cells(self, rows: DataFrame) -> dict[tuple[int, str], list[tuple[float, float]]]:
        """Imputed (value, count) pairs per fit and column: null counts per fold and slot, one aggregate."""
        d = self.design
        nulls = [(i, c, size) for i, (kind, c, size) in enumerate(d.blocks) if kind == "null"]
        slots = d.slots()
        cells = F.array(*[F.struct(F.lit(c).alias("column"), slots[i].alias("slot")) for i, c, _ in nulls])
        counts = (
            rows.select(F.col(self.fold).alias("fold"), F.inline(cells)).filter(F.col("slot") >= 0)
            .groupBy("fold", "column", "slot").agg(F.count("*").alias("n")).collect()
        )
        out: dict[tuple[int, str], list[tuple[float, float]]] = {}
        for f in self.fits:
            for r in counts:
                if r["fold"] != f:
                    value = self._fill_values(f, r["column"])[r["slot"]]
                    out.setdefault((f, r["column"]), []).append((value, float(r["n"])))
        return out

    def _learn_quartiles(self, rows: DataFrame) -> None:
        """Quartiles of the *imputed* columns: values are counted per fold like everything else, only the cells that a fit fills are copied for it."""
        d = self.design
        table = [(f, c, i, v) for f in self.fits for c in d.continuous for i, v in enumerate(self._fill_values(f, c))]
        spark = rows.sparkSession
        fills = spark.createDataFrame(table, f"{L.FIT} int, column string, slot int, fill double")
        slots = {c: s for (kind, c, _), s in zip(d.blocks, d.slots()) if kind == "null"}
        cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x"), slots[c].alias("slot")) for c in d.continuous])
        long = rows.select(F.col(self.fold).cast("int").alias("fold"), F.inline(cells))
        empty = expand_folds(long.filter(F.col("x").isNull()), self.k).drop("x")
        filled = empty.join(F.broadcast(fills), [L.FIT, "column", "slot"]).select((-1 - F.col(L.FIT)).alias("fold"), "column", F.col("fill").alias("value"))  # bounded by MAX_WIDTH per fit
        values = long.select("fold", "column", F.col("x").alias("value")).filter(F.col("value").isNotNull()).unionByName(filled)
        q = long_quantiles(values.filter(~F.isnan("value")), [0.25, 0.5, 0.75], fold="fold", k=self.k)
        got: dict[tuple[int, str], dict[float, float]] = {}
        for r in q.collect():
            got.setdefault((r[L.FIT], r["column"]), {})[r["prob"]] = r["value"]
        self.quart = {key: (v[0.5], v[0.75] - v[0.25]) for key, v in got.items()}

    # the one pass over the rows

    def _y(self, f: int) -> Column:
        """The target as fit f transforms it; a target outside the transform's domain ends the job."""
        forward = target_pair("yeojohnson", self.y_lam[f])[0] if self.y_lam else self.forward
        y = forward(F.col(self.target).cast("double"))
        error = F.raise_error(F.concat(F.lit("the target transform is not defined at "), F.col(self.target).cast("string")))
        return F.when(y.isNull() | F.isnan(y), error.cast("double")).otherwise(y)

    def _x(self, c: str, f: int) -> Column:
        x = F.col(c).cast("double")
        return yeo_johnson(x, self.lam[(f, c)]) if self.lam else x

    def _shift(self, c: str, f: int) -> float:
        """Constant taken off the values before they are multiplied, to keep digits."""
        if not self.lam:
            return self.center[c]
        return float(L._power_function()(np.array([self.center[c]]), self.lam[(f, c)], "yeo-johnson")[0])

    def _sum(self, rows: DataFrame) -> None:
        d = self.design
        variants = self.variants()
        ys = [(self._y(v) - self.y_shifts[v]).alias(f"__y{v}") for v in variants]
        xs = [(self._x(c, v) - self._shift(c, v)).alias(f"__x{v}_{i}") for v in variants for i, c in enumerate(d.continuous)]
        given = [c.alias(f"__s{i}") for i, c in enumerate(d.inputs())]
        wide = rows.select(F.col(self.fold).cast("int").alias("__fold"), *ys, *xs, *given)
        nc, width, find = len(d.continuous), d.width, d.finder()
        starts, ng = [d.start[(kind, c)] for kind, c, _ in d.blocks], len(given)

        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            acc: dict[tuple[int, int], np.ndarray] = {}
            for batch in batches:
                n = batch.num_rows
                number = lambda c: batch.column(c).cast(pa.float64()).to_numpy(zero_copy_only=False)
                base = np.zeros((n, width + 1))
                base[:, 0] = 1.0
                for s, slot in zip(starts, find([batch.column(f"__s{i}") for i in range(ng)])):
                    hit = np.flatnonzero(slot >= 0)
                    base[hit, s + slot[hit]] = 1.0
                folds = batch.column("__fold").to_numpy(zero_copy_only=False)
                parts = [(int(f), np.flatnonzero(folds == f)) for f in np.unique(folds)]
                for v in variants:
                    base[:, width] = number(f"__y{v}")
                    for i in range(nc):
                        base[:, 1 + i] = np.nan_to_num(number(f"__x{v}_{i}"), nan=0.0)
                    for f, idx in parts:
                        m = base[idx]
                        g = m.T @ m
                        acc[(v, f)] = acc[(v, f)] + g if (v, f) in acc else g
            for (v, f), g in acc.items():
                i, j = np.nonzero(np.triu(g))
                yield pa.record_batch([pa.array(np.full(len(i), v, "int32")), pa.array(np.full(len(i), f, "int32")), pa.array(i.astype("int32")),
                                       pa.array(j.astype("int32")), pa.array(g[i, j])], names=["v", "fold", "i", "j", "s"])

        sums = few_tasks(wide).mapInArrow(partial, "v int, fold int, i int, j int, s double")
        cells = sums.groupBy("v", "fold", "i", "j").agg(F.sum("s").alias("s")).toPandas()  # width^2 cells per fold
        self.grams = {(v, f): np.zeros((width + 1, width + 1)) for v in variants for f in range(self.k)}
        for (v, f), part in cells.groupby(["v", "fold"]):
            g = self.grams[(int(v), int(f))]
            i, j, s = part["i"].to_numpy(), part["j"].to_numpy(), part["s"].to_numpy()
            g[i, j] = s
            g[j, i] = s

    def base_gram(self, f: int, held_out: bool = False) -> np.ndarray:
        v = self.variant(f)
        if held_out:
            return self.grams[(v, f)]
        return sum(self.grams[(v, g)] for g in range(self.k) if g != f)

    # per fit: the linear map from base vector to prepared features

    def _prepare(self, f: int) -> Prepared:
        d = self.design
        G = self.base_gram(f)
        n = G[0, 0]
        names, maps = [], []
        psi = L._power_function()
        for i, c in enumerate(d.continuous):
            row = np.zeros(d.width)
            row[1 + i] = 1.0
            shift = self._shift(c, f)
            start = d.start[("null", c)]
            for s, value in enumerate(self._fill_values(f, c)):
                if self.lam:
                    value = float(psi(np.array([value]), self.lam[(f, c)], "yeo-johnson")[0])
                row[start + s] = value - shift
            if self.scaling in ("standard", "yeo-johnson"):
                mean = row @ G[:-1, 0] / n
                var = row @ G[:-1, :-1] @ row / n - mean * mean
                center, scale = mean, np.sqrt(var) if var > 1e-20 else 1.0
            elif self.scaling == "minmax":
                s = self.stats[(f, c)]
                center, scale = s["lo"] - shift, (s["hi"] - s["lo"]) or 1.0
            else:
                mid, iqr = self.quart[(f, c)]
                center, scale = mid - shift, iqr or 1.0
            row[0] -= center
            names.append(c)
            maps.append(row / scale)
        for c in d.categorical:
            start, values = d.start[("cat", c)], d.levels[c]
            counts = G[0, start:start + len(values)]
            mode = int(np.argmax(counts)) if len(values) else 0
            for j in np.flatnonzero(counts > 0):
                row = np.zeros(d.width)
                row[start + j] = 1.0
                if j == mode:
                    row[start + len(values)] = 1.0
                names.append(f"{c}={values[j]}")
                maps.append(row)
        for c in d.ordinal:
            start, values = d.start[("ord", c)], d.levels[c]
            counts = G[0, start:start + len(values)]
            present = np.flatnonzero(counts > 0)
            code = {int(j): r for r, j in enumerate(present)}
            row = np.zeros(d.width)
            for j in range(len(values)):
                row[start + j] = code.get(j, -1)
            row[start + len(values)] = code.get(int(np.argmax(counts)), -1) if len(present) else -1
            row[start + len(values) + 1] = -1.0
            names.append(c)
            maps.append(row)
        lam = [self.lam[(f, c)] for c in d.continuous] if self.lam else None
        return Prepared(names, np.array(maps).reshape(len(names), d.width), lam, [self._shift(c, f) for c in d.continuous])

    def normal(self, f: int) -> Normal:
        """Centred normal equations of fit f over the prepared features; computed once."""
        if f in self._normal:
            return self._normal[f]
        prep, G = self.prepared[f], self.base_gram(f)
        n = G[0, 0]
        Z = prep.T
        zsum, ysum = Z @ G[:-1, 0], G[-1, 0]
        S = Z @ G[:-1, :-1] @ Z.T - np.outer(zsum, zsum) / n
        r = Z @ G[:-1, -1] - zsum * ysum / n
        self._normal[f] = Normal(prep.names, S, r, G[-1, -1] - ysum * ysum / n, n, zsum / n, ysum / n)
        return self._normal[f]

    def base_coefficients(self, f: int, w: np.ndarray, names: Sequence[str] | None = None) -> np.ndarray:
        """Prepared-feature weights as weights on the base vector, intercept included."""
        prep, eq = self.prepared[f], self.normal(f)
        if names is not None:
            full = np.zeros(len(prep.names))
            full[[prep.names.index(c) for c in names]] = w
            w = full
        out = w @ prep.T
        out[0] += eq.y_mean + self.y_shifts[f] - w @ eq.z_mean
        return out

    def held_out_error(self, f: int, coef: np.ndarray) -> tuple[float, float]:
        """(sum of squared errors, rows) of a fit on the fold it left out, in the transformed target."""
        G = self.base_gram(f, held_out=True)
        a = np.append(-coef, 1.0)
        a[0] += self.y_shifts[f]
        return float(a @ G @ a), float(G[0, 0])

    def held_out_variance(self, f: int) -> float:
        G = self.base_gram(f, held_out=True)
        return float(G[-1, -1] / G[0, 0] - (G[-1, 0] / G[0, 0]) ** 2)


@dataclass
class Normal:
    names: list[str]
    S: np.ndarray
    r: np.ndarray
    yy: float
    n: float
    z_mean: np.ndarray
    y_mean: float
    warm: dict[float, np.ndarray] = field(default_factory=dict)  # last solution per mixing ratio

    @cached_property
    def spectrum(self) -> tuple[np.ndarray, np.ndarray]:
        """Eigenvalues and eigenvectors of S, shared by every candidate of a search."""
        values, vectors = np.linalg.eigh(self.S)
        return np.maximum(values, 0.0), vectors

    def subset(self, names: Sequence[str]) -> Normal:
        idx = [self.names.index(c) for c in names]
        return Normal(list(names), self.S[np.ix_(idx, idx)], self.r[idx], self.yy, self.n, self.z_mean[idx], self.y_mean)


COEF_SCHEMA = f"model string, {L.FIT} int, coef array<double>, lam array<double>, shift array<double>"


def coefficient_table(spark: SparkSession, front: FrontEnd, coefs: Mapping[tuple[str, int], np.ndarray]) -> DataFrame:
    """One row per (model, fit): all that scoring needs besides the design. At most MAX_WIDTH wide."""
    rows = []
    for (model, f), coef in coefs.items():
        p = front.prepared[f]
        rows.append((model, f, [float(v) for v in coef], p.lam, [float(s) for s in p.shift]))
    return spark.createDataFrame(rows, COEF_SCHEMA)


def predict(df: DataFrame, design: Design, coefs: DataFrame, keep: Sequence[str], fit: str, inverse=F.expm1) -> DataFrame:
    """Long form of `predict_wide`: `(keep..., model, z, pred)`."""
    wide, models = predict_wide(df, design, coefs, keep, fit)
    return long_predictions(wide, models, keep, inverse)


def long_predictions(wide: DataFrame, models: Sequence[str], keep: Sequence[str], inverse=F.expm1) -> DataFrame:
    cells = F.array(*[F.struct(F.lit(m).alias("model"), F.col(m).alias("z")) for m in models])
    return wide.select(*keep, F.inline(cells)).withColumn("pred", inverse(F.col("z")))


def predict_wide(
    df: DataFrame, design: Design, coefs: DataFrame, keep: Sequence[str], fit: str
) -> tuple[DataFrame, list[str]]:
    """Keeps the given columns and adds one column per model: the prediction in the transformed
    target, by the fit that the row's `fit` column names. Also returns the model names.

    A map over the rows: slots and sums are an Arrow batch function for all models at once. The same sum as a Spark expression passes the size above which the JVM
    no longer compiles a method: 11 s against 2.5 s for 150,000 rows and four models. The
    coefficients that travel with the function are models x fits rows of at most MAX_WIDTH doubles.
    """
    table = coefs.collect()
    models = sorted({r["model"] for r in table})
    weights: dict[int, np.ndarray] = {}
    tuning: dict[int, tuple] = {}
    for r in table:
        f = r[L.FIT]
        w = weights.setdefault(f, np.zeros((len(models), design.width)))
        w[models.index(r["model"])] = r["coef"]
        tuning[f] = (r["lam"], r["shift"])
    nc, starts = len(design.continuous), [design.start[(kind, c)] for kind, c, _ in design.blocks]
    psi, find = L._power_function(), design.finder()

    def score(fit: pa.Array, *cols: pa.Array) -> pa.Array:
        fits, n = fit.to_numpy(zero_copy_only=False), len(fit)
        z = np.full((n, len(models)), np.nan)
        slots = find(cols[nc:])
        for f in np.unique(fits):
            if f not in weights:
                continue
            w, (lam, shift) = weights[f], tuning[f]
            idx = np.flatnonzero(fits == f)
            part = np.tile(w[:, 0], (len(idx), 1))
            for i in range(nc):
                x = cols[i].to_numpy(zero_copy_only=False).astype("float64")[idx]
                x = (psi(x, lam[i], "yeo-johnson") if lam is not None else x) - shift[i]
                part += np.outer(np.nan_to_num(x, nan=0.0), w[:, 1 + i])
            for start, found in zip(starts, slots):
                slot = found[idx]
                hit = np.flatnonzero(slot >= 0)
                part[hit] += w[:, start + slot[hit]].T
            z[idx] = part
        return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype="int32") * len(models)), pa.array(z.ravel()))

    xs = [F.col(c).cast("double") for c in design.continuous]
    scored = df.select(*keep, F.arrow_udf(score, "array<double>")(F.col(fit).cast("int"), *xs, *design.inputs()).alias("__z"))
    return scored.select(*keep, *[F.get("__z", F.lit(i)).alias(m) for i, m in enumerate(models)]), models
