"""Exact ranks and quantiles without sorting a whole table in one task.

Two ideas carry everything here.

* A *hash order* (for splits and folds) is bucketed by a prefix of the hash. Buckets are counted,
  the counts are prefix-summed (one row per prefix, a fixed number), and `row_number` runs inside
  a bucket.
* A *value order* (for quantiles and ranks) is a tree of cells. Edges from a quantile sketch of
  bounded size split a column; a cell that still holds more rows than one task may sort is split
  again by edges of its own, as often as it takes. Every edge's own value is a cell for itself, so a
  value that holds most of the rows does not keep its neighbours together. The edges only balance
  the cells: counts are exact, so results are exact whatever the sketch returned.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabwright.functions.joins import attach, measured, null_safe_join
from tabwright.session import materialize

BUCKETS = 256  # cells that one split makes between its edges
CELL = 200_000  # rows (distinct values, where they are counted first) that one task may sort
DIGIT_BITS = 9  # of a cell's number, for each split: twice the edges and one
DEPTH = 7  # digits of a cell's number


def melt_numeric(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Long form `(keep..., column, value double)` without nulls; a NaN counts as missing."""
    values = [F.col(c).cast("double").alias(c) for c in cols]
    return (
        df.select(*keep, *values)
        .unpivot(list(keep), list(cols), "column", "value")
        .filter(F.col("value").isNotNull() & ~F.isnan("value"))
    )


def hash_key(key: str, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))


def hash_order(
    df: DataFrame, key: str, seed: int, out: str = "rn", by: Sequence[str] = (), digits: int = 4
) -> DataFrame:
    """1-based position of every row in the order of `md5(seed:key)`, ties by key.

    With `by`, positions start again in every group; a large group is spread over its own hash
    buckets, so it never sits in one window partition. `digits` hex digits give 16**digits buckets
    of equal expected size. Without `by` the offset table has that many rows at most, whatever the
    input, which is what allows the broadcast; with `by` it is counted first.
    """
    by = list(by)
    keyed = df.withColumn("__h", hash_key(key, seed)).withColumn("__b", F.substring("__h", 1, digits))
    counts = keyed.groupBy(*by, "__b").agg(F.count("*").alias("__n"))
    before = W.partitionBy(*by).orderBy("__b").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select(*by, "__b", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    inside = W.partitionBy(*by, "__b").orderBy("__h", key)
    placed = attach(keyed, offsets, [*by, "__b"]) if by else keyed.join(F.broadcast(offsets), "__b")
    return placed.withColumn(out, F.col("__off") + F.row_number().over(inside)).drop("__b", "__h", "__off")


def value_order(df: DataFrame, col: str, out: str = "rn", buckets: int = BUCKETS, cell: int = CELL) -> DataFrame:
    """1-based position of every row in the order of a unique numeric column."""
    rows = df.withColumn("column", F.lit(col)).withColumn("value", F.col(col).cast("double"))
    keys = ["column", "bucket"]
    placed, offsets, local = cells(rows, (), buckets, cell)
    placed = null_safe_join(placed, F.broadcast(offsets), keys) if local else attach(placed, offsets, keys)
    inside = W.partitionBy(*keys).orderBy(col)
    return placed.withColumn(out, F.col("__off") + F.row_number().over(inside)).drop("bucket", "__off", "total", "column", "value")


def rank_levels(levels: DataFrame, by: Sequence[str] = (), cell: int = CELL, most: int = 1 << 14) -> DataFrame:
    """Adds `code`: 0-based position of each distinct string `level` within `(by..., column)`.

    Columns with more levels than `cell` are cut into ranges. Their number follows from the counted
    levels; their edges come from a sample of 16 levels per range (those with small hashes, so
    that a second run has the same), which only balances them.
    """
    counts = {r["column"]: r["n"] for r in levels.groupBy("column").agg(F.count_distinct("level").alias("n")).collect()}
    buckets = 1
    while buckets < most and buckets * cell < max(counts.values(), default=0):
        buckets *= 2
    placed = levels.withColumn("bucket", F.lit(0))
    if buckets > 1:
        scale = 1 << 30
        share = [(c, min(scale, -(-16 * buckets * scale // max(n, 1)))) for c, n in counts.items()]
        limits = levels.sparkSession.createDataFrame(share, "column string, __most long")
        chosen = null_safe_join(levels.select("column", "level"), F.broadcast(limits), ["column"])  # one row per column
        chosen = chosen.filter(F.pmod(F.xxhash64("column", "level"), F.lit(scale)) < F.col("__most"))
        picks = F.transform(F.sequence(F.lit(1), F.lit(buckets - 1)), lambda i: F.get("s", F.floor(i * F.size("s") / buckets).cast("int")))
        edges = chosen.groupBy("column").agg(F.sort_array(F.collect_set("level")).alias("s")).select("column", picks.alias("__edges"))
        placed = search_sorted(levels.join(F.broadcast(edges), "column", "left"), "__edges", "level", buckets).drop("__edges")
    group = [*by, "column"]
    per = placed.groupBy(*group, "bucket").agg(F.count("*").alias("n"))
    per = per.withColumn("off", F.sum("n").over(W.partitionBy(*group).orderBy("bucket")) - F.col("n")).drop("n")
    inside = W.partitionBy(*group, "bucket").orderBy("level")
    # at most `buckets` rows per column and fit
    return (
        null_safe_join(placed, F.broadcast(per), [*group, "bucket"])
        .withColumn("code", F.col("off") + F.row_number().over(inside) - 1)
        .drop("bucket", "off")
    )


def _sketch(buckets: int) -> Column:
    """A sorted array of `buckets - 1` doubles from a sketch of bounded size."""
    probs = ", ".join(f"{i / buckets}D" for i in range(1, buckets))
    return F.expr(f"percentile_approx(value, array({probs}), {buckets * 4})").alias("__edges")


def search_sorted(
    df: DataFrame, edges: str, value: str, buckets: int, out: str = "bucket", inclusive: bool = False
) -> DataFrame:
    """Adds the number of entries of the sorted array `edges` below (or not above) the value.

    `buckets` is a power of two above the array length. Each halving step is its own projection, so
    the whole search stays in generated code; a higher-order function over the edge array took four
    times as long on 2.4 million values.
    """
    placed = df.withColumn(out, F.lit(0))
    step = buckets // 2
    while step:
        edge = F.get(edges, F.col(out) + (step - 1))
        passed = edge <= F.col(value) if inclusive else edge < F.col(value)
        placed = placed.withColumn(out, F.col(out) + F.when(passed, step).otherwise(0))
        step //= 2
    return placed


def _split(rows: DataFrame, buckets: int) -> DataFrame:
    """Appends a digit to every row's `bucket`, in the order of values: one for each range between edges
    and one for each edge's own value. Rows without edges get 0."""
    placed = search_sorted(rows, "__edges", "value", buckets, "__lo")
    own = F.coalesce(F.get("__edges", F.col("__lo")) == F.col("value"), F.lit(False)).cast("int")
    digit = 2 * F.col("__lo") + own
    return placed.withColumn("bucket", F.shiftleft("bucket", DIGIT_BITS) + digit).drop("__lo", "__edges")


def _root(long: DataFrame, buckets: int) -> DataFrame:
    """Adds `bucket` to `(…, column, value)` rows: the first split, with edges per column.

    The edges are fetched once (`buckets - 1` doubles per column) and become part of the plan. A
    sketch depends on the order in which partial results arrive; computed again, after a lost
    executor or in a second job, it could give other edges and so other cells.
    """
    rows = [(r["column"], r["__edges"]) for r in long.groupBy("column").agg(_sketch(buckets)).collect()]
    edges = long.sparkSession.createDataFrame(rows, "column string, __edges array<double>")
    return _split(long.join(F.broadcast(edges), "column").withColumn("bucket", F.lit(0).cast("long")), buckets)


def _deeper(rows: DataFrame, heavy: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """One more digit: the heavy cells are split by edges of their own, written once; others go on whole."""
    edges = attach(rows, heavy, keys, name="heavy").groupBy(*keys).agg(_sketch(buckets))
    return _split(attach(rows, edges, keys, "left", name="edges"), buckets)


def cells(rows: DataFrame, by: Sequence[str] = (), buckets: int = BUCKETS, cell: int = CELL, weight: str | None = None) -> tuple[DataFrame, DataFrame, bool]:
    """Cells of at most `cell` rows (or of one value) for `(by..., column, value)` rows.

    Returns the rows with `bucket`, a table `(by..., column, bucket, __off, total)` with the rows (or summed
    weights) before each cell and in the whole, and whether that table is one of fixed size on the driver. Cells
    are numbered in value order. A root split per column is followed by splits of single cells, of
    one group's column each, until none is heavy; the sizes are written, since several readers follow.
    """
    keys, group = [*by, "column", "bucket"], [*by, "column"]
    rows, depth = _root(rows, buckets), 1
    size = F.sum(weight) if weight else F.count("*")
    while True:
        sizes = rows.groupBy(*keys).agg(F.count("*").alias("rows"), size.alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi"))
        local = not by and depth == 1  # a few hundred rows per column
        if local:
            sizes = rows.sparkSession.createDataFrame(sizes.collect(), sizes.schema)
        else:
            sizes = materialize(sizes, "cells")
        heavy = sizes.filter((F.col("rows") > cell) & (F.col("lo") < F.col("hi"))).select(*keys)
        if depth == DEPTH or heavy.isEmpty():
            break
        rows, depth = _deeper(rows, heavy, keys, buckets), depth + 1
    # prefix sums over first digits, then over the cells below each: no window holds all cells of a column
    sized = sizes.withColumn("__head", F.shiftright("bucket", DIGIT_BITS * (depth - 1)))
    w = W.partitionBy(*group)
    heads = sized.groupBy(*group, "__head").agg(F.sum("n").alias("__h"))
    heads = heads.withColumns({"__b": F.sum("__h").over(w.orderBy("__head")) - F.col("__h"), "total": F.sum("__h").over(w)}).drop("__h")
    upto = F.sum("n").over(W.partitionBy(*group, "__head").orderBy("bucket"))
    offsets = null_safe_join(sized, heads, [*group, "__head"]).select(*keys, (F.col("__b") + upto - F.col("n")).alias("__off"), "total")
    return rows, offsets, local


def sees(fit: Column, fold: Column) -> Column:
    """Whether a fit learns from a row: from all but its left-out fold. A negative fold -1 - f marks a row that fit f alone sees."""
    return F.when(fold < 0, fit == -1 - fold).otherwise(fit != fold)


def expand_folds(stats: DataFrame, k: int, fold: str = "fold", out: str = "fit_fold") -> DataFrame:
    """Hand every per-fold statistic to the fits that may see it.

    `fit_fold = f` for f < k is the fit that leaves fold f out; `fit_fold = k` uses all rows.
    Applied to aggregated tables only, so rows are never multiplied.
    """
    fits = F.array(*[F.lit(i) for i in range(k + 1)])
    return stats.withColumn(out, F.explode(F.filter(fits, lambda f: sees(f, F.col(fold))))).drop(fold)


def exact_quantiles(
    df: DataFrame,
    cols: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
    fold: str | None = None,
    k: int = 0,
    buckets: int = BUCKETS,
    cell: int = CELL,
) -> DataFrame:
    """Exact quantiles with linear interpolation: `(by..., [fit_fold], column, prob, value, n)`."""
    keep = [*by, *([fold] if fold else [])]
    return long_quantiles(melt_numeric(df, cols, keep), probs, by, fold, k, buckets, cell)


def long_quantiles(
    long: DataFrame, probs: Sequence[float], by: Sequence[str] = (), fold: str | None = None, k: int = 0,
    buckets: int = BUCKETS, cell: int = CELL,
) -> DataFrame:
    """`exact_quantiles` for rows that are already `(by..., [fold], column, value)`.

    1. sketch -> edges per column; 2. exact counts per cell (map-side combined, tiny); 3. a cell
    that holds a wanted position and more than `cell` rows is split again, and the cells are
    counted anew, until none is; 4. only the cells that hold a wanted position are shuffled, as
    distinct values with counts. With `fold`, cells are counted per fold once and the counts are
    handed to the k + 1 fits.
    """
    by = list(by)
    keep = by + ([fold] if fold else [])
    group = by + (["fit_fold"] if fold else []) + ["column"]
    keys = by + ["column", "bucket"]  # with a fold, a row meets every fit that may see it
    # per cell: the wanted positions that fall into it, as places within the cell
    spots = F.expr(
        "filter(flatten(transform(array(" + ", ".join(f"{float(p)!r}D" for p in probs) + "), p -> transform("
        "array_distinct(array(floor(p * (total - 1)), ceil(p * (total - 1)))), pos -> named_struct('prob', p, "
        "'frac', p * (total - 1) - floor(p * (total - 1)), 'place', pos - (upto - n))))), s -> s.place >= 0 and s.place < n)"
    )
    w = W.partitionBy(*group)
    tagged, depth = _root(long, buckets), 1
    while True:
        hist = tagged.groupBy(*keep, "column", "bucket").agg(F.count("*").alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi"))
        whole = W.partitionBy(*keys)  # over the folds
        heavy = (F.sum("n").over(whole) > cell) & (F.min("lo").over(whole) < F.max("hi").over(whole))
        hist = hist.withColumn("heavy", heavy).drop("lo", "hi")
        if fold:
            hist = expand_folds(hist, k, fold).groupBy(*group, "bucket").agg(F.sum("n").alias("n"), F.max("heavy").alias("heavy"))
        hist = hist.withColumn("upto", F.sum("n").over(w.orderBy("bucket"))).withColumn("total", F.sum("n").over(w))
        need = hist.withColumn("spots", spots).filter(F.size("spots") > 0).select(*group, "bucket", "total", "spots", "heavy")
        if by:
            need, small = measured(need, "quantile_cells")
        else:  # at most columns x fits x 2 x probs rows
            need, small = long.sparkSession.createDataFrame(need.collect(), need.schema), True
        split = need.filter("heavy").select(*keys).distinct()
        if depth == DEPTH or split.isEmpty():
            break
        tagged, depth = _deeper(tagged, split, keys, buckets), depth + 1
    need = need.drop("heavy")
    at = group + ["bucket"]
    here = need.drop("spots", "total")
    picked = null_safe_join(tagged, F.broadcast(here) if small else here, keys)
    if fold:
        picked = picked.filter(sees(F.col("fit_fold"), F.col(fold)))
    counted = picked.groupBy(*at, "value").agg(F.count("*").alias("c"))
    ranked = counted.withColumn("hi", F.sum("c").over(W.partitionBy(*at).orderBy("value")))
    inside = F.expr("filter(spots, s -> s.place < hi and s.place >= hi - c)")
    hit = (
        null_safe_join(ranked, F.broadcast(need) if small else need, at).withColumn("spots", inside).filter(F.size("spots") > 0)
        .select(*group, "value", "total", F.inline("spots"))
    )
    lo, hi = F.min("value"), F.max("value")
    return hit.groupBy(*group, "prob").agg(
        (lo + (hi - lo) * F.max("frac")).alias("value"), F.max("total").alias("n")
    )


def wide_quantiles(q: DataFrame, names: dict[float, str], group: Sequence[str]) -> DataFrame:
    """One column per probability."""
    return q.groupBy(*group).agg(
        *[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(name) for p, name in names.items()]
    )


def rank_values(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), buckets: int = BUCKETS, cell: int = CELL) -> DataFrame:
    """`(by..., column, value, cnt, before, total)` for every distinct value.

    `before` counts the rows with a smaller value. Equal values are combined before the shuffle,
    so a value shared by a third of the rows is one row here.
    """
    long = melt_numeric(df, cols, by)
    counted = long.groupBy(*by, "column", "value").agg(F.count("*").alias("cnt"))
    return rank_counted(counted, by, buckets, cell)


def rank_counted(counted: DataFrame, by: Sequence[str] = (), buckets: int = BUCKETS, cell: int = CELL) -> DataFrame:
    """`rank_values` for distinct values `(by..., column, value, cnt)` that are already counted.

    They are written once, since the edges, the cells and the ranks all read them.
    """
    keys = [*by, "column", "bucket"]
    counted = materialize(counted, "values")
    values, offsets, local = cells(counted, by, buckets, cell, "cnt")
    placed = null_safe_join(values, F.broadcast(offsets), keys) if local else attach(values, offsets, keys)
    inside = W.partitionBy(*keys).orderBy("value")
    return placed.withColumn("before", F.col("__off") + F.sum("cnt").over(inside) - F.col("cnt")).select(
        *by, "column", "value", "cnt", "before", "total")


def value_counts(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = (), nulls: bool = False) -> DataFrame:
    """Counts per `(keep..., column, value string)`; combined map-side before the shuffle."""
    strings = [F.col(c).cast("string").alias(c) for c in cols]
    long = df.select(*keep, *strings).unpivot(list(keep), list(cols), "column", "value")
    if not nulls:
        long = long.filter(F.col("value").isNotNull())
    return long.groupBy(*keep, "column", "value").agg(F.count("*").alias("cnt"))


def most_frequent(counts: DataFrame, group: Sequence[str], value: str = "value", cnt: str = "cnt") -> DataFrame:
    """Most frequent value per group, ties to the smallest: `(group..., value, cnt)`."""
    best = F.min(F.struct((-F.col(cnt)).alias("m"), F.col(value).alias("v")))
    return counts.groupBy(*group).agg(best.alias("b")).select(
        *group, F.col("b.v").alias(value), (-F.col("b.m")).alias(cnt)
    )
