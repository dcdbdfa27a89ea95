"""Mixing sources to target weights: hash-random keys, key ranges with prefix sums, one cut per source."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tabwright.llm.common import attach_small, word_count
from tabwright.session import materialize

SEED = "mix-1"
ROWS_PER_RANGE = 5_000


def _sized(docs: DataFrame, seed: str, id_col: str, source_col: str, text_col: str) -> DataFrame:
    """The document's columns, its words (a null text has none) and its key.

    The key is a hash of the id, so that it needs no row order; rows that repeat an id share a key."""
    key = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit("null"))))
    return docs.withColumns({"__size": word_count(text_col), "__key": key, "__source": F.col(source_col)})


def source_targets(totals: DataFrame, weights=(1, 2, 3), cap: int = 3) -> DataFrame:
    """(source, source_size) with `target`: shares of all words by weight, none above cap * source_size.

    Sources in code point order, null last, take the weights in turn. Sorted by cap * size / weight, the
    capped sources are a prefix: the level that the others share is the first one that no longer exceeds
    its own cap. The windows run over one row per source.
    """
    order = W.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(order) - 1) % len(weights)
    weighed = totals.withColumn("weight", F.element_at(F.array(*[F.lit(int(w)) for w in weights]), turn + 1))
    limit = F.col("source_size") * cap
    rank = W.orderBy((limit.cast("double") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    rest = rank.rowsBetween(0, W.unboundedFollowing)
    before = F.coalesce(F.sum(limit).over(rank.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    everything = W.partitionBy(F.lit(1))
    level = (F.sum("source_size").over(everything) - before).cast("double") / F.sum("weight").over(rest)
    levelled = weighed.withColumns({"level": level, "__rank": F.row_number().over(rank)})
    free = F.col("level") * F.col("weight") <= limit
    first = F.min(F.when(free, F.struct("__rank", "level"))).over(everything)["level"]
    target = F.least(first * F.col("weight"), limit.cast("double"))
    return levelled.select("source", "source_size", target.alias("target"))


def _cuts(sized: DataFrame, targets: DataFrame, cap: int) -> DataFrame:
    """One row per source: full epochs, and the key (with size) where the last, partial epoch is cut.

    `sized` holds (source, key, size). The keys' leading hex digits are ranges of equal width; sums of
    ranges give every range its offset, and only the range that holds a source's cut is sorted row by
    row. A source with most of the rows is spread over all ranges like any other.
    """
    largest = sized.groupBy("source").count().agg(F.max("count")).first()[0] or 1
    digits = max(1, math.ceil(math.log(max(1.0, largest / ROWS_PER_RANGE), 16)))
    span = F.substring("key", 1, digits)
    budget = F.least(F.floor(F.col("target") + 0.5), F.col("source_size") * cap).cast("long")
    goals = targets.withColumn("budget", budget).withColumns({
        "epochs": F.when(F.col("source_size") > 0, F.floor(F.expr("try_divide(budget, source_size)"))).otherwise(0).cast("long"),
    }).withColumn("rest", F.col("budget") - F.col("epochs") * F.col("source_size"))
    goals = goals.withColumnRenamed("source", "__s")
    ranges = sized.groupBy("source", span.alias("span")).agg(F.sum("size").alias("words"))
    upto = F.sum("words").over(W.partitionBy("source").orderBy("span"))
    placed = ranges.withColumn("upto", upto).join(goals, F.col("source").eqNullSafe(F.col("__s")))
    holding = placed.filter((F.col("upto") - F.col("words") <= F.col("rest")) & (F.col("rest") < F.col("upto"))).select(
        "__s", F.col("span").alias("__span"), (F.col("rest") - (F.col("upto") - F.col("words"))).alias("left"))
    inside = sized.join(holding, F.col("source").eqNullSafe(F.col("__s")) & (span == F.col("__span")))
    ties = inside.groupBy("__s", "left", "key", "size").agg(F.count("*").alias("n"))
    total = F.col("size") * F.col("n")
    running = F.sum(total).over(W.partitionBy("__s").orderBy("key", "size"))
    cut = ties.withColumn("upto", running).filter((F.col("upto") - total <= F.col("left")) & (F.col("left") < F.col("upto")))
    cut = cut.select(F.col("__s").alias("__c"), F.col("key").alias("cut_key"), F.col("size").alias("cut_size"),
                     F.floor((F.col("left") - F.col("upto") + total) / F.col("n")).cast("long").alias("cut_words"))
    return goals.join(cut, F.col("__s").eqNullSafe(F.col("__c")), "left").select(
        "__s", "source_size", "target", "epochs", "cut_key", "cut_size", "cut_words")


RESULTS = ["mix_size", "mix_source_size", "mix_target", "mix_taken"]


def _taken(docs: DataFrame, weights, cap: int, seed: str, id_col: str, source_col: str, text_col: str) -> DataFrame:
    """`docs` with __size, __source_size, __target and __taken; whatever other names it has."""
    sized = _sized(docs, seed, id_col, source_col, text_col)
    slim = materialize(sized.select(F.col("__source").alias("source"), F.col("__key").alias("key"), F.col("__size").alias("size")), "mix-sizes")
    targets = source_targets(slim.groupBy("source").agg(F.sum("size").alias("source_size")), weights, cap)
    cuts = _cuts(slim, materialize(targets, "mix-targets"), cap)
    cuts = cuts.withColumnsRenamed({c: f"__{c}" for c in ("source_size", "target", "epochs", "cut_key", "cut_size", "cut_words")})
    joined = attach_small(sized, cuts, F.col("__source").eqNullSafe(F.col("__s")), name="mix-cuts")
    here, at = F.struct("__key", "__size"), F.struct(F.col("__cut_key").alias("__key"), F.col("__cut_size").alias("__size"))
    part = F.when(F.col("__cut_key").isNull(), 0).when(here < at, F.col("__size")).when(here == at, F.col("__cut_words")).otherwise(0)
    return joined.withColumn("__taken", (F.col("__epochs") * F.col("__size") + part).cast("long"))


def mix(docs: DataFrame, weights=(1, 2, 3), cap: int = 3, seed: str = SEED, id_col: str = "doc_id",
        source_col: str = "source", text_col: str = "text") -> DataFrame:
    """`docs` with `mix_size`, `mix_source_size`, `mix_target`, `mix_taken` (long, long, double, long); columns of these names go.

    `mix_taken` counts the words that the mix takes from the row: full epochs of its source repeat it, the
    last epoch takes rows in key order until the source's budget (the rounded target) is used exactly,
    so that one row per source is taken in part. No text is shuffled: each row is compared with its
    source's cut. A null text has no words and is not taken; a null source is a source of its own; rows
    with equal key and size share a cut evenly, rounded down; an empty table gives an empty result.
    """
    taken = _taken(docs, weights, cap, seed, id_col, source_col, text_col)
    return taken.select(*[F.col(f"`{c}`") for c in docs.columns if c not in RESULTS], F.col("__size").alias("mix_size"),
                        F.col("__source_size").alias("mix_source_size"), F.col("__target").alias("mix_target"), F.col("__taken").alias("mix_taken"))


def mixed_documents(docs: DataFrame, weights=(1, 2, 3), cap: int = 3, seed: str = SEED, id_col: str = "doc_id",
                    source_col: str = "source", text_col: str = "text") -> DataFrame:
    """The mix as documents: each row once per epoch in which at least half of its words are taken.

    Texts stay whole; the columns are those of `docs`. Rows without words are not part of the mix.
    """
    taken = _taken(docs, weights, cap, seed, id_col, source_col, text_col).filter(F.col("__taken") > 0)
    copies = F.floor(F.col("__taken") / F.col("__size") + 0.5).cast("int")
    return taken.filter(copies > 0).withColumn("__copy", F.explode(F.sequence(F.lit(1), copies))).select(*[F.col(f"`{c}`") for c in docs.columns])


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    return mix(docs).select("doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"),
                            F.col("mix_target").alias("target"), F.col("mix_taken").alias("taken"))


SQL = r"""
with d as (
  select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size,
         md5('mix-1:' || coalesce(cast(doc_id as varchar), 'null')) as k
  from documents),
s as (
  select source, cast(sum(size) as bigint) as source_size,
         (row_number() over (order by source nulls last) - 1) % 3 + 1 as weight
  from d group by source),
r as (
  select *, row_number() over (order by cast(source_size * 3 as double) / weight, source nulls last) as rk,
         cast(sum(source_size) over () - coalesce(sum(source_size * 3) over (
           order by cast(source_size * 3 as double) / weight, source nulls last
           rows between unbounded preceding and 1 preceding), 0) as double)
         / cast(sum(weight) over (order by cast(source_size * 3 as double) / weight, source nulls last
                             rows between current row and unbounded following) as double) as level
  from s),
t as (
  select source, source_size,
         least((select level from r where level * weight <= source_size * 3 order by rk limit 1) * weight,
               cast(source_size * 3 as double)) as target
  from r),
b as (
  select *, least(cast(floor(target + 0.5) as bigint), source_size * 3) as budget from t),
e as (
  select *, case when source_size > 0 then budget // source_size else 0 end as epochs from b),
p as (
  select d.*, e.source_size, e.target, e.epochs, e.budget - e.epochs * e.source_size as rest,
         sum(d.size) over (partition by d.source order by d.k, d.size) - d.size as before
  from d join e on d.source is not distinct from e.source)
select doc_id, size, source_size, target,
       cast(epochs * size + greatest(0, least(size, rest - before)) as bigint) as taken
from p
"""
