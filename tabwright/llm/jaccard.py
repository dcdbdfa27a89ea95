"""N-gram Jaccard join: rare-first prefix filtering with length, positional and suffix filters, verified once per pair.

Links are only needed up to components. So most pairs of a group of near copies are never formed: hubs are
tried first, and only pairs between different components are listed after that.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabwright.llm import rolling
from tabwright.llm.common import WORD, attach_small, bounded_batches, by_value, slices, text_or_empty, with_copies
from tabwright.llm.components import components
from tabwright.session import materialize

by_value(__name__)

WORDS = 5
SKETCH_BITS = 24  # counters that order the shingles by frequency, a byte each when they are broadcast
SKETCH_BLOCK = 1 << 14
STEPS = 8  # steps of a counter's byte for each doubling
HOT = 200_000  # postings of one token that may meet in one task
SLICE = 1_000_000
GROUP = 128  # texts that are compared with one hub in one place
HUB_ROUNDS = 2


def shingle_sets(texts: list[bytes], words: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; fewer words are one shingle, no words none."""
    data, begins = rolling.joined(texts)
    hashes, starts, _ = rolling.words(rolling.LOWER[data])
    grams = rolling.windows(hashes, words, 51)
    bounds = np.searchsorted(starts, begins)
    out = []
    for lo, hi in zip(bounds, bounds[1:]):
        if hi - lo >= words:
            out.append(np.unique(grams[lo : hi - words + 1]))
        elif hi > lo:
            out.append(rolling.windows(hashes[lo:hi], hi - lo, 60 + int(hi - lo)))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union of two sorted sets; a suffix filter on a few pivots comes first."""
    need = percent * (len(x) + len(y))  # intersection * (100 + percent) has to reach it
    if (100 + percent) * min(len(x), len(y)) < need:
        return False
    if len(x) > 64:
        pivots = np.arange(len(x) // 16, len(x), len(x) // 16)
        across = np.searchsorted(y, x[pivots])
        bound = np.minimum(np.diff(np.r_[0, pivots, len(x)]), np.diff(np.r_[0, across, len(y)])).sum()
        if (100 + percent) * int(bound) < need:
            return False
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    both = int((y[at] == x).sum()) if len(y) else 0
    return both > 0 and (100 + percent) * both >= need


def _overview(docs: DataFrame, words: int) -> DataFrame:
    """Two kinds of rows: (id, th, n) with the size of each set, and (block, counts) of each task's sketch."""

    def run(batches):
        import pyarrow as pa

        names = ["id", "th", "n", "block", "counts"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
        total = np.zeros(1 << SKETCH_BITS, np.uint32)
        for batch in batches:
            texts = batch.column(2).to_pylist()
            sizes = []
            for lo, hi in slices(texts, SLICE):
                sets = shingle_sets([t.encode("utf-8") for t in texts[lo:hi]], words)
                sizes += map(len, sets)
                np.add.at(total, (np.concatenate(sets) >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), np.uint32(1))
            none = pa.nulls(len(texts))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sizes, pa.int64()),
                                              none.cast(pa.int32()), none.cast(pa.binary())], names=names)
        parts = total.reshape(-1, SKETCH_BLOCK)
        blocks = np.flatnonzero(parts.any(axis=1)).tolist()
        counts = [zlib.compress((parts[i].astype(np.uint8) if parts[i].max() < 256 else parts[i]).tobytes(), 1) for i in blocks]
        none = [None] * len(blocks)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip((none, none, none, blocks, counts), kinds)], names=names)

    return docs.select("id", "th", "text").mapInArrow(run, "id long, th long, n long, block int, counts binary")


def _merged(partial: DataFrame) -> np.ndarray:
    """The sum of all tasks' sketches, added block by block in the cluster; 2^SKETCH_BITS bytes.

    A byte q stands for a count of at most 2^(q / STEPS): enough for the order, and a bound on a token's postings.
    """

    def add(batches):
        import pyarrow as pa

        totals: dict = {}
        for batch in batches:
            for block, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                raw = zlib.decompress(packed)
                counts = np.frombuffer(raw, np.uint8 if len(raw) == SKETCH_BLOCK else np.uint32)
                totals[block] = totals.get(block, 0) + counts.astype(np.uint64)
        levels = [np.minimum(np.ceil(STEPS * np.log2(np.maximum(t, 1))), 255).astype(np.uint8).tobytes() for t in totals.values()]
        yield pa.RecordBatch.from_arrays([pa.array(totals.keys(), pa.int32()), pa.array(levels, pa.binary())], names=["block", "counts"])

    total = np.zeros(1 << SKETCH_BITS, np.uint8)
    for r in partial.select("block", "counts").repartition("block").mapInArrow(add, "block int, counts binary").collect():
        total[r["block"] * SKETCH_BLOCK : (r["block"] + 1) * SKETCH_BLOCK] = np.frombuffer(r["counts"], np.uint8)
    return total


def _most(hot: int) -> int:
    """The largest byte of a counter that stands for `hot` texts at most."""
    return int(np.floor(STEPS * np.log2(hot)))


def _postings(docs: DataFrame, order, words: int, percent: int, least: int, most: int) -> DataFrame:
    """(token, id, th, meta) of every prefix: the rarest shingles of a set, as many as a similar set has to meet.

    meta holds the set's size (upper half) and the shingle's position in the rare-first order. Tokens whose counter's
    byte is outside `least` to `most` are left to another call.
    """

    def run(batches):
        import pyarrow as pa

        counts = np.frombuffer(order.value, np.uint8)
        for batch in batches:
            ids, hashes, texts = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2).to_pylist()
            for lo, hi in slices(texts, SLICE):
                tokens, owners, digests, metas = [], [], [], []
                for key, th, s in zip(ids[lo:hi], hashes[lo:hi], shingle_sets([t.encode("utf-8") for t in texts[lo:hi]], words)):
                    n = len(s)
                    if not n:
                        continue
                    size = n - (percent * n + 99) // 100 + 1
                    level = counts[(s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
                    rare = np.argsort(level, kind="stable")[:size]  # equal levels stay in the order of their hashes
                    at = np.flatnonzero((level[rare] >= least) & (level[rare] <= most))
                    tokens.append(s[rare[at]])
                    owners.append(np.full(len(at), key, np.int64))
                    digests.append(np.full(len(at), th, np.int64))
                    metas.append(at + (n << 32))
                if tokens:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(tokens).astype(np.int64)), pa.array(np.concatenate(owners)),
                                                      pa.array(np.concatenate(digests)), pa.array(np.concatenate(metas).astype(np.int64))],
                                                     names=["token", "id", "th", "meta"])

    return docs.select("id", "th", "text").mapInArrow(run, "token long, id long, th long, meta long")


def _possible(percent: int):
    """Length and positional filter of two postings (meta, meta2) of one token."""
    n, m = F.shiftright("meta", 32), F.shiftright("meta2", 32)
    i, j = F.col("meta").bitwiseAND((1 << 32) - 1), F.col("meta2").bitwiseAND((1 << 32) - 1)
    long_enough = F.least(n, m) * 100 >= F.greatest(n, m) * percent
    return long_enough & ((100 + percent) * (1 + F.least(n - i - 1, m - j - 1)) >= percent * (n + m))


def _verified(pairs: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) that link. Each text goes once to every hub that asks for it, hubs to each of their groups."""
    sizes = pairs.groupBy("a").agg(F.count("*").alias("n"))
    groups = F.greatest(F.lit(1), F.ceil(F.col("n") / GROUP)).cast("int")
    dealt = pairs.join(sizes, "a").select(F.col("a").alias("hub"), F.pmod(F.xxhash64("b"), groups).cast("int").alias("part"), F.col("b").alias("of"))
    hubs = sizes.select(F.col("a").alias("hub"), F.explode(F.sequence(F.lit(0), groups - 1)).alias("part"), F.col("a").alias("of"))
    asked = attach_small(docs.select("id", "text"), dealt.union(hubs), F.col("id") == F.col("of"), "inner", "asked")

    def run(batches):
        import pyarrow as pa

        key, hub = None, []
        for batch in batches:
            a, b = [], []
            columns = [c.to_pylist() for c in batch.columns]
            for lo, hi in slices(columns[3], SLICE):
                sets = shingle_sets([t.encode("utf-8") for t in columns[3][lo:hi]], words)
                for h, part, other, s in zip(*(c[lo:hi] for c in columns[:3]), sets):
                    if (h, part) != key:
                        key, hub = (h, part), []
                    if other == h:
                        hub.append(s)  # several texts only if an id repeats
                    elif any(similar(x, s, percent) for x in hub):
                        a.append(h)
                        b.append(other)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    spread = asked.select("hub", "part", "of", "text").repartition("hub", "part")
    placed = spread.sortWithinPartitions("hub", "part", F.col("of") != F.col("hub"))
    return placed.mapInArrow(run, "a long, b long")


def _hub_pairs(rows: DataFrame, turn: int, percent: int) -> DataFrame:
    """One pair (hub, document) at most per document: the best hub of its tokens, if that is of another component.

    First the text with the most shared shingles in its prefix is the hub of a token: the original of a
    group of altered copies has no rare ones of its own. Later turns draw hubs by hash.
    """
    rank = -F.col("shared") if turn == 0 else F.xxhash64("id", F.lit(turn))
    first = F.struct(rank.cast("long").alias("h"), "id", "meta", "comp")
    hubs = rows.groupBy("token").agg(F.min(first).alias("f")).select(
        "token", F.col("f.h").alias("h"), F.col("f.id").alias("a"), F.col("f.meta").alias("meta2"), F.col("f.comp").alias("comp2"))
    met = rows.join(hubs, "token").filter((F.col("comp") != F.col("comp2")) & _possible(percent))
    return met.groupBy(F.col("id").alias("b")).agg(F.min(F.struct("h", "a")).alias("best")).select("best.a", "b")


def _one_token_per_list(rows: DataFrame) -> DataFrame:
    """Of tokens that stand in the same documents, the earliest: it holds for all their pairs, and its filter is the sharpest.

    Lists are compared by their length and by sums of two hashes of (id, text): an id stands twice in a list if its row
    repeats or two of its texts share the token, and texts of one id differ in size and order. The halves of the hashes
    are added by themselves, so that no sum overflows. The order of two such tokens is that of their positions in the
    smallest document.
    """
    halves = [half for seed in (0, 1) for h in [F.xxhash64("id", "th", F.lit(seed))]
              for half in (F.shiftright(h, 32), h.bitwiseAND((1 << 32) - 1))]
    key = [f"s{i}" for i in range(len(halves))]
    lists = rows.groupBy("token").agg(
        F.count("*").alias("n"), *[F.sum(half).alias(k) for k, half in zip(key, halves)],
        F.min(F.struct("id", "th", F.col("meta").bitwiseAND((1 << 32) - 1).alias("at"))).alias("one"))
    first = lists.groupBy("n", *key).agg(F.min(F.struct(F.col("one.at"), "token")).alias("f")).select(F.col("f.token").alias("token"))
    return rows.join(first, "token")


def _labelled(postings: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Postings (with `comp`) of the tokens that still meet different components."""
    if labels is None:
        rows = postings.withColumn("comp", F.col("id"))
    else:
        rows = attach_small(postings.drop("comp"), labels, F.col("id") == F.col("node"), name="labels").withColumn(
            "comp", F.coalesce("component", "id")).drop("node", "component")
    mixed = rows.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo < hi").select(F.col("token").alias("__t"))
    return attach_small(rows, mixed, F.col("token") == F.col("__t"), "left_semi", "mixed")


def _shared_postings(docs: DataFrame, order, words: int, percent: int, hot: int) -> DataFrame:
    """Postings (with `comp` and `shared`) of the tokens that stand in several documents.

    Most tokens stand in one. Those whose counter proves `hot` postings at most meet in one task each, so postings are
    shuffled once; the others are written and met by counts that are combined before the shuffle.
    """
    bound = _most(hot)
    token = W.partitionBy("token")
    cold = _postings(docs, order, words, percent, 0, bound).withColumns(
        {"comp": F.col("id"), "__lo": F.min("id").over(token), "__hi": F.max("id").over(token)})
    rows = cold.filter("__lo < __hi").drop("__lo", "__hi")
    if np.frombuffer(order.value, np.uint8).max(initial=0) > bound:
        crowded = materialize(_postings(docs, order, words, percent, bound + 1, 255), "postings")
        rows = rows.unionByName(_labelled(crowded, None))
    rows = materialize(rows, "postings")
    shared = rows.groupBy("id").agg(F.count("*").alias("shared")).withColumnRenamed("id", "__id")
    return attach_small(rows, shared, F.col("id") == F.col("__id"), name="shared").drop("__id")


def linked(docs: DataFrame, words: int = WORDS, percent: int = 80, id_col: str = "doc_id", text_col: str = "text",
           hot: int = HOT) -> DataFrame:
    """`id_col`, n_shingles and component_id for every row of `docs`.

    ASCII letters are compared in lower case. A null text is empty; texts without words link with nothing;
    rows with one id are one document; a null id comes last and is returned as null. Texts that occur in
    several rows are compared once. Nothing but frequency counters comes to the driver.
    """
    bounded_batches(docs)
    last = (1 << 63) - 1
    base = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(last)).alias("id"), text_or_empty(text_col).alias("text"))
    keyed = with_copies(base, "id", "text").withColumn("th", F.xxhash64("text"))
    singles = keyed.filter("__first is null or id = __first").select("id", "th", "text")
    overview = materialize(_overview(singles, words), "overview")
    order = docs.sparkSession.sparkContext.broadcast(_merged(overview.filter("block is not null")).tobytes())
    rows = materialize(_shared_postings(singles, order, words, percent, hot), "postings")
    same = keyed.filter((F.col("id") > F.col("__first")) & F.col("text").rlike(WORD)).select(F.col("__first").alias("a"), F.col("id").alias("b"))
    known = same.limit(0)
    for turn in range(HUB_ROUNDS):
        if rows.isEmpty():
            break
        pairs = materialize(_hub_pairs(rows, turn, percent), "pairs")
        links = _verified(pairs, singles, words, percent)
        labels = materialize(components(known.union(links)), "labels")
        known = labels.select(F.col("component").alias("a"), F.col("node").alias("b"))
        rows = materialize(_labelled(rows, labels), "postings")
    rows = materialize(_one_token_per_list(rows), "postings")
    other = rows.select("token", F.col("id").alias("b"), F.col("meta").alias("meta2"), F.col("comp").alias("comp2"))
    pairs = rows.join(other, "token").filter((F.col("comp") < F.col("comp2")) & _possible(percent)).select(F.col("id").alias("a"), "b").distinct()
    links = _verified(materialize(pairs, "pairs"), singles, words, percent)
    labels = components(known.union(links).union(same))
    sizes = overview.filter("block is null").select(F.col("id").alias("__i"), F.col("th").alias("__t"), "n").distinct()
    out = keyed.select("id", F.coalesce("__first", "id").alias("__node"), "th").join(sizes, (F.col("__node") == F.col("__i")) & (F.col("th") == F.col("__t")), "left")
    out = out.join(labels, F.col("id") == F.col("node"), "left")
    component = F.coalesce("component", "id")
    kind = docs.schema[id_col].dataType.simpleString()
    return out.select(F.nullif("id", F.lit(last)).cast(kind).alias(id_col), F.coalesce("n", F.lit(0)).cast("long").alias("n_shingles"),
                      F.nullif(component, F.lit(last)).alias("component_id"))


def one_per_group(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The documents whose id is the smallest of their component, with the columns of `docs`.

    Of rows that repeat such an id and its text, one stays; null ids are kept if nothing links to them.
    """
    groups = linked(docs, id_col=id_col, **options).filter(F.col(id_col).isNotNull()).filter(F.col(id_col) != F.col("component_id"))
    gone = groups.select(F.col(id_col).alias("__gone")).distinct()
    kept = attach_small(docs, gone, F.col(id_col) == F.col("__gone"), "left_anti", "gone")
    return kept


def query(spark, sf_dir: str) -> DataFrame:
    return linked(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


SQL = r"""
with recursive d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') as w
  from documents),
s as (
  select doc_id, case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
                 else list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) end as g
  from d),
e as (select doc_id, len(g) as n, unnest(g) as t from s),
p as (select a.doc_id as a, b.doc_id as b from e a join e b on a.t = b.t and a.doc_id <> b.doc_id
      group by a.doc_id, b.doc_id having 100 * count(*) >= 80 * (any_value(a.n) + any_value(b.n) - count(*))),
r as (select doc_id as a, doc_id as b from d union select r.a, p.b from r join p on r.b = p.a),
c as (select a, min(b) as component_id from r group by a)
select s.doc_id, cast(len(g) as bigint) as n_shingles, component_id from s join c on c.a = s.doc_id
"""
