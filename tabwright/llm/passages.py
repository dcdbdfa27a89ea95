"""Substring dedup: count-min sketches of the tasks, merged, tell which word windows may repeat; those are grouped exactly."""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tabwright.llm import rolling
from tabwright.llm.common import attach_small, bounded_batches, by_value, slices, text_or_empty, with_copies

by_value(__name__)

WINDOW = 20
GRAM = 8  # words of the grams that stand for windows in the sketch
DEPTH = 2
BLOCK_BITS = 16  # cells of one block of a sketch
MIN_BITS, MAX_BITS = 16, 27  # cells of a row: 2^27 are 16 MiB as a bitmap of repeated cells
SLICE = 4_000_000


def _anchors(texts: list[bytes], window: int, gram: int):
    """For every window inside one text: its start word, the hash of its smallest gram, and the text's number.

    Equal windows have equal smallest grams at equal places, so a gram is counted at least as often as any
    window that it stands for.
    """
    data, begins = rolling.joined(texts)
    hashes, starts, _ = rolling.words(data)
    owner = np.searchsorted(begins, starts, side="right") - 1
    grams = rolling.windows(hashes, gram, 21)
    place = rolling.first_minimum(grams, window - gram + 1)
    first = np.flatnonzero(owner[: len(place)] == owner[window - 1 :]) if len(place) else place
    return hashes, owner, grams, first, place[first]


def _cells(hashes: np.ndarray, row: int, bits: int) -> np.ndarray:
    return (rolling.mix(hashes + np.uint64(row * 0x9E3779B97F4A7C15 % 2**64)) >> np.uint64(64 - bits)).astype(np.int64)


def sketch(docs: DataFrame, bits: int, hashes_of, size: int = SLICE) -> DataFrame:
    """(line, block, bitmap): for every line of the count-min sketch, which cells were hit twice or more.

    Each task counts what `hashes_of` finds in slices of its texts and sends, per block, the cells hit once and those hit
    more often; partial sketches are added block by block after one shuffle of these lists.
    """
    small = min(bits, BLOCK_BITS)

    def count(batches):
        import pyarrow as pa

        found = []
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for lo, hi in slices(texts, size):
                found.append(hashes_of([t.encode("utf-8") for t in texts[lo:hi]]))
        hashes = np.concatenate(found) if found else np.empty(0, np.uint64)
        for line in range(DEPTH):
            cells, n = np.unique(_cells(hashes, line, bits), return_counts=True)
            blocks, at = np.unique(cells >> small, return_index=True)
            inside = (cells & ((1 << small) - 1)).astype(np.uint16)
            once, more = [], []
            for lo, hi in zip(at, [*at[1:], len(cells)]):
                once.append(inside[lo:hi][n[lo:hi] == 1].tobytes())
                more.append(inside[lo:hi][n[lo:hi] > 1].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array([line] * len(blocks), pa.int32()), pa.array(blocks, pa.int32()),
                                              pa.array(once, pa.binary()), pa.array(more, pa.binary())], names=["line", "block", "once", "more"])

    def add(batches):
        import pyarrow as pa

        key, total = None, None
        out = []

        def close():
            if key is not None and (total > 1).any():
                out.append((*key, np.packbits(total > 1, bitorder="little").tobytes()))

        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()),
                                               pa.array([r[2] for r in rows], pa.binary())], names=["line", "block", "bitmap"])

        for batch in batches:
            for line, block, once, more in zip(*(c.to_pylist() for c in batch.columns)):
                if (line, block) != key:
                    close()
                    key, total = (line, block), np.zeros(1 << small, np.uint8)
                for cells, n in ((once, 1), (more, 2)):
                    at = np.frombuffer(cells, np.uint16)
                    total[at] = np.minimum(total[at] + n, 2)
            if len(out) >= 256:
                yield batch_of(out)
                out.clear()
        close()
        yield batch_of(out)

    partial = docs.select("text").mapInArrow(count, "line int, block int, once binary, more binary")
    return partial.repartition("line", "block").sortWithinPartitions("line", "block").mapInArrow(add, "line int, block int, bitmap binary")


def cells_for(docs: DataFrame, bytes_per_cell: int) -> int:
    """Bits of a cell number, from the counted bytes of all texts."""
    total = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    return min(MAX_BITS, max(MIN_BITS, int(total / bytes_per_cell).bit_length()))


def repeated_cells(docs: DataFrame, bits: int, hashes_of, size: int = SLICE):
    """A broadcast of the merged sketch's bitmaps, one per line: at most DEPTH * 2^MAX_BITS / 8 bytes."""
    maps = [np.zeros(-(-(1 << bits) // 8), np.uint8) for _ in range(DEPTH)]
    width = max(1, (1 << min(bits, BLOCK_BITS)) // 8)
    for r in sketch(docs, bits, hashes_of, size).toLocalIterator():
        maps[r["line"]][r["block"] * width : (r["block"] + 1) * width] = np.frombuffer(r["bitmap"], np.uint8)
    return docs.sparkSession.sparkContext.broadcast([m.tobytes() for m in maps])


def maybe_repeated(hashes: np.ndarray, bitmaps: list[bytes], bits: int) -> np.ndarray:
    """Whether every line of the sketch has seen the hash's cell twice."""
    keep = np.ones(len(hashes), dtype=bool)
    for line, bitmap in enumerate(bitmaps):
        cell = _cells(hashes, line, bits)
        keep &= (np.frombuffer(bitmap, np.uint8)[cell >> 3] >> (cell & 7).astype(np.uint8)) & 1 == 1
    return keep


def _repeated(docs: DataFrame, bitmaps, bits: int, window: int, gram: int) -> DataFrame:
    """(h1, h2, id, tag, sure) of the windows whose estimate is two or more; tag holds the text's short hash and the start.

    Within a slice only the first of equal windows goes on to the exact grouping; the others repeat for
    sure. So a window that occurs very often is one row per slice there.
    """

    def emit(batches):
        import pyarrow as pa

        for batch in batches:
            ids, tags, texts = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(), batch.column(2).to_pylist()
            for lo, hi in slices(texts, SLICE):
                hashes, owner, grams, first, place = _anchors([t.encode("utf-8") for t in texts[lo:hi]], window, gram)
                first = first[maybe_repeated(grams[place], bitmaps.value, bits)]
                h1, h2 = (rolling.windows(hashes, window, seed)[first].astype(np.int64) for seed in (31, 41))
                text_of = owner[first]
                begin = np.searchsorted(owner, text_of)
                doc, tag = ids[lo:hi][text_of], tags[lo:hi][text_of] + (first - begin)
                order = np.lexsort((tag, doc, h2, h1))
                h1, h2, doc, tag = h1[order], h2[order], doc[order], tag[order]
                fresh = np.r_[True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])] if len(h1) else np.empty(0, bool)
                head = np.maximum.accumulate(np.where(fresh, np.arange(len(h1)), 0)) if len(h1) else np.empty(0, int)
                tied = (doc == doc[head]) & (tag == tag[head])
                twin = tied & ~fresh  # a repeated row: the same window of the same text
                h1, h2, doc, tag, sure = (x[~twin] for x in (h1, h2, doc, tag, ~tied))
                yield pa.RecordBatch.from_arrays([pa.array(h1), pa.array(h2), pa.array(doc, pa.int64()), pa.array(tag), pa.array(sure)],
                                                 names=["h1", "h2", "id", "tag", "sure"])

    return docs.select("id", "tag", "text").mapInArrow(emit, "h1 long, h2 long, id long, tag long, sure boolean")


def removed_runs(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, bits: int | None = None) -> DataFrame:
    """(id, short, begins, ends): word ranges to remove of each text that has any.

    `docs` holds id (long), tag (short text hash in the upper half) and text. `bits` sizes the sketch: by
    default four cells per expected gram, at most 2^27 per line; a fuller sketch lets more windows through
    to the exact grouping and loses none.
    """
    if bits is None:
        bits = cells_for(docs, 10)

    def grams_of(texts):
        _, _, grams, _, place = _anchors(texts, window, gram)
        return grams[np.unique(place)]

    bitmaps = repeated_cells(docs, bits, grams_of)
    rows = _repeated(docs, bitmaps, bits, window, gram)
    place = F.rank().over(W.partitionBy("h1", "h2").orderBy("id", "tag"))
    # a sure row has a window of its own here: it needs no comparison
    rows = rows.withColumn("h2", F.when(F.col("sure"), F.xxhash64("id", "tag")).otherwise(F.col("h2")))
    flagged = rows.withColumn("place", place).filter("sure or place > 1").select(
        "id", F.shiftright("tag", 32).alias("short"), F.col("tag").bitwiseAND((1 << 32) - 1).cast("int").alias("start"))
    listed = flagged.groupBy("id", "short").agg(F.sort_array(F.collect_list("start")).alias("s"))
    s = F.col("s")
    begins = F.filter(s, lambda x, i: (i == 0) | (x - F.element_at(s, F.greatest(i, F.lit(1))) > window))
    ends = F.filter(s, lambda x, i: F.coalesce(F.try_element_at(s, i + 2) - x > window, F.lit(True)))
    return listed.select("id", "short", begins.alias("begins"), F.transform(ends, lambda x: x + window).alias("ends"))


def dedup_windows(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", bits: int | None = None) -> DataFrame:
    """`id_col`, n_words, n_removed, kept_sha256 and kept_text for every row of `docs`.

    A word goes if it lies in a window of `window` words that also starts earlier: in a row with a smaller
    id, or earlier in the same text. Null ids come first; a null text has no words; rows that repeat id and
    text are one document and get one result; different texts of one id are ordered by a hash. Later copies
    of a whole text are recognised by digest and take no part in the grouping. The text itself is not
    shuffled unless the list of removals is too large to broadcast.
    """
    bounded_batches(docs)
    id_type = docs.schema[id_col].dataType.simpleString()
    order = F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63)))
    base = docs.select(F.col(id_col).alias("doc"), order.alias("id"), text_or_empty(text_col).alias("text"))
    tag = F.shiftleft(F.pmod(F.xxhash64("text"), F.lit(1 << 31)), 32)
    keyed = with_copies(base, "id", "text").withColumn("tag", tag)
    runs = removed_runs(keyed.filter("__first is null or id = __first").select("id", "tag", "text"), window, GRAM if window > GRAM else 1, bits)
    runs = runs.withColumnsRenamed({"id": "__id", "short": "__short"})
    ready = attach_small(keyed, runs, (F.col("id") == F.col("__id")) & (F.shiftright("tag", 32) == F.col("__short")), name="runs")

    def cut(batches):
        import pyarrow as pa

        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns[1:]]
            n_words, n_removed, digest, kept_text = [], [], [], []
            for text, copy, begins, ends in zip(*columns):
                words = text.encode("utf-8").split()
                n = len(words)
                if copy and n >= window:
                    kept = []
                elif begins:
                    kept, at = [], 0
                    for b, e in zip(begins, ends):
                        kept += words[at:b]
                        at = e
                    kept += words[at:]
                else:
                    kept = words
                whole = b" ".join(kept)
                n_words.append(n)
                n_removed.append(n - len(kept))
                digest.append(hashlib.sha256(whole).hexdigest())
                kept_text.append(whole.decode("utf-8"))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                                              pa.array(digest, pa.string()), pa.array(kept_text, pa.string())],
                                             names=["doc", "n_words", "n_removed", "kept_sha256", "kept_text"])

    copy = F.coalesce(F.col("id") > F.col("__first"), F.lit(False))
    out = ready.select("doc", "text", copy.alias("copy"), "begins", "ends").mapInArrow(
        cut, f"doc {id_type}, n_words long, n_removed long, kept_sha256 string, kept_text string")
    return out.withColumnRenamed("doc", id_col)


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return dedup_windows(docs).drop("kept_text")


SQL = r"""
with d as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
v as (select doc_id, w, unnest(range(1, len(w) - 18)) as i from d),
k as (select doc_id, i, rank() over (partition by array_to_string(w[i:i + 19], ' ') order by doc_id, i) as place from v),
g as (select distinct doc_id, unnest(range(i, i + 20)) as j from k where place > 1),
x as (select doc_id, w, unnest(range(1, len(w) + 1)) as j from d),
t as (select x.doc_id, string_agg(case when g.j is null then w[x.j] end, ' ' order by x.j) as kept, count(g.j) as n_removed
      from x left join g on g.doc_id = x.doc_id and g.j = x.j group by x.doc_id)
select d.doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_removed, 0) as bigint) as n_removed,
       sha256(coalesce(kept, '')) as kept_sha256
from d left join t on t.doc_id = d.doc_id
"""
