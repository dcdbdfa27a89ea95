"""Suffix-array dedup: prefix doubling over synchronised positions, down to single windows where it is needed.

A window of 400 bytes is found again through its anchor, the 64-byte gram with the smallest hash inside it:
equal windows have equal anchors at equal offsets. Offsets are taken in blocks. For a block, the bytes that
all its windows share are ranked by prefix doubling (64, 128, 256, 337 bytes), positions dropping out as soon
as their rank is unique. If the union of the block's windows repeats as a whole, all of them do; else, where
the shared bytes do repeat, the block is cut into parts, for which the same holds, down to single windows.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.llm import rolling
from tabwright.llm.common import attach_small, bounded_batches, by_value, slices, text_or_empty, with_copies
from tabwright.llm.passages import cells_for, maybe_repeated, repeated_cells
from tabwright.session import materialize

by_value(__name__)

LENGTH = 400
GRAM = 64
BLOCK = 64
PARTS = 4  # of a block whose windows repeat in part
SLICE = 1_000_000


def _runs(texts: list[bytes], length: int, gram: int):
    """Anchors of a slice: their place and gram hash, the first and last window start that each one serves, its text."""
    data, begins = rolling.joined(texts)
    values = rolling.byte_table(71)[data]
    grams = rolling.windows(values, gram, 72)
    place = rolling.first_minimum(grams, length - gram + 1)
    n = len(place)
    owner = np.repeat(np.arange(len(texts)), np.diff(begins))[:n]
    start = np.flatnonzero(np.arange(n) + length <= begins[1:][owner] - 1)  # the line feed after a text is not part of it
    anchor = place[start]
    new = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]]) if len(anchor) else np.empty(0, np.int64)
    last = np.r_[new[1:], len(anchor)] - 1
    at = anchor[new]
    return values, begins, at, grams[at], start[new], start[last], owner[start[new]]


def _named(values: np.ndarray, seed: int, ranges: list[tuple[np.ndarray, np.ndarray]]) -> list[np.ndarray]:
    """64-bit names of byte ranges, worked through in pieces of the slice so that power tables stay small."""
    out = [np.empty(len(s), np.uint64) for s, _ in ranges]
    reach = max((int((e - s).max()) for s, e in ranges if len(s)), default=0)
    for lo in range(0, len(values), rolling.BLOCK):
        sums, down = rolling._sums(values[lo : lo + rolling.BLOCK + reach], seed)
        for name, (s, e) in zip(out, ranges):
            mine = np.flatnonzero((s >= lo) & (s < lo + rolling.BLOCK))
            name[mine] = rolling.spans(sums, down, s[mine] - lo, e[mine] - lo)
    return out


def _blocks(docs: DataFrame, bitmaps, bits: int, length: int, gram: int, block: int) -> DataFrame:
    """One row per anchor and block of offsets that it serves, if the sketch has seen the anchor's gram twice.

    rank: name of the first `gram` bytes that the block's windows share; n1, n2, n3: names that follow at
    growing offsets; u1, u2: name of all bytes of its windows, cut at the text's ends; id, place (short text
    hash and first byte of that union), size (its bytes), inside (the anchor's offset in it), block.
    """
    shared = length - block + 1

    def emit(batches):
        import pyarrow as pa

        names = ["rank", "n1", "n2", "n3", "u1", "u2", "id", "place", "size", "inside", "block"]
        for batch in batches:
            ids, tags, texts = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2).to_pylist()
            for lo, hi in slices(texts, SLICE):
                values, begins, at, key, first, last, owner = _runs([t.encode("utf-8") for t in texts[lo:hi]], length, gram)
                keep = maybe_repeated(key, bitmaps.value, bits)
                at, first, last, owner = at[keep], first[keep], last[keep], owner[keep]
                low, high = (at - last) // block, (at - first) // block
                n = high - low + 1
                row = np.repeat(np.arange(len(at)), n)
                b = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + low[row]
                a, text = at[row], owner[row]
                p = a - b * block
                begin, end = begins[text], begins[text + 1] - 1
                left, right = np.maximum(begin, p - block + 1), np.minimum(end, p + length)
                steps = [(p, p + gram), (p + gram, p + 2 * gram), (p + 2 * gram, p + 4 * gram), (p + 4 * gram, p + shared), (left, right)]
                *grown, u1 = _named(values, 73, steps)
                (u2,) = _named(values, 75, [(left, right)])
                where = (a - left).astype(np.uint64) + (b.astype(np.uint64) << np.uint64(32))
                arrays = [grown[0] + b.astype(np.uint64), *grown[1:], rolling.mix(u1 ^ where), rolling.mix(u2 + where)]
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(x.view(np.int64)) for x in arrays), pa.array(ids[lo:hi][text], pa.int64()), pa.array(tags[lo:hi][text] + (left - begin), pa.int64()),
                     pa.array((right - left).astype(np.int32)), pa.array((a - left).astype(np.int32)), pa.array(b.astype(np.int32))], names=names)

    return docs.select("id", "tag", "text").mapInArrow(
        emit, "rank long, n1 long, n2 long, n3 long, u1 long, u2 long, id long, place long, size int, inside int, block int")


def _not_unique(rows: DataFrame, key: str = "rank") -> DataFrame:
    """The rows whose key occurs twice or more.

    Keys are counted before their shuffle; the repeated ones are written, so that the rows meet them by a
    broadcast or, if there are too many, by a join whose frequent keys can be split.
    """
    often = rows.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1").select(F.col(key).alias("__often"))
    return attach_small(rows, often, F.col(key) == F.col("__often"), "left_semi", "often")


def _doubled(rows: DataFrame) -> DataFrame:
    """Prefix doubling: rank by the pair (rank, name at the next offset), keeping positions that are not unique."""
    rows = materialize(_not_unique(rows), "ranks")
    for name in ("n1", "n2", "n3"):
        paired = rows.withColumn("rank", F.xxhash64("rank", name)).drop(name)
        rows = materialize(_not_unique(paired), "ranks")
    return rows


def _parts(docs: DataFrame, requests: DataFrame, length: int, block: int, part: int) -> DataFrame:
    """(k1, k2, left, right, id, place): the asked blocks, cut into parts of `part` neighbouring windows.

    k1, k2: names of the bytes that all windows of the part share; left, right: the text's bytes before and after
    these that belong to some of its windows; place: start of the part's last window, with the short text hash in
    the upper half.
    """
    asked = requests.select(F.col("id").alias("__id"), F.shiftright("place", 32).alias("__short"),
                            (F.col("place").bitwiseAND((1 << 32) - 1) + F.col("inside")).alias("anchor"), "block")
    asked = asked.groupBy("__id", "__short").agg(F.collect_list("anchor").alias("anchors"), F.collect_list(F.col("block").cast("long")).alias("blocks"))
    ready = attach_small(docs, asked, (F.col("id") == F.col("__id")) & (F.shiftright("tag", 32) == F.col("__short")), "inner", "asked")

    def emit(batches):
        import pyarrow as pa

        for batch in batches:
            ids, tags = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for i, (text, anchors, blocks) in enumerate(zip(*(c.to_pylist() for c in batch.columns[2:]))):
                data = text.encode("utf-8")
                values = rolling.byte_table(71)[np.frombuffer(data, np.uint8)]
                base = np.array(anchors, np.int64) - np.array(blocks, np.int64) * block
                last = np.unique((base[:, None] - np.arange(0, block, part)).ravel())
                end = last - part + 1 + length  # of the bytes that the part's windows share
                inside = (last >= 0) & (end <= len(data))
                last, end = last[inside], end[inside]
                left, right = np.maximum(last - part + 1, 0), np.minimum(end + part - 1, len(data))
                some = right - left >= length
                last, end, left, right = last[some], end[some], left[some], right[some]
                k1, k2 = (_named(values, seed, [(last, end)])[0].view(np.int64) for seed in (77, 79))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(k1), pa.array(k2), pa.array([data[x:y] for x, y in zip(left, last)], pa.binary()), pa.array([data[x:y] for x, y in zip(end, right)], pa.binary()),
                     pa.array(np.full(len(last), ids[i]), pa.int64()), pa.array(tags[i] + last)], names=["k1", "k2", "left", "right", "id", "place"])

    return ready.select("id", "tag", "text", "anchors", "blocks").mapInArrow(emit, "k1 long, k2 long, left binary, right binary, id long, place long")


def _repeated_windows(parts: DataFrame, length: int, part: int) -> DataFrame:
    """(id, place, size): the windows of `parts` that occur twice, those of a part that repeats as a whole in one range.

    Parts that share their bytes with another, different one are cut into finer ones, down to single windows. A
    part whose windows are already known to repeat is only there for others to be compared with.
    """
    found = []
    parts = parts.withColumn("known", F.lit(0))
    before, after = F.length("left"), F.length("right")
    names = F.xxhash64("k1", "left", "right").alias("u1"), F.xxhash64("k2", "right", "left").alias("u2")
    while True:
        parts = materialize(parts, "parts")
        ends = materialize(parts.groupBy("k1", "k2", "left", "right").agg(
            F.count("*").alias("n"), F.min("id").alias("id"), F.min("place").alias("place"), F.min("known").alias("known")), "ends")
        ranges = parts.filter("known = 0").select("id", (F.col("place") - before).alias("place"), (before + after + length - part + 1).alias("size"), *names)
        found.append(_repeated(ranges, ends.filter("n > 1").select(*names), "whole"))
        if part == 1:
            return reduce(DataFrame.union, found)
        fine = next(part // n for n in (4, 2, part) if part % n == 0)
        cut = _not_unique(ends, "k1").withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(part - 1), F.lit(fine))))
        shared = F.col("j"), part - fine - F.col("j")  # bytes on either side that all windows of the finer part have
        cut = cut.filter((before >= shared[0]) & (after >= shared[1]))
        beside = F.substring("left", before - shared[0] + 1, shared[0]), F.substring("right", F.lit(1), shared[1])
        some = [F.least(F.lit(fine - 1), n - m) for n, m in zip((before, after), shared)]
        parts = cut.filter(some[0] + some[1] >= fine - 1).select(
            F.xxhash64("k1", "j", *beside).alias("k1"), F.xxhash64("k2", "j", *beside).alias("k2"),
            F.substring("left", before - shared[0] - some[0] + 1, some[0]).alias("left"), F.substring("right", shared[1] + 1, some[1]).alias("right"),
            "id", (F.col("place") - F.col("j")).alias("place"), F.greatest("known", (F.col("n") > 1).cast("int")).alias("known"))
        part = fine


def _repeated(ranges: DataFrame, names: DataFrame, name: str) -> DataFrame:
    """(id, place, size) of the ranges whose name of 128 bits (u1, u2) is among `names`."""
    names = names.select(F.col("u1").alias("__u1"), F.col("u2").alias("__u2"))
    return attach_small(ranges, names, (F.col("u1") == F.col("__u1")) & (F.col("u2") == F.col("__u2")), "left_semi", name).select("id", "place", "size")


def _merged(ranges: DataFrame) -> DataFrame:
    """(id, short, begins, ends): the maximal runs of each text's ranges (id, place, size)."""

    def merge(batches):
        import pyarrow as pa

        key, runs = None, []
        out = []

        def batch_of(rows):
            return pa.RecordBatch.from_arrays([
                pa.array([k[0] for k, _ in rows], pa.int64()), pa.array([k[1] for k, _ in rows], pa.int64()),
                pa.array([[r[0] for r in x] for _, x in rows], pa.list_(pa.int64())), pa.array([[r[1] for r in x] for _, x in rows], pa.list_(pa.int64()))],
                names=["id", "short", "begins", "ends"])

        for batch in batches:
            for doc, place, size in zip(*(c.to_pylist() for c in batch.columns)):
                now, begin = (doc, place >> 32), place & ((1 << 32) - 1)
                if now != key:
                    if key is not None:
                        out.append((key, runs))
                    key, runs = now, []
                if runs and begin <= runs[-1][1]:
                    runs[-1][1] = max(runs[-1][1], begin + size)
                else:
                    runs.append([begin, begin + size])
            if len(out) > 1000:
                yield batch_of(out)
                out = []
        if key is not None:
            out.append((key, runs))
        yield batch_of(out)

    dealt = ranges.withColumn("short", F.shiftright("place", 32)).repartition("id", "short").sortWithinPartitions("id", "place")
    return dealt.select("id", "place", "size").mapInArrow(merge, "id long, short long, begins array<long>, ends array<long>")


def repeated_runs(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, block: int = BLOCK, bits: int | None = None) -> DataFrame:
    """(id, short, begins, ends): byte ranges of each text that are covered by repeated strings of `length` bytes.

    `docs` holds id (long), tag (short text hash in the upper half) and text.
    """
    if length - block + 1 < 4 * gram or block > gram:
        raise ValueError("the windows of a block have to share four grams or more")
    if bits is None:
        bits = cells_for(docs, 40)

    def anchors_of(texts):
        return _runs(texts, length, gram)[3]

    bitmaps = repeated_cells(docs, bits, anchors_of, SLICE)
    rows = _doubled(_blocks(docs, bitmaps, bits, length, gram, block))
    unions = rows.groupBy("u1", "u2").agg(F.count("*").alias("n"), F.min("rank").alias("rank"), F.min(F.struct("id", "place", "inside", "block")).alias("one"))
    unions = materialize(unions, "unions")
    sure = _repeated(rows.select("id", "place", "size", "u1", "u2"), unions.filter("n > 1"), "sure")  # a union holds the bytes of its rank
    requests = _not_unique(unions).select("one.*")
    part = max(1, block // PARTS)
    return _merged(sure.union(_repeated_windows(_parts(docs, requests, length, block, part), length, part)))


def dedup_bytes(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", gram: int = GRAM,
                block: int = BLOCK, bits: int | None = None) -> DataFrame:
    """`id_col`, n_bytes, n_removed, n_spans, kept_sha256 and kept (binary) for every row of `docs`.

    A byte goes if it lies in a string of `length` bytes that also starts anywhere else, in the same text or
    another row; matches end at text ends. A null text is empty; a repeated row repeats its whole text. Rows
    that share a text are found by digest, and one of them stands for all. `kept` may be cut inside a
    character.
    """
    bounded_batches(docs)
    kind = docs.schema[id_col].dataType.simpleString()
    order = F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63)))
    base = docs.select(F.col(id_col).alias("doc"), order.alias("id"), text_or_empty(text_col).alias("text"))
    tag = F.shiftleft(F.pmod(F.xxhash64("text"), F.lit(1 << 31)), 32)
    keyed = with_copies(base, "id", "text").withColumn("tag", tag)
    singles = keyed.filter("__first is null or id = __first").select("id", "tag", "text")
    runs = repeated_runs(singles, length, gram, block, bits).withColumnsRenamed({"id": "__id", "short": "__short"})
    ready = attach_small(keyed, runs, (F.col("id") == F.col("__id")) & (F.shiftright("tag", 32) == F.col("__short")), name="runs")

    def cut(batches):
        import pyarrow as pa

        for batch in batches:
            rows = []
            for text, copy, begins, ends in zip(*(c.to_pylist() for c in batch.columns[1:])):
                data = text.encode("utf-8")
                n = len(data)
                if copy and n >= length:
                    begins, ends = [0], [n]
                parts, at = [], 0
                for b, e in zip(begins or [], ends or []):
                    parts.append(data[at:b])
                    at = e
                kept = b"".join([*parts, data[at:]])
                rows.append((n, n - len(kept), len(begins or []), hashlib.sha256(kept).hexdigest(), kept))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds))],
                                             names=["doc", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    out = ready.select("doc", "text", F.col("__rows").isNotNull().alias("copy"), "begins", "ends").mapInArrow(
        cut, f"doc {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    return out.withColumnRenamed("doc", id_col)


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return dedup_bytes(docs).drop("kept")
