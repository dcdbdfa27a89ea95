"""Phrase collocations from a weighted de Bruijn graph: counted 4-word edges, unary paths, shorter counts from node flow.

An edge is a sequence of four words, from the node of its first three to the node of its last three. What a
node's edges do not show are the pieces that end there; those ends are counted apart. So f(node) is the sum
of its edges and ends, f(two words) the sum over the nodes that begin with them plus the pieces that end with
them, and f(word) follows in the same way. Only edges and ends are taken from the texts.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tabwright.llm import rolling
from tabwright.llm.common import attach_small, bounded_batches, by_value, slices, text_or_empty
from tabwright.session import materialize

by_value(__name__)

MIN_COUNT = 30
TOP = 2000
SCALE = 2_000_000
DROP_PERCENT = 80
BUCKET_BYTES = 4 << 20  # bytes of texts per bucket of nodes: a bucket is aggregated as a whole
FLUSH_BYTES = 24 << 20  # of edges that a task gathers before it sends them
SLICE = 2_000_000
PACKS = "level int, lang string, bucket int, phrase string, f long, packed binary, counts binary"

#: 0 belongs to a word, 1 parts words, 2 parts pieces.
KIND = np.zeros(256, dtype=np.uint8)
KIND[[0x20, 0x09]] = 1
KIND[[ord(c) for c in ".,;:!?"] + [0x0A, 0x0B, 0x0C, 0x0D]] = 2


def _gather(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lines: the bytes from each start up to its stop, then a line feed; and where each line ends."""
    sizes = stops - starts + 1
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    at = np.repeat(starts - (ends - sizes), sizes)
    at += np.arange(total)
    lines = data.take(at, mode="clip") if total else np.empty(0, np.uint8)
    lines[ends - 1] = 10
    return lines, ends


def _heads(lines: np.ndarray, ends: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """`_gather` of the part of each line up to its stop, in order: one mask instead of a place for each byte."""
    step = np.zeros(len(lines) + 1, dtype=np.int8)
    starts = np.r_[0, ends[:-1]] if len(ends) else ends
    step[starts] = 1
    step[stops + 1] -= 1
    kept = lines[np.cumsum(step[:-1], dtype=np.int8).view(bool)]
    until = np.cumsum(stops - starts + 1)
    kept[until - 1] = 10
    return kept, until


def _ordered(lines: np.ndarray, ends: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lines in another order."""
    data, offsets = _bytes_of(_binary(lines, ends).take(order))
    return data, offsets[1:]


def _binary(data: np.ndarray, ends: np.ndarray):
    """An Arrow column of byte strings that end at `ends`."""
    import pyarrow as pa

    offsets = np.zeros(len(ends) + 1, dtype=np.int64)
    offsets[1:] = ends
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _bytes_of(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an Arrow column of byte strings, and its offsets."""
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def _spread(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A number for every range of bytes that spreads ranges over buckets: of its length, its first, last and middle bytes."""
    size = ends - starts
    total = size.astype(np.uint64)
    for begin in (starts, np.maximum(starts, ends - 8), np.maximum(starts, starts + size // 2 - 4)):
        at = begin[:, None] + np.arange(8)
        eight = np.where(at < ends[:, None], data.take(at, mode="clip"), 0) if len(data) else at
        total = rolling.mix(total + np.ascontiguousarray(eight, dtype=np.uint8).view("<u8").ravel())
    return total


def _line_buckets(lines: np.ndarray, ends: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of every line, by its bytes."""
    starts = np.r_[0, ends[:-1]] if len(ends) else ends
    return (_spread(lines, starts, ends - 1) % np.uint64(buckets)).astype(np.int32)


def _counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    _, first, n = np.unique(keys, return_index=True, return_counts=True)
    return first, n


def edges_of(texts: list[bytes], buckets: int):
    """(level, lines, line ends, counts, buckets) of the texts' edges and piece ends, level 3, and ends of levels 2 and 1.

    An edge is a line of four words, a piece end a line of three words and a space. Equal edges are found
    by numbers of words and of pairs, without any hash.
    """
    data = rolling.LOWER[rolling.joined(texts)[0]]
    kind = KIND[data]
    inside = kind == 0
    border = np.flatnonzero(np.diff(np.r_[False, inside, False].view(np.int8)))
    starts, ends = border[::2], border[1::2]
    if not len(starts):
        return
    piece = np.cumsum(kind == 2, dtype=np.int32)[starts]
    # numbers of words: equal for equal words only
    words = _binary(data[inside], np.cumsum(ends - starts)).dictionary_encode()
    number = words.indices.to_numpy().astype(np.int64)
    known, offsets = _bytes_of(words.dictionary)
    hashes = _spread(known, offsets[:-1], offsets[1:])[number]
    # words with one space after each: every phrase is a range of these bytes
    inside[ends] = True
    clean = np.where(kind > 0, np.uint8(32), data)[inside]
    stops = np.cumsum(ends - starts + 1) - 1
    begins = stops - (ends - starts)
    n, size = len(number), int(number.max()) + 1
    last = np.flatnonzero(np.r_[piece[1:] != piece[:-1], True])

    pairs = np.unique(number[:-1] * size + number[1:], return_inverse=True)[1] if n > 1 else np.empty(0, np.int64)
    many = int(pairs.max()) + 1 if len(pairs) else 0
    at = np.flatnonzero(piece[3:] == piece[:-3]) if n > 3 else np.empty(0, np.int64)
    first, count = _counted(pairs[at] * many + pairs[at + 2])
    edge = at[first]
    ending = last[last >= 2]
    ending = ending[piece[ending - 2] == piece[ending]] - 2
    first, ended = _counted(pairs[ending] * size + number[ending + 2])
    ending = ending[first]
    node = np.r_[edge, ending]
    # an end stops behind the space after its third word
    until = np.r_[stops[edge + 3], stops[ending + 2] + 1]
    mixed = rolling.mix(hashes[node] + rolling.mix(hashes[node + 1] + rolling.mix(hashes[node + 2])))
    yield 3, *_gather(clean, begins[node], until), np.r_[count, ended], (mixed % np.uint64(buckets)).astype(np.int32)

    ending = last[last >= 1]
    ending = ending[piece[ending - 1] == piece[ending]] - 1
    first, ended = _counted(pairs[ending])
    lines, line_ends = _gather(clean, begins[ending[first]], stops[ending[first] + 1])
    yield 2, lines, line_ends, ended, _line_buckets(lines, line_ends, buckets)
    first, ended = _counted(number[last])
    lines, line_ends = _gather(clean, begins[last[first]], stops[last[first]])
    yield 1, lines, line_ends, ended, _line_buckets(lines, line_ends, buckets)


def _packs(level: int, lang: str, parts: list):
    """Rows of PACKS: the parts' lines and counts by bucket, compressed."""
    import zstandard

    lines = np.concatenate([p[0] for p in parts])
    shifts = np.cumsum([0, *[len(p[0]) for p in parts[:-1]]])
    ends = np.concatenate([p[1] + s for p, s in zip(parts, shifts)])
    counts, bucket = np.concatenate([p[2] for p in parts]).astype(np.int64), np.concatenate([p[3] for p in parts])
    order = np.argsort(bucket, kind="stable")
    lines, ends = _ordered(lines, ends, order)
    counts, bucket = counts[order], bucket[order]
    pack = zstandard.ZstdCompressor(level=3)
    numbers, heads = np.unique(bucket, return_index=True)
    for b, lo, hi in zip(numbers, heads, [*heads[1:], len(bucket)]):
        yield level, lang, int(b), None, None, pack.compress(lines[ends[lo - 1] if lo else 0 : ends[hi - 1]].tobytes()), pack.compress(counts[lo:hi].tobytes())


def _batch(rows: list):
    import pyarrow as pa

    kinds = [pa.int32(), pa.string(), pa.int32(), pa.string(), pa.int64(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*rows)) or [()] * 7, kinds)],
                                      names=["level", "lang", "bucket", "phrase", "f", "packed", "counts"])


def _phrases(level: int, lang: str, bucket: int, lines: np.ndarray, ends: np.ndarray, counts: np.ndarray):
    """A batch with a row for each line."""
    import pyarrow as pa

    n = len(counts)
    starts = np.r_[0, ends[:-1]] if n else ends
    text = [lines[a : b - 1].tobytes().decode("utf-8") for a, b in zip(starts, ends)]
    return pa.RecordBatch.from_arrays(
        [pa.array([level] * n, pa.int32()), pa.array([lang] * n, pa.string()), pa.array([bucket] * n, pa.int32()), pa.array(text, pa.string()),
         pa.array(counts, pa.int64()), pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary())],
        names=["level", "lang", "bucket", "phrase", "f", "packed", "counts"])


def _summed(lines: np.ndarray, ends: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct lines with the sums of their counts."""
    coded = _binary(lines, ends).dictionary_encode()
    sums = np.zeros(len(coded.dictionary), dtype=np.int64)
    np.add.at(sums, coded.indices.to_numpy(), counts)
    data, offsets = _bytes_of(coded.dictionary)
    return data, offsets[1:], sums


def _reduced(lines: np.ndarray, ends: np.ndarray, counts: np.ndarray, level: int, lang: str, bucket: int, buckets: int, least: int):
    """What one bucket's lines of a level give: batches of frequent phrases, then packs of partial sums one level below."""
    lines, ends, counts = _summed(lines, ends, counts)

    def frequent(k, lines, ends, counts, chosen):
        chosen = np.flatnonzero(chosen)
        starts = np.where(chosen > 0, ends[chosen - 1], 0)
        return _phrases(k, lang, bucket, *_gather(lines, starts, ends[chosen] - 1), counts[chosen])

    if level == 3:
        space = np.flatnonzero(lines == 32).reshape(-1, 3)[:, 2]
        yield frequent(4, lines, ends, counts, (counts >= least) & (space + 2 < ends))
        lines, ends, counts = _summed(*_heads(lines, ends, space), counts)
    yield frequent(level, lines, ends, counts, counts >= least)
    if level == 1:
        import pyarrow as pa

        yield pa.RecordBatch.from_arrays(
            [pa.array([0], pa.int32()), pa.array([lang], pa.string()), pa.array([bucket], pa.int32()), pa.nulls(1, pa.string()),
             pa.array([int(counts.sum())], pa.int64()), pa.nulls(1, pa.binary()), pa.nulls(1, pa.binary())],
            names=["level", "lang", "bucket", "phrase", "f", "packed", "counts"])
        return
    space = np.flatnonzero(lines == 32).reshape(-1, level - 1)[:, -1]
    lines, ends, counts = _summed(*_heads(lines, ends, space), counts)
    yield from (_batch([row]) for row in _packs(level - 1, lang, [(lines, ends, counts, _line_buckets(lines, ends, buckets))]))


def _flow(packs: DataFrame, level: int, buckets: int, least: int) -> DataFrame:
    """The packs of `level` summed bucket by bucket; packs of lower levels pass."""

    def reduce(batches):
        import zstandard

        unpack = zstandard.ZstdDecompressor()
        key, lines, counts = None, [], []

        def close():
            if key is not None:
                data = np.frombuffer(b"".join(lines), np.uint8)
                ends = np.flatnonzero(data == 10) + 1
                yield from _reduced(data, ends, np.frombuffer(b"".join(counts), np.int64), *key, buckets, least)

        for batch in batches:
            passed = []
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[0] != level:
                    passed.append(row)
                    continue
                if row[:3] != key:
                    yield from close()
                    key, lines, counts = row[:3], [], []
                lines.append(unpack.decompress(row[5]))
                counts.append(unpack.decompress(row[6]))
            if passed:
                yield _batch(passed)
        yield from close()

    n = max(int(packs.sparkSession.conf.get("spark.sql.shuffle.partitions")), buckets)
    rows = packs.filter("phrase is null and level > 0").repartition(n, "bucket", "level").sortWithinPartitions("level", "lang", "bucket")
    return rows.mapInArrow(reduce, PACKS)


def phrase_counts(docs: DataFrame, least: int = MIN_COUNT, lang_col: str = "lang", text_col: str = "text", bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """(lang, words, phrase, f): every phrase of 1 to 4 words that occurs `least` times, and with words 0 the count of all words.

    Three shuffles: edges by node, pairs, words. Each task sends an edge once per flush whatever its number of
    occurrences, so a phrase that stands in a third of all texts is a few rows; all edges of a node meet in one
    bucket, whose size follows from the counted bytes of all texts.
    """
    bounded_batches(docs)
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), text_or_empty(text_col).alias("text"))
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    buckets = max(1, -(-total // bucket_bytes))

    def emit(batches):
        gathered: dict = {}
        size = 0

        def flush():
            for (level, lang), parts in gathered.items():
                rows = []
                for row in _packs(level, lang, parts):
                    rows.append(row)
                    if len(rows) == 64:
                        yield _batch(rows)
                        rows = []
                yield _batch(rows)
            gathered.clear()

        for batch in batches:
            by_lang: dict = {}
            for lang, text in zip(*(c.to_pylist() for c in batch.columns)):
                by_lang.setdefault(lang, []).append(text)
            for lang, texts in by_lang.items():
                for lo, hi in slices(texts, SLICE):
                    for level, *part in edges_of([t.encode("utf-8") for t in texts[lo:hi]], buckets):
                        gathered.setdefault((level, lang), []).append(part)
                        size += len(part[0]) + 24 * len(part[2])
                if size > FLUSH_BYTES:
                    yield from flush()
                    size = 0
        yield from flush()

    flow = materialize(_flow(rows.mapInArrow(emit, PACKS), 3, buckets, least), "flow-nodes")
    pairs = materialize(_flow(flow, 2, buckets, least), "flow-pairs")
    words = materialize(_flow(pairs, 1, buckets, least), "flow-words")
    found = [f.filter("packed is null").select("lang", F.col("level").alias("words"), "phrase", "f") for f in (flow, pairs, words)]
    sums = found[2].filter("words = 0").groupBy("lang").agg(F.sum("f").alias("f")).select("lang", F.lit(0).alias("words"), F.lit(None).cast("string").alias("phrase"), "f")
    return found[0].union(found[1]).union(found[2].filter("words > 0")).union(sums)


def unary_paths(counts: DataFrame, rounds: int = 40) -> DataFrame:
    """(lang, phrase, f, edges): the graph of frequent edges with every unary path as one row.

    A node is unary if one edge enters it and one leaves it, both as often as the node occurs: nothing starts,
    ends or branches there. Edges point to the edge before them across a unary node; the pointers are doubled until
    each points to the head of its path, which takes as many rounds as the longest path has binary digits. A
    path cannot close to a ring, since the texts that run along it begin somewhere.
    """
    edges = counts.filter("words = 4").select("lang", F.col("phrase").alias("edge"), "f")
    nodes = counts.filter("words = 3").select("lang", F.col("phrase").alias("node"), "f")
    out = edges.groupBy("lang", F.substring_index("edge", " ", 3).alias("node")).agg(F.count("*").alias("n"), F.max("f").alias("f"), F.min("edge").alias("edge"))
    into = edges.groupBy("lang", F.substring_index("edge", " ", -3).alias("node")).agg(F.count("*").alias("n"), F.max("f").alias("f"), F.min("edge").alias("head"))
    links = nodes.join(out.filter("n = 1").drop("n"), ["lang", "node", "f"]).join(into.filter("n = 1").drop("n"), ["lang", "node", "f"])
    now = materialize(links.select("lang", "edge", "head", F.lit(1).alias("steps")), "links")
    for _ in range(rounds):
        far = now.select(F.col("lang").alias("__l"), F.col("edge").alias("__e"), F.col("head").alias("__h"), F.col("steps").alias("__s"))
        joined = now.join(far, (F.col("lang") == F.col("__l")) & (F.col("head") == F.col("__e")), "left")
        now = materialize(joined.select("lang", "edge", F.coalesce("__h", "head").alias("head"), (F.col("steps") + F.coalesce("__s", F.lit(0))).alias("steps"),
                                        F.col("__h").isNotNull().alias("moved")), "links")
        if now.filter("moved").isEmpty():
            break
    else:
        raise RuntimeError("paths did not settle")
    placed = edges.join(now.drop("moved"), ["lang", "edge"], "left").withColumns({"head": F.coalesce("head", "edge"), "steps": F.coalesce("steps", F.lit(0))})
    word = F.when(F.col("steps") == 0, F.col("edge")).otherwise(F.substring_index("edge", " ", -1))
    ordered = F.array_sort(F.collect_list(F.struct("steps", word.alias("word"))))
    return placed.groupBy("lang", "head").agg(F.array_join(F.transform(ordered, lambda x: x["word"]), " ").alias("phrase"), F.max("f").alias("f"), F.count("*").alias("edges")).drop("head")


def _windows(paths: DataFrame, width: int, inner: bool) -> DataFrame:
    """The `width`-word windows of paths; inner leaves out the first and the last."""
    w, off = F.col("w"), 1 if inner else 0
    rows = paths.withColumn("w", F.split("phrase", " ")).withColumn("size", F.size("w") - width + 1 - 2 * off).filter("size > 0")
    at = rows.select("lang", "f", "w", F.explode(F.sequence(F.lit(1), F.col("size"))).alias("i"))
    return at.select("lang", F.array_join(F.slice(w, F.col("i") + off, width), " ").alias("phrase"), "f")


def collocations(docs: DataFrame, least: int = MIN_COUNT, top: int = TOP, scale: int = SCALE, drop_percent: int = DROP_PERCENT, lang_col: str = "lang",
                 text_col: str = "text", bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's best phrases of 2 to 4 words; all numbers long.

    A-Z are lower-cased; texts are split at sentence marks and line ends into pieces, pieces at spaces and tabs into
    words. A phrase is a candidate if it occurs `least` times. Its score is the smallest floor(scale * a / (l + r)) over
    its cuts in two parts that occur l and r times, ties to the first cut. A candidate goes if one with more words
    contains it and occurs at least `drop_percent` % as often. Ranks follow score, a, and the phrase's bytes. A null
    text has no words, a null language is `und`, repeated rows count each time, an empty table gives no rows.

    Inner nodes of unary paths occur exactly as often as the edges around them and go without a look-up (unless
    `drop_percent` is above 100). For the others it is enough to compare with phrases of one word more: a longer one occurs no more often.
    """
    counts = materialize(phrase_counts(docs, least, lang_col, text_col, bucket_bytes), "phrases")
    paths = materialize(unary_paths(counts), "paths")
    four = _windows(paths, 4, False).withColumn("words", F.lit(4))
    shorter = counts.filter("words in (2, 3)").select("lang", "phrase", "f", "words")
    if drop_percent <= 100:
        shorter = shorter.join(_windows(paths, 3, True).select("lang", "phrase"), ["lang", "phrase"], "left_anti")
    longer = counts.filter("words in (3, 4)").select("lang", "words", "f", F.explode(F.array(
        F.regexp_replace("phrase", " [^ ]*$", ""), F.regexp_replace("phrase", "^[^ ]* ", ""))).alias("part"))
    most = longer.groupBy("lang", "part").agg(F.max("f").alias("most"))
    kept = shorter.join(most.withColumnRenamed("part", "phrase"), ["lang", "phrase"], "left").filter(
        F.expr(f"most is null or cast(most as decimal(20,0)) * 100 < cast(f as decimal(20,0)) * {int(drop_percent)}")).drop("most")
    candidates = kept.unionByName(four)
    w = F.split("phrase", " ")
    cut = candidates.select("lang", "phrase", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"), "words")
    parts = cut.select("lang", "phrase", "a", "k", F.array_join(F.slice(w, F.lit(1), F.col("k")), " ").alias("first"),
                       F.array_join(F.slice(w, F.col("k") + 1, F.col("words") - F.col("k")), " ").alias("rest"))
    known = counts.filter("words between 1 and 3")
    for part, name in (("first", "l"), ("rest", "r")):
        side = known.select(F.col("lang").alias("__lang"), F.col("phrase").alias("__part"), F.col("f").alias(name))
        parts = attach_small(parts, side, (F.col("lang") == F.col("__lang")) & (F.col(part) == F.col("__part")), "inner", "parts").drop("__lang", "__part")
    scored = parts.withColumn("score", F.expr(f"cast(a as decimal(20,0)) * {int(scale)} div (cast(l as decimal(20,0)) + r)"))
    best = scored.groupBy("lang", "phrase").agg(F.max("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("b")).select("lang", "phrase", "a", "b.l", "b.r", "b.score")
    # a language's first `top` are among the first `top` of each of its parts, so no task sorts a whole language
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(32))
    first = best.withColumn("part", part).withColumn("place", F.row_number().over(W.partitionBy("lang", "part").orderBy(*order))).filter(F.col("place") <= top)
    ranked = first.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    totals = counts.filter("words = 0").select(F.col("lang").alias("__lang"), F.col("f").alias("n"))
    return ranked.join(totals, F.col("lang") == F.col("__lang")).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def query(spark, sf_dir: str) -> DataFrame:
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet").select("lang", "text"))


SQL = r"""
with d as (select coalesce(lang, 'und') as lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents),
p as (select lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) as s from d),
w as (select lang, regexp_extract_all(s, '[^\x20\x09]+') as w from p),
k as (select lang, w, unnest([1, 2, 3, 4]) as k from w),
i as (select lang, w, k, unnest(range(1, cast(len(w) as bigint) - k + 2)) as i from k),
g as (select lang, k, w[i:i + k - 1] as p, cast(count(*) as bigint) as f from i group by all),
t as (select lang, cast(sum(f) as bigint) as n from g where k = 1 group by lang),
c as (select * from g where k > 1 and f >= 30),
x as (select lang, p[:k - 1] as p, f from c union all select lang, p[2:], f from c union all
      select lang, p[:2], f from c where k = 4 union all select lang, p[2:3], f from c where k = 4 union all select lang, p[3:], f from c where k = 4),
m as (select lang, p, max(f) as most from x group by all),
e as (select c.* from c left join m on m.lang = c.lang and m.p = c.p where most is null or 100 * most < 80 * f),
u as (select lang, p, k, f, unnest(range(1, cast(k as bigint))) as j from e),
s as (select u.lang, u.p, u.f as a, j, l.f as l, r.f as r, (2000000 * cast(u.f as hugeint)) // (l.f + r.f) as score
      from u join g l on l.lang = u.lang and l.p = u.p[:j] join g r on r.lang = u.lang and r.p = u.p[j + 1:]),
b as (select * from s qualify row_number() over (partition by lang, p order by score, j) = 1),
o as (select lang, array_to_string(p, ' ') as phrase, a, l, r, cast(score as bigint) as score from b),
z as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from o)
select z.lang, cast(rank as bigint) as rank, phrase, a, l, r, n, score from z join t on t.lang = z.lang where rank <= 2000
"""
