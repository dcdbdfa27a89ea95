import hashlib
import random
from collections import Counter

from tabwright.llm import suffixes


def brute(rows, length):
    data = [(k, (t or "").encode()) for k, t in rows]
    count = Counter(d[i : i + length] for _, d in data for i in range(len(d) - length + 1))
    out = []
    for k, d in data:
        gone = bytearray(len(d))
        end = 0
        for i in range(len(d) - length + 1):
            if count[d[i : i + length]] > 1:
                begin = max(i, end)
                gone[begin : i + length] = b"\x01" * (i + length - begin)
                end = i + length
        kept = bytes(b for b, g in zip(d, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((str(k), len(d), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def _check(spark, rows, length=suffixes.LENGTH, **options):
    df = spark.createDataFrame([(k, t, "x") for k, t in rows], "doc_id long, text string, id string").repartition(6)
    got = sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffixes.dedup_bytes(df, length, **options).collect())
    want = brute(rows, length)
    assert [g for g, w in zip(got, want) if g != w] == [] and len(got) == len(want)


def test_equals_brute_force(spark, sf, text_rows):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    odd = [t if t is None else t[:3000] for t in text_rows]
    _check(spark, [*rows, *((10_000 + i, t) for i, t in enumerate(odd))])


def test_short_lengths_on_random_copies(spark):
    rng = random.Random(12)
    pool = ["".join(rng.choice("abcé ") for _ in range(rng.randrange(20, 200))) for _ in range(12)]
    texts = []
    for _ in range(160):
        parts = [rng.choice(pool)[rng.randrange(10) :] if rng.random() < 0.7 else "".join(rng.choice("xyz") for _ in range(rng.randrange(30))) for _ in range(rng.randrange(4))]
        texts.append("".join(parts))
    texts += ["a" * 300, "ab" * 200, None, ""]
    rows = [(None if i == 5 else i // 2 if i < 20 else i, t) for i, t in enumerate(texts)]
    _check(spark, rows, 40, gram=6, block=6)
    _check(spark, rows, 40, gram=9, block=4, bits=3)


def test_empty_table(spark):
    assert suffixes.dedup_bytes(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_edges_of_matches_at_every_offset(spark):
    rng = random.Random(5)
    word = lambda n: "".join(rng.choice("abcd") for _ in range(n))
    core = word(120)
    rows = [(i, word(rng.randrange(40)) + core[rng.randrange(30) : 120 - rng.randrange(30)] + word(rng.randrange(40))) for i in range(120)]
    _check(spark, rows, 64, gram=9, block=8)
    _check(spark, [*rows, *((i + 200, core[i:]) for i in range(50))], 64, gram=8, block=6)


def test_windows_that_straddle_are_few(spark, monkeypatch):
    """A block that repeats in part is cut where it has to be, not written window by window."""
    rng = random.Random(8)
    word = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    passages = [word(700) for _ in range(40)]
    rows = [(i, word(300) + passages[i % 40] + word(300)) for i in range(120)]
    written = []
    keep = suffixes.materialize
    monkeypatch.setattr(suffixes, "materialize", lambda df, name: (lambda out: written.append((name, out.count())) or out)(keep(df, name)))
    _check(spark, rows)
    blocks = sum(n for name, n in written if name == "unions")
    assert sum(n for name, n in written if name in ("windows", "parts", "ends")) < 24 * blocks
