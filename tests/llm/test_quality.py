import math
import random
import re
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from tabwright.llm import quality

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def _hash(*parts):
    seed = 42
    for p in parts:
        seed = xxhash.xxh64_intdigest(p.encode(), seed=seed)
    return (seed - (1 << 64) if seed >> 63 else seed) % quality.BUCKETS


def _grams(words):
    return [_hash(w) for w in words] + [_hash(*words[i : i + 2]) for i in range(len(words))]


def _base(text):
    text = text or ""
    words = WORDS.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORDS.search(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    count = Counter(windows)
    covered = {j for i, w in enumerate(windows) if count[w] > 1 for j in range(i, i + 3)}
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return words, (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), failed)


def _compare(spark, texts, trusted):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, kept string")
    ids = spark.createDataFrame([(i,) for i in trusted], "doc_id long")
    ratios = quality.log_ratios(quality.gram_counts(df, ids))
    raw, target = Counter(), Counter()
    for i, t in enumerate(texts):
        grams = _grams(_base(t)[0])
        raw.update(grams)
        if i in trusted:
            target.update(grams)
    n = quality.BUCKETS
    want = [math.log((target[b] + 1) / (sum(target.values()) + n)) - math.log((raw[b] + 1) / (sum(raw.values()) + n)) for b in range(n)]
    assert ratios == pytest.approx(want)
    got = {r["doc_id"]: r for r in quality.measure(df, ratios).collect()}
    for i, t in enumerate(texts):
        words, base = _base(t)
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == base, repr(t)[:200]
        llr = sum(want[b] for b in _grams(words)) / (2 * len(words)) if words else 0.0
        assert r["llr"] == pytest.approx(llr, abs=1e-8)
        assert r["kept"] == (not base[-1] and r["llr"] >= quality.THRESHOLD)


def test_equals_brute_force(spark, sf, text_rows):
    rng = random.Random(4)
    odd = ["a\n\nb\na\n a\nb\r\n", "\n\n", "x y z x y z", "x x x x", "#*$ %&|<> é", "\x85a\xa0b c\x1cd"]
    odd += [" ".join(rng.choice("abc") for _ in range(rng.randrange(1, 120))) for _ in range(120)]
    docs = [r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").limit(150).collect()]
    texts = [*text_rows, *odd, *docs]
    _compare(spark, texts, set(range(0, len(texts), 3)))


def test_junk_falls_below_clean_text(spark):
    sf = "/root/testdata/sf0.01"
    rows = quality.query(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("not base_failed").collect()
    clean = [r["kept"] for r in rows if r["quality"] == 1]
    junk = [r["kept"] for r in rows if r["quality"] == 0]
    assert all(clean) and sum(junk) < 0.2 * len(junk)


def test_empty_tables(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    ids = spark.createDataFrame([(None,), (7,)], "doc_id long")
    assert quality.measure(df, quality.log_ratios(quality.gram_counts(df, ids))).count() == 0
    one = spark.createDataFrame([(None, None), (None, "a b")], "doc_id long, text string")
    got = quality.measure(one, quality.log_ratios(quality.gram_counts(one, ids))).orderBy(F.col("n_words")).collect()
    assert [(r["n_words"], r["kept"]) for r in got] == [(0, False), (2, False)]


def test_buckets_grow_and_shares_hold_on_a_larger_corpus(spark):
    sf = "/root/testdata/sf0.1"
    assert quality.buckets_for(spark.read.parquet(f"{sf}/documents.parquet")) > 4 * quality.BUCKETS
    rows = quality.query(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("not base_failed").collect()
    clean = [r["kept"] for r in rows if r["quality"] == 1]
    junk = [r["kept"] for r in rows if r["quality"] == 0]
    assert sum(clean) > 0.995 * len(clean) and sum(junk) < 0.02 * len(junk)


def test_joined_ratios_equal_the_list(spark, monkeypatch, text_rows):
    rng = random.Random(5)
    texts = [*text_rows, *(" ".join(rng.choice("abcdefgh") * rng.randrange(1, 9) for _ in range(rng.randrange(1, 150))) for _ in range(60))]
    df = spark.createDataFrame([(i % 50, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, n int")
    ids = spark.range(0, 40, 3).toDF("doc_id")
    counts = quality.gram_counts(df, ids)
    want = quality.measure(df, quality.log_ratios(counts))
    for limit in (quality.RATIO_BYTES, 32 * 20):
        monkeypatch.setattr(quality, "RATIO_BYTES", limit)
        got = quality.measure(df, quality.ratio_table(counts, quality.BUCKETS), buckets=quality.BUCKETS)
        assert got.columns == want.columns
        key = lambda r: (r["doc_id"], r["text"] or "", r["llr"])
        for x, y in zip(sorted(got.collect(), key=key), sorted(want.collect(), key=key), strict=True):
            assert x["llr"] == pytest.approx(y["llr"], abs=1e-8)
            assert {**x.asDict(), "llr": 0} == {**y.asDict(), "llr": 0}


def test_counts_are_sent_by_few_tasks(spark):
    """What is shuffled for the counts is tasks times buckets, so many splits are counted by one task a core."""
    df = spark.range(200).selectExpr("id as doc_id", "concat('a b ', id, ' a') as text").repartition(64)
    counts = quality.gram_counts(df, df.filter("doc_id < 20"))
    tasks = re.findall(r"Repartition (\d+), false", counts._jdf.queryExecution().analyzed().toString())
    assert tasks and int(tasks[0]) <= spark.sparkContext.defaultParallelism
    assert counts.agg(F.sum("raw"), F.sum("target")).first()[:] == (1600, 160)


def test_words_and_symbols_of_odd_spaces(spark):
    texts = ["", " ", "a\t\n b\x0b\x0cc\r", "\u00a0#\u2028 *$%&|<>^ \x00 x\x1c", "\n\n#", "\U0001f600 #\U0001f600"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = quality.measure(df, [0.0] * quality.BUCKETS).orderBy("doc_id").collect()
    for t, r in zip(texts, got):
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        assert (r["n_words"], r["word_chars"], r["n_symbols"]) == (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t))


def test_a_pass_over_the_grams_splits_a_text_once(spark):
    df = spark.createDataFrame([(0, "a b a"), (1, ""), (2, None), (3, "c")], "doc_id long, text string")
    counts = quality.gram_counts(df, df.filter("doc_id = 0"))
    table = quality.ratio_table(counts, quality.BUCKETS)
    sums = quality.text_ratios(df, table, quality.BUCKETS)
    for frame in (counts, sums):
        assert frame._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1
    assert counts.agg(F.sum("raw"), F.sum("target")).first()[:] == (8, 6)
    assert sorted(r["__n"] for r in sums.collect()) == [2, 6]


def test_repeated_windows_that_touch_and_overlap(spark):
    texts = ["a b c a b c", "x x x x x", "a b c d a b c e a b c", "p q r s p q r s t p q r s", "a b c x b c a y c a b", "a b", "a b c"]
    texts += [f"{'k l m n ' * 40}o {'k l m ' * 3}"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = quality.measure(df, [0.0] * quality.BUCKETS).orderBy("doc_id").collect()
    assert [r["n_repeat_words"] for r in got] == [_base(t)[1][4] for t in texts]
