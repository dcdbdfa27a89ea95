import random
import re
from collections import Counter

import pytest

from tabwright.llm import common, phrases

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counted(rows):
    f = Counter()
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            for k in (1, 2, 3, 4):
                f.update(("und" if lang is None else lang, tuple(w[i : i + k])) for i in range(len(w) - k + 1))
    return f


def brute(rows, least, top):
    f = counted(rows)
    cand = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= least}
    out = {}
    for (lang, p), a in cand.items():
        longer = [b for (g, q), b in cand.items() if g == lang and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
        if any(100 * b >= 80 * a for b in longer):
            continue
        score, k = min((2_000_000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k) for k in range(1, len(p)))
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    n = Counter()
    for (lang, p), a in f.items():
        n[lang] += a if len(p) == 1 else 0
    return [(lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for lang, all_ in out.items() for i, (s, a, p, l, r) in enumerate(sorted(all_)[:top])]


def result(df):
    return sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in df.collect())


def made_up(text_rows):
    rng = random.Random(3)
    words = ["a", "B", "the", "é", "É", "of", "x'y", "漢字", "b\x1cc", "Zed"]
    line = "this license line stands in very many of the texts and never changes"
    rows = [(rng.choice(["en", "de", None, "und", ""]), "".join(rng.choice(words) + rng.choice([" ", "  ", "\t", ". ", "\n", " ", " "]) for _ in range(rng.randrange(60)))) for _ in range(250)]
    rows += [("en", f"w{i} {line}. tail {i}") for i in range(40)] + [("en", line)] * 5
    return rows + [("en", t) for t in text_rows] + [(None, None), ("fr", "...!?"), ("fr", "one two")]


@pytest.mark.parametrize("least, top, limit", [(4, 2000, common.BROADCAST_BYTES), (2, 15, -1)])
def test_equals_brute_force(spark, text_rows, monkeypatch, least, top, limit):
    monkeypatch.setattr(common, "BROADCAST_BYTES", limit)
    rows = made_up(text_rows)
    df = spark.createDataFrame(rows, "lang string, text string").repartition(6)
    assert result(phrases.collocations(df, least, top, bucket_bytes=20_000)) == sorted(brute(rows, least, top))


def test_counts_from_flow_and_ends(spark, text_rows):
    rows = made_up(text_rows)
    df = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    f = counted(rows)
    for size in (5_000, 1 << 30):
        got = phrases.phrase_counts(df, 1, bucket_bytes=size).collect()
        assert {(r["lang"], tuple(r["phrase"].split(" "))): r["f"] for r in got if r["words"]} == dict(f)
        assert {r["lang"]: r["f"] for r in got if not r["words"]} == {g: sum(a for (h, p), a in f.items() if h == g and len(p) == 1) for g in {h for h, _ in f}}
    few = {(r["lang"], r["phrase"]): r["f"] for r in phrases.phrase_counts(df, 7).collect() if r["words"]}
    assert few == {(g, " ".join(p)): a for (g, p), a in f.items() if a >= 7}


def test_flush_sizes_do_not_change_counts(spark, text_rows, monkeypatch):
    df = spark.createDataFrame(made_up(text_rows), "lang string, text string").repartition(2)
    whole = sorted(phrases.phrase_counts(df, 3).collect(), key=str)
    monkeypatch.setattr(phrases, "FLUSH_BYTES", 100)
    monkeypatch.setattr(phrases, "SLICE", 50)
    assert sorted(phrases.phrase_counts(df, 3).collect(), key=str) == whole


def test_unary_paths(spark):
    line = "one two three four five six seven eight nine ten"
    rows = [("en", line)] * 3 + [("en", "x one two three four. y one two three four")] + [("en", "six seven eight nine ten z")]
    counts = phrases.phrase_counts(spark.createDataFrame(rows, "lang string, text string"), 2)
    paths = {(r["phrase"], r["f"], r["edges"]) for r in phrases.unary_paths(counts).collect()}
    # the edge at the head occurs more often, and another text joins at "six seven eight"
    assert paths == {("one two three four", 5, 1), ("two three four five six seven eight", 3, 4), ("six seven eight nine ten", 4, 2)}


def test_empty_and_extra_columns(spark):
    df = spark.createDataFrame([], "lang string, text string")
    assert phrases.collocations(df).count() == 0
    df = spark.createDataFrame([("a b",)] * 3, "text string").selectExpr("text", "cast(null as string) lang", "1 as f", "2 as phrase", "3 as rank")
    assert result(phrases.collocations(df, 2)) == [("und", 1, "a b", 3, 3, 3, 6, 1_000_000)]


def test_products_beyond_64_bits(spark):
    big = 6 * 10**12
    row = spark.sql(f"select cast({big}L as decimal(20,0)) * {phrases.SCALE} div (cast({big}L as decimal(20,0)) + {big}L) as s").first()
    assert row["s"] == phrases.SCALE * big // (2 * big)
