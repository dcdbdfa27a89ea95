import random
import re

import numpy as np

from tabwright.llm import jaccard
from tabwright.llm.components import components


def _set(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return set()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or {tuple(w)}


def brute(rows):
    sets = [(k, _set(t)) for k, t in rows]
    root = {k: k for k, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            n = len(x & y)
            if n and 100 * n >= 80 * len(x | y):
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return sorted((k, len(s), find(k)) for k, s in sets)


def _check(spark, rows, **options):
    df = spark.createDataFrame([(k, t, "x") for k, t in rows], "doc_id long, text string, id string").repartition(5)
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.linked(df, **options).collect())
    assert got == brute(rows)


def _near_copies(rng, groups, size, words, vocabulary="abcdefghij"):
    out = []
    for _ in range(groups):
        base = ["".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 3))) for _ in range(words)]
        for _ in range(size):
            t = list(base)
            for _ in range(rng.randrange(0, 1 + max(1, words // 20))):
                t[rng.randrange(len(t))] = rng.choice(["zz", "yy", "Xx", "q"])
            out.append(" ".join(t).upper() if rng.random() < 0.1 else "  ".join(t))
    return out


def test_equals_brute_force_on_near_copies(spark, text_rows):
    rng = random.Random(6)
    texts = [*text_rows, *_near_copies(rng, 6, 25, 60), *_near_copies(rng, 20, 6, 12), *_near_copies(rng, 30, 3, 4, "ab"), "É a b c d e", "é a b c d e"]
    rng.shuffle(texts)
    _check(spark, list(enumerate(texts)))


def test_repeated_rows_null_ids_and_empty(spark):
    t = " ".join(f"w{i}" for i in range(40))
    df = spark.createDataFrame([(None, t), (3, t), (3, t), (3, "other"), (9, "other"), (None, "lonely")], "doc_id long, text string")
    got = sorted((str(r["doc_id"]), r["n_shingles"], r["component_id"]) for r in jaccard.linked(df).collect())
    assert got == [("3", 1, 3), ("3", 36, 3), ("3", 36, 3), ("9", 1, 3), ("None", 1, 3), ("None", 36, 3)]
    assert jaccard.linked(df.limit(0)).count() == 0
    assert sorted(r["text"] for r in jaccard.one_per_group(df.filter("doc_id is not null")).collect()) == sorted([t, t, "other"])


def test_similar_is_exact():
    rng = np.random.default_rng(3)
    for _ in range(400):
        n = int(rng.integers(1, 300))
        x = np.unique(rng.integers(0, 400, n).astype(np.uint64))
        y = np.unique(np.r_[rng.choice(x, max(1, int(len(x) * rng.uniform(0.6, 1)))), rng.integers(0, 400, int(rng.integers(0, 30))).astype(np.uint64)])
        both = len(np.intersect1d(x, y))
        assert jaccard.similar(x, y, 80) == (100 * both >= 80 * (len(x) + len(y) - both))


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 90), (95, 100), (7, 7)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {90: 90, 95: 90, 100: 90}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_repeated_rows_and_two_texts_of_an_id_keep_all_links(spark, monkeypatch):
    rng = random.Random(8)
    texts = _near_copies(rng, 25, 4, 40)
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    short = [(300 + i // 2, t) for i, t in enumerate(_near_copies(rng, 15, 2, 60) + _near_copies(rng, 15, 2, 12))]
    rng.shuffle(short)
    of_two = [(500 + i // 2, t) for i, (_, t) in enumerate(short)]
    for rounds in (0, jaccard.HUB_ROUNDS):
        monkeypatch.setattr(jaccard, "HUB_ROUNDS", rounds)
        _check(spark, rows * 2)
        _check(spark, of_two)


def test_crowded_tokens_take_the_way_of_combined_counts(spark):
    rng = random.Random(11)
    texts = [*_near_copies(rng, 3, 40, 30), *_near_copies(rng, 30, 2, 20), *["one two three four five six"] * 30]
    rng.shuffle(texts)
    for hot in (1, 8):  # every token that several texts share, and the tokens of the large groups
        _check(spark, list(enumerate(texts)), hot=hot)


def test_a_counter_bounds_the_postings_of_its_tokens():
    for n in (1, 2, 3, 100, 200_000, 200_001, 10**9):
        level = int(min(np.ceil(jaccard.STEPS * np.log2(n)), 255))
        assert 2 ** (level / jaccard.STEPS) >= n * (1 - 1e-12)
        assert n <= 200_000 or level > jaccard._most(200_000)
