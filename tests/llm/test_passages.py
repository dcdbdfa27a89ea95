import hashlib
import random
import re

import numpy as np

from tabwright.llm import passages, rolling


def brute(rows, window):
    words = {k: re.findall(r"[^\x20\x09-\x0D]+", rows[k] or "") for k in rows}
    first, out = {}, {}
    for k in sorted(words):
        gone = set()
        w = words[k]
        for i in range(len(w) - window + 1):
            key = tuple(w[i : i + window])
            if key in first:
                gone.update(range(i, i + window))
            else:
                first[key] = True
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out[k] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def _check(spark, texts, window=passages.WINDOW, bits=None):
    rows = dict(enumerate(texts))
    df = spark.createDataFrame([(k, t, "x") for k, t in rows.items()], "doc_id long, text string, id string").repartition(7)
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in passages.dedup_windows(df, window, bits=bits).collect()}
    assert got == brute(rows, window)


def test_equals_brute_force(spark, sf, text_rows):
    docs = [r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    _check(spark, [*text_rows, *docs])


def test_full_sketch_loses_nothing(spark):
    rng = random.Random(8)
    texts = []
    for _ in range(150):
        t = [rng.choice("abc") for _ in range(rng.randrange(0, 40))]
        texts.append(" ".join(t))
        if rng.random() < 0.4:
            texts.append(" ".join(rng.choice(texts).split()[: rng.randrange(1, 30)] + t))
    for window, bits in ((5, 8), (10, 16), (20, 4)):
        _check(spark, texts, window, bits)


def test_repeated_rows_and_null_ids(spark):
    t = " ".join(f"w{i}" for i in range(30))
    df = spark.createDataFrame([(None, t), (1, t), (1, t), (2, "x " + t), (2, "y " + t)], "doc_id long, text string")
    got = sorted((str(r["doc_id"]), r["n_words"], r["n_removed"]) for r in passages.dedup_windows(df).collect())
    assert got == [("1", 30, 30), ("1", 30, 30), ("2", 31, 30), ("2", 31, 30), ("None", 30, 0)]
    same = spark.createDataFrame([(1, t), (1, t)], "doc_id long, text string")
    assert [r["n_removed"] for r in passages.dedup_windows(same).collect()] == [0, 0]
    assert passages.dedup_windows(df.limit(0)).count() == 0


def test_hashes():
    rng = np.random.default_rng(0)
    data = rng.integers(0, 256, 3000).astype(np.uint8)
    data[::5] = 32
    h, s, e = rolling.words(data)
    assert [data[a:b].tobytes() for a, b in zip(s, e)] == data.tobytes().split()
    seen = {}
    for k, a, b in zip(h, s, e):
        assert seen.setdefault(data[a:b].tobytes(), k) == k
    assert len(set(h.tolist())) == len(seen)
    v = rng.integers(0, 3, 4000).astype(np.uint64)
    w = rolling.windows(v, 6, 5)
    keys = {}
    for i, k in enumerate(w):
        assert keys.setdefault(v[i : i + 6].tobytes(), k) == k
    assert len(set(keys.values())) == len(keys)
    v = v << np.uint64(40)
    for width in (1, 7, 300):
        m = rolling.first_minimum(v, width)
        assert [int(i + np.argmin(v[i : i + width])) for i in range(len(v) - width + 1)] == m.tolist()


def test_blocks_do_not_change_hashes(monkeypatch):
    rng = np.random.default_rng(1)
    data = rng.integers(97, 100, 5000).astype(np.uint8)
    data[rng.integers(0, 5000, 900)] = 10
    whole, wide = rolling.words(data)[0], rolling.windows(data.astype(np.uint64), 50, 3)
    place = rolling.first_minimum(wide, 9)
    monkeypatch.setattr(rolling, "BLOCK", 64)
    assert (rolling.words(data)[0] == whole).all() and (rolling.windows(data.astype(np.uint64), 50, 3) == wide).all()
    assert (rolling.first_minimum(wide, 9) == place).all()


def test_large_side_tables_are_shuffled(spark, sf, monkeypatch):
    from tabwright.llm import common, jaccard, suffixes

    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    operators = [lambda: passages.dedup_windows(docs).drop("kept_text"), lambda: suffixes.dedup_bytes(docs).drop("kept"), lambda: jaccard.linked(docs)]
    small = [sorted(op().collect()) for op in operators]
    monkeypatch.setattr(common, "BROADCAST_BYTES", -1)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert [sorted(op().collect()) for op in operators] == small
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
