import numpy as np
from pyspark.sql import functions as F

from tabwright.llm import bytenet


def test_chunks_cover_every_byte():
    for n in (0, 1, 1023, 1024, 1025, 1984, 1985, 5000):
        data = bytes(1 + i % 250 for i in range(n))
        chunks = bytenet.chunk_bytes(data)
        flat = np.zeros((len(chunks) - 1) * bytenet.STEP + bytenet.CHUNK, np.uint8)
        for i, c in enumerate(chunks):
            flat[i * bytenet.STEP : i * bytenet.STEP + bytenet.CHUNK] = c
        assert flat[:n].tobytes() == data and not flat[n:].any()
        assert len(chunks) == 1 or (len(chunks) - 1) * bytenet.STEP + bytenet.CHUNK - bytenet.STEP < n


def test_gradients_match_differences():
    net = bytenet.ByteNet(3)
    for k in net.p:
        net.p[k] = net.p[k].astype(np.float64)
    rng = np.random.default_rng(0)
    docs = [bytenet.chunk_bytes(rng.integers(32, 120, n).astype(np.uint8).tobytes()) for n in (50, 1500, 3000)]
    y = np.array([0.0, 1.0, 1.0])

    def loss():
        total = 0.0
        for d, t in zip(docs, y):
            f = net._features(net.pooled(d).astype(np.float64), np.array([0]))
            p = 1 / (1 + np.exp(-(f @ net.p["out"] + net.p["base"][0])))
            total -= float(np.log(p if t else 1 - p)[0]) / len(docs)
        return total

    grads = net._gradients(docs, y)
    for k, at in (("conv", (3, 4)), ("bias", (2,)), ("emb", (70, 1)), ("base", (0,))):
        old, step = net.p[k][at], 1e-2
        net.p[k][at] = old + step
        up = loss()
        net.p[k][at] = old - step
        down = loss()
        net.p[k][at] = old
        assert abs((up - down) / (2 * step) - grads[k][at]) < 2e-3


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = bytenet.query(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("held_out").collect()
    right = sum((r["score"] >= 0.7) == (r["quality"] == 1) for r in got) / len(got)
    assert right > 0.9


def test_odd_rows(spark, text_rows):
    df = spark.createDataFrame([(i, t, "old") for i, t in enumerate(text_rows)] + [(None, None, None)], "doc_id long, text string, quality_score string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(8)] + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    net = bytenet.train(df, labels, steps=5)
    got = bytenet.score(df, net).collect()
    assert len(got) == len(text_rows) + 1 and all(0 <= r["quality_score"] <= 1 for r in got)
    by_text = {}
    for r in got:
        by_text.setdefault(r["text"] or "", set()).add(r["quality_score"])
    assert all(len(v) == 1 for v in by_text.values())
    assert bytenet.score(df.limit(0), net).count() == 0
    assert bytenet.train(df, labels.limit(0), steps=5).scores([b""])[0] == 0.5
    ids = spark.range(50).select(F.col("id").alias("doc_id"))
    import zlib
    for r in ids.withColumn("h", bytenet.held_out()).collect():
        assert r["h"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)


def test_training_reads_whole_texts(spark, monkeypatch):
    texts = ["".join(chr(33 + (i * i + i // 97) % 90) for i in range(n)) for n in (0, 900, 1025, 2048, 3000, 9000, 40_000)]
    texts += ["漢字仮" * 334, "é" * 3000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    df = df.withColumn("doc_id", F.col("doc_id") * 1000)
    ids = [i * 1000 for i in range(len(texts))]
    labels = spark.createDataFrame([(d, i % 2) for i, d in enumerate(ids)], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(bytenet.ByteNet, "fit", lambda net, docs, y, steps: seen.extend(docs))
    bytenet.train(df, labels)
    learned = [r["doc_id"] // 1000 for r in df.filter(~bytenet.held_out()).orderBy("doc_id").collect()]
    assert len(seen) == len(learned) >= 5
    for i, chunks in zip(learned, seen):
        assert np.array_equal(chunks, bytenet.chunk_bytes(texts[i].encode()))


def test_gradients_do_not_depend_on_blocks():
    rng = np.random.default_rng(5)
    docs = [bytenet.chunk_bytes(rng.integers(32, 120, n).astype(np.uint8).tobytes()) for n in (0, 700, 5000, 20_000)]
    y = np.array([0.0, 1.0, 1.0, 0.0], np.float32)
    whole, parts = (bytenet.ByteNet(3)._gradients(docs, y, block=b) for b in (1000, 3))
    assert all(np.allclose(whole[k], parts[k], rtol=1e-3, atol=1e-6) for k in whole)


def test_sample_is_bounded_when_an_id_repeats(spark, monkeypatch):
    docs = spark.range(3000).selectExpr("1L as doc_id", "concat('text ', id) as text").union(
        spark.range(2, 40).selectExpr("id as doc_id", "concat('other ', id) as text"))
    labels = spark.range(1, 40).selectExpr("id as doc_id", "cast(id % 2 as int) as quality")
    seen = []
    monkeypatch.setattr(bytenet.ByteNet, "fit", lambda self, chunks, y, steps: seen.append((len(chunks), sum(y))))
    bytenet.train(docs, labels, rows=30)
    bytenet.train(docs, labels, rows=4)
    assert 0 < seen[0][0] <= 30 and seen[1] == (4, 2)
