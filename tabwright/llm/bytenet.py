"""Quality classifier: a byte-level convolutional network in numpy, pooled over overlapping chunks of the whole text."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.llm.common import bounded_batches, by_value, text_or_empty

by_value(__name__)

CHUNK, STEP = 1024, 960  # bytes of a chunk, and from one chunk's start to the next
WIDTH, STRIDE, DEPTH, FILTERS = 8, 2, 6, 24
TRAIN_ROWS = 1200  # bound of the labelled sample that the network is fitted on, half of it per label at most
STEPS = 600  # passes over the sample are repeated until so many batches have been seen
THRESHOLD = 0.7


def chunk_bytes(text: bytes) -> np.ndarray:
    """All chunks of a text, the last one filled with zero bytes; an empty text has one empty chunk."""
    n = max(1, -(-max(0, len(text) - (CHUNK - STEP)) // STEP))
    flat = np.zeros((n - 1) * STEP + CHUNK, dtype=np.uint8)
    flat[: len(text)] = np.frombuffer(text, dtype=np.uint8)
    return np.lib.stride_tricks.sliding_window_view(flat, CHUNK)[::STEP]


class ByteNet:
    """Embedding, one convolution, maximum per chunk; then maximum and mean over chunks, and one probability."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.p = {
            "emb": rng.normal(0, 0.5, (256, DEPTH)).astype(np.float32),
            "conv": rng.normal(0, (2 / (WIDTH * DEPTH)) ** 0.5, (WIDTH * DEPTH, FILTERS)).astype(np.float32),
            "bias": np.zeros(FILTERS, np.float32),
            "out": rng.normal(0, 0.1, 2 * FILTERS).astype(np.float32),
            "base": np.zeros(1, np.float32),
        }
        self.shift = 0.0  # log odds of the labels against the balanced sample

    def _columns(self, chunks: np.ndarray) -> np.ndarray:
        e = self.p["emb"][chunks]
        windows = np.lib.stride_tricks.sliding_window_view(e.reshape(len(chunks), -1), WIDTH * DEPTH, axis=1)
        return np.ascontiguousarray(windows[:, :: STRIDE * DEPTH])

    def pooled(self, chunks: np.ndarray, block: int = 64) -> np.ndarray:
        """(chunks, filters): each filter's largest answer in the chunk, negative ones as zero."""
        out = np.empty((len(chunks), FILTERS), np.float32)
        for lo in range(0, len(chunks), block):
            cols = self._columns(chunks[lo : lo + block])
            out[lo : lo + block] = (cols @ self.p["conv"]).max(axis=1)
        return np.maximum(out + self.p["bias"], 0)

    def _features(self, pooled: np.ndarray, starts: np.ndarray) -> np.ndarray:
        n = np.diff(np.r_[starts, len(pooled)])[:, None]
        return np.hstack([np.maximum.reduceat(pooled, starts), np.add.reduceat(pooled, starts) / n])

    def scores(self, texts: list[bytes]) -> np.ndarray:
        """One probability per text; memory is bounded by blocks of chunks, whatever a text's length."""
        features = []
        buffer: list[np.ndarray] = []
        held = 0

        def flush():
            nonlocal held
            if buffer:
                starts = np.cumsum([0, *map(len, buffer[:-1])])
                features.append(self._features(self.pooled(np.concatenate(buffer)), starts))
                buffer.clear()
                held = 0

        for text in texts:
            chunks = chunk_bytes(text)
            buffer.append(chunks)
            held += len(chunks)
            if held >= 512:
                flush()
        flush()
        if not features:
            return np.empty(0)
        logit = np.vstack(features).astype(np.float64) @ self.p["out"].astype(np.float64) + float(self.p["base"][0]) + self.shift
        return 1 / (1 + np.exp(-np.clip(logit, -40, 40)))

    def fit(self, docs: list[np.ndarray], labels: np.ndarray, steps: int = STEPS, batch: int = 24, rate: float = 0.006, seed: int = 11) -> ByteNet:
        """Adam on the cross-entropy; only the place of each maximum carries a gradient."""
        rng = np.random.default_rng(seed)
        moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.p.items()}
        batches = -(-len(docs) // batch)
        epochs = -(-steps // batches)
        step, total = 0, epochs * batches
        for _ in range(epochs):
            order = rng.permutation(len(docs))
            for lo in range(0, len(docs), batch):
                ids = order[lo : lo + batch]
                grads = self._gradients([docs[i] for i in ids], labels[ids])
                step += 1
                pace = rate * (1 - step / (total + 1)) ** 0.5
                for k, g in grads.items():
                    m, v = moments[k]
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    self.p[k] -= (pace * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
        return self

    def _gradients(self, docs: list[np.ndarray], labels: np.ndarray, block: int = 64) -> dict[str, np.ndarray]:
        """Gradients over all chunks of the texts; only a block of chunks is spread out at a time."""
        counts = np.array([len(d) for d in docs])
        starts = np.cumsum(counts) - counts
        owner = np.repeat(np.arange(len(docs)), counts)
        parts = [d[lo : lo + block] for d in docs for lo in range(0, len(d), block)]
        edges = np.cumsum([0, *map(len, parts)])
        place = np.empty((len(owner), FILTERS), np.int32)
        top = np.empty((len(owner), FILTERS), self.p["conv"].dtype)
        for lo, part in zip(edges, parts):
            answers = self._columns(part) @ self.p["conv"]
            at = answers.argmax(axis=1)
            place[lo : lo + len(part)] = at
            top[lo : lo + len(part)] = np.take_along_axis(answers, at[:, None], axis=1)[:, 0]
        pooled = np.maximum(top + self.p["bias"], 0)
        features = self._features(pooled, starts)
        logit = features @ self.p["out"] + self.p["base"][0]
        error = ((1 / (1 + np.exp(-np.clip(logit, -40, 40))) - labels) / len(docs)).astype(np.float32)
        by_feature = error[:, None] * self.p["out"]
        best = pooled == features[owner, :FILTERS]
        back = best * by_feature[owner, :FILTERS] + by_feature[owner, FILTERS:] / counts[owner][:, None]
        back = np.where(pooled > 0, back, 0).astype(np.float32)
        emb, conv = np.zeros((256, DEPTH)), np.zeros(self.p["conv"].shape)
        for lo, part in zip(edges, parts):
            push, at = back[lo : lo + len(part)], place[lo : lo + len(part)]
            symbols = part[np.arange(len(part))[:, None, None], at[:, :, None] * STRIDE + np.arange(WIDTH)]
            patches = self.p["emb"][symbols].reshape(len(part), FILTERS, -1)
            conv += np.einsum("nf,nfk->kf", push, patches)
            spread = (push[:, :, None] * self.p["conv"].T[None]).reshape(-1, DEPTH)
            emb += np.stack([np.bincount(symbols.reshape(-1), spread[:, d], 256) for d in range(DEPTH)], axis=1)
        return {
            "emb": emb.astype(np.float32), "conv": conv.astype(np.float32), "bias": back.sum(axis=0),
            "out": features.T.astype(np.float32) @ error + 1e-4 * self.p["out"], "base": np.array([error.sum()], np.float32),
        }


def held_out(id_col: str = "doc_id"):
    """Rows whose label is never learned: crc32 of the id's text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, steps: int = STEPS, id_col: str = "doc_id",
          label_col: str = "quality", text_col: str = "text") -> ByteNet:
    """Fit on a sample of labelled rows that is bounded by `rows`, taken in hash order of the id, halves by label.

    Held-out rows, null ids and null labels are left out. The sampled ids (at most `rows`) are broadcast;
    one whole text of each (of an id that stands several times, the one with the smallest digest) comes to
    the driver and is learned in the chunks that scoring reads.
    """
    usable = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(id_col)).select(
        F.col(id_col).alias("__id"), F.col(label_col).cast("int").alias("__label"))
    totals = {r["__label"]: r["count"] for r in usable.groupBy("__label").count().collect() if r["__label"] in (0, 1)}
    by_hash = [usable.filter(F.col("__label") == y).orderBy(F.md5(F.col("__id").cast("string")), "__id").limit(rows // 2) for y in (0, 1)]
    sample = F.broadcast(by_hash[0].union(by_hash[1]))
    text = text_or_empty(text_col)
    found = docs.join(sample, F.col(id_col) == F.col("__id")).groupBy("__id", "__label").agg(
        F.min(F.struct(F.md5(text).alias("h"), text.cast("binary").alias("text"))).alias("one")).select("__id", "__label", "one.text", "one.h")
    got = sorted(found.collect(), key=lambda r: (r["__id"], r["__label"], r["h"]))
    net = ByteNet()
    if len({r["__label"] for r in got}) < 2:  # nothing to tell apart: the share of label 1, smoothed
        net.p["out"][:] = 0
        net.shift = float(np.log((totals.get(1, 0) + 1) / (totals.get(0, 0) + 1)))
        return net
    chunks = [chunk_bytes(bytes(r["text"])) for r in got]
    y = np.array([r["__label"] for r in got], dtype=np.float32)
    net.fit(chunks, y, steps)
    net.shift = float(np.log(totals[1] / totals[0]) - np.log(y.sum() / (len(y) - y.sum())))
    return net


def score(docs: DataFrame, net: ByteNet, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """`docs` with `quality_score` (6 decimals) and `quality_predicted` (1 from `threshold` on), replacing such columns.

    Every byte of every text is read; a null text is empty and an empty text is scored like any other.
    Equal texts get equal scores.
    """
    bounded_batches(docs)
    names = [c for c in docs.columns if c not in ("quality_score", "quality_predicted")]
    at = len(names)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            texts = [t.encode("utf-8") for t in batch.column(at).to_pylist()]
            got = pa.array(np.round(net.scores(texts), 6), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], got], names=[*names, "quality_score"])

    schema = docs.select(*[F.col(f"`{c}`") for c in names]).schema.add("quality_score", "double")
    scored = docs.select(*[F.col(f"`{c}`") for c in names], text_or_empty(text_col).alias("__text")).mapInArrow(run, schema)
    return scored.withColumn("quality_predicted", (F.col("quality_score") >= threshold).cast("int"))


def kept_documents(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents that the classifier does not reject, with the columns of `docs`."""
    return score(docs, train(docs, labels, **options)).filter(F.col("quality_predicted") == 1).select(*docs.columns)


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    net = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    slim = docs.select("doc_id", "text", held_out().alias("held_out"))
    scored = score(slim, net).drop("text")
    return scored.select("doc_id", "held_out", F.col("quality_score").alias("score"), F.col("quality_predicted").alias("predicted"))
