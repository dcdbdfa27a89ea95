"""Approximate nearest neighbours by a permutation index: pivots in order of nearness, postings per pivot, footrule, rerank."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tabwright.llm.common import attach_small, by_value
from tabwright.session import materialize

by_value(__name__)

PIVOTS = 256
PREFIX = 64  # nearest pivots that represent a vector
SAMPLE = 8  # vectors that are looked at for each pivot wanted
SHARE, LEAST = 0.2, 256  # of a shard's distinct vectors, those with the smallest footrule distance are reranked exactly
SHARD_ROWS, QUERY_BLOCK = 4096, 1024


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v, dims) of the rows that take part: an id, and finite components that are not all zero."""
    v = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).filter("id is not null and v is not null")
    good = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    return rows.filter(good).withColumn("dims", F.size("v"))


class Index:
    """A shard: its distinct vectors, the smallest ids of each, and per pivot a posting of all vectors.

    A posting holds `prefix - place` for vectors that have the pivot among their nearest ones, else zero. The
    footrule distance of two prefixes (absent pivots at place `prefix`) is a constant less twice the sum of
    the smaller posted values, so the largest sums are the smallest distances.
    """

    def __init__(self, ids: np.ndarray, x: np.ndarray, pivots: np.ndarray, prefix: int, k: int):
        order = np.argsort(ids, kind="stable")
        ids, x = ids[order], np.ascontiguousarray(x[order])
        raw = (x + 0.0).view(np.dtype((np.void, x.itemsize * x.shape[1]))).ravel()  # + 0.0: one zero only
        _, first, which = np.unique(raw, return_index=True, return_inverse=True)
        self.vectors = x[first]
        by_vector = np.lexsort((ids, which))
        which, ids = which[by_vector], ids[by_vector]
        fresh = np.r_[True, (which[1:] != which[:-1]) | (ids[1:] != ids[:-1])]  # a row that repeats id and vector is one
        which, ids = which[fresh], ids[fresh]
        self.start = np.searchsorted(which, np.arange(len(first)))
        self.ids, self.k = ids, k
        self.count = np.minimum(np.bincount(which, minlength=len(first)), k + 1)
        self.smallest = ids[self.start]
        self.prefix = prefix
        self.place = np.empty(len(first), np.int64)  # among the smallest ids, where ties of the footrule are cut
        self.place[np.lexsort((np.arange(len(first)), self.smallest))] = np.arange(len(first))
        self.longest = np.sqrt(np.square(self.vectors).sum(axis=1)).max()
        self.postings = np.zeros((len(pivots), len(first)), np.uint8)
        near = self.nearest(self.vectors, pivots, prefix)
        np.put_along_axis(self.postings, near.T, np.broadcast_to(np.arange(prefix, 0, -1, dtype=np.uint8)[:, None], near.T.shape), axis=0)

    @staticmethod
    def nearest(x: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
        return np.argsort(-(x @ pivots.T), axis=1, kind="stable")[:, :prefix]

    def search(self, own: int, q: np.ndarray, near: np.ndarray, share: float, least: int) -> tuple[np.ndarray, np.ndarray]:
        """The k best ids and inner products for one query among the vectors of smallest footrule distance."""
        n = len(self.smallest)
        take = min(n, max(least, int(np.ceil(share * n))))
        if take < n:
            weight = np.arange(self.prefix, 0, -1, dtype=np.uint8)[:, None]
            sums = np.minimum(self.postings[near], weight).sum(axis=0, dtype=np.uint16)  # at most 255 * 256 / 2
            rank = np.argpartition(self.place - (sums.astype(np.int64) << 32), take - 1)[:take]
        else:
            rank = np.arange(n)
        close = self.vectors[rank] @ q  # to leave out the far ones; the score itself is the sum below
        if take > self.k + 1:
            least_close = np.partition(close, take - self.k - 1)[take - self.k - 1]
            reach = self.longest * np.sqrt(q @ q) * len(q) * 1e-14
            rank = rank[~(close < least_close - reach)]  # all of them, if a product overflows
        scores = (self.vectors[rank] * q).sum(axis=1)
        best = np.lexsort((self.smallest[rank], -scores))[: self.k + 1]
        ids, out = [], []
        for j in best:
            v = rank[j]
            mine = self.ids[self.start[v] : self.start[v] + self.count[v]]
            mine = mine[mine != own]
            ids.append(mine)
            out.append(np.full(len(mine), scores[j]))
        ids, out = np.concatenate(ids), np.concatenate(out)
        order = np.lexsort((ids, -out))[: self.k]
        return ids[order], out[order]


def search(vectors: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
           pivots: int = PIVOTS, prefix: int = PREFIX, share: float = SHARE, least: int = LEAST) -> DataFrame:
    """query_id, rank, vec_id, score: for each query row the `k` nearest found by inner product, ties to smaller ids.

    Rows without id or vector, with null or non-finite components or only zeros take no part. Vectors are
    searched among those of their own length. A query finds every row but those of its own id; rows that
    repeat id and vector are one; with fewer candidates all are returned. Vectors are dealt to shards by a
    hash and queries to blocks; every block meets every shard of its length, both of bounded size. Pivots
    are the `pivots` distinct vectors of a length with the smallest hashes; every row is indexed. Equal
    vectors are one entry of a shard.
    """
    rows = materialize(usable(vectors, id_col, vector_col).withColumn("key", F.xxhash64("v")).dropDuplicates(["id", "v"]), "vectors")
    asked = materialize(usable(queries, id_col, vector_col).withColumn("key", F.xxhash64("v")).dropDuplicates(["id", "key"]), "queries")
    sizes = rows.groupBy("dims").agg(F.count("*").alias("n"), F.approx_count_distinct("key").alias("distinct"))
    sizes = sizes.join(asked.groupBy("dims").agg(F.count("*").alias("wanted")), "dims").select(
        F.col("dims").alias("d"), F.ceil(F.col("n") / SHARD_ROWS).cast("int").alias("shards"), F.ceil(F.col("wanted") / QUERY_BLOCK).cast("int").alias("blocks"),
        F.least(F.lit(1.0), F.lit(float(SAMPLE * pivots)) / F.greatest(F.col("distinct"), F.lit(1))).alias("part"))
    sizes = materialize(sizes, "lengths")
    rows = attach_small(rows, sizes, F.col("dims") == F.col("d"), "inner", "lengths")
    asked = attach_small(asked, sizes, F.col("dims") == F.col("d"), "inner", "lengths")
    # Keys are spread evenly, so that this part of their range holds about SAMPLE distinct vectors for each pivot.
    low = rows.filter(F.col("key") / 2.0**64 + 0.5 <= F.col("part")).groupBy("dims", "shards", "blocks", "key").agg(F.min("v").alias("v"))
    points = low.withColumn("at", F.row_number().over(W.partitionBy("dims").orderBy("key"))).filter(F.col("at") <= pivots)

    def every(n: str):
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    side = rows.select("dims", F.pmod(F.xxhash64("id", "v"), F.col("shards")).cast("int").alias("shard"), every("blocks").alias("block"), "id", "v")
    wanted = asked.select("dims", every("shards").alias("shard"), F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int").alias("block"), "id", "key", "v", F.lit(False).alias("pivot"))
    marks = points.select("dims", every("shards").alias("shard"), "blocks", "key", "v").select(
        "dims", "shard", every("blocks").alias("block"), F.lit(0).cast("long").alias("id"), "key", "v", F.lit(True).alias("pivot"))
    wanted = wanted.unionByName(marks)

    def match(right, left):
        import pandas as pd

        marks, left = left[left["pivot"]].sort_values("key"), left[~left["pivot"]]
        if not len(left) or not len(right) or not len(marks):
            return pd.DataFrame({"query_id": [], "key": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "key": "int64", "vec_id": "int64", "score": "float64"})
        points = np.stack(marks["v"].to_numpy())
        near = min(prefix, len(points), 255)
        index = Index(right["id"].to_numpy(), np.stack(right["v"].to_numpy()), points, near, k)
        q = np.stack(left["v"].to_numpy())
        nearest = Index.nearest(q, points, near)
        parts = []
        for i, (own, key) in enumerate(zip(left["id"], left["key"])):
            ids, scores = index.search(own, q[i], nearest[i], share, least)
            parts.append((np.full(len(ids), own), np.full(len(ids), key), ids, scores))
        return pd.DataFrame(dict(zip(("query_id", "key", "vec_id", "score"), map(np.concatenate, zip(*parts)))))

    keys = ("dims", "shard", "block")
    pairs = side.groupBy(*keys).cogroup(wanted.groupBy(*keys)).applyInPandas(match, "query_id long, key long, vec_id long, score double")
    order = W.partitionBy("query_id", "key").orderBy(F.desc("score"), "vec_id")
    ranked = pairs.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def query(spark, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return search(vectors, vectors.filter("vec_id % 20 = 0"))
