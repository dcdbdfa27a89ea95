"""Exact dedup by progressive refinement: equal lengths, then equal prefix hashes, then equal digests of whole texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.llm.common import attach_small, text_or_empty
from tabwright.session import materialize

PREFIX = 256  # characters that the second step compares
RESULTS = ["text_sha256", "keep_id", "group_size", "kept"]


def normalised(text_col: str = "text") -> Column:
    """The text with every run of the six white space characters as one space; null is empty.

    The pattern leaves single spaces alone, so that an ordinary text is only searched and not rebuilt.
    """
    return F.regexp_replace(text_or_empty(text_col), r"(?:\x20[\x20\x09-\x0D]|[\x09-\x0D])[\x20\x09-\x0D]*", " ")


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    base = docs.select(F.col(id_col).alias("id"), normalised(text_col).alias("norm"))
    return base.withColumns({"n": F.length("norm"), "prefix": F.xxhash64(F.substring("norm", 1, PREFIX))})


def repeated_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(digest, first_id, n_rows) of every normalised text that several rows hold.

    1. Lengths are counted; 2. rows whose length occurs again are counted by length and hash of the
    first characters; 3. only rows that still share both are hashed whole and counted by that digest.
    Every count is combined before its shuffle, so a group that holds a third of all rows is one row per
    task; no text is shuffled unless the keys of step 2 are too many to broadcast.
    """
    keyed = _keyed(docs, id_col, text_col)
    slim = materialize(keyed.select("n", "prefix"), "lengths")
    lengths = slim.groupBy("n").count().filter("count > 1").select(F.col("n").alias("__n"))
    again = attach_small(slim, lengths, F.col("n") == F.col("__n"), "inner", "same-length")
    prefixes = again.groupBy("n", "prefix").count().filter("count > 1").select(F.col("n").alias("__n"), F.col("prefix").alias("__p"))
    left = attach_small(keyed, prefixes, (F.col("n") == F.col("__n")) & (F.col("prefix") == F.col("__p")), "inner", "same-prefix")
    hashed = left.select("id", F.unhex(F.sha2("norm", 256)).alias("digest"))
    return hashed.groupBy("digest").agg(F.min("id").alias("first_id"), F.count("*").alias("n_rows")).filter("n_rows > 1")


def grouped(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with text_sha256, keep_id, group_size (long) and kept; columns of `docs` with these names go.

    Texts are equal when they are identical with white space runs as single spaces; a null text is an
    empty one, and empty texts are equal. Of equal texts the row with the smallest id stays; a null id is
    larger than any other. Rows that repeat id and text are one document and share `kept`; a text
    that no other row holds has its own id and a size of 1. An empty table gives an empty result.
    """
    groups = repeated_texts(docs, id_col, text_col).select(
        F.col("digest").alias("__digest"), F.col("first_id").alias("__first"), F.col("n_rows").alias("__rows"))
    # the digest is a column of its own below the join: where that is shuffled, a caller who drops the text does not send it
    mine = docs.withColumn("__sha", F.sha2(normalised(text_col), 256)).withColumn("__key", F.unhex("__sha"))
    found = attach_small(mine, groups, F.col("__key") == F.col("__digest"), name="groups")
    keep = F.when(F.col("__digest").isNull(), F.col(id_col)).otherwise(F.col("__first"))
    return found.select(
        *[c for c in docs.columns if c not in RESULTS], F.col("__sha").alias("text_sha256"), keep.alias("keep_id"),
        F.coalesce(F.col("__rows"), F.lit(1)).cast("long").alias("group_size"), F.col(id_col).eqNullSafe(keep).alias("kept"))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with the columns of `docs`; of rows that repeat id and text, one."""
    named = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(docs.columns)])  # no name clashes with the results
    key, text = (f"c{docs.columns.index(c)}" for c in (id_col, text_col))
    rows = grouped(named, key, text).filter("kept")
    single = rows.filter("group_size = 1")
    one = rows.filter("group_size > 1").dropDuplicates(["text_sha256", "keep_id"])
    both = single.union(one)
    return both.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return grouped(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


SQL = r"""
with t as (select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as norm from documents)
select doc_id, min(doc_id) over (partition by norm) as keep_id, count(*) over (partition by norm) as group_size,
       doc_id = min(doc_id) over (partition by norm) as kept, sha256(norm) as text_sha256
from t
"""
