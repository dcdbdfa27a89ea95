import hashlib
import re

import pytest
from pyspark.sql import functions as F

from tabwright.llm import common, exact


def brute(rows):
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows]
    groups = {}
    for (k, _), t in zip(rows, norm):
        groups.setdefault(t, []).append(k)
    out = []
    for (k, _), t in zip(rows, norm):
        keep = min((x for x in groups[t] if x is not None), default=None)
        out.append((k, keep, len(groups[t]), k == keep, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r) for r in df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=str)


def odd_rows(text_rows):
    long = "word " * 60
    more = ["a  b c", "a\tb\n\nc", " a b c", long + "x", long + "y", long + "x", long.replace(" ", "\r\n") + "x", "  ", " ", "\t"]
    rows = [(i, t) for i, t in enumerate([*text_rows, *more])]
    return rows + [(None, "one"), (3, "one"), (3, "one"), (50, None), (None, "only null"), (None, "only null"), (-5, "a b c")]


@pytest.mark.parametrize("limit", [common.BROADCAST_BYTES, -1])
def test_equals_brute_force(spark, sf, text_rows, monkeypatch, limit):
    monkeypatch.setattr(common, "BROADCAST_BYTES", limit)
    real = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    rows = odd_rows(text_rows) + [(k + 100, t) for k, t in real]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert result(exact.grouped(df)) == brute(rows)


def test_only_shared_prefixes_are_hashed_whole(spark):
    long = "word " * 80
    rows = [(1, long + "x"), (2, long + "y"), (3, "z" + long), (4, long + "x"), (5, "short")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = exact.repeated_texts(df).collect()
    assert [(r["first_id"], r["n_rows"]) for r in found] == [(1, 2)]
    assert bytes(found[0]["digest"]) == hashlib.sha256((long + "x").encode()).digest()


def test_clashing_names_and_extra_columns(spark):
    df = spark.createDataFrame([(2, "a", True, "k", 1), (1, "a", False, "k", 2)], "doc_id long, text string, kept boolean, keep_id string, n int")
    out = exact.grouped(df)
    assert out.columns == ["doc_id", "text", "n", *exact.RESULTS]
    assert {(r["doc_id"], r["keep_id"], r["kept"], r["n"]) for r in out.collect()} == {(2, 1, False, 1), (1, 1, True, 2)}
    kept = exact.deduplicated(df)
    assert kept.columns == df.columns and [tuple(r) for r in kept.collect()] == [(1, "a", False, "k", 2)]


def test_one_row_of_each_text_stays(spark, text_rows):
    rows = odd_rows(text_rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("norm", F.lit(0))
    kept = exact.deduplicated(df).collect()
    texts = [re.sub(r"[\x20\x09-\x0D]+", " ", r["text"] or "") for r in kept]
    assert len(texts) == len(set(texts)) == len({re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows})


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert exact.grouped(df).count() == 0 and exact.deduplicated(df).count() == 0


def test_a_third_of_all_rows_in_one_group(spark):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "same  text").otherwise(F.col("id").cast("string")).alias("text"))
    out = exact.grouped(df).groupBy("kept", "group_size").count().collect()
    assert {(r["kept"], r["group_size"], r["count"]) for r in out} == {(True, 1, 2000), (True, 1000, 1), (False, 1000, 999)}
