"""Quality rules: base measures of a text, and the log-likelihood ratio of hashed n-grams between trusted and raw text.

DataFrame expressions only: a text's measures are computed inside its row, the two multinomials are one aggregate,
and the n-grams of a text meet the ratios of their buckets by a join.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.llm.common import WORD, attach_small, text_or_empty
from tabwright.session import few_tasks, materialize

BUCKETS = 1 << 14  # fewest hash buckets of word unigrams and bigrams together
GRAMS = 32  # distinct n-grams per bucket: the threshold is made for about so many, so buckets grow with the corpus
RATIO_BYTES = 64 << 20  # of the buckets that are broadcast, the most frequent ones; the others meet n-grams by a shuffle
SMOOTHING = 1.0
SPACES = "\t\n\x0b\x0c\r"  # what `WORD` leaves out, besides the blank
THRESHOLD = -0.1  # nats per n-gram; a text below it is more like the raw corpus than like the trusted part
MIN_WORDS = 50
MAX_REPEATED = 50  # percent of words in repeated 3-word windows


def _measured(docs: DataFrame, text_col: str) -> DataFrame:
    """`docs` with `__text`, `__words` (array) and `__chars`, the code points in words.

    Spaces become blanks first: Spark splits at a fixed character without a regular expression.
    """
    text = text_or_empty(text_col)
    blanks = reduce(lambda x, space: F.replace(x, F.lit(space), F.lit(" ")), SPACES, text)
    cut = docs.withColumns({"__text": text, "__pieces": F.split(blanks, " ")})
    return cut.withColumns({"__words": F.array_remove("__pieces", ""), "__chars": F.length("__text") - F.size("__pieces") + 1}).drop("__pieces")


def _bucket(*parts: Column, buckets: int | None = None) -> Column:
    return F.pmod(F.xxhash64(*parts), F.lit(buckets or BUCKETS))


def _pairs(words: DataFrame, of) -> DataFrame:
    """`words` (with `__words`) with a row per word: `of(*parts)` of its unigram, `one`, and of the bigram with the next word, `two`.

    The outer generator keeps Spark from adding a filter on the array's size, for which a text would be split twice.
    """
    keep = [c for c in words.columns if c != "__words"]
    single = words.select(*keep, "__words", F.posexplode_outer("__words").alias("i", "w")).filter("w is not null")
    return single.select(*keep, of(F.col("w")).alias("one"), of(F.col("w"), F.try_element_at("__words", F.col("i") + 2)).alias("two"))


def _grams(words: DataFrame, of) -> DataFrame:
    """`words` (with `__words`) with a row per n-gram, `of(*parts)` in `bucket`: unigrams, and bigrams with the next word."""
    pairs = _pairs(words, of)
    return pairs.withColumn("bucket", F.explode(F.array("one", "two"))).drop("one", "two")


def buckets_for(docs: DataFrame, text_col: str = "text") -> int:
    """Buckets for the distinct n-grams of the corpus, as a sketch counts them (1 %): at most `GRAMS` in each on average."""
    grams = _grams(_measured(docs.select(text_col), text_col).select("__words"), F.xxhash64)
    return max(BUCKETS, -(-grams.agg(F.approx_count_distinct("bucket", 0.01)).first()[0] // GRAMS))


def gram_counts(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int | None = None) -> DataFrame:
    """(bucket, raw, target): n-gram counts of all documents and of the trusted ones, at most `buckets` rows.

    Each word gives its unigram and the bigram with its successor (the last word: with nothing).
    """
    ids = trusted.select(F.col(id_col).alias("__id")).filter("__id is not null").distinct().withColumn("__target", F.lit(1))
    rows = few_tasks(docs.select(F.col(id_col).alias("__doc"), F.col(text_col)), per_core=1)  # a task sends up to a row per bucket
    marked = attach_small(rows, ids, F.col("__doc") == F.col("__id"), name="trusted")
    words = _measured(marked, text_col).select(F.coalesce("__target", F.lit(0)).alias("target"), "__words")
    return _grams(words, lambda *parts: _bucket(*parts, buckets=buckets)).groupBy("bucket").agg(
        F.count("*").alias("raw"), F.sum("target").cast("long").alias("target"))


def ratio_table(counts: DataFrame, buckets: int) -> DataFrame:
    """(bucket, raw, ratio) of the counted buckets, written once: what `log_ratios` gives, for any number of buckets."""
    counts = materialize(counts, "grams")
    total = counts.agg(F.coalesce(F.sum("raw"), F.lit(0)).alias("raw"), F.coalesce(F.sum("target"), F.lit(0)).alias("target")).first()
    scale = math.log((total["raw"] + SMOOTHING * buckets) / (total["target"] + SMOOTHING * buckets))
    return counts.select("bucket", "raw", (F.log((F.col("target") + SMOOTHING) / (F.col("raw") + SMOOTHING)) + scale).alias("ratio"))


def text_ratios(docs: DataFrame, table: DataFrame, buckets: int, text_col: str = "text", limit: int | None = None) -> DataFrame:
    """(key, __total, __n): sum of the ratios, in 1e-9, and number of the n-grams of all rows of a text.

    The most frequent buckets are broadcast, as many as `limit` bytes hold; n-grams of the others are
    shuffled. Sums are of whole numbers, so that they do not depend on the order of rows.
    """
    table = table.select(F.col("bucket").alias("__b"), "raw", F.rint(F.col("ratio") * 1e9).alias("ratio"))
    most = max(1, (limit or RATIO_BYTES) // 32)
    common, rest = table, None
    if table.count() > most:
        last = table.orderBy(F.desc("raw"), "__b").limit(most).orderBy("raw", F.desc("__b")).first()
        often = (F.col("raw") > last["raw"]) | ((F.col("raw") == last["raw"]) & (F.col("__b") <= last["__b"]))
        common, rest = table.filter(often), table.filter(~often)
    text = text_or_empty(text_col)
    words = _measured(docs.select(F.col(text_col)), text_col).select(F.xxhash64(text).alias("key"), "__words")
    met = _pairs(words, lambda *parts: _bucket(*parts, buckets=buckets))
    for gram in ("one", "two"):  # the same table, broadcast once
        met = met.join(F.broadcast(common.drop("raw")).alias(gram), F.col(gram) == F.col(f"{gram}.__b"), "left")
    ratios = [F.coalesce(F.col(f"{gram}.ratio"), F.lit(0.0)) for gram in ("one", "two")]
    sums = met.select("key", (ratios[0] + ratios[1]).alias("ratio"), F.lit(2).alias("n"))
    if rest is not None:
        missed = F.array(*[F.when(F.col(f"{gram}.__b").isNull(), F.col(gram)) for gram in ("one", "two")])
        far = met.select("key", F.explode(missed).alias("bucket")).filter("bucket is not null")
        far = far.join(rest.hint("shuffle_merge"), F.col("bucket") == F.col("__b"))
        sums = sums.union(far.select("key", "ratio", F.lit(0)))
    return sums.groupBy("key").agg(F.sum("ratio").alias("__total"), F.sum("n").alias("__n"))


def log_ratios(counts: DataFrame) -> list[float]:
    """log P(bucket | trusted) - log P(bucket | raw) for each of `BUCKETS` buckets, with additive smoothing."""
    raw, target = [0] * BUCKETS, [0] * BUCKETS
    for r in counts.collect():  # at most BUCKETS rows
        raw[r["bucket"]], target[r["bucket"]] = r["raw"], r["target"]
    scale = math.log((sum(raw) + SMOOTHING * BUCKETS) / (sum(target) + SMOOTHING * BUCKETS))
    return [math.log((t + SMOOTHING) / (r + SMOOTHING)) + scale for t, r in zip(target, raw)]


def measure(docs: DataFrame, ratios: list[float] | DataFrame, threshold: float = THRESHOLD, text_col: str = "text",
            buckets: int | None = None) -> DataFrame:
    """`docs` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, llr, base_failed and kept
    (columns of these names are replaced).

    A null text is empty; a text without words has zeros everywhere, an llr of 0 and fails. Equal texts get
    equal results and an empty table an empty result. A document's windows are sorted inside its row, and
    only if some window repeats. `ratios` is the list of `log_ratios`, or the table of `ratio_table` for `buckets`.
    """
    words, n = F.col("__words"), F.size("__words")
    rows = _measured(docs, text_col)
    joined = isinstance(ratios, DataFrame)
    if joined:
        total = F.xxhash64("__text")
    else:
        weight = F.lit(ratios)
        grams = F.transform(words, lambda w, i: F.element_at(weight, (_bucket(w) + 1).cast("int"))
                            + F.element_at(weight, (_bucket(w, F.try_element_at(words, i + 2)) + 1).cast("int")))
        total = F.aggregate(grams, F.lit(0.0), lambda a, x: a + x)
    windows = F.when(n >= 3, F.transform(F.slice(words, 1, F.greatest(n - 2, F.lit(1))), lambda w, i: F.xxhash64(
        w, F.try_element_at(words, i + 2), F.try_element_at(words, i + 3))))
    text = F.col("__text")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    rows = rows.withColumns({
        "__llr": total, "__windows": windows, "__lines": lines,
        "__symbols": F.regexp_count(text, F.lit(r"[#*$%&|<>]")), "__n": n,
    }).drop("__text", "__words")
    rows = rows.withColumn("__sorted", F.when(
        F.size(F.array_distinct("__windows")) < F.size("__windows"),
        F.sort_array(F.transform("__windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    ordered = F.col("__sorted")
    twice = F.filter(F.zip_with(ordered, F.slice(ordered, 2, F.size(ordered)), lambda x, y: F.when(x["h"] == y["h"], F.array(x["i"], y["i"]))),
                     lambda pair: pair.isNotNull())
    rows = rows.withColumn("__at", F.array_distinct(F.flatten(twice)))  # windows that occur twice or more
    at = F.col("__at")
    covered = F.array_union(F.array_union(at, F.transform(at, lambda i: i + 1)), F.transform(at, lambda i: i + 2))
    n = F.col("__n")
    measures = {
        "n_words": n, "word_chars": F.col("__chars"), "n_symbols": F.col("__symbols"),
        "n_dup_lines": F.size("__lines") - F.size(F.array_distinct("__lines")),
        "n_repeat_words": F.when(at.isNotNull(), F.size(covered)).otherwise(0),
    }
    keep = [c for c in docs.columns if c not in {*measures, "llr", "base_failed", "kept"}]
    mean = F.col("__llr") if joined else F.round(F.coalesce(F.try_divide(F.col("__llr"), 2 * n), F.lit(0.0)), 9)
    # The generator keeps filters on the measures from being rewritten into copies of the nested expressions.
    out = rows.select(*keep, F.inline(F.array(F.struct(*[v.cast("long").alias(k) for k, v in measures.items()], mean.alias("llr")))))
    if joined:  # llr holds the text's hash so far
        sums = text_ratios(docs, ratios, buckets, text_col).withColumnRenamed("key", "__key")
        mean = F.round(F.coalesce(F.try_divide(F.col("__total"), F.col("__n") * 1e9), F.lit(0.0)), 9)
        out = attach_small(out, sums, F.col("llr") == F.col("__key"), name="ratios").withColumn("llr", mean).drop("__key", "__total", "__n")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    return out.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & (F.col("llr") >= threshold))


def trusted_rows(labels: DataFrame) -> DataFrame:
    """Labelled rows that stand for the text we want: good and not toxic."""
    return labels.filter("quality = 1 and coalesce(toxic, 0) = 0")


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    buckets = buckets_for(docs)
    counts = gram_counts(docs, trusted_rows(spark.read.parquet(f"{sf_dir}/labels.parquet")), buckets=buckets)
    return measure(docs, ratio_table(counts, buckets), buckets=buckets).drop("text")
