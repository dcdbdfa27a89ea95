"""From documents to encoded training text: five stages, each a function (spark, docs, sf_dir) -> DataFrame.

Every stage gets what its predecessor kept, written as Parquet and read again. All but the last return the
columns of `documents`; the last adds the best segmentation of every text, the next best ones and a round trip.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.llm import bytenet, jaccard, mixing, pieces, pii
from tabwright.session import materialize

TOKENIZER = public_tokenizers.path("piece_bpe_32k.model")
ORACLE_SQL = None  # a network's scores, hashes of shingles and segmentations have no SQL form


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return bytenet.kept_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: the one with the smallest id."""
    return jaccard.one_per_group(docs)


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; `n_chars` is that of the new text."""
    cleaned = pii.redacted(docs)
    return cleaned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else cleaned


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources meet their target weights; a document appears once per epoch that takes it."""
    return mixing.mixed_documents(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their pieces, the next best segmentations as edits, and whether decoding gives the text back."""
    return pieces.encode(docs, pieces.load(TOKENIZER), verify=True)


STAGES = [
    ("quality classifier", quality), ("n-gram Jaccard join", near_duplicates), ("PII", private_data),
    ("mixing sources to target weights", mixture), ("SentencePiece encoding and decoding", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each result written to the shared folder before the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.split()[0].lower())
    return STAGES[-1][1](spark, docs, sf_dir)
