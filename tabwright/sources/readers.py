"""Readers: CSV with a missing token, head rows, and the train/test pair as one frame."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.operators.shape import stack


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None, missing: str = "NA") -> DataFrame:
    """CSV with a header line; `missing` reads as null. Without a schema types are inferred.

    Giving the schema saves a pass over the files; the header is checked against it.
    """
    reader = spark.read.option("header", True).option("nullValue", missing).option("mode", "FAILFAST")
    reader = reader.schema(schema).option("enforceSchema", False) if schema is not None else reader.option("inferSchema", True)
    try:
        return reader.csv(path)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc):
            raise FileNotFoundError(f"no CSV at {path}") from exc
        raise


def head_rows(df: DataFrame, key: str, n: int) -> DataFrame:
    """The first n rows in key order."""
    return df.orderBy(key).limit(n)


def check_unique(df: DataFrame, key: str) -> None:
    """Raises with an example when a key occurs twice."""
    twice = df.groupBy(key).agg(F.count("*").alias("n")).filter(F.col("n") > 1).limit(1).collect()
    if twice:
        raise ValueError(f"{key} is not unique: {twice[0][key]} occurs {twice[0]['n']} times")


def load_split(train: DataFrame, test: DataFrame, key: str, target: str) -> DataFrame:
    """Train on test with a `split` column and the target null in test; keys must be unique over both."""
    check_unique(train.select(key).unionByName(test.select(key)), key)
    return stack(train.withColumn("split", F.lit("train")), test.drop(target).withColumn("split", F.lit("test")))
