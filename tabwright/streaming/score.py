"""Scoring rows as they arrive. The scorer keeps no state, so this is a map over the stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tabwright.plans.workbench import clean
from tabwright.sources.sinks import LinearScorer, checked


def score_arrivals(spark: SparkSession, source: str, schema: T.StructType, model_path: str, sink: str, checkpoint: str) -> None:
    """Scores every file that is in `source`, writes Parquet to `sink`, then stops.

    Progress lives in `checkpoint`; a rerun scores only new files, and the file sink commits each
    batch once.
    """
    scorer = LinearScorer.load(spark, model_path)
    stream: DataFrame = spark.readStream.schema(schema).parquet(source)
    scored = checked(scorer.score(clean(stream), ["row_id"]).select("row_id", "pred"), "pred")
    query = scored.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
