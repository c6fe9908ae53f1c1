"""The immutable raw layer: Parquet, by fragment type."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from fragloom.operators.schema import UNKNOWN

SCHEMA = "payload string, ingested_at timestamp, kafka_offset bigint, fragment_type string"


def bronze_rows(classified: DataFrame) -> DataFrame:
    """payload, fragment_type, ingested_at, kafka_offset of the messages that could be decoded, payloads as they came."""
    kind = F.coalesce("fragment_type", F.lit(UNKNOWN))
    return classified.where("message is not null").select(F.col("value").cast("string").alias("payload"), kind.alias("fragment_type"), F.col("ts").alias("ingested_at"), F.col("seq").alias("kafka_offset"))


def append(rows: DataFrame, folder: str, batch: int | None = None) -> None:
    """Add rows; a numbered batch replaces itself when it is written again."""
    if batch is None:
        rows.write.mode("append").partitionBy("fragment_type").parquet(folder)
    else:
        rows.write.mode("overwrite").partitionBy("fragment_type").parquet(f"{folder}/batch={batch}")


def scan(spark: SparkSession, folder: str) -> DataFrame:
    """All raw rows, as input for a reprocess: seq, ts, value."""
    raw = spark.read.parquet(folder)
    return raw.select(F.col("kafka_offset").alias("seq"), F.col("ingested_at").alias("ts"), F.col("payload").alias("value"))


def counts(bronze: DataFrame) -> DataFrame:
    """fragment_type, n."""
    return bronze.groupBy("fragment_type").agg(F.count("*").alias("n"))
