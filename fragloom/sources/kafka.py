"""Message sources for streams.  Offsets are kept by the query's checkpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def kafka_stream(spark: SparkSession, servers: str, topic: str, starting: str = "earliest", most: int | None = None, **options: str) -> DataFrame:
    """seq, ts, value of a Kafka topic (needs the Kafka connector on the class path); ``most`` bounds a trigger's offsets, 500 as a writer that flushes at so many rows."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic).option("startingOffsets", starting)
    if most:
        reader = reader.option("maxOffsetsPerTrigger", most)
    for key, value in options.items():
        reader = reader.option(key, value)
    return topic_rows(reader.load())


#: A topic has fewer partitions.
PARTITIONS = 1 << 16


def topic_rows(records: DataFrame) -> DataFrame:
    """seq, ts, value of a topic's records (partition, offset, timestamp, value).

    seq orders records by offset, then partition: no two share one, and within a partition, which holds all messages of a key, it follows arrival.
    """
    return records.select((F.col("offset") * PARTITIONS + F.col("partition")).alias("seq"), F.col("timestamp").alias("ts"), "value")


def file_stream(spark: SparkSession, folder: str, files_per_trigger: int = 1) -> DataFrame:
    """seq, ts, value of Parquet files that arrive in a folder."""
    return spark.readStream.schema("seq bigint, ts timestamp, value string").option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def bounded(messages: DataFrame, most: int) -> DataFrame:
    """The first messages that can be decoded, so many at most."""
    from fragloom.operators.fragments import decode

    return messages.where(decode(F.col("value")).isNotNull()).orderBy("seq").limit(most)
