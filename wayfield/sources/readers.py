"""Where records come from: Kafka topics and text files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def kafka_options(servers: str, topic: str, starting: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting}


def kafka_json(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """JSON key/value topic from the earliest offset, as envelope records."""
    rows = spark.readStream.format("kafka").options(**kafka_options(servers, topic, "earliest")).load()
    return as_envelope(rows)


def as_envelope(rows: DataFrame) -> DataFrame:
    """Kafka key and value (JSON text) as one ``{"key":...,"value":...}`` record."""
    key = F.coalesce(F.col("key").cast("string"), F.lit("null"))
    return rows.select(F.concat(F.lit('{"key":'), key, F.lit(',"value":'),
                                F.col("value").cast("string"), F.lit("}")).alias("value"))


def kafka_text(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """Plain text topic from the latest offset."""
    rows = spark.readStream.format("kafka").options(**kafka_options(servers, topic, "latest")).load()
    return rows.select(F.col("value").cast("string").alias("value"))


def text_file(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def text_stream(spark: SparkSession, path: str, files_per_trigger: int = 100) -> DataFrame:
    """Text files as they arrive in a folder."""
    return spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(path)
