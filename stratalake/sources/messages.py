"""Message-topic sources. Every one yields the same six-column envelope."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stratalake.sources.schemas import ENVELOPE


def topic_stream(spark: SparkSession, brokers: str, topic: str, **options: str) -> DataFrame:
    """Follow one topic from its start; needs the Kafka connector on the classpath."""
    settings = {
        "kafka.bootstrap.servers": brokers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
        **options,
    }
    return spark.readStream.format("kafka").options(**settings).load()


def envelope_files_stream(spark: SparkSession, path: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """The same envelope followed from a folder of files, for replays and tests."""
    return spark.readStream.format(fmt).schema(ENVELOPE).options(**options).load(path)
