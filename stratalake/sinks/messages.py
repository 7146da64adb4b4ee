"""Rows as keyed JSON messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_messages(df: DataFrame, key: str | Column, columns: list[str] | None = None) -> DataFrame:
    """``key`` and ``value`` (one JSON object per row), the shape a topic sink takes."""
    key = F.col(key) if isinstance(key, str) else key
    body = F.to_json(F.struct(*(columns or df.columns)))
    return df.select(key.cast("string").alias("key"), body.alias("value"))


def send(messages: DataFrame, brokers: str, topic: str) -> None:
    """Publish to a topic; needs the Kafka connector on the classpath."""
    (
        messages.write.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("kafka.acks", "all")
        .option("topic", topic)
        .save()
    )
