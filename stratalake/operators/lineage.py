"""Lineage stamps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BATCH_LINEAGE = ["_ingestion_timestamp", "_source_system", "_source_format", "_batch_id"]


def stamp(df: DataFrame, source_system: str, source_format: str, batch_id: str | None = None) -> DataFrame:
    """Say when, from where and in which batch the rows came in. Streams have no batch id."""
    marks = {
        "_ingestion_timestamp": F.current_timestamp(),
        "_source_system": F.lit(source_system),
        "_source_format": F.lit(source_format),
    }
    if batch_id is not None:
        marks["_batch_id"] = F.lit(batch_id)
    return df.withColumns(marks)


def clocked(df: DataFrame, column: str = "generated_at") -> DataFrame:
    return df.withColumn(column, F.current_timestamp())
