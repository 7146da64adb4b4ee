"""Small helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.session import run_dir

#: A word of the whitespace-separated kind, in Java's and in DuckDB's regular expressions.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared folder and read back; the table goes when the application ends."""
    path = run_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and leave every other character alone."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def order_id(name: str = "doc_id") -> Column:
    """doc_id for ordering: a null id comes after all others."""
    return F.coalesce(F.col(name).cast("bigint"), F.lit(2**63 - 1))


def pieces(batches: Iterator[pa.RecordBatch], column: int, limit: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of the batches whose ``column`` (binary) holds about ``limit`` bytes, or one long row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        start = 0
        lengths = batch.column(column).cast(pa.large_binary())
        ends = memoryview(lengths.buffers()[1]).cast("q")[lengths.offset : lengths.offset + len(lengths) + 1]
        for i in range(batch.num_rows):
            size = ends[i + 1] - ends[start]
            if size >= limit:
                yield batch.slice(start, i + 1 - start)
                start = i + 1
        if start < batch.num_rows:
            yield batch.slice(start)
