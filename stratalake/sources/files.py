"""Landing-file readers. Each checks that its input exists and names it when it does not."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.sinks.versions import read_current, read_version
from stratalake.sources.xml_split import records


class MissingDataset(FileNotFoundError):
    """A landing file or a layer table that a step needs is not there."""


# A folder without a data file, such as one whose first write has not ended, is no data set yet.
NOT_THERE = {"PATH_NOT_FOUND", "DELTA_TABLE_NOT_FOUND", "DELTA_PATH_DOES_NOT_EXIST", "UNABLE_TO_INFER_SCHEMA"}


def _guarded(read: Callable[[], DataFrame], name: str, path: str) -> DataFrame:
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() in NOT_THERE:
            raise MissingDataset(f"dataset {name} not found: {path}") from error
        raise


def all_strings(columns: list[str]) -> str:
    return ", ".join(f"`{c}` string" for c in columns)


def read_csv(spark: SparkSession, path: str, name: str = "csv", columns: list[str] | None = None) -> DataFrame:
    """CSV with header, every column a string.

    Without ``columns`` the header decides. A file whose header differs, from ``columns`` or from the
    other files, is an error instead of being read by position.
    """
    reader = spark.read.option("header", True).option("enforceSchema", False)
    if columns:
        reader = reader.schema(all_strings(columns))
    return _guarded(lambda: reader.csv(path), name, path)


RAW_LINE = "_raw_line"


def read_json(spark: SparkSession, path: str, name: str, columns: list[str]) -> DataFrame:
    """JSON lines: the named fields as text, whatever their JSON type, and the line itself in ``_raw_line``.

    Nothing is lost: fields without a column, and lines that are no JSON object (all their fields are NULL), are
    still there as text. Blank lines are passed over. There is no inference pass over the input.
    """
    lines = _guarded(lambda: spark.read.text(path), name, path).where(r"value rlike '\\S'")
    record = F.from_json("value", all_strings(columns))
    return lines.select(record.alias("r"), F.col("value").alias(RAW_LINE)).select("r.*", RAW_LINE)


def read_xml(
    spark: SparkSession, path: str, row_tag: str, columns: list[str], name: str = "xml", split: bool = False
) -> DataFrame:
    """One row per ``row_tag`` element; a missing child element is NULL.

    With ``split`` a large file is read by several tasks, which takes two passes over it (``xml_split``). Files that declare
    an encoding other than UTF-8 are read by one task each all the same.
    """
    if split:
        found = _guarded(lambda: records(spark, path, row_tag), name, path)
        if found is not None:
            row = F.from_xml("record", all_strings(columns), {"rowTag": row_tag})
            return found.select(row.alias("r")).select("r.*")
    reader = spark.read.schema(all_strings(columns)).option("rowTag", row_tag)
    return _guarded(lambda: reader.xml(path), name, path)


def read_table(spark: SparkSession, path: str, name: str, fmt: str = "parquet") -> DataFrame:
    """A layer table; of one that is written in versions, the present version."""
    current = read_current(spark, path) if fmt == "parquet" else None
    if current is not None:
        return read_version(spark, path, current)
    return _guarded(lambda: spark.read.format(fmt).load(path), name, path)
