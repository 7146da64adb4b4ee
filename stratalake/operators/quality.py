"""Audit, quality report, catalogue and post-write checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.config import FLEET_TABLES, GOLD_TABLES, QUALITY_RULES

AUDIT_SCHEMA = (
    "batch_id string, layer string, dataset string, source_format string, target_path string, record_count bigint"
)
CATALOG_SCHEMA = "table_name string, description string, powerbi_path string, layer string"


class EmptyTable(ValueError):
    """A table that must hold rows was written empty."""


def counted(df: DataFrame, **labels: str) -> DataFrame:
    """One labelled row with the number of rows of ``df``."""
    count = df.agg(F.count(F.lit(1)).alias("record_count"))
    return count.select(*[F.lit(value).alias(name) for name, value in labels.items()], "record_count")


def quality_report(tables: dict[str, DataFrame], layer: str = "silver") -> DataFrame:
    """Row count and rule text per table. Give written tables: their counts come from file footers."""
    rows = [
        counted(df, layer=layer, table_name=name).withColumn("quality_rule", F.lit(QUALITY_RULES[name]))
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, rows)


REPORT_SCHEMA = "layer string, table_name string, record_count bigint, quality_rule string"


def counted_report(spark: SparkSession, counts: dict[str, int], layer: str = "silver") -> DataFrame:
    """``quality_report`` from row counts that the writes of the tables took."""
    return spark.createDataFrame([(layer, name, n, QUALITY_RULES[name]) for name, n in counts.items()], REPORT_SCHEMA)


def audit(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """(batch_id, layer, dataset, source_format, target_path, record_count) per ingested data set."""
    return spark.createDataFrame(rows, AUDIT_SCHEMA)


def catalog(spark: SparkSession, tables: dict[str, str], layer: str) -> DataFrame:
    rows = [(f"gold_{name}", text, f"data/powerbi/{name}", layer) for name, text in tables.items()]
    return spark.createDataFrame(rows, CATALOG_SCHEMA)


def gold_catalog(spark: SparkSession) -> DataFrame:
    return catalog(spark, GOLD_TABLES, "gold")


def fleet_catalog(spark: SparkSession) -> DataFrame:
    return catalog(spark, FLEET_TABLES, "gold_realtime")


def row_check(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, has_rows) for written tables; one row of each is looked for."""
    checks = [
        df.limit(1).agg((F.count(F.lit(1)) > 0).alias("has_rows")).select(F.lit(name).alias("table_name"), "has_rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, checks)


def require_rows(tables: dict[str, DataFrame], may_be_empty: frozenset[str] = frozenset()) -> None:
    """Raise if a written table has no rows; looks for one row instead of counting."""
    for name, df in tables.items():
        if name not in may_be_empty and df.isEmpty():
            raise EmptyTable(f"table {name} is empty")
