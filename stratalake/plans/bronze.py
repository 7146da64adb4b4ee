"""Landing files to Bronze tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.config import LANDING, LakeConfig
from stratalake.operators.lineage import clocked, stamp
from stratalake.operators.quality import audit, require_rows
from stratalake.operators.variant import unknown_fields
from stratalake.sinks.tables import store_counted, write_table
from stratalake.sources import files, schemas


def landed(spark: SparkSession, cfg: LakeConfig, dataset: str) -> DataFrame:
    path = cfg.landing(dataset)
    if dataset == "ventas":
        return files.read_csv(spark, path, dataset)
    if dataset == "web_events":
        return files.read_json(spark, path, dataset, schemas.WEB_RAW)
    return files.read_xml(spark, path, schemas.PRODUCT_ROW_TAG, schemas.PRODUCT_RAW, dataset, split=True)


def run_bronze(spark: SparkSession, cfg: LakeConfig, report_fields: bool = False) -> dict[str, DataFrame]:
    """Ingest every landing data set under one batch id and record it in the audit table.

    Rows are counted by the write itself. ``report_fields`` adds a table of JSON fields that have no column of their
    own, which reads the lines once more.
    """
    tables, log = {}, []
    for dataset, (_, system, source_format) in LANDING.items():
        rows = stamp(landed(spark, cfg, dataset), system, source_format, cfg.batch_id)
        tables[dataset], count = store_counted(rows, cfg.bronze(dataset), dataset, cfg.fmt)
        log.append((cfg.batch_id, "bronze", dataset, source_format, f"data/bronze/{dataset}", count))
    if report_fields:
        new = unknown_fields(tables["web_events"], schemas.WEB_RAW).withColumn("batch_id", F.lit(cfg.batch_id))
        write_table(clocked(new, "processed_at").coalesce(1), cfg.bronze("campos_nuevos"), cfg.fmt, mode="append")
    audited = clocked(audit(spark, log), "processed_at").coalesce(1)
    write_table(audited, cfg.bronze("audit_ingestion"), cfg.fmt, mode="append")
    logged = files.read_table(spark, cfg.bronze("audit_ingestion"), "audit_ingestion", cfg.fmt)
    require_rows({**tables, "audit_ingestion": logged.where(logged["batch_id"] == cfg.batch_id)})
    return tables
