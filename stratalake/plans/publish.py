"""Publish the Gold tables as CSV extracts with a manifest."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from stratalake.config import PUBLISHED, LakeConfig
from stratalake.sinks.tables import write_dataset_extract, write_extract
from stratalake.sources.files import MissingDataset, read_table

MANIFEST = "powerbi_manifest"
MANIFEST_SCHEMA = (
    "dataset string, status string, source string, target string, message string, generated_at_utc string"
)
# Manifest messages.
DONE = "Exportado correctamente"
NOT_FOUND = "Carpeta no encontrada"


def run_publish(spark: SparkSession, cfg: LakeConfig, datasets: list[str] | None = None) -> DataFrame:
    """Export each Gold table; a missing or failing one is noted and does not stop the others."""
    results = []
    for name in datasets or PUBLISHED:
        source, target = cfg.gold(name), cfg.extract(f"final/{name}")
        try:
            write_dataset_extract(read_table(spark, source, name, cfg.fmt), target, name)
            outcome = ("EXPORTED", source, target, DONE)
        except MissingDataset:
            outcome = ("SKIPPED", source, target, NOT_FOUND)
        except Exception as error:  # noqa: BLE001 - the manifest reports it
            outcome = ("ERROR", source, target, " ".join(str(error).split()))
        results.append((name, *outcome, datetime.now(timezone.utc).isoformat()))
    manifest = spark.createDataFrame(results, MANIFEST_SCHEMA).coalesce(1)
    write_extract(manifest, cfg.extract(f"final/{MANIFEST}"))
    return manifest
