"""Bronze tables to clean, de-duplicated and enriched Silver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession

from stratalake.config import LakeConfig
from stratalake.operators import clean, rules
from stratalake.operators.enrich import enrich
from stratalake.operators.lineage import clocked
from stratalake.operators.quality import counted_report, require_rows
from stratalake.sinks.tables import SORTED_ROW_GROUP, clustered_for, sorted_inside, store, store_counted, write_table
from stratalake.sources.files import read_table

CLEANINGS = {"ventas": clean.SALES, "web_events": clean.WEB_EVENTS, "productos": clean.PRODUCTS}
MONTH = ("anio_mes",)


def run_silver(
    spark: SparkSession, cfg: LakeConfig, keep_rejects: bool = False, lenient_int: bool = False
) -> dict[str, DataFrame]:
    """Each table is written once; everything after that reads the written table.

    The write itself counts rows and rule hits. Counts on the way to a shuffle may be taken twice where an executor is
    lost; hits that do not add up to the rows of the Bronze table, which its files know, are counted again.
    """
    tables, counts, hits = {}, {}, {}
    for name, cleaning in CLEANINGS.items():
        raw = read_table(spark, cfg.bronze(name), f"bronze_{name}", cfg.fmt)
        seen = Observation()
        rows = clocked(cleaning.clean(raw, lenient_int, seen), "processed_at")
        by = MONTH if "anio_mes" in rows.columns else ()
        tables[name], counts[name] = store_counted(
            clustered_for(rows, *by) if by else rows, cfg.silver(name), name, cfg.fmt, partition_by=by
        )
        hits[name] = cleaning.rules, seen.get
        if seen.get.get("n") != raw.count():
            typed = cleaning.project(raw, lenient_int=lenient_int)
            again = typed.agg(*[c.alias(n) for n, c in rules.counters(cleaning.rules).items()])
            hits[name] = cleaning.rules, again.first().asDict()
        if keep_rejects:
            rejects = cleaning.rejects(cleaning.project(raw, lenient_int=lenient_int))
            write_table(rejects, cfg.silver(f"{name}_rechazos"), cfg.fmt)

    enriched, counts["ventas_enriquecidas"] = enriched_sales(tables["ventas"], tables["productos"], cfg)
    tables["ventas_enriquecidas"] = enriched
    write_table(clocked(rules.counted_hits(spark, hits)).coalesce(1), cfg.silver("data_quality_rules"), cfg.fmt)
    report = clocked(counted_report(spark, counts)).coalesce(1)
    tables["data_quality_report"] = store(
        report, cfg.silver("data_quality_report"), "data_quality_report", cfg.fmt
    )
    require_rows(tables)
    return tables


def enriched_sales(sales: DataFrame, products: DataFrame, cfg: LakeConfig) -> tuple[DataFrame, int]:
    """The enriched table and its number of rows; files are in order of the amount, which the top sales ask for."""
    rows = clustered_for(clocked(enrich(sales, products), "processed_at"), *MONTH)
    rows = sorted_inside(rows, "monto", partition_by=MONTH)
    path = cfg.silver("ventas_enriquecidas")
    return store_counted(
        rows, path, "ventas_enriquecidas", cfg.fmt, partition_by=MONTH, row_group_bytes=SORTED_ROW_GROUP
    )
