"""Silver tables to Gold KPI tables with their BI extracts."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stratalake.config import FLEET_CATALOG, GOLD_CATALOG, MAY_BE_EMPTY, STREAM_TABLE, LakeConfig
from stratalake.operators import fleet, pareto, quality, rules, sales
from stratalake.operators.lineage import clocked
from stratalake.sinks.tables import side_by_side, store, write_dataset_extract, write_table
from stratalake.sources.files import read_table
from stratalake.streaming.runs import fleet_tables


def publishable(df: DataFrame, cfg: LakeConfig, name: str) -> DataFrame:
    """Write a Gold table and, from the written table, its extract."""
    table = store(clocked(df), cfg.gold(name), f"gold_{name}", cfg.fmt)
    write_dataset_extract(table, cfg.extract(name), name)
    return table


def publish_all(outputs: dict[str, DataFrame], cfg: LakeConfig) -> dict[str, DataFrame]:
    written = side_by_side(partial(publishable, df, cfg, name) for name, df in outputs.items())
    return dict(zip(outputs, written))


MONTHS, CHANNELS = ("anio_mes",), ("categoria_final", "canal")


def by_customers(rows: DataFrame, keys: tuple[str, ...], margin: bool = False) -> DataFrame:
    return sales.sales_rollup(rows, (*keys, "id_cliente"), margin=margin)


def run_gold(spark: SparkSession, cfg: LakeConfig) -> dict[str, DataFrame]:
    """All batch KPI tables, from narrow rollups of the written sales: by month, by channel and by customer.

    Where customer ids are dense, the first two hold bitmaps of customers instead of a row for each of them.
    """
    enriched = read_table(spark, cfg.silver("ventas_enriquecidas"), "silver_ventas_enriquecidas", cfg.fmt)
    web = read_table(spark, cfg.silver("web_events"), "silver_web_events", cfg.fmt)
    rollup = sales.bitmap_rollup if sales.dense(enriched) else by_customers
    months = store(rollup(enriched, MONTHS, margin=True), cfg.path("rollup", "meses"), "month_rollup")
    channels = rollup(enriched, CHANNELS)
    # a customer's months, where there are such rows, are all that the customer table needs of the sales
    customers = sales.sales_rollup(enriched) if sales.MEMBERS in months.columns else months
    customers = store(sales.by_customer(customers), cfg.path("rollup", "clientes"), "customer_rollup")
    tables = publish_all(
        {
            "kpis_generales": sales.overall_of_table(months, enriched),
            "ventas_mensuales": sales.monthly(months),
            "cliente_mayor_volumen": sales.top_customer(customers),
            "top10_ventas": sales.top_sales_of_table(enriched),
            "promedio_venta_cliente": sales.customer_averages(customers),
            "pareto_80_clientes": pareto.pareto(customers),
            "ventas_categoria_canal": sales.by_category_channel(channels),
            "web_kpis": sales.web_activity_by_bitmaps(web) if sales.dense(web) else sales.web_activity(web),
            GOLD_CATALOG: quality.gold_catalog(spark).coalesce(1),
        },
        cfg,
    )
    # The summary reads the written Pareto table instead of ranking the customers again.
    tables |= publish_all({"resumen_pareto": pareto.pareto_summary(tables["pareto_80_clientes"])}, cfg)
    quality.require_rows(tables)
    return tables


def run_fleet(spark: SparkSession, cfg: LakeConfig) -> dict[str, DataFrame]:
    """All fleet KPI tables from the stream table: one pass for the rollup, one for the alerts, one for the rejects.

    Events that break a rule, unreadable messages among them, are kept in a table with the rules' names; the pass for the
    rollup counts the hits of each rule, or they are counted again where that does not add up (see ``run_silver``).
    """
    rows = read_table(spark, cfg.bronze(STREAM_TABLE), f"bronze_{STREAM_TABLE}", cfg.fmt)
    prepared, seen = fleet.prepare(rows), Observation()
    rollup = store(fleet.fleet_rollup(fleet.prepare(rows, seen)), cfg.path("rollup", "gps"), "fleet_rollup")
    write_table(fleet.rejects(rows), cfg.silver("gps_rechazos"), cfg.fmt)
    if seen.get.get("n") == rows.count():
        hits = rules.counted_hits(spark, {"gps": (fleet.EVENT_RULES, seen.get)})
    else:
        hits = fleet.rule_hits(rows).select(F.lit("gps").alias("table_name"), "*")
    write_table(clocked(hits).coalesce(1), cfg.silver("gps_data_quality_rules"), cfg.fmt)
    outputs = {
        **fleet_tables(rollup),
        "rt_alertas_operativas": fleet.sorted_alerts(prepared),
        FLEET_CATALOG: quality.fleet_catalog(spark).coalesce(1),
    }
    tables = publish_all(outputs, cfg)
    quality.require_rows(tables, MAY_BE_EMPTY)
    return tables
