"""One DataFrame query per operator; each takes (spark, folder of the tables)."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from stratalake.config import DEFAULT_TOPIC, GOLD_CATALOG, GOLD_TABLES, LakeConfig
from stratalake.functions.numbers import round_half_up
from stratalake.functions.once import once
from stratalake.operators import clean, fleet, pareto, quality, rules, sales, variant
from stratalake.operators.enrich import enrich
from stratalake.operators.lineage import stamp
from stratalake.plans.bronze import run_bronze
from stratalake.plans.gold import run_gold
from stratalake.plans.publish import MANIFEST, run_publish
from stratalake.session import run_dir
from stratalake.sinks import buckets
from stratalake.sinks import tables as sinks
from stratalake.sinks.messages import as_messages
from stratalake.sources import files, messages, schemas, star
from stratalake.streaming import gps, runs

Query = Callable[[SparkSession, str], DataFrame]


def portable(df: DataFrame) -> DataFrame:
    """Same column types on every engine: dates as text, instants without zone, decimals as doubles."""

    def plain(name: str, kind: str):
        column = F.col(f"`{name}`")
        if kind == "date":
            return column.cast("string").alias(name)
        if kind == "timestamp":
            return column.cast("timestamp_ntz").alias(name)
        if kind.startswith("decimal"):
            return column.cast("double").alias(name)
        return column

    return df.select(*[plain(name, kind) for name, kind in df.dtypes])


# --- cleaning, de-duplication, enrichment ---------------------------------------------------------


def dedup_sales(spark, folder):
    return star.newest_lines(spark, folder).drop("l_quantity")


def clean_sales(spark, folder):
    typed = clean.SALES.project(star.raw_sales(spark, folder), carry=[])
    return clean.SALES.accepted(typed).withColumns(clean.SALES.calendar())


def clean_sales_lenient(spark, folder):
    """Quantities such as "3.7" read as 3."""
    typed = clean.SALES.project(star.raw_sales(spark, folder), carry=[], lenient_int=True)
    return clean.SALES.accepted(typed).select("id_venta", "id_cliente", "id_producto", "cantidad", "monto")


def clean_sales_rejects(spark, folder):
    typed = clean.SALES.project(star.raw_sales(spark, folder), carry=[])
    rejects = clean.SALES.rejects(typed)
    return rejects.withColumn("failed_rules", F.concat_ws("|", clean.FAILED)).drop(clean.FAILED)


def silver_sales(spark, folder):
    return clean.SALES.clean(star.raw_sales(spark, folder)).drop("_ingestion_timestamp")


#: A task holds a bucket of the sales, so there are as many buckets as sales ask for, and 16 at least.
SALES_A_BUCKET = 500_000


def _buckets(spark, folder, most: int = SALES_A_BUCKET) -> int:
    return max(16, -(-star.table(spark, folder, "lineitem").count() // most))


def silver_sales_in_buckets(spark, folder):
    """Three batches, one after another, merged into a table in buckets of the sale's id."""
    raw, place, n = star.raw_sales(spark, folder), run_dir(spark, "buckets"), _buckets(spark, folder)
    typed = clean.SALES.accepted(clean.SALES.project(raw, carry=["_ingestion_timestamp"]))
    for part in range(3):
        batch = typed.where(F.pmod(F.xxhash64("monto"), F.lit(3)) == part)
        table = buckets.add_batch(batch, place, clean.SALES.keys, ["_ingestion_timestamp"], n)
    return table.withColumns(clean.SALES.calendar()).drop("_ingestion_timestamp")


def enrich_sales_in_buckets(spark, folder):
    """The catalogue in buckets of its id: joined as it lies, whatever its size."""
    place = run_dir(spark, "catalogue")
    products = buckets.add_batch(star.productos(spark, folder), place, ["id_producto"], [], _buckets(spark, folder))
    return enrich(star.ventas(spark, folder), products).select(star.ventas_enriquecidas(spark, folder).columns)


def clean_web(spark, folder):
    return clean.WEB_EVENTS.clean(star.raw_web(spark, folder))


def clean_products(spark, folder):
    return clean.PRODUCTS.clean(star.raw_products(spark, folder))


def enrich_sales(spark, folder):
    return star.ventas_enriquecidas(spark, folder)


# --- sales and web KPIs ---------------------------------------------------------------------------


def kpi_overall(spark, folder):
    return sales.overall(star.ventas_enriquecidas(spark, folder))


def _customers(spark, folder) -> DataFrame:
    return sales.by_customer(sales.sales_rollup(star.customer_lines(spark, folder), sales.CUSTOMER_KEYS))


def kpi_monthly(spark, folder):
    return sales.monthly(sales.sales_rollup(star.ventas_enriquecidas(spark, folder), sales.MONTH_KEYS, margin=True))


def kpi_customer(spark, folder):
    return sales.customer_averages(_customers(spark, folder))


def kpi_category_channel(spark, folder):
    return sales.by_category_channel(sales.sales_rollup(star.ventas_enriquecidas(spark, folder), sales.CHANNEL_KEYS))


def kpi_web(spark, folder):
    return sales.web_activity(star.web_silver(spark, folder))


def kpi_monthly_bitmap(spark, folder):
    """From a rollup with bitmaps of customers: a row for a month and 32,768 ids."""
    return sales.monthly(sales.bitmap_rollup(star.ventas_enriquecidas(spark, folder), ("anio_mes",), margin=True))


def kpi_category_channel_bitmap(spark, folder):
    return sales.by_category_channel(sales.bitmap_rollup(star.ventas_enriquecidas(spark, folder), ("categoria_final", "canal")))


def kpi_overall_bitmap(spark, folder):
    """From a written rollup by month, whose bitmaps are merged, and bitmaps of the table's product ids."""
    table = _enriched_table(spark, folder)
    months = sinks.store(sales.bitmap_rollup(table, ("anio_mes",), margin=True), run_dir(spark, "months"), "month_rollup")
    return sales.overall_of_table(months, table)


def kpi_web_bitmap(spark, folder):
    return sales.web_activity_by_bitmaps(star.web_silver(spark, folder))


def rollup_rows(spark, folder):
    """Rows of the rollups with a row for each customer and of those with bitmaps."""
    table = _enriched_table(spark, folder)
    months, channels = sales.MONTH_KEYS[:1], sales.CHANNEL_KEYS[:2]
    rollups = {
        "meses por cliente": sales.sales_rollup(table, sales.MONTH_KEYS),
        "meses con mapas": sales.bitmap_rollup(table, months),
        "canales por cliente": sales.sales_rollup(table, sales.CHANNEL_KEYS),
        "canales con mapas": sales.bitmap_rollup(table, channels),
    }
    return reduce(DataFrame.unionByName, [quality.counted(df, rollup=name) for name, df in rollups.items()])


def top_customer(spark, folder):
    return sales.top_customer(_customers(spark, folder))


def top10_sales(spark, folder):
    """The ten lines are taken first and only they are joined: every line has its order and customer."""
    lines = star.newest_lines(spark, folder).orderBy(F.desc("monto"), "id_venta").limit(10)
    return sales.top_sales(star.ventas_enriquecidas(spark, folder, lines))


def pareto_customers(spark, folder):
    return pareto.pareto(_customers(spark, folder))


def pareto_summary(spark, folder):
    return pareto.pareto_summary(pareto_customers(spark, folder))


# --- fleet ----------------------------------------------------------------------------------------


def gps_scored(spark, folder):
    return star.gps(spark, folder)


def gps_prepared(spark, folder):
    return fleet.prepare(star.gps(spark, folder)).select(
        "event_id", "camion", "timestamp_evento", "fecha_evento", "hora_evento", "anio_mes", "nivel_riesgo",
        "alerta_operativa",
    )


def _fleet_rollup(spark, folder) -> DataFrame:
    return fleet.fleet_rollup(fleet.prepare(star.gps(spark, folder)))


def fleet_overall(spark, folder):
    return fleet.overall(_fleet_rollup(spark, folder))


def fleet_zone(spark, folder):
    return fleet.by_zone(_fleet_rollup(spark, folder))


def fleet_hour(spark, folder):
    return fleet.by_hour(_fleet_rollup(spark, folder))


def fleet_status(spark, folder):
    return fleet.by_status(_fleet_rollup(spark, folder))


def fleet_alerts(spark, folder):
    return fleet.sorted_alerts(fleet.prepare(star.gps(spark, folder)))


def fleet_overall_extremes(spark, folder):
    """Measures of 1e21, 1e25, 1e30 and NaN now and then neither stop the run nor blank a KPI."""
    return fleet.overall(fleet.fleet_rollup(fleet.prepare(star.gps_with_extremes(spark, folder))))


def fleet_rejects(spark, folder):
    rejects = fleet.rejects(star.gps_with_extremes(spark, folder))
    return rejects.select("event_id", "camion", F.concat_ws("|", "_failed_rules").alias("failed_rules"))


def gps_messages(spark, folder):
    """Keyed JSON messages, read back with the schema on arrival."""
    sent = as_messages(star.gps(spark, folder).drop("timestamp_evento"), "camion")
    got = once(sent, ["key"], {"got": F.from_json("value", schemas.GPS_MESSAGE)})
    return got.select("key", *[F.col("got")[c].alias(c) for c in schemas.GPS_COLUMNS if c != "timestamp_evento"])


def gps_parse_json(spark, folder):
    """Envelope with some unreadable messages and some wrong field types, parsed."""
    parsed = gps.parse(star.envelope(spark, folder, faulty=True))
    return parsed.drop("_raw_message")


def gps_unreadable(spark, folder):
    parsed = gps.parse(star.envelope(spark, folder, faulty=True))
    return gps.unreadable(parsed).select(*gps.MESSAGE_ID, "_message_key", "_raw_message")


# --- streaming: every stream is run to its present end into files -----------------------------------


def _drained(spark, rows: DataFrame, name: str) -> DataFrame:
    place = run_dir(spark, name)
    runs.start_append(rows, f"{place}/table", f"{place}/checkpoint").awaitTermination()
    return files.read_table(spark, f"{place}/table", name)


def stream_bronze(spark, folder):
    envelope = star.as_envelope(star.gps_of(star.events_stream(spark, folder)), faulty=True)
    rows = _drained(spark, gps.bronze(envelope), "stream_bronze")
    return rows.drop("_raw_message", "_ingestion_timestamp")


def stream_bounded_run(spark, folder):
    """A run that is bounded in time, long enough here to come to the end of the feed."""
    place, cfg = run_dir(spark, "bounded"), LakeConfig(root=run_dir(spark, "bounded"), runtime_seconds=600)
    envelope = star.as_envelope(star.gps_of(star.events_stream(spark, folder)))
    query = runs.start_append(gps.parse(envelope), f"{place}/table", f"{place}/checkpoint")
    ended = runs.run_for(query, cfg.runtime_seconds)
    table = files.read_table(spark, f"{place}/table", "bounded")
    return table.select(*gps.MESSAGE_ID, "event_id", "camion", "timestamp_evento").withColumn("ended", F.lit(ended and not query.isActive))


def stream_alerts(spark, folder):
    prepared = fleet.prepare(star.gps_of(star.events_stream(spark, folder)))
    return _drained(spark, fleet.alerts(prepared), "stream_alerts")


#: A task reads a file of landed messages whole, so files are of so many messages and a micro-batch takes several of them.
MESSAGES_A_FILE = 100_000


def _landed_envelope(spark, folder, redelivered: bool = False, batches: int = 4, most: int = MESSAGES_A_FILE) -> tuple[str, int]:
    """Messages written as files for so many micro-batches, some of them twice if asked for; the folder, and the files a batch."""
    place = run_dir(spark, "envelope")
    rows = star.envelope(spark, folder)
    files = -(-star.table(spark, folder, "events").count() // (batches * most)) or 1
    if redelivered:
        rows = rows.unionByName(rows.filter(F.col("offset") % 7 == 0))
    rows.repartition(batches * files, "offset").write.parquet(place)
    return place, files


def stream_hourly(spark, folder):
    """All hours: the feed is followed to its end, then closed, and followed on from the same checkpoint."""
    (feed, _), place = _landed_envelope(spark, folder), run_dir(spark, "stream_hourly")

    def follow():
        stream = messages.envelope_files_stream(spark, feed)
        hours = gps.hourly(fleet.prepare(gps.parse(stream)))
        runs.start_append(hours, f"{place}/table", f"{place}/checkpoint").awaitTermination()

    follow()
    last = spark.read.parquet(feed).agg(F.max("timestamp") + F.expr("interval 1 day")).first()[0]
    gps.end_of_feed(spark, str(last), DEFAULT_TOPIC).write.mode("append").parquet(feed)
    follow()
    return files.read_table(spark, f"{place}/table", "stream_hourly")


def stream_dedup(spark, folder):
    place, _ = _landed_envelope(spark, folder, redelivered=True)
    stream = messages.envelope_files_stream(spark, place)
    rows = _drained(spark, gps.once_each(gps.parse(stream)), "stream_dedup")
    return rows.select(*gps.MESSAGE_ID, "event_id", "camion", "timestamp_evento")


def _live_fleet(spark, folder, name: str, approximate: bool = False, batches: int = 4) -> DataFrame:
    """Live table after a stream has been followed to its end in so many micro-batches, with merges of the changed totals on
    the way; one run for a session, folder and kind serves all that ask."""
    key = spark.sparkContext.applicationId, folder, approximate
    if key not in _LIVE:
        feed, files_a_batch = _landed_envelope(spark, folder, batches=batches)
        stream = messages.envelope_files_stream(spark, feed, maxFilesPerTrigger=files_a_batch)
        place = run_dir(spark, "live_fleet")
        runs.start_fleet_refresh(
            gps.parse(stream), f"{place}/rollup", lambda table: f"{place}/{table}", f"{place}/checkpoint",
            approximate=approximate, merge_every=2,
        ).awaitTermination()
        _LIVE[key] = place
    return files.read_table(spark, f"{_LIVE[key]}/{name}", name).drop("generated_at")


_LIVE: dict[tuple[str, str, bool], str] = {}


def stream_fleet_overall(spark, folder):
    return _live_fleet(spark, folder, "rt_kpis_generales")


def stream_fleet_zone(spark, folder):
    return _live_fleet(spark, folder, "rt_kpis_por_zona")


def stream_fleet_hour(spark, folder):
    return _live_fleet(spark, folder, "rt_toneladas_por_hora")


def _near(estimate: str, exact: str, error: float = 0.05):
    """Estimated numbers are within 5 percent, three standard errors of the sketch."""
    return F.abs(F.col(estimate) - F.col(exact)) <= error * F.col(exact)


def _against_exact(sketched: DataFrame, exact: DataFrame, keys: list[str], trucks: str) -> DataFrame:
    """The estimated table with whether its numbers of trucks are near the exact ones."""
    both = sketched.join(exact.select(*keys, F.col(trucks).alias("_exact")), keys)
    return both.withColumn("cerca", _near(trucks, "_exact")).drop(trucks, "_exact")


def _sketched(spark, folder) -> DataFrame:
    """A written rollup by hour, zone and state that holds sketches of trucks instead of a row for each."""
    rollup = fleet.fleet_rollup(fleet.prepare(star.gps(spark, folder)), fleet.SKETCH_KEYS)
    return sinks.store(rollup, run_dir(spark, "sketched"), "fleet_rollup")


def fleet_hour_sketch(spark, folder):
    """Hours from the sketched rollup, and whether their numbers of trucks are within 5 percent of the exact ones."""
    return _against_exact(fleet.by_hour(_sketched(spark, folder)), fleet_hour(spark, folder), ["fecha_evento", "hora_evento"], "camiones_activos")


def fleet_zone_sketch(spark, folder):
    return _against_exact(fleet.by_zone(_sketched(spark, folder)), fleet_zone(spark, folder), ["zona"], "camiones_activos")


def stream_fleet_status_sketch(spark, folder):
    """The live state table with estimated trucks, merged batch by batch."""
    live = _live_fleet(spark, folder, "rt_estado_flota", approximate=True)
    return _against_exact(live, fleet_status(spark, folder), ["estado_entrega"], "camiones")


# --- layers, files and reports ----------------------------------------------------------------------


def bronze_stamp(spark, folder):
    """Landed rows per lineage mark."""
    rows = stamp(star.raw_sales(spark, folder).drop("_ingestion_timestamp"), "ERP_POS", "CSV", "batch-1")
    return rows.groupBy("_source_system", "_source_format", "_batch_id").agg(
        F.count("_ingestion_timestamp").alias("rows"), F.count_distinct("_ingestion_timestamp").alias("moments")
    )


def layer_roundtrip_csv(spark, folder):
    place = run_dir(spark, "csv")
    sinks.write_csv(star.raw_sales(spark, folder).drop("_ingestion_timestamp"), place)
    columns = [c for c in schemas.SALES_RAW if c != "created_at"]
    landed = files.read_csv(spark, place, "ventas", columns)
    return clean.SALES.accepted(clean.SALES.project(landed))


def layer_roundtrip_json(spark, folder):
    place = run_dir(spark, "json")
    moment = F.date_format("event_timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    sinks.write_json(star.web_events(spark, folder).withColumn("event_timestamp", moment), place)
    landed = files.read_json(spark, place, "web_events", schemas.WEB_RAW)
    return clean.WEB_EVENTS.accepted(clean.WEB_EVENTS.project(landed, carry=[]))


def bronze_json_untidy(spark, folder):
    """Quoted ids, ids written 7.0, unknown fields and broken lines: what is read and what is kept as text."""
    place = run_dir(spark, "json")
    star.untidy_json(spark, folder).write.text(place)
    landed = files.read_json(spark, place, "web_events", schemas.WEB_RAW)
    typed = clean.WEB_EVENTS.project(landed, carry=[files.RAW_LINE])
    return typed.select(
        "event_id", "id_cliente", "page", "event_timestamp",
        F.col(files.RAW_LINE).contains("campo_nuevo").alias("has_extra"),
        F.when(F.col("event_id").isNull(), F.col(files.RAW_LINE)).alias("unread"),
    )


def layer_roundtrip_xml(spark, folder):
    place = run_dir(spark, "xml")
    sinks.write_xml(star.raw_products(spark, folder), place, "productos", schemas.PRODUCT_ROW_TAG)
    landed = files.read_xml(spark, place, schemas.PRODUCT_ROW_TAG, schemas.PRODUCT_RAW)
    return clean.PRODUCTS.accepted(clean.PRODUCTS.project(landed))


def layer_roundtrip_xml_split(spark, folder):
    """One file, read by several tasks."""
    place = run_dir(spark, "xml")
    sinks.write_xml(star.raw_products(spark, folder).coalesce(1), place, "productos", schemas.PRODUCT_ROW_TAG, rows_a_file=0)
    landed = files.read_xml(spark, place, schemas.PRODUCT_ROW_TAG, schemas.PRODUCT_RAW, split=True)
    return clean.PRODUCTS.accepted(clean.PRODUCTS.project(landed))


def month_partitions(spark, folder):
    """A month-partitioned table written with balanced tasks and read back."""
    rows = sinks.clustered_for(star.ventas(spark, folder), "anio_mes")
    table = sinks.store(rows, run_dir(spark, "months"), "ventas", partition_by=("anio_mes",))
    return table.groupBy("anio_mes").agg(
        F.count("id_venta").alias("ventas"),
        round_half_up(sales.AMOUNT.total_of_rows(), 2).alias("ingreso_total"),
        F.max("fecha_venta").alias("hasta"),
    )


def _enriched_table(spark, folder) -> DataFrame:
    """Written in order of the amount inside each file, as the Silver job does."""
    rows = sinks.sorted_inside(star.ventas_enriquecidas(spark, folder), "monto")
    return sinks.store(rows, run_dir(spark, "enriched"), "ventas_enriquecidas", row_group_bytes=sinks.SORTED_ROW_GROUP)


def kpi_overall_of_table(spark, folder):
    """As the Gold run does it: from the rollup and the product column of the written table."""
    table = _enriched_table(spark, folder)
    return sales.overall_of_table(sales.sales_rollup(table, sales.MONTH_KEYS, margin=True), table)


def top10_sales_of_table(spark, folder):
    return sales.top_sales_of_table(_enriched_table(spark, folder))


def quality_report(spark, folder):
    """Rows as the writes of the tables counted them."""
    tables = {
        "ventas": silver_sales(spark, folder),
        "web_events": clean_web(spark, folder),
        "productos": clean_products(spark, folder),
        "ventas_enriquecidas": enrich_sales(spark, folder),
    }
    # The tables do not read each other, so the last tasks of one write run beside the first of another.
    written = sinks.side_by_side(partial(sinks.store_counted, df, run_dir(spark, name), name) for name, df in tables.items())
    return quality.counted_report(spark, {name: count for name, (_, count) in zip(tables, written)})


def silver_rule_hits(spark, folder):
    """Rule hits as counted while the Silver tables were written."""
    parts = {"ventas": (clean.SALES, star.raw_sales), "web_events": (clean.WEB_EVENTS, star.raw_web), "productos": (clean.PRODUCTS, star.raw_products)}
    counted = {}
    for name, (cleaning, raw) in parts.items():
        seen = Observation()
        sinks.store(cleaning.clean(raw(spark, folder), seen=seen), run_dir(spark, name), name)
        counted[name] = cleaning.rules, seen.get
    return rules.counted_hits(spark, counted).drop("table_name")


def fleet_rule_hits(spark, folder):
    return fleet.rule_hits(star.gps_with_extremes(spark, folder))


def _untidy_lines(spark, folder) -> DataFrame:
    place = run_dir(spark, "json")
    star.untidy_json(spark, folder).write.text(place)
    return files.read_json(spark, place, "web_events", schemas.WEB_RAW)


def json_unknown_fields(spark, folder):
    """Fields that have no column, by type, and in how many lines they stand."""
    return variant.unknown_fields(_untidy_lines(spark, folder), schemas.WEB_RAW)


def json_unknown_values(spark, folder):
    """Values of a field that nobody named, and of one under another type."""
    landed = _untidy_lines(spark, folder)
    return landed.select(
        F.col("event_id").cast("bigint").alias("event_id"),
        variant.field("$.campo_nuevo", "bigint").alias("campo_nuevo"),
        variant.field("$.page", "string").alias("page"),
    ).where("campo_nuevo is not null")


def quality_rule_hits(spark, folder):
    parts = [
        (clean.SALES, star.raw_sales),
        (clean.WEB_EVENTS, star.raw_web),
        (clean.PRODUCTS, star.raw_products),
    ]
    hits = [c.rule_hits(c.project(raw(spark, folder), carry=[])) for c, raw in parts]
    return reduce(DataFrame.unionByName, hits)


def bronze_audit(spark, folder):
    """Landing files to Bronze; what the audit table says of the batch."""
    cfg = LakeConfig(root=run_dir(spark, "landing"))
    sinks.write_csv(star.raw_sales(spark, folder).drop("_ingestion_timestamp"), cfg.landing("ventas"))
    star.untidy_json(spark, folder).write.text(cfg.landing("web_events"))
    sinks.write_xml(star.raw_products(spark, folder), cfg.landing("productos"), "productos", schemas.PRODUCT_ROW_TAG)
    run_bronze(spark, cfg)
    audit = files.read_table(spark, cfg.bronze("audit_ingestion"), "audit_ingestion")
    return audit.select(
        "layer", "dataset", "source_format", "target_path", "record_count", (F.col("batch_id") == cfg.batch_id).alias("this_batch")
    )


_RUNS: dict[tuple[str, str], LakeConfig] = {}


def _published(spark, folder) -> LakeConfig:
    """Gold run over written Silver tables, then the extracts; one run for a session and folder serves all that ask."""
    key = spark.sparkContext.applicationId, folder
    if key not in _RUNS:
        cfg = LakeConfig(root=run_dir(spark, "gold"))
        sinks.write_table(star.ventas_enriquecidas(spark, folder), cfg.silver("ventas_enriquecidas"))
        sinks.write_table(star.web_silver(spark, folder), cfg.silver("web_events"))
        run_gold(spark, cfg)
        run_publish(spark, cfg)
        _RUNS[key] = cfg
    return _RUNS[key]


def publish_manifest(spark, folder):
    """Status of each data set, with the rows of its extract; the fleet tables have not been made."""
    cfg = _published(spark, folder)
    manifest = files.read_csv(spark, cfg.extract(f"final/{MANIFEST}"), MANIFEST)
    done = [r.dataset for r in manifest.collect() if r.status == "EXPORTED"]
    rows = [quality.counted(files.read_csv(spark, cfg.extract(f"final/{n}"), n), dataset=n) for n in done]
    return manifest.join(reduce(DataFrame.unionByName, rows), "dataset", "left").select(
        "dataset", "status", "message", "record_count"
    )


def publish_catalog(spark, folder):
    """The Gold catalogue as written, with the rows of each table that it lists."""
    cfg = _published(spark, folder)
    listed = files.read_table(spark, cfg.gold(GOLD_CATALOG), GOLD_CATALOG)
    rows = [quality.counted(files.read_table(spark, cfg.gold(n), n), table_name=f"gold_{n}") for n in GOLD_TABLES]
    return listed.join(reduce(DataFrame.unionByName, rows), "table_name").select(
        "table_name", "powerbi_path", "layer", "record_count"
    )


def publish_pareto(spark, folder):
    """Values of the published Pareto table, and whether each file of it is in order."""
    cfg = _published(spark, folder)
    rows = files.read_csv(spark, cfg.extract("final/pareto_80_clientes"), "pareto_80_clientes").withColumns(
        {"at": F.monotonically_increasing_id(), "part": F.spark_partition_id()}
    )
    rank = F.col("ranking_cliente").cast("bigint")
    last = F.max(rank).over(Window.partitionBy("part").orderBy("at").rowsBetween(Window.unboundedPreceding, -1))
    kinds = {"cantidad_ventas": "bigint", "total_comprado": "double", "ingreso_global": "double", "ingreso_acumulado": "double",
             "porcentaje_acumulado": "double", "id_cliente": "bigint"}
    return rows.select(
        *[F.col(c).cast(k).alias(c) for c, k in kinds.items()], rank.alias("ranking_cliente"),
        "porcentaje_acumulado_label", "segmento_pareto", F.coalesce(last < rank, F.lit(True)).alias("in_order"),
    )


def post_write_check(spark, folder):
    """Which of the written Gold tables have rows; the live alerts of a feed without any have none."""
    cfg = _published(spark, folder)
    tables = {name: files.read_table(spark, cfg.gold(name), name) for name in GOLD_TABLES}
    calm = fleet.prepare(star.gps(spark, folder)).where("false")
    tables["rt_alertas_operativas"] = sinks.store(fleet.alerts(calm), run_dir(spark, "alerts"), "rt_alertas_operativas")
    return quality.row_check(tables)


def publish_gold(spark, folder):
    """Rows of each published extract."""
    cfg = _published(spark, folder)
    rows = [
        quality.counted(files.read_csv(spark, cfg.extract(f"final/{name}"), name), dataset=name)
        for name in GOLD_TABLES
    ]
    return reduce(DataFrame.unionByName, rows)


REGISTERED: list[Query] = [
    dedup_sales, clean_sales, clean_sales_lenient, clean_sales_rejects, silver_sales, silver_sales_in_buckets, enrich_sales_in_buckets, clean_web, clean_products,
    enrich_sales, kpi_overall, kpi_monthly, kpi_customer, kpi_category_channel, kpi_web, kpi_monthly_bitmap, kpi_category_channel_bitmap, kpi_overall_bitmap, kpi_web_bitmap, rollup_rows, top_customer, top10_sales,
    pareto_customers, pareto_summary, gps_scored, gps_prepared, fleet_overall, fleet_zone, fleet_hour, fleet_status,
    fleet_alerts, fleet_overall_extremes, fleet_rejects, bronze_json_untidy, gps_messages, gps_parse_json, gps_unreadable, stream_bronze, stream_bounded_run, stream_alerts, stream_hourly,
    stream_dedup, stream_fleet_overall, stream_fleet_zone, stream_fleet_hour, stream_fleet_status_sketch, fleet_hour_sketch, fleet_zone_sketch, bronze_stamp, layer_roundtrip_csv, layer_roundtrip_json,
    bronze_audit, publish_manifest, publish_catalog, publish_pareto, layer_roundtrip_xml, layer_roundtrip_xml_split, month_partitions, kpi_overall_of_table, top10_sales_of_table, quality_report, quality_rule_hits, silver_rule_hits, fleet_rule_hits, json_unknown_fields, json_unknown_values, post_write_check, publish_gold,
]


def _registered(query: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return portable(query(spark, folder))

    run.__name__ = query.__name__
    run.__doc__ = query.__doc__
    return run


QUERIES: dict[str, Query] = {query.__name__: _registered(query) for query in REGISTERED}
