"""Star-schema tables shaped into the retail and fleet inputs.

``folder`` holds one parquet file per table. Formulas use integer arithmetic, so that they give the
same values in every engine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.config import DEFAULT_TOPIC
from stratalake.functions.calendar import event_calendar, sale_calendar
from stratalake.functions.numbers import round_half_up
from stratalake.functions.once import once
from stratalake.operators import fleet
from stratalake.operators.dedup import latest
from stratalake.operators.enrich import enrich
from stratalake.sources.schemas import GPS_COLUMNS

# Truck capacities in tons and delivery states with the end of their share of twentieths.
CAPACITIES = [8, 10, 12, 15, 18, 20, 25]
STATES = {"EN_RUTA": 11, "EN_PATIO": 15, "DESCARGANDO": 18, "FINALIZADO": 20}
SOURCE_NAME = "gps_iot_simulado"
DEVICES = ["mobile", "desktop", "tablet"]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def pick(values: list, index: Column) -> Column:
    """The value at a computed zero-based position of a short literal list."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), index.cast("int") + 1)


def sale_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines as sales; the same id_venta may occur several times."""
    return table(spark, folder, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id_venta"),
        F.col("l_partkey").alias("id_producto"),
        F.col("l_quantity").cast("int").alias("cantidad"),
        F.col("l_extendedprice").alias("monto"),
        F.col("l_shipdate").cast("date").alias("fecha_venta"),
        "l_quantity",
        "l_suppkey",
        "l_orderkey",
    )


def newest_lines(spark: SparkSession, folder: str) -> DataFrame:
    newest_by = ["fecha_venta", "monto", "id_producto", "l_suppkey"]
    return latest(sale_lines(spark, folder), ["id_venta"], newest_by)


def with_context(spark: SparkSession, folder: str, lines: DataFrame) -> DataFrame:
    """Add customer, channel, country and category of the order, and the unit price."""
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"),
        F.col("o_custkey").alias("id_cliente"),
        F.expr("substr(o_orderpriority, 3)").alias("canal"),
    )
    customers = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("id_cliente"),
        F.col("c_nationkey").alias("n_nationkey"),
        F.lower("c_mktsegment").alias("categoria"),
    )
    nations = table(spark, folder, "nation").select("n_nationkey", F.col("n_name").alias("pais"))
    context = orders.join(customers.join(nations, "n_nationkey"), "id_cliente")
    # Lines and orders both grow with the data, so neither is a side to broadcast.
    return lines.join(context.hint("merge"), "l_orderkey").select(
        "id_venta",
        "id_cliente",
        "id_producto",
        "cantidad",
        round_half_up(F.col("monto") / F.col("l_quantity"), 2).alias("precio_unitario"),
        "monto",
        "fecha_venta",
        "canal",
        "pais",
        "categoria",
    )


def ventas(spark: SparkSession, folder: str, lines: DataFrame | None = None) -> DataFrame:
    """Sales of the given lines, or of all newest lines."""
    sales = with_context(spark, folder, newest_lines(spark, folder) if lines is None else lines)
    return sales.withColumns(sale_calendar("fecha_venta"))


def customer_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Newest lines with their customer, for reports that need nothing else. Every order has a customer."""
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("id_cliente")
    )
    lines = newest_lines(spark, folder).select("l_orderkey", "id_venta", "cantidad", "monto")
    return lines.join(orders, "l_orderkey").drop("l_orderkey")


def productos(spark: SparkSession, folder: str) -> DataFrame:
    """The catalogue. Every tenth part has been renumbered in it, so some sales find no product."""
    renumbered = F.when(F.col("p_partkey") % 10 == 0, -F.col("p_partkey")).otherwise(F.col("p_partkey"))
    return table(spark, folder, "part").select(
        renumbered.alias("id_producto"),
        F.col("p_name").alias("nombre_producto"),
        F.lower("p_type").alias("categoria"),
        F.col("p_brand").alias("proveedor"),
        F.col("p_retailprice").alias("precio_base"),
        (F.col("p_size") % 2 == 0).alias("activo"),
    )


def ventas_enriquecidas(spark: SparkSession, folder: str, lines: DataFrame | None = None) -> DataFrame:
    return enrich(ventas(spark, folder, lines), productos(spark, folder))


def web_events(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    day = F.date_format("ts", "yyyy-MM-dd")
    return events.select(
        "event_id",
        F.col("user_id").alias("id_cliente"),
        F.concat(F.lit("sess_"), F.col("user_id").cast("string"), F.lit("_"), day).alias("session_id"),
        F.concat(F.lit("/"), "event_type").alias("page"),
        "event_type",
        pick(DEVICES, F.col("event_id") % 3).alias("device"),
        F.col("ts").cast("timestamp").alias("event_timestamp"),
        F.lit("web_api").alias("ingestion_source"),
    )


def web_silver(spark: SparkSession, folder: str) -> DataFrame:
    return web_events(spark, folder).withColumns(event_calendar("event_timestamp"))


def _now_and_then(column: str, every: int, value: str, otherwise: Column) -> Column:
    return F.when(F.col(column) % every == 0, value).otherwise(otherwise)


def raw_sales(spark: SparkSession, folder: str) -> DataFrame:
    """Sales as landed: all strings, untidy text, and a bad cell now and then."""
    text = {c: F.col(c).cast("string") for c in ("id_venta", "id_cliente", "id_producto", "precio_unitario")}
    amount = _now_and_then("id_venta", 79, "", F.col("monto").cast("string"))
    amount = _now_and_then("id_venta", 101, "1e21", _now_and_then("id_venta", 103, "NaN", amount))
    return with_context(spark, folder, sale_lines(spark, folder)).select(
        _now_and_then("id_venta", 97, "abc", text["id_venta"]).alias("id_venta"),
        text["id_cliente"].alias("id_cliente"),
        text["id_producto"].alias("id_producto"),
        _now_and_then("id_venta", 89, "3.7", F.col("cantidad").cast("string")).alias("cantidad"),
        text["precio_unitario"].alias("precio_unitario"),
        _now_and_then("id_venta", 73, "-1", amount).alias("monto"),
        _now_and_then("id_venta", 83, "2026-13-01", F.col("fecha_venta").cast("string")).alias("fecha_venta"),
        F.concat(F.lit("  "), F.lower("canal"), F.lit(" ")).alias("canal"),
        F.concat(F.lit(" "), F.upper("pais")).alias("pais"),
        F.concat(F.upper("categoria"), F.lit(" ")).alias("categoria"),
        F.col("fecha_venta").cast("timestamp").alias("_ingestion_timestamp"),
    )


def raw_web(spark: SparkSession, folder: str) -> DataFrame:
    events = web_events(spark, folder)
    moment = F.date_format("event_timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return events.select(
        _now_and_then("event_id", 71, "abc", F.col("event_id").cast("string")).alias("event_id"),
        _now_and_then("event_id", 61, "", F.col("id_cliente").cast("string")).alias("id_cliente"),
        F.concat(F.lit(" "), "session_id").alias("session_id"),
        F.concat(F.upper("page"), F.lit(" ")).alias("page"),
        F.upper("event_type").alias("event_type"),
        F.concat(F.lit("  "), "device").alias("device"),
        _now_and_then("event_id", 67, "not a time", moment).alias("event_timestamp"),
        "ingestion_source",
    )


def untidy_json(spark: SparkSession, folder: str) -> DataFrame:
    """Web events as JSON lines of which some are written in unusual ways, and some not at all (column value)."""
    event = F.col("event_id")
    line = F.to_json(
        F.struct("event_id", "id_cliente", "page", F.date_format("event_timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("event_timestamp"))
    )
    quoted = F.regexp_replace(line, r'"event_id":(\d+)', r'"event_id":"$1"')
    decimal = F.regexp_replace(line, r'"event_id":(\d+)', r'"event_id":$1.0')
    extra = F.regexp_replace(line, r"\}$", ',"campo_nuevo":1}')
    broken = F.concat(F.lit("{broken "), event.cast("string"))
    return web_events(spark, folder).select(
        F.when(event % 11 == 0, quoted).when(event % 13 == 0, decimal).when(event % 17 == 0, extra)
        .when(event % 19 == 0, broken).otherwise(line).alias("value")
    )


def raw_products(spark: SparkSession, folder: str) -> DataFrame:
    """The whole part table as landed, with TRUE / no / missing activity marks and zero prices."""
    parts = table(spark, folder, "part")
    active = pick(["TRUE", "no", " true "], F.col("p_size") % 3)
    return parts.select(
        F.col("p_partkey").cast("string").alias("id_producto"),
        F.concat(F.lit(" "), "p_name").alias("nombre_producto"),
        F.concat(F.upper("p_type"), F.lit("  ")).alias("categoria"),
        F.concat("p_brand", F.lit(" ")).alias("proveedor"),
        _now_and_then("p_partkey", 53, "0", F.col("p_retailprice").cast("string")).alias("precio_base"),
        F.when(F.col("p_partkey") % 7 != 0, active).alias("activo"),
    )


def gps_unscored(events: DataFrame) -> DataFrame:
    """Truck positions before risk scoring; ``events`` may be a stream."""
    event = F.col("event_id")
    step = (event * 7 + F.col("user_id")) % 20
    state = F.coalesce(*[F.when(step < end, name) for name, end in STATES.items()])
    drift = ((event * 11) % 1000 - 500) / F.lit(10000.0)
    base = events.withColumns(
        {
            "zona": pick(list(fleet.ZONES), event % len(fleet.ZONES)),
            "capacidad_toneladas": pick(CAPACITIES, F.col("user_id") % 7).cast("double"),
        }
    )
    load = F.col("capacidad_toneladas") * ((event * 31) % 97 + 3) / 100
    return base.select(
        "event_id",
        F.col("ts").cast("timestamp").alias("timestamp_evento"),
        F.concat(F.lit("CAM-"), F.lpad((F.col("user_id") % 35 + 1).cast("string"), 3, "0")).alias("camion"),
        "zona",
        round_half_up(fleet.zone_value(0) + drift, 6).alias("lat"),
        round_half_up(fleet.zone_value(1) + drift, 6).alias("lon"),
        round_half_up(load, 2).alias("toneladas"),
        "capacidad_toneladas",
        ((event * 53) % 9500 / F.lit(100.0)).alias("velocidad"),
        state.alias("estado_entrega"),
        ((event * 29) % 91).cast("int").alias("tiempo_espera_min"),
        ((event * 17) % 1500 / F.lit(10000.0)).alias("jitter"),
        F.lit(SOURCE_NAME).alias("fuente"),
    )


def gps_of(events: DataFrame) -> DataFrame:
    scored = fleet.scored(gps_unscored(events)).withColumn("event_id", F.col("event_id").cast("int"))
    return once(scored, [], {name: F.col(name) for name in GPS_COLUMNS})


def gps(spark: SparkSession, folder: str) -> DataFrame:
    return gps_of(table(spark, folder, "events"))


def gps_with_extremes(spark: SparkSession, folder: str) -> DataFrame:
    """Events of which some have a measure that is no number or far too large."""
    event = F.col("event_id")
    speed = F.when(event % 113 == 0, float("nan")).when(event % 109 == 0, 1e30).otherwise(F.col("velocidad"))
    return gps(spark, folder).withColumns(
        {
            "velocidad": speed,
            "riesgo_retraso": F.when(event % 107 == 0, 1e25).otherwise(F.col("riesgo_retraso")),
            "toneladas": F.when(event % 127 == 0, 1e21).otherwise(F.col("toneladas")),
        }
    )


def events_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The event table followed as a stream of files."""
    schema = table(spark, folder, "events").schema
    return spark.readStream.schema(schema).parquet(f"{folder}/events*.parquet")


def as_envelope(events: DataFrame, faulty: bool = False) -> DataFrame:
    """Events as topic messages: three partitions, one offset per message.

    With ``faulty`` some messages are no JSON at all and some have a field of the wrong type.
    """
    event = F.col("event_id")
    moment = F.date_format("timestamp_evento", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    body = events.withColumn("_at", F.col("timestamp_evento")).withColumn("timestamp_evento", moment)
    text = F.to_json(F.struct(*GPS_COLUMNS))
    if faulty:
        wrong_type = F.regexp_replace(text, '"velocidad":[0-9.]+', '"velocidad":"fast"')
        text = F.when(event % 101 == 0, "no json").when(event % 103 == 0, wrong_type).otherwise(text)
    messages = body.withColumn("_json", text)
    return messages.select(
        F.lit(DEFAULT_TOPIC).alias("topic"),
        (event % 3).cast("int").alias("partition"),
        F.floor(event / 3).alias("offset"),
        F.col("_at").alias("timestamp"),
        F.col("camion").cast("binary").alias("key"),
        F.col("_json").cast("binary").alias("value"),
    )


def envelope(spark: SparkSession, folder: str, faulty: bool = False) -> DataFrame:
    return as_envelope(gps(spark, folder), faulty)
