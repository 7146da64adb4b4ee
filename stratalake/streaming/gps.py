"""Fleet messages: envelope to Bronze rows, and the streaming views built on them.

All functions take and give DataFrames and work on batch and streaming input alike, unless said
otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.config import STREAM_LINEAGE
from stratalake.functions.numbers import round_half_up
from stratalake.functions.once import once
from stratalake.operators import fleet
from stratalake.operators.lineage import stamp
from stratalake.sources.schemas import GPS_COLUMNS, GPS_MESSAGE

# Envelope column -> Bronze column.
ENVELOPE_COLUMNS = {
    "topic": "_topic",
    "partition": "_partition",
    "offset": "_offset",
    "timestamp": "_kafka_timestamp",
    "key": "_message_key",
    "value": "_raw_message",
}
MESSAGE_ID = ["_topic", "_partition", "_offset"]
ARRIVAL = "_kafka_timestamp"


def parse(envelope: DataFrame) -> DataFrame:
    """Message fields, envelope and raw text. An unreadable message stays, with NULL fields.

    The text is read once, also where rules and KPIs filter on many of its fields.
    """
    texts = {name: F.col(name).cast("string") for name in ("key", "value")}
    renamed = envelope.withColumns(texts).select(
        *[F.col(name).alias(new) for name, new in ENVELOPE_COLUMNS.items()]
    )
    read = once(renamed, list(ENVELOPE_COLUMNS.values()), {"_message": F.from_json("_raw_message", GPS_MESSAGE)})
    return read.select(
        *[F.col("_message")[name].alias(name) for name in GPS_COLUMNS], *ENVELOPE_COLUMNS.values()
    ).withColumn("timestamp_evento", F.col("timestamp_evento").try_cast("timestamp"))


def bronze(envelope: DataFrame) -> DataFrame:
    return stamp(parse(envelope), *STREAM_LINEAGE)


def unreadable(bronze_rows: DataFrame) -> DataFrame:
    """Messages that carry no usable event; the KPIs leave them out."""
    return bronze_rows.filter("event_id is null or camion is null or timestamp_evento is null")


def once_each(bronze_rows: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Drop re-delivered messages on a stream; state is kept only for ``delay``."""
    return bronze_rows.withWatermark(ARRIVAL, delay).dropDuplicatesWithinWatermark(MESSAGE_ID)


# Truck name of the message that ends a feed; its own hour never closes, so it is in no result.
END_OF_FEED = "__fin__"


def end_of_feed(spark: SparkSession, moment: str, topic: str, partition: int = 0, offset: int = -1) -> DataFrame:
    """One envelope row that moves the watermark to ``moment`` and so closes the last hours of a feed that ends.

    Send it after the last event, with a moment later than that by the watermark's delay and an hour at least.
    """
    body = {"event_id": F.lit(-1), "timestamp_evento": F.lit(moment), "camion": F.lit(END_OF_FEED)}
    return spark.range(1).select(
        F.lit(topic).alias("topic"),
        F.lit(partition).alias("partition"),
        F.lit(offset).cast("bigint").alias("offset"),
        F.lit(moment).cast("timestamp").alias("timestamp"),
        F.lit(END_OF_FEED).cast("binary").alias("key"),
        F.to_json(F.struct(*[value.alias(name) for name, value in body.items()])).cast("binary").alias("value"),
    )


def hourly(prepared: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Hourly tonnage on a stream (append mode): an hour is emitted once the watermark has passed it.

    The last hour of a feed that ends is emitted after ``end_of_feed``.

    Trucks are counted exactly: a first aggregation has one row per hour and truck, a second one
    counts those rows and adds up their sums. Both keep state only for open hours.
    """
    measures = [fleet.TONS, fleet.SPEED, fleet.LOAD]
    per_truck = (
        prepared.withWatermark("timestamp_evento", delay)
        .groupBy(F.window("timestamp_evento", "1 hour").alias("hour"), "camion")
        .agg(F.count(F.lit(1)).alias("eventos"), *[c for m in measures for c in m.partial()])
    )
    per_hour = per_truck.groupBy(F.window(F.window_time("hour"), "1 hour").alias("hour")).agg(
        F.sum("eventos").alias("total_eventos"),
        F.count(F.lit(1)).alias("camiones_activos"),
        round_half_up(fleet.TONS.total(), 2).alias("toneladas_por_hora"),
        round_half_up(fleet.SPEED.mean(), 2).alias("velocidad_promedio"),
        round_half_up(fleet.LOAD.mean(), 2).alias("ocupacion_promedio_pct"),
    )
    start = F.col("hour.start")
    return per_hour.select(
        F.to_date(start).alias("fecha_evento"),
        F.hour(start).alias("hora_evento"),
        *[c for c in per_hour.columns if c != "hour"],
    )
