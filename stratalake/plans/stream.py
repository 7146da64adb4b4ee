"""Streaming jobs: message topic to the Bronze stream table and to the live fleet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from stratalake.config import STREAM_TABLE, LakeConfig
from stratalake.operators import fleet
from stratalake.sources.messages import topic_stream
from stratalake.streaming import gps
from stratalake.streaming.late import LateRows
from stratalake.streaming.runs import LiveQueries, run_for, start_append, start_fleet_refresh


def followed(
    spark: SparkSession, cfg: LakeConfig, envelope: DataFrame | None, every: str | None
) -> tuple[DataFrame, str | None]:
    """The topic, or ``envelope`` in its place, e.g. for a replay from files; and how often to look."""
    if envelope is not None:
        return envelope, every
    limit = {} if cfg.max_offsets is None else {"maxOffsetsPerTrigger": str(cfg.max_offsets)}
    return topic_stream(spark, cfg.brokers, cfg.topic, **limit), every or cfg.trigger


def start_stream_bronze(
    spark: SparkSession,
    cfg: LakeConfig,
    envelope: DataFrame | None = None,
    every: str | None = None,
    once_each: bool = False,
) -> StreamingQuery:
    """Append messages to the stream table; ``once_each`` drops re-delivered ones."""
    rows, every = followed(spark, cfg, envelope, every)
    rows = gps.bronze(rows)
    return start_append(
        gps.once_each(rows) if once_each else rows,
        cfg.bronze(STREAM_TABLE),
        cfg.checkpoint("streaming_bronze/gps_camiones"),
        cfg.fmt,
        every,
    )


def run_stream_bronze(
    spark: SparkSession, cfg: LakeConfig, envelope: DataFrame | None = None, once_each: bool = False
) -> bool:
    """Ingest for ``cfg.runtime_seconds``, then stop."""
    return run_for(start_stream_bronze(spark, cfg, envelope, once_each=once_each), cfg.runtime_seconds)


def start_live_fleet(
    spark: SparkSession,
    cfg: LakeConfig,
    envelope: DataFrame | None = None,
    every: str | None = None,
    approximate: bool = False,
) -> LiveQueries:
    """Keep the live fleet KPI tables current; ``approximate`` estimates the numbers of trucks."""
    rows, every = followed(spark, cfg, envelope, every)
    return start_fleet_refresh(
        gps.parse(rows),
        cfg.path("rollup", "gps_live"),
        cfg.live,
        cfg.checkpoint("live_fleet/gps_camiones"),
        cfg.fmt,
        every,
        approximate,
    )


def start_live_alerts(
    spark: SparkSession, cfg: LakeConfig, envelope: DataFrame | None = None, every: str | None = None
) -> StreamingQuery:
    """Append alerts as they come."""
    rows, every = followed(spark, cfg, envelope, every)
    alerts = fleet.alerts(fleet.prepare(gps.parse(rows)))
    return start_append(
        alerts, cfg.live("rt_alertas_operativas"), cfg.checkpoint("live_alerts/gps_camiones"), cfg.fmt, every
    )


def start_live_rejects(
    spark: SparkSession, cfg: LakeConfig, envelope: DataFrame | None = None, every: str | None = None
) -> StreamingQuery:
    """Append events that break a rule, unreadable messages among them, with the rules' names and the raw text."""
    rows, every = followed(spark, cfg, envelope, every)
    rejects = fleet.rejects(gps.parse(rows))
    return start_append(rejects, cfg.live("rt_rechazos"), cfg.checkpoint("live_rejects/gps_camiones"), cfg.fmt, every)


def start_hourly(
    spark: SparkSession, cfg: LakeConfig, envelope: DataFrame | None = None, every: str | None = None
) -> StreamingQuery:
    """Append each hour once it is closed; ``gps.end_of_feed`` closes the last ones of a feed that ends."""
    rows, every = followed(spark, cfg, envelope, every)
    hours = gps.hourly(fleet.prepare(gps.parse(rows)))
    return start_append(hours, cfg.live("toneladas_por_hora_cerradas"), cfg.checkpoint("hourly/gps_camiones"), cfg.fmt, every)


def run_live(spark: SparkSession, cfg: LakeConfig) -> None:
    """Live KPIs, alerts, rejects and closed hours side by side for ``cfg.runtime_seconds``, and an account of late rows."""
    with LateRows(spark, cfg.live("rt_filas_tardias"), cfg.fmt):
        queries = [start(spark, cfg) for start in (start_live_fleet, start_live_alerts, start_live_rejects, start_hourly)]
        for query in queries:
            run_for(query, cfg.runtime_seconds if query is queries[0] else 1)
