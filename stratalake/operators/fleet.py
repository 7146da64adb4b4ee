"""Truck-fleet expressions, risk levels, alerts and KPIs.

The four KPI tables are read off one rollup of the events, (hour, zone, status, truck) with mergeable
sums. Because the rollup merges, a stream can add to it batch by batch.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from stratalake.functions.calendar import event_calendar
from stratalake.functions.numbers import IN_RANGE, WIDE, ExactSum, ratio, round_half_up
from stratalake.operators import rules

# Zones with their base position and base risk.
# zone: (base_lat, base_lon, riesgo_base)
ZONES = {
    "Centro_Distribucion": (14.6349, -90.5069, 0.10),
    "Ruta_Atlantico": (14.7200, -90.3500, 0.35),
    "Ruta_Pacifico": (14.3000, -90.7800, 0.28),
    "Zona_Oriente": (14.9667, -89.5333, 0.45),
    "Zona_Occidente": (14.8333, -91.5167, 0.30),
}
# Risk levels from the top, alert limits and alert names.
RISK_LEVELS = {"ALTO": 0.75, "MEDIO": 0.50}
LOWEST_RISK_LEVEL = "BAJO"
ON_THE_ROAD = "EN_RUTA"
ALERT_WAIT_MIN = 60
ALERT_SPEED = 10
ALERT_RISK = 0.75
ALERT_RISK_TYPE = "RIESGO_ALTO_RETRASO"
ALERT_WAIT_TYPE = "ESPERA_PROLONGADA"
ALERT_STOPPED_TYPE = "POSIBLE_DETENCION_EN_RUTA"
ALERT_OTHER_TYPE = "ALERTA_OPERATIVA"
# Delay-risk score.
SLOW_SPEED, SLOW_RISK = 15, 0.25
LONG_WAIT_MIN, LONG_WAIT_RISK = 45, 0.20
ON_TIME_BELOW = 0.55


def zone_value(index: int, zone: str = "zona") -> Column:
    """Look up one of the few fixed zone values; an unknown zone gives NULL."""
    pairs = [(F.lit(name), F.lit(values[index])) for name, values in ZONES.items()]
    return F.create_map(*chain.from_iterable(pairs))[F.col(zone)]


def occupancy_pct() -> Column:
    return round_half_up(F.try_divide(F.col("toneladas"), F.col("capacidad_toneladas")) * 100, 2)


def delay_risk(base: Column, jitter: Column) -> Column:
    """Score in [0, 1]; conditions on unknown speed, status or wait add nothing."""
    slow = (F.col("velocidad") < SLOW_SPEED) & (F.col("estado_entrega") == ON_THE_ROAD)
    waiting = F.col("tiempo_espera_min") > LONG_WAIT_MIN
    raised = base + F.when(slow, SLOW_RISK).otherwise(0.0) + F.when(waiting, LONG_WAIT_RISK).otherwise(0.0) + jitter
    # least() passes over NULL, but an unknown zone or jitter leaves the score unknown.
    return F.when(base.isNotNull() & jitter.isNotNull(), F.least(F.lit(1.0), raised))


def scored(events: DataFrame, jitter: str = "jitter") -> DataFrame:
    """Occupancy, delay risk (rounded to 4) and the on-time flag, which looks at the unrounded risk."""
    risk = delay_risk(zone_value(2), F.col(jitter))
    return (
        events.withColumn("_risk", risk)
        .withColumns(
            {
                "ocupacion_pct": occupancy_pct(),
                "riesgo_retraso": round_half_up("_risk", 4),
                "entrega_a_tiempo": F.col("_risk") < ON_TIME_BELOW,
            }
        )
        .drop("_risk")
    )


def risk_level(risk: str = "riesgo_retraso") -> Column:
    level = F.lit(LOWEST_RISK_LEVEL)
    for name, start in reversed(RISK_LEVELS.items()):
        level = F.when(F.col(risk) >= start, name).otherwise(level)
    return level


def _waits_long() -> Column:
    return F.col("tiempo_espera_min") >= ALERT_WAIT_MIN


def _stands_still() -> Column:
    return (F.col("velocidad") <= ALERT_SPEED) & (F.col("estado_entrega") == ON_THE_ROAD)


def needs_attention() -> Column:
    """Plain comparisons, so that the scan of a table can use them; NULL stands for no."""
    return (F.col("riesgo_retraso") >= ALERT_RISK) | _waits_long() | _stands_still()


# A measure may be missing, but one that is there is a number in range.
EVENT_RULES = {
    "event_id presente": "event_id is not null",
    "camion presente": "camion is not null",
    "timestamp_evento presente": "timestamp_evento is not null",
    **{
        f"{name} en rango": f"{name} is null or {IN_RANGE.format(name)}"
        for name in ("toneladas", "capacidad_toneladas", "ocupacion_pct", "velocidad", "riesgo_retraso")
    },
}


def rejects(gps: DataFrame) -> DataFrame:
    """Events that ``prepare`` leaves out, with the names of the rules that each one breaks."""
    return rules.rejects(gps, EVENT_RULES)


def rule_hits(gps: DataFrame) -> DataFrame:
    return rules.hits(gps, EVENT_RULES)


def prepare(gps: DataFrame, seen: Observation | None = None) -> DataFrame:
    """Usable events with calendar columns, risk level and alert flag; works on streams as well.

    ``seen`` counts the events that meet each rule when the result is computed.
    """
    usable = gps
    if seen is not None:
        usable = gps.observe(seen, *[c.alias(n) for n, c in rules.counters(EVENT_RULES).items()])
    for sql in EVENT_RULES.values():
        usable = usable.filter(sql)
    return usable.withColumns(
        {
            **event_calendar("timestamp_evento", hour=True),
            "nivel_riesgo": risk_level(),
            "alerta_operativa": F.coalesce(needs_attention(), F.lit(False)),
        }
    )


# Columns of the alert table before the percent risk and the alert type.
ALERT_EVENT_COLUMNS = [
    "event_id",
    "timestamp_evento",
    "camion",
    "zona",
    "lat",
    "lon",
    "toneladas",
    "capacidad_toneladas",
    "ocupacion_pct",
    "velocidad",
    "estado_entrega",
    "tiempo_espera_min",
]


def alerts(prepared: DataFrame) -> DataFrame:
    """Events that need attention, with the reason that comes first. Unsorted, so usable on streams.

    The reason looks at the rounded percent risk, the flag at the raw risk.
    """
    percent = round_half_up(F.col("riesgo_retraso") * 100, 2)
    reason = (
        F.when(F.col("riesgo_retraso_pct") >= ALERT_RISK * 100, ALERT_RISK_TYPE)
        .when(_waits_long(), ALERT_WAIT_TYPE)
        .when(_stands_still(), ALERT_STOPPED_TYPE)
        .otherwise(ALERT_OTHER_TYPE)
    )
    return (
        prepared.filter(needs_attention())
        .select(
            *ALERT_EVENT_COLUMNS,
            percent.alias("riesgo_retraso_pct"),
            "nivel_riesgo",
            "entrega_a_tiempo",
        )
        .withColumn("tipo_alerta", reason)
    )


def sorted_alerts(prepared: DataFrame) -> DataFrame:
    return alerts(prepared).orderBy(F.desc("riesgo_retraso_pct"), F.desc("tiempo_espera_min"), "event_id")


TONS = ExactSum("toneladas", 2)
SPEED = ExactSum("velocidad", 2)
WAIT = ExactSum("tiempo_espera_min", 0)
LOAD = ExactSum("ocupacion_pct", 2)
RISK = ExactSum("riesgo_retraso", 4)
MEASURES = [TONS, SPEED, WAIT, LOAD, RISK]
ROLLUP_KEYS = ("fecha_evento", "hora_evento", "zona", "estado_entrega", "camion")


# Rollups without the truck among their keys hold a sketch of their trucks: 2 ** 12 registers, standard error 1.6 %.
SKETCH, SKETCH_LOG_SIZE = "camiones_sketch", 12
SKETCH_KEYS = tuple(key for key in ROLLUP_KEYS if key != "camion")


def fleet_rollup(prepared: DataFrame, keys: tuple[str, ...] = ROLLUP_KEYS) -> DataFrame:
    """Partial results per ``keys``; rows of several rollups can be put together and rolled up again.

    With the truck among the keys trucks are counted exactly. Without it (``SKETCH_KEYS``) a row is an hour, zone and
    state, however many trucks there are, and their number is estimated from a mergeable sketch.
    """
    trucks = [] if "camion" in keys else [F.hll_sketch_agg("camion", F.lit(SKETCH_LOG_SIZE)).alias(SKETCH)]
    return prepared.groupBy(*keys).agg(
        *trucks,
        F.count(F.lit(1)).alias("eventos"),
        F.count_if("entrega_a_tiempo").alias("a_tiempo"),
        F.count_if("alerta_operativa").alias("alertas"),
        F.count_if(F.col("nivel_riesgo") == "ALTO").alias("riesgo_alto"),
        *chain.from_iterable(measure.partial() for measure in MEASURES),
    )


def merge_rollups(parts: DataFrame, keys: tuple[str, ...] = ROLLUP_KEYS) -> DataFrame:
    """One row per key out of several partial rows."""
    sums = [
        F.hll_union_agg(name).alias(name) if name == SKETCH else F.sum(name).cast(kind).alias(name)
        for name, kind in parts.dtypes
        if name not in ROLLUP_KEYS
    ]
    return parts.groupBy(*keys).agg(*sums)


def _trucks(rollup: DataFrame, name: str) -> Column:
    """Exact where the rollup has the trucks, else estimated."""
    if SKETCH not in rollup.columns:
        return F.count_distinct("camion").alias(name)
    return F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(SKETCH)), F.lit(0)).cast("bigint").alias(name)


def _count(column: str, name: str) -> Column:
    return F.sum(column).cast("bigint").alias(name)


def _total(measure: ExactSum, name: str) -> Column:
    return round_half_up(measure.total(), 2).alias(name)


def _mean(measure: ExactSum, name: str, factor: int = 1) -> Column:
    return round_half_up(measure.mean(factor), 2).alias(name)


def _on_time_pct() -> Column:
    share = ratio((F.sum("a_tiempo") * 100).cast(WIDE), F.sum("eventos"))
    return round_half_up(share, 2).alias("entregas_a_tiempo_pct")


def overall(rollup: DataFrame) -> DataFrame:
    """One row; with no events the counts are 0 and the measures NULL."""
    table = rollup.agg(
        _count("eventos", "total_eventos_gps"),
        _trucks(rollup, "camiones_activos"),
        _total(TONS, "toneladas_transportadas"),
        _mean(SPEED, "velocidad_promedio"),
        _mean(WAIT, "tiempo_espera_promedio_min"),
        _mean(LOAD, "ocupacion_promedio_pct"),
        _mean(RISK, "riesgo_retraso_promedio_pct", 100),
        _on_time_pct(),
        _count("alertas", "total_alertas_operativas"),
        _count("riesgo_alto", "eventos_riesgo_alto"),
    )
    return table.fillna(0, ["total_eventos_gps"])


def by_zone(rollup: DataFrame) -> DataFrame:
    table = rollup.groupBy("zona").agg(
        _count("eventos", "total_eventos"),
        _trucks(rollup, "camiones_activos"),
        _total(TONS, "toneladas_transportadas"),
        _mean(SPEED, "velocidad_promedio"),
        _mean(WAIT, "tiempo_espera_promedio_min"),
        _mean(LOAD, "ocupacion_promedio_pct"),
        _mean(RISK, "riesgo_promedio_pct", 100),
        _count("alertas", "alertas_operativas"),
        _on_time_pct(),
    )
    return table.orderBy(F.desc("alertas_operativas"), F.desc("riesgo_promedio_pct"), "zona")


def by_hour(rollup: DataFrame) -> DataFrame:
    table = rollup.groupBy("fecha_evento", "hora_evento").agg(
        _count("eventos", "total_eventos"),
        _trucks(rollup, "camiones_activos"),
        _total(TONS, "toneladas_por_hora"),
        _mean(SPEED, "velocidad_promedio"),
        _mean(LOAD, "ocupacion_promedio_pct"),
    )
    return table.orderBy("fecha_evento", "hora_evento")


def by_status(rollup: DataFrame) -> DataFrame:
    table = rollup.groupBy("estado_entrega").agg(
        _count("eventos", "total_eventos"),
        _trucks(rollup, "camiones"),
        _total(TONS, "toneladas"),
        _mean(WAIT, "tiempo_espera_promedio_min"),
    )
    return table.orderBy(F.desc("total_eventos"), "estado_entrega")
