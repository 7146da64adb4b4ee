import pytest
from pyspark.sql import functions as F

from stratalake.operators import fleet

GPS = (
    "event_id int, timestamp_evento timestamp, camion string, zona string, lat double, lon double, toneladas double, "
    "capacidad_toneladas double, ocupacion_pct double, velocidad double, estado_entrega string, "
    "tiempo_espera_min int, riesgo_retraso double, entrega_a_tiempo boolean"
)


def events(spark, *changes):
    base = dict(
        camion="CAM-001", zona="Zona_Oriente", lat=1.0, lon=2.0, toneladas=5.25, capacidad_toneladas=10.0,
        ocupacion_pct=52.5, velocidad=50.0, estado_entrega="EN_RUTA", tiempo_espera_min=0, riesgo_retraso=0.1,
        entrega_a_tiempo=True, at="2026-01-05 10:20:30",
    )
    data = []
    for number, change in enumerate(changes, 1):
        row = {"event_id": number, **base, **change}
        data.append(tuple(row[c] for c in ["event_id", "at", *[f.split()[0] for f in GPS.split(", ")[2:]]]))
    text = spark.createDataFrame(data, GPS.replace("timestamp_evento timestamp", "timestamp_evento string"))
    return text.withColumn("timestamp_evento", F.col("timestamp_evento").cast("timestamp"))


@pytest.mark.parametrize(
    "change, level, alert",
    [
        ({"riesgo_retraso": None}, "BAJO", False),
        ({"riesgo_retraso": 0.4999}, "BAJO", False),
        ({"riesgo_retraso": 0.50}, "MEDIO", False),
        ({"riesgo_retraso": 0.7499}, "MEDIO", False),
        ({"riesgo_retraso": 0.75}, "ALTO", True),
        ({"tiempo_espera_min": 59}, "BAJO", False),
        ({"tiempo_espera_min": 60}, "BAJO", True),
        ({"velocidad": 10.0}, "BAJO", True),
        ({"velocidad": 10.01}, "BAJO", False),
        ({"velocidad": 10.0, "estado_entrega": "EN_PATIO"}, "BAJO", False),
        ({"velocidad": None, "estado_entrega": None, "tiempo_espera_min": None}, "BAJO", False),
        ({"velocidad": 5.0, "estado_entrega": None, "tiempo_espera_min": 90}, "BAJO", True),
    ],
)
def test_levels_and_alerts(spark, change, level, alert):
    row = fleet.prepare(events(spark, change)).first()
    assert (row.nivel_riesgo, row.alerta_operativa) == (level, alert)
    assert (str(row.fecha_evento), row.hora_evento, row.anio_mes) == ("2026-01-05", 10, "2026-01")


def test_unusable_events_are_left_out(spark):
    df = events(spark, {"event_id": None}, {"camion": None}, {"at": None}, {})
    assert fleet.prepare(df).count() == 1


def test_alert_reasons_in_order(spark):
    df = events(
        spark,
        {"riesgo_retraso": 0.8, "tiempo_espera_min": 90},
        {"tiempo_espera_min": 90, "velocidad": 1.0},
        {"velocidad": 1.0},
        # The flag looks at the raw risk, the reason at the rounded percent.
        {"riesgo_retraso": 0.74996, "tiempo_espera_min": 60},
    )
    got = {r.event_id: (r.tipo_alerta, r.nivel_riesgo, r.riesgo_retraso_pct) for r in fleet.alerts(fleet.prepare(df)).collect()}
    assert got == {
        1: ("RIESGO_ALTO_RETRASO", "ALTO", 80.0),
        2: ("ESPERA_PROLONGADA", "BAJO", 10.0),
        3: ("POSIBLE_DETENCION_EN_RUTA", "BAJO", 10.0),
        4: ("RIESGO_ALTO_RETRASO", "MEDIO", 75.0),
    }


def test_alerts_are_sorted_by_risk_then_wait(spark):
    df = events(spark, {"tiempo_espera_min": 61}, {"riesgo_retraso": 0.9}, {"tiempo_espera_min": 70})
    assert [r.event_id for r in fleet.sorted_alerts(fleet.prepare(df)).collect()] == [2, 3, 1]
    assert len(fleet.alerts(fleet.prepare(df)).columns) == 16


def test_kpis(spark):
    df = events(
        spark,
        {},
        {"camion": "CAM-002", "toneladas": 0.1, "velocidad": None, "entrega_a_tiempo": False, "riesgo_retraso": 0.8},
        {"zona": "Ruta_Pacifico", "estado_entrega": "EN_PATIO", "entrega_a_tiempo": None, "at": "2026-01-05 11:00:00"},
    )
    rollup = fleet.fleet_rollup(fleet.prepare(df))
    assert tuple(fleet.overall(rollup).first()) == (3, 2, 10.6, 50.0, 0.0, 52.5, 33.33, 33.33, 1, 1)
    zones = [tuple(r) for r in fleet.by_zone(rollup).collect()]
    assert zones[0] == ("Zona_Oriente", 2, 2, 5.35, 50.0, 0.0, 52.5, 45.0, 1, 50.0)
    assert zones[1] == ("Ruta_Pacifico", 1, 1, 5.25, 50.0, 0.0, 52.5, 10.0, 0, 0.0)
    assert [tuple(r)[1:4] for r in fleet.by_hour(rollup).collect()] == [(10, 2, 2), (11, 1, 1)]
    assert [tuple(r) for r in fleet.by_status(rollup).collect()] == [("EN_RUTA", 2, 2, 5.35, 0.0), ("EN_PATIO", 1, 1, 5.25, 0.0)]


def test_kpis_of_nothing(spark):
    rollup = fleet.fleet_rollup(fleet.prepare(events(spark, {}).limit(0)))
    assert tuple(fleet.overall(rollup).first()) == (0, 0, None, None, None, None, None, None, None, None)
    assert fleet.by_zone(rollup).count() == 0


def test_scores(spark):
    data = [
        ("Centro_Distribucion", 10.0, "EN_RUTA", 50, 0.05),
        ("Zona_Oriente", 10.0, "EN_RUTA", 50, 0.15),
        ("Zona_Oriente", 15.0, "EN_RUTA", 45, 0.10),
        ("Ruta_Pacifico", None, None, None, 0.0),
        ("desconocida", 10.0, "EN_RUTA", 50, 0.0),
    ]
    schema = "zona string, velocidad double, estado_entrega string, tiempo_espera_min int, jitter double"
    df = spark.createDataFrame(data, schema).selectExpr("*", "5D as toneladas", "8D as capacidad_toneladas")
    got = [(r.riesgo_retraso, r.entrega_a_tiempo, r.ocupacion_pct) for r in fleet.scored(df).collect()]
    # 0.45 + 0.10 is 0.55 and so not below the limit.
    assert got == [(0.6, False, 62.5), (1.0, False, 62.5), (0.55, False, 62.5), (0.28, True, 62.5), (None, None, 62.5)]


def test_alert_conditions_reach_the_scan(spark, tmp_path, plan_of):
    events(spark, {}).write.parquet(str(tmp_path / "t"))
    plan = plan_of(fleet.alerts(fleet.prepare(spark.read.parquet(str(tmp_path / "t")))))
    assert "Or(Or(GreaterThanOrEqual(riesgo_retraso,0.75)" in plan and "IsNotNull(camion)" in plan
