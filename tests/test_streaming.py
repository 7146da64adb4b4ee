"""Streams against the batch result of the same rows, restarts and late rows."""

import json
from datetime import datetime, timedelta

import pytest

from contract import queries
from stratalake.config import STREAM_TABLE, LakeConfig
from stratalake.operators import fleet
from stratalake.plans.gold import run_fleet
from stratalake.plans.stream import start_hourly, start_live_alerts, start_live_fleet, start_live_rejects, start_stream_bronze
from stratalake.sources.files import MissingDataset, read_table
from stratalake.sources.messages import envelope_files_stream
from stratalake.sinks.versions import read_current
from stratalake.sources.schemas import ENVELOPE
from stratalake.streaming import gps, runs
from stratalake.streaming.late import LateRows

START = datetime(2026, 1, 5, 10, 0, 0)


def message(number, minute=0, **changes):
    value = dict(
        event_id=number, timestamp_evento=(START + timedelta(minutes=minute)).isoformat() + "+00:00", camion="CAM-001",
        zona="Zona_Oriente", lat=1.0, lon=2.0, toneladas=5.5, capacidad_toneladas=10, ocupacion_pct=55.0, velocidad=40.0,
        estado_entrega="EN_RUTA", tiempo_espera_min=5, riesgo_retraso=0.2, entrega_a_tiempo=True, fuente="x",
    )
    value.update(changes)
    return json.dumps(value)


@pytest.fixture
def topic(spark, tmp_path):
    """A folder that stands for a topic: every call adds one file of messages."""
    folder = str(tmp_path / "topic")
    sent = []

    def add(*values, offsets=None):
        for value in values:
            sent.append(value)
        first = len(sent) - len(values)
        offsets = offsets or range(first, len(sent))
        data = [
            ("gpscamiones", 0, offset, START + timedelta(seconds=offset), b"CAM-001", value.encode())
            for offset, value in zip(offsets, values)
        ]
        spark.createDataFrame(data, ENVELOPE).coalesce(1).write.mode("append").parquet(folder)
        return folder

    return add


def table(spark, path):
    rows = read_table(spark, path, "t").drop("generated_at").collect()
    return sorted(str(sorted(r.asDict().items())) for r in rows)


def test_parse_keeps_unreadable_messages_with_their_text(spark, topic):
    folder = topic(message(1), "garbage", message(3, velocidad="fast"))
    got = {r._offset: r for r in gps.parse(spark.read.parquet(folder)).collect()}
    assert got[0].event_id == 1 and got[0].timestamp_evento == START and got[0]._message_key == "CAM-001"
    assert got[1].event_id is None and got[1]._raw_message == "garbage"
    assert got[2].event_id == 3 and got[2].velocidad is None and got[2].toneladas == 5.5
    assert [r._offset for r in gps.unreadable(gps.parse(spark.read.parquet(folder))).collect()] == [1]


def test_bronze_stream_equals_batch_and_a_restart_adds_nothing(spark, topic, tmp_path):
    cfg = LakeConfig(root=str(tmp_path / "lake"))
    folder = topic(message(1), "garbage", message(1, camion="CAM-002"))

    def ingest():
        start_stream_bronze(spark, cfg, envelope_files_stream(spark, folder)).awaitTermination()
        return spark.read.parquet(cfg.bronze(STREAM_TABLE)).drop("_ingestion_timestamp")

    first = sorted(map(str, ingest().collect()))
    batch = gps.bronze(spark.read.parquet(folder)).drop("_ingestion_timestamp")
    assert first == sorted(map(str, batch.collect())) and len(first) == 3
    assert "_batch_id" not in batch.columns
    assert ingest().count() == 3
    topic(message(4))
    assert ingest().count() == 4


def test_equal_event_ids_are_different_events(spark, topic):
    prepared = fleet.prepare(gps.parse(spark.read.parquet(topic(message(1), message(1, minute=5)))))
    assert fleet.overall(fleet.fleet_rollup(prepared)).first().total_eventos_gps == 2


def test_a_redelivered_message_counts_once(spark, topic, tmp_path):
    topic(message(1), message(2))
    folder = topic(message(2), offsets=[1])
    rows = gps.once_each(gps.parse(envelope_files_stream(spark, folder, maxFilesPerTrigger=1)))
    runs.start_append(rows, str(tmp_path / "t"), str(tmp_path / "c")).awaitTermination()
    assert sorted(r.event_id for r in spark.read.parquet(str(tmp_path / "t")).collect()) == [1, 2]


def test_hours_close_behind_the_watermark_and_late_rows_are_dropped(spark, topic, tmp_path):
    def run():
        stream = fleet.prepare(gps.parse(envelope_files_stream(spark, str(tmp_path / "topic"))))
        runs.start_append(gps.hourly(stream), str(tmp_path / "t"), str(tmp_path / "c")).awaitTermination()
        got = spark.read.parquet(str(tmp_path / "t")).orderBy("fecha_evento", "hora_evento").collect()
        return [(r.hora_evento, r.total_eventos, r.camiones_activos, r.toneladas_por_hora) for r in got]

    topic(message(1), message(2, minute=59, camion="CAM-002"), message(3, minute=59), message(4, minute=75))
    assert run() == [(10, 3, 2, 16.5)]
    topic(message(5, minute=30), message(6, minute=140))
    assert run() == [(10, 3, 2, 16.5), (11, 1, 1, 5.5)]


def test_alert_stream_equals_batch(spark, topic, tmp_path):
    folder = topic(message(1, riesgo_retraso=0.9), message(2), message(3, tiempo_espera_min=80))
    stream = fleet.alerts(fleet.prepare(gps.parse(envelope_files_stream(spark, folder))))
    runs.start_append(stream, str(tmp_path / "t"), str(tmp_path / "c")).awaitTermination()
    batch = fleet.sorted_alerts(fleet.prepare(gps.parse(spark.read.parquet(folder)))).collect()
    got = spark.read.parquet(str(tmp_path / "t")).collect()
    assert sorted(map(str, got)) == sorted(map(str, batch)) and len(got) == 2


def test_live_tables_equal_the_batch_tables_after_every_run(spark, topic, tmp_path):
    cfg = LakeConfig(root=str(tmp_path / "lake"))
    names = ["rt_kpis_generales", "rt_kpis_por_zona", "rt_toneladas_por_hora", "rt_estado_flota"]
    folder = topic(message(1), message(2, camion="CAM-002", toneladas=0.1), "garbage")
    for extra in ((), (message(3, minute=70, zona="Ruta_Pacifico", riesgo_retraso=0.9),), (message(4, camion="CAM-002"),)):
        if extra:
            topic(*extra)
        stream = envelope_files_stream(spark, folder, maxFilesPerTrigger=1)
        start_live_fleet(spark, cfg, stream).awaitTermination()
        start_stream_bronze(spark, cfg, envelope_files_stream(spark, folder)).awaitTermination()
        live = {name: table(spark, cfg.live(name)) for name in names}
        run_fleet(spark, cfg)
        assert live == {name: table(spark, cfg.gold(name)) for name in names}


@pytest.mark.parametrize("kind", [runs.sketch_refresh, runs.hours_refresh])
def test_a_batch_leaves_untouched_days_alone(spark, topic, tmp_path, kind):
    """Files of a day change only with a batch that has events of that day."""
    first = fleet.prepare(gps.parse(spark.read.parquet(topic(message(1), message(2, minute=60 * 24)))))
    later = first.where("event_id = 2")
    refresh = kind(str(tmp_path / "rollup"), lambda name: str(tmp_path / name))

    def used():
        current = read_current(spark, str(tmp_path / runs.HOURLY_TABLE))
        return {f.partition("fecha_evento=")[2]: f for f in current["folders"]}

    refresh(first, 0)
    assert [r.total_eventos for r in read_table(spark, str(tmp_path / runs.HOURLY_TABLE), "t").collect()] == [1, 1]
    refresh(later, 1)
    before = used()
    days = sorted(before)
    assert len(days) == 2
    refresh(later, 2)
    refresh(later, 2)
    assert used()[days[0]] == before[days[0]] and used()[days[1]] != before[days[1]]
    got = read_table(spark, str(tmp_path / runs.HOURLY_TABLE), "t").orderBy("fecha_evento").collect()
    assert [r.total_eventos for r in got] == [1, 3] and [r.camiones_activos for r in got] == [1, 1]
    assert len(list((tmp_path / "rollup").rglob(f"fecha_evento={days[0]}/_batch=*"))) == 1
    assert len(list((tmp_path / "rollup").rglob(f"fecha_evento={days[1]}/_batch=*"))) == 2
    refresh(first.limit(0), 3)
    assert used()[days[0]] == before[days[0]]


def test_rejected_messages_are_kept_and_counted(spark, topic, tmp_path):
    """Unreadable messages and measures out of range stand in tables of the batch job and of the stream, with reasons."""
    cfg = LakeConfig(root=str(tmp_path / "lake"))
    folder = topic(message(1), "garbage", message(3, velocidad=1e30), message(4, camion=None))
    start_stream_bronze(spark, cfg, envelope_files_stream(spark, folder)).awaitTermination()
    run_fleet(spark, cfg)
    start_live_rejects(spark, cfg, envelope_files_stream(spark, folder)).awaitTermination()
    for path in (cfg.silver("gps_rechazos"), cfg.live("rt_rechazos")):
        rows = {r._offset: r for r in read_table(spark, path, "r").collect()}
        assert {k: r._failed_rules for k, r in rows.items()} == {
            1: ["event_id presente", "camion presente", "timestamp_evento presente"],
            2: ["velocidad en rango"],
            3: ["camion presente"],
        }
        assert rows[1]._raw_message == "garbage"
    hits = {r.quality_rule: (r.passed, r.failed) for r in read_table(spark, cfg.silver("gps_data_quality_rules"), "q").collect()}
    assert hits["camion presente"] == (2, 2) and hits["velocidad en rango"] == (3, 1) and hits["event_id presente"] == (3, 1)


def test_the_last_hour_comes_when_the_feed_is_closed(spark, topic, tmp_path):
    folder, cfg = topic(message(1), message(2, minute=70)), LakeConfig(root=str(tmp_path / "lake"))
    start_hourly(spark, cfg, envelope_files_stream(spark, folder)).awaitTermination()
    gps.end_of_feed(spark, "2027-12-01 00:00:00", "gpscamiones").write.mode("append").parquet(folder)
    start_hourly(spark, cfg, envelope_files_stream(spark, folder)).awaitTermination()
    got = spark.read.parquet(cfg.live("toneladas_por_hora_cerradas")).collect()
    assert sorted(r.total_eventos for r in got) == [1, 1]
    start_live_alerts(spark, cfg, envelope_files_stream(spark, folder)).awaitTermination()


@pytest.mark.parametrize("kind", [runs.sketch_refresh, runs.hours_refresh])
def test_a_repeated_batch_does_not_count_twice(spark, topic, tmp_path, kind):
    """The same refresh may run again after a failure: it starts from the state before it."""
    prepared = fleet.prepare(gps.parse(spark.read.parquet(topic(message(1), message(2)))))
    refresh = kind(str(tmp_path / "rollup"), lambda name: str(tmp_path / name), "parquet")
    for batch_id in (0, 0, 1, 1, 2):
        refresh(prepared, batch_id)
    assert read_table(spark, str(tmp_path / runs.HOURLY_TABLE), "t").first().total_eventos == 6
    if kind is runs.sketch_refresh:
        assert read_table(spark, str(tmp_path / "rt_kpis_generales"), "t").first().total_eventos_gps == 6


def test_repeated_changes_do_not_count_twice(spark, topic, tmp_path):
    """Changes are whole totals; only the changed keys are written, and merges now and then keep few folders."""
    prepared = fleet.prepare(gps.parse(spark.read.parquet(topic(message(1), message(2, camion="CAM-002"), message(3)))))
    totals = fleet.fleet_rollup(prepared, runs.STATE_KEYS)
    one = totals.where("camion = 'CAM-001'")
    refresh = runs.totals_refresh(str(tmp_path / "s"), lambda name: str(tmp_path / name), merge_every=3)
    seen = []
    for batch_id in (0, 0, 1, 2, 2, 3, 4, 5, 5, 6):
        more = one.withColumn("eventos", one["eventos"] + batch_id).select(totals.columns)
        refresh(totals if batch_id == 0 else more, batch_id)
        row = read_table(spark, str(tmp_path / "rt_kpis_generales"), "t").first()
        seen.append((row.total_eventos_gps, row.camiones_activos))
    assert seen == [(3 + n, 2) for n in (0, 0, 1, 2, 2, 3, 4, 5, 5, 6)]
    assert spark.read.parquet(str(tmp_path / "s" / "changes" / "6")).count() == 1
    assert sorted(p.name for p in (tmp_path / "s" / "changes").iterdir()) == ["3", "4", "5", "6"]
    refresh(totals, 0)
    assert read_table(spark, str(tmp_path / "rt_kpis_generales"), "t").first().total_eventos_gps == 3


def test_estimated_trucks_are_near_and_take_no_row_each(spark, tmp_path):
    events = spark.range(20_000).selectExpr(
        "cast(id as int) as event_id", "timestamp '2026-01-05 10:00:00' as timestamp_evento", "concat('C', id % 5000) as camion",
        "'Z' as zona", "1D as lat", "2D as lon", "1.5D as toneladas", "10D as capacidad_toneladas", "15D as ocupacion_pct",
        "40D as velocidad", "'EN_RUTA' as estado_entrega", "5 as tiempo_espera_min", "0.2D as riesgo_retraso",
        "true as entrega_a_tiempo", "'x' as fuente",
    )
    refresh = runs.sketch_refresh(str(tmp_path / "rollup"), lambda name: str(tmp_path / name))
    refresh(fleet.prepare(events.where("event_id < 12000")), 0)
    refresh(fleet.prepare(events.where("event_id >= 12000")), 1)
    row = read_table(spark, str(tmp_path / "rt_kpis_generales"), "t").first()
    assert row.total_eventos_gps == 20_000 and abs(row.camiones_activos - 5000) < 250
    for kept in ("totals/1", "fresh"):
        rollup = read_table(spark, str(tmp_path / "rollup" / kept), "t")
        assert "camion" not in rollup.columns and rollup.count() == 1


def test_a_restart_goes_on_with_the_totals(spark, topic, tmp_path):
    """Totals come back from the state store, and a query that is stopped in between loses and repeats nothing."""
    cfg = LakeConfig(root=str(tmp_path / "lake"))
    folder = topic(message(1), message(2, camion="CAM-002"))
    for number in (3, 4, 5):
        query = start_live_fleet(spark, cfg, envelope_files_stream(spark, folder), every="1 second")
        assert runs.run_for(query, 6) is False and not query.isActive
        topic(message(number, camion=f"CAM-00{number}"))
    start_live_fleet(spark, cfg, envelope_files_stream(spark, folder)).awaitTermination()
    row = read_table(spark, cfg.live("rt_kpis_generales"), "t").first()
    assert (row.total_eventos_gps, row.camiones_activos) == (5, 5)
    assert read_table(spark, cfg.live(runs.HOURLY_TABLE), "t").first().total_eventos == 5


def test_a_bounded_run_stops(spark, topic, tmp_path):
    rows = gps.parse(envelope_files_stream(spark, topic(message(1))))
    query = runs.start_append(rows, str(tmp_path / "t"), str(tmp_path / "c"), every="1 second")
    assert runs.run_for(query, 3) is False
    assert not query.isActive


def test_late_rows_are_accounted_for(spark, topic, tmp_path):
    """Two trucks' events of a closed hour come after the watermark has passed it."""
    account = str(tmp_path / "late")

    def run():
        stream = fleet.prepare(gps.parse(envelope_files_stream(spark, str(tmp_path / "topic"))))
        with LateRows(spark, account):
            runs.start_append(gps.hourly(stream), str(tmp_path / "t"), str(tmp_path / "c")).awaitTermination()

    topic(message(1), message(2, minute=200))
    run()
    with pytest.raises(MissingDataset):
        read_table(spark, account, "late")
    topic(message(3, minute=5), message(4, minute=6, camion="CAM-002"), message(5, minute=201))
    run()
    rows = read_table(spark, account, "late").collect()
    assert sum(r.filas_descartadas for r in rows) == 2
    assert all(r.lote >= 1 and r.marca_de_agua and r.operador for r in rows)


def test_files_of_a_micro_batch_grow_in_number_not_in_size(spark, tmp_path):
    events = spark.range(400).selectExpr(
        "id as event_id", "timestamp'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, id) as ts", "id % 9 as user_id"
    )
    events.write.parquet(f"{tmp_path}/events.parquet")
    place, files_a_batch = queries._landed_envelope(spark, str(tmp_path), batches=2, most=50)
    landed = spark.read.parquet(place)
    assert files_a_batch == 4 and len(landed.inputFiles()) == 8 and landed.count() == 400
