"""Landing files through every layer to the published extracts."""

import json
from pathlib import Path

import pytest

from stratalake.config import FLEET_TABLES, GOLD_TABLES, PUBLISHED, LakeConfig
from stratalake.operators.quality import EmptyTable
from stratalake.plans.bronze import run_bronze
from stratalake.plans.gold import run_fleet, run_gold
from stratalake.plans.publish import run_publish
from stratalake.plans.silver import run_silver
from stratalake.plans.stream import start_stream_bronze
from stratalake.operators.variant import field, line_schema, unknown_fields
from stratalake.sinks.tables import store_counted
from stratalake.sources.files import read_csv, read_json, read_table
from stratalake.sources.messages import envelope_files_stream
from stratalake.sources.schemas import ENVELOPE

SALES = """id_venta,id_cliente,id_producto,cantidad,precio_unitario,monto,fecha_venta,canal,pais,categoria,created_at
1,10,1,2,50.0,100.0,2026-01-15,pos,guatemala,HOGAR,x
1,10,1,2,50.0,100.0,2026-01-15,pos,guatemala,HOGAR,x
2,11,2,1,30.0,30.0,2026-01-20,web,el salvador,moda,x
3,12,9,1,20.0,20.0,2026-02-02,app,honduras,deportes,x
4,10,1,0,50.0,50.0,2026-02-03,pos,guatemala,hogar,x
abc,10,1,1,50.0,50.0,2026-02-03,pos,guatemala,hogar,x
5,10,1,1,50.0,50.0,2026-13-03,pos,guatemala,hogar,x
"""
EVENTS = [
    dict(event_id=1, id_cliente=10, session_id="s1", page="/HOME", event_type="Login", device="mobile"),
    dict(event_id=2, id_cliente=10, session_id="s1", page="/home", event_type="login", device="mobile"),
    dict(event_id=3, id_cliente=None, session_id="s1", page="/home", event_type="login", device="mobile"),
]
PRODUCTS = """<?xml version='1.0' encoding='utf-8'?>
<productos><producto><id_producto>1</id_producto><nombre_producto>Silla</nombre_producto><categoria>muebles</categoria>
<proveedor>P</proveedor><precio_base>40.0</precio_base><activo>true</activo></producto>
<producto><id_producto>2</id_producto><nombre_producto>Falda</nombre_producto><categoria>moda</categoria>
<proveedor>Q</proveedor><precio_base>35.5</precio_base><activo>no</activo></producto>
<producto><id_producto>3</id_producto><nombre_producto>Gratis</nombre_producto><precio_base>0</precio_base></producto>
</productos>"""


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    raw = root / "data" / "raw"
    for folder, name, text in (
        ("csv/ventas", "part-0.csv", SALES),
        ("json/web_events", "part-0.json", "\n".join(json.dumps({**e, "event_timestamp": "2026-01-05T10:20:30.000Z", "ingestion_source": "web_api"}) for e in EVENTS)),
        ("xml", "productos.xml", PRODUCTS),
    ):
        (raw / folder).mkdir(parents=True)
        (raw / folder / name).write_text(text, encoding="utf-8")
    cfg = LakeConfig(root=str(root), batch_id="run-1")
    bronze, silver = run_bronze(spark, cfg), run_silver(spark, cfg, keep_rejects=True)
    return cfg, bronze, silver, run_gold(spark, cfg)


def test_bronze(spark, lake):
    cfg, bronze, _, _ = lake
    assert {name: df.count() for name, df in bronze.items()} == {"ventas": 7, "web_events": 3, "productos": 3}
    row = bronze["productos"].first()
    assert (row._source_system, row._source_format, row._batch_id) == ("MASTER_DATA", "XML", "run-1")
    audit = {r.dataset: r for r in spark.read.parquet(cfg.bronze("audit_ingestion")).collect()}
    assert {n: (r.batch_id, r.source_format, r.record_count) for n, r in audit.items()} == {
        "ventas": ("run-1", "CSV", 7),
        "web_events": ("run-1", "JSON", 3),
        "productos": ("run-1", "XML", 3),
    }
    assert audit["ventas"].target_path == "data/bronze/ventas" and audit["ventas"].processed_at


def test_silver(spark, lake):
    cfg, _, silver, _ = lake
    assert sorted(r.id_venta for r in silver["ventas"].collect()) == [1, 2, 3]
    enriched = {r.id_venta: r for r in silver["ventas_enriquecidas"].collect()}
    assert [(enriched[i].categoria_final, enriched[i].margen_estimado) for i in (1, 2, 3)] == [
        ("muebles", 20.0),
        ("moda", -5.5),
        ("deportes", None),
    ]
    assert {"_batch_id", "processed_at", "anio_mes", "producto_activo"} <= set(silver["ventas_enriquecidas"].columns)
    report = {r.table_name: r.record_count for r in silver["data_quality_report"].collect()}
    assert report == {"ventas": 3, "web_events": 2, "productos": 2, "ventas_enriquecidas": 3}
    rejects = read_table(spark, cfg.silver("ventas_rechazos"), "ventas_rechazos")
    assert rejects.count() == 3
    assert sorted(p.name for p in Path(cfg.silver("ventas")).rglob("anio_mes=*")) == [
        "anio_mes=2026-01",
        "anio_mes=2026-02",
    ]


def test_rule_hits_are_counted_by_the_writes(spark, lake):
    cfg, bronze, _, _ = lake
    hits = {(r.table_name, r.quality_rule): (r.passed, r.failed) for r in read_table(spark, cfg.silver("data_quality_rules"), "q").collect()}
    assert hits["ventas", "id_venta presente"] == (6, 1) and hits["ventas", "cantidad positiva"] == (6, 1)
    assert hits["productos", "precio_base positivo"] == (2, 1)
    assert all(sum(v) == bronze[name].count() for (name, _), v in hits.items())


def test_unknown_fields_are_reported(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"event_id": 1, "x": 1, "y": {"z": 2}}\n{"event_id": 2, "x": "a"}\nbroken\n[1]\n{"x": 5}\n')
    landed = read_json(spark, str(tmp_path), "web", ["event_id"])
    rows = {tuple(r) for r in unknown_fields(landed, ["event_id"]).collect()}
    assert rows == {("x", "BIGINT", 2), ("x", "STRING", 1), ("y", "OBJECT<z: BIGINT>", 1)}
    values = [r[0] for r in landed.select(field("$.y.z", "int")).collect()]
    assert sorted(v for v in values if v is not None) == [2]
    assert "x" in line_schema(landed.where("event_id is not null")).first().esquema


def test_one_job_counts_and_writes(spark, tmp_path):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("counted", "")
    try:
        _, n = store_counted(spark.range(1000, numPartitions=3), str(tmp_path / "t"), "t")
        assert n == 1000 and len(tracker.getJobIdsForGroup("counted")) == 1
    finally:
        spark.sparkContext._jsc.clearJobGroup()


def test_gold(lake):
    _, _, _, gold = lake
    assert tuple(gold["kpis_generales"].first())[:-1] == (3, 3, 3, 150.0, 50.0, 100.0, 20.0, 4, 7.25)
    assert [tuple(r)[:2] for r in gold["ventas_mensuales"].collect()] == [("2026-01", 2), ("2026-02", 1)]
    assert gold["cliente_mayor_volumen"].first().id_cliente == 10
    shares = {r.id_cliente: (r.ranking_cliente, r.porcentaje_acumulado) for r in gold["pareto_80_clientes"].collect()}
    assert shares == {10: (1, 0.6667), 11: (2, 0.8667), 12: (3, 1.0)}
    assert gold["web_kpis"].first().total_eventos == 2
    names = [r.table_name for r in gold["catalogo_gold"].collect()]
    assert sorted(names) == sorted(f"gold_{n}" for n in GOLD_TABLES)
    assert all("generated_at" in df.columns for df in gold.values())


def test_fleet_and_publishing(spark, lake, tmp_path):
    cfg, _, _, gold = lake
    value = json.dumps(
        dict(event_id=1, timestamp_evento="2026-01-05T10:00:00+00:00", camion="CAM-001", zona="Ruta_Pacifico", toneladas=2.5)
    )
    from datetime import datetime

    data = [("gpscamiones", 0, 0, datetime(2026, 1, 5), b"CAM-001", value.encode())]
    spark.createDataFrame(data, ENVELOPE).write.parquet(str(tmp_path / "topic"))
    start_stream_bronze(spark, cfg, envelope_files_stream(spark, str(tmp_path / "topic"))).awaitTermination()
    fleet = run_fleet(spark, cfg)
    assert fleet["rt_kpis_generales"].first().toneladas_transportadas == 2.5
    assert fleet["rt_alertas_operativas"].count() == 0
    assert fleet["rt_catalogo"].count() == len(FLEET_TABLES)

    manifest = run_publish(spark, cfg).collect()
    assert [(r.dataset, r.status) for r in manifest] == [(name, "EXPORTED") for name in PUBLISHED]
    monthly = read_csv(spark, cfg.extract("final/ventas_mensuales"))
    # The extract is the written table, its clock column included.
    written = gold["ventas_mensuales"].collect()
    assert [r.generated_at[:19].replace("T", " ") for r in monthly.collect()] == [str(r.generated_at)[:19] for r in written]


def test_a_second_batch_is_added_to_the_audit(spark, lake):
    cfg, _, _, _ = lake
    run_bronze(spark, LakeConfig(root=cfg.root, batch_id="run-2"))
    batches = {r.batch_id for r in spark.read.parquet(cfg.bronze("audit_ingestion")).collect()}
    assert batches == {"run-1", "run-2"}


def test_missing_and_empty_inputs_stop_the_run(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="ventas"):
        run_bronze(spark, LakeConfig(root=str(tmp_path)))
    with pytest.raises(FileNotFoundError, match="bronze_ventas"):
        run_silver(spark, LakeConfig(root=str(tmp_path)))
    with pytest.raises(FileNotFoundError, match="silver_ventas_enriquecidas"):
        run_gold(spark, LakeConfig(root=str(tmp_path)))
    raw = tmp_path / "data" / "raw"
    (raw / "csv" / "ventas").mkdir(parents=True)
    (raw / "csv" / "ventas" / "a.csv").write_text(SALES.splitlines()[0] + "\n")
    (raw / "json" / "web_events").mkdir(parents=True)
    (raw / "json" / "web_events" / "a.json").write_text('{"event_id": 1}\n')
    (raw / "xml").mkdir()
    (raw / "xml" / "productos.xml").write_text(PRODUCTS)
    with pytest.raises(EmptyTable, match="ventas"):
        run_bronze(spark, LakeConfig(root=str(tmp_path)))


def test_configuration_from_the_environment(monkeypatch):
    monkeypatch.setenv("APP_HOME", "/lake/")
    monkeypatch.setenv("STREAMING_RUNTIME_SECONDS", "7")
    cfg = LakeConfig.from_env(fmt="delta")
    assert cfg.gold("web_kpis") == "/lake/data/gold/web_kpis"
    assert (cfg.runtime_seconds, cfg.fmt, cfg.topic) == (7, "delta", "gpscamiones")
