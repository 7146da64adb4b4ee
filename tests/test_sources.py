from types import SimpleNamespace

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from stratalake.config import LakeConfig
from stratalake.operators import clean
from stratalake.plans.publish import run_publish
from stratalake.session import run_dir, shared_dir
from stratalake.sinks import tables as sinks
from stratalake.sinks.messages import as_messages, send
from stratalake.sources import files, messages, schemas


def test_csv_goes_by_its_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("b,a\n1,x\n2,\n")
    got = files.read_csv(spark, str(tmp_path)).orderBy("b")
    assert got.dtypes == [("b", "string"), ("a", "string")]
    assert [r.asDict() for r in got.collect()] == [{"b": "1", "a": "x"}, {"b": "2", "a": None}]


def test_csv_with_another_header_is_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text("b,a\n1,x\n")
    with pytest.raises(Exception, match="header"):
        files.read_csv(spark, str(tmp_path), columns=["a", "b"]).collect()


def test_csv_files_with_different_headers_are_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\n1,x\n")
    (tmp_path / "b.csv").write_text("b,a\nx,1\n")
    with pytest.raises(Exception, match="header"):
        files.read_csv(spark, str(tmp_path)).collect()


def test_json_lines_lose_nothing(spark, tmp_path):
    lines = ['{"event_id": "12", "page": "/x"}', '{"event_id": 7.0, "page": 5, "more": [1]}', "{broken", '{"event_id": 7.5}', "[1]", "  "]
    (tmp_path / "a.json").write_text("\n".join(lines) + "\n")
    landed = files.read_json(spark, str(tmp_path), "web", schemas.WEB_RAW)
    got = {r[files.RAW_LINE]: (r.event_id, r.page) for r in landed.collect()}
    assert got == dict(zip(lines[:5], [("12", "/x"), ("7.0", "5"), (None, None), ("7.5", None), (None, None)], strict=True))
    typed = clean.WEB_EVENTS.project(landed, carry=[files.RAW_LINE])
    assert [r.event_id for r in typed.orderBy(files.RAW_LINE).collect()] == [None, 12, 7, None, None]


def test_xml_missing_element_is_null(spark, tmp_path):
    path = tmp_path / "p.xml"
    path.write_text(
        "<?xml version='1.0' encoding='utf-8'?><productos>"
        "<producto><id_producto>1</id_producto><nombre_producto>Caf&#233;</nombre_producto><activo>true</activo></producto>"
        "<producto><id_producto>2</id_producto><precio_base>5</precio_base></producto></productos>"
    )
    got = files.read_xml(spark, str(path), schemas.PRODUCT_ROW_TAG, schemas.PRODUCT_RAW).orderBy("id_producto").collect()
    assert [(r.id_producto, r.nombre_producto, r.precio_base, r.activo) for r in got] == [
        ("1", "Café", None, "true"),
        ("2", None, "5", None),
    ]


@pytest.mark.parametrize(
    "read",
    [
        lambda s, p: files.read_csv(s, p, "ventas"),
        lambda s, p: files.read_json(s, p, "ventas", schemas.WEB_RAW),
        lambda s, p: files.read_xml(s, p, "producto", schemas.PRODUCT_RAW, "ventas"),
        lambda s, p: files.read_table(s, p, "ventas"),
    ],
)
def test_missing_input_names_the_dataset(spark, tmp_path, read):
    with pytest.raises(FileNotFoundError, match="ventas"):
        read(spark, str(tmp_path / "none"))


def test_a_single_month_is_read_from_its_partition(spark, tmp_path, plan_of):
    df = spark.range(100).selectExpr("id", "concat('2026-0', id % 5 + 1) as anio_mes")
    table = sinks.store(sinks.clustered_for(df, "anio_mes"), str(tmp_path / "t"), "t", partition_by=("anio_mes",))
    assert dict(table.dtypes)["anio_mes"] == "string"
    months = table.filter(table.anio_mes.between("2026-02", "2026-03"))
    assert months.count() == 40
    plan = plan_of(months)
    assert "PartitionFilters: [isnotnull(anio_mes" in plan and "PushedFilters: []" in plan


def test_a_large_month_is_written_by_several_tasks(spark, tmp_path):
    """The write does not depend on the number of months: one month gives several files."""
    settings = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "32KB"}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        df = spark.range(0, 200_000, 1, 8).selectExpr("id", "uuid() as text", "'2026-01' as anio_mes")
        sinks.write_table(sinks.clustered_for(df, "anio_mes"), str(tmp_path / "t"), partition_by=("anio_mes",))
        assert len(list((tmp_path / "t").rglob("anio_mes=2026-01/*.parquet"))) > 4
    finally:
        for name in settings:
            spark.conf.unset(name)


def test_only_touched_partitions_are_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    by_month = {"partition_by": ("anio_mes",)}
    sinks.write_table(spark.sql("select 1 as x, '2026-01' as anio_mes union all select 2, '2026-02'"), path, **by_month)
    sinks.write_table(spark.sql("select 3 as x, '2026-02' as anio_mes"), path, only_touched_partitions=True, **by_month)
    assert sorted(tuple(r) for r in files.read_table(spark, path, "t").collect()) == [(1, "2026-01"), (3, "2026-02")]


def test_overwrite_replaces_the_schema(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_table(spark.sql("select 1 as x"), path)
    assert sinks.store(spark.sql("select 'a' as y, 2D as z"), path, "t").columns == ["y", "z"]


def test_extract_layout_is_fixed_and_in_order(spark, tmp_path):
    """A sorted table of several files gives a sorted extract, in one file or in many."""
    df = spark.range(0, 4000, 1, 8).withColumn("text", F.lit("ñandú, \"x\"")).withColumn("n", F.col("id") % 10)
    table = sinks.store(df.orderBy(F.desc("n"), "id").repartition(8), str(tmp_path / "t"), "t")
    for one_file in (True, False):
        out = tmp_path / f"x{one_file}"
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            sinks.write_extract(table, str(out), ["-n", "id"], one_file)
        finally:
            spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        parts = sorted(out.glob("part-*.csv"))
        assert (len(parts) == 1) == one_file
        lines = [line.split(",") for p in parts for line in p.read_text(encoding="utf-8").splitlines() if line[:2] != "id"]
        keys = [(-int(line[-1]), int(line[0])) for line in lines]
        assert keys == sorted(keys) and len(keys) == 4000
        assert parts[0].read_text(encoding="utf-8").startswith("id,text,n\n")


def test_messages_have_a_key_and_a_json_value(spark):
    df = spark.sql("select 'CAM-001' as camion, 1.5D as toneladas, cast(null as int) as espera")
    assert tuple(as_messages(df, "camion").first()) == ("CAM-001", '{"camion":"CAM-001","toneladas":1.5}')


def test_topics_need_the_connector(spark):
    """Without the connector on the classpath the error names the missing source."""
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        messages.topic_stream(spark, "localhost:1", "gpscamiones")
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        send(spark.sql("select 'k' as key, 'v' as value"), "localhost:1", "gpscamiones")


def test_the_named_shared_folder_is_used():
    named = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: {"spark.checkpoint.dir": "hdfs:///shared"}[key]))
    assert shared_dir(named) == "hdfs:///shared"


def test_run_folders_stand_in_one_folder_of_the_application(spark):
    first, second = run_dir(spark, "x"), run_dir(spark, "x")
    assert first != second
    assert f"{shared_dir(spark).rstrip('/')}/{spark.sparkContext.applicationId}/x-" in first


def test_a_cluster_without_a_shared_folder_is_refused():
    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    unnamed = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: default), sparkContext=context)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(unnamed)


def test_publishing_goes_on_after_a_missing_and_a_broken_table(spark, tmp_path):
    cfg = LakeConfig(root=str(tmp_path))
    sinks.write_table(spark.sql("select '2026-01' as anio_mes, 'view' as event_type, 'tablet' as device, 1 as x"), cfg.gold("web_kpis"))
    broken = tmp_path / "data" / "gold" / "resumen_pareto"
    broken.mkdir(parents=True)
    (broken / "part-0.parquet").write_text("no parquet")
    manifest = {r.dataset: r for r in run_publish(spark, cfg, ["resumen_pareto", "top10_ventas", "web_kpis"]).collect()}
    assert [manifest[n].status for n in ("resumen_pareto", "top10_ventas", "web_kpis")] == ["ERROR", "SKIPPED", "EXPORTED"]
    assert manifest["web_kpis"].message == "Exportado correctamente"
    assert manifest["top10_ventas"].message == "Carpeta no encontrada"
    assert files.read_csv(spark, cfg.extract("final/web_kpis")).count() == 1
    assert files.read_csv(spark, cfg.extract("final/powerbi_manifest")).count() == 3
