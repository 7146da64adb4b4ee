from datetime import date, datetime

from stratalake.operators import clean
from stratalake.sources.schemas import PRODUCT_RAW, SALES_RAW

GOOD = dict(
    id_venta="1",
    id_cliente="10",
    id_producto="5",
    cantidad="2",
    precio_unitario="3.5",
    monto="7.0",
    fecha_venta="2026-01-31",
    canal=" pos ",
    pais="el salvador",
    categoria=" HOGAR ",
    created_at="x",
)


def sales(spark, *changes, landed="2026-02-01 00:00:00"):
    data = [tuple({**GOOD, **change}.get(c) for c in SALES_RAW) for change in changes]
    df = spark.createDataFrame(data, ", ".join(f"{c} string" for c in SALES_RAW))
    return df.selectExpr("*", f"timestamp'{landed}' as _ingestion_timestamp", "'b' as _batch_id")


def test_text_is_normalised_and_calendar_added(spark):
    (row,) = clean.SALES.clean(sales(spark, {})).collect()
    assert (row.canal, row.pais, row.categoria) == ("POS", "El Salvador", "hogar")
    assert (row.anio, row.mes, row.anio_mes) == (2026, 1, "2026-01")
    assert row.fecha_venta == date(2026, 1, 31)
    assert "created_at" not in row and row._batch_id == "b"


def test_bad_cells_reject_the_row_and_say_why(spark):
    bad = [
        {"id_venta": "abc"},
        {"monto": ""},
        {"monto": "0"},
        {"monto": "-1"},
        {"monto": "NaN"},
        {"monto": "Infinity"},
        {"monto": "1e21"},
        {"cantidad": "0"},
        {"cantidad": "3.7"},
        {"fecha_venta": "2026-13-01"},
        {"id_cliente": None},
    ]
    typed = clean.SALES.project(sales(spark, *bad))
    assert clean.SALES.accepted(typed).count() == 0
    reasons = [r[clean.FAILED] for r in clean.SALES.rejects(typed).collect()]
    assert reasons == [
        ["id_venta presente"],
        ["monto positivo"],
        ["monto positivo"],
        ["monto positivo"],
        ["monto en rango"],
        ["monto en rango"],
        ["monto en rango"],
        ["cantidad positiva"],
        ["cantidad positiva"],
        ["fecha_venta presente"],
        ["id_cliente presente"],
    ]


def test_optional_price_may_be_missing(spark):
    (row,) = clean.SALES.clean(sales(spark, {"precio_unitario": "n/a"})).collect()
    assert row.precio_unitario is None


def test_lenient_quantity(spark):
    (row,) = clean.SALES.clean(sales(spark, {"cantidad": "3.7"}), lenient_int=True).collect()
    assert row.cantidad == 3


def test_latest_batch_wins(spark):
    old = sales(spark, {"monto": "99"}, landed="2026-02-01 00:00:00")
    new = sales(spark, {"monto": "7"}, landed="2026-02-02 00:00:00")
    (row,) = clean.SALES.clean(old.union(new)).collect()
    assert row.monto == 7.0 and row._ingestion_timestamp == datetime(2026, 2, 2)


def test_rule_hits_count_passes_and_failures(spark):
    typed = clean.SALES.project(sales(spark, {}, {"monto": "0"}, {"monto": None, "id_venta": "x"}))
    hits = {r.quality_rule: (r.passed, r.failed) for r in clean.SALES.rule_hits(typed).collect()}
    assert hits["monto positivo"] == (1, 2)
    assert hits["id_venta presente"] == (2, 1)
    assert hits["cantidad positiva"] == (3, 0)


def test_products(spark):
    data = [
        ("1", " Silla ", "HOGAR ", " P ", "10.5", "TRUE"),
        ("2", "Mesa", "hogar", "P", "11", "false"),
        ("3", "Luz", "hogar", "P", "12", None),
        ("4", "Roto", "hogar", "P", "0", "true"),
        ("5", "Roto", "hogar", "P", None, "true"),
        ("2", "Mesa", "hogar", "P", "11", "false"),
    ]
    df = spark.createDataFrame(data, ", ".join(f"{c} string" for c in PRODUCT_RAW))
    got = {r.id_producto: r for r in clean.PRODUCTS.clean(df).collect()}
    assert sorted(got) == [1, 2, 3]
    assert [got[i].activo for i in (1, 2, 3)] == [True, False, False]
    assert (got[1].nombre_producto, got[1].categoria, got[1].proveedor) == ("Silla", "hogar", "P")


def test_web_events(spark):
    data = [
        ("1", "7", " s ", "/HOME ", "LOGIN", " Mobile", "2026-01-05T10:20:30.000Z", "web_api"),
        ("1", "7", " s ", "/HOME ", "LOGIN", " Mobile", "2026-01-05T10:20:30.000Z", "web_api"),
        ("2", "7", "s", "/", "login", "mobile", "never", "web_api"),
        ("3", None, "s", "/", "login", "mobile", "2026-01-05 10:20:30", "web_api"),
    ]
    columns = "event_id string, id_cliente string, session_id string, page string, event_type string, device string"
    df = spark.createDataFrame(data, f"{columns}, event_timestamp string, ingestion_source string")
    (row,) = clean.WEB_EVENTS.clean(df).collect()
    assert (row.session_id, row.page, row.event_type, row.device) == ("s", "/home", "login", "mobile")
    assert row.fecha_evento == date(2026, 1, 5) and row.anio_mes == "2026-01"


def test_empty_input(spark):
    assert clean.SALES.clean(sales(spark, {}).limit(0)).count() == 0


def test_rules_do_not_read_the_cells_again(spark):
    """Pushed below the readings, each rule of the amount would parse its text anew."""
    plan = clean.SALES.clean(sales(spark, {}))._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in plan.splitlines() if "Filter" in line]
    assert filters and not any("cast" in line for line in filters)
    assert plan.count("try_cast(monto") == 1
