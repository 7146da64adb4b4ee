import re

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from stratalake.operators import sales
from stratalake.sinks import tables as sinks

SALES = (
    "id_venta bigint, id_cliente bigint, id_producto bigint, cantidad int, monto double, margen_estimado double, "
    "anio_mes string, categoria_final string, canal string"
)
DATA = [
    (1, 10, 5, 2, 10.00, 1.0, "2026-01", "hogar", "POS"),
    (2, 10, 6, 1, 20.01, None, "2026-01", "moda", "WEB"),
    (3, 11, 5, 4, 0.10, -2.5, "2026-02", "hogar", "POS"),
    (4, 12, 5, 1, 30.01, 3.0, "2026-02", None, "POS"),
]


@pytest.fixture
def df(spark):
    return spark.createDataFrame(DATA, SALES)


def test_overall(df):
    assert tuple(sales.overall(df).first()) == (4, 3, 2, 60.12, 15.03, 30.01, 0.1, 8, 0.5)


def test_overall_of_nothing_is_one_row(df):
    assert tuple(sales.overall(df.limit(0)).first()) == (0, 0, 0, None, None, None, None, None, None)


def test_overall_from_rollup_and_table(df):
    for rows in (df, df.limit(0)):
        table = sales.overall_of_table(sales.sales_rollup(rows, sales.MONTH_KEYS, margin=True), rows)
        assert table.schema.names == sales.overall(rows).schema.names
        assert tuple(table.first()) == tuple(sales.overall(rows).first())


def test_a_full_rollup_gives_the_same_tables_as_a_narrow_one(df):
    full = sales.sales_rollup(df, ("anio_mes", "categoria_final", "canal", "id_cliente"), margin=True)
    narrow = sales.sales_rollup(df, sales.MONTH_KEYS, margin=True)
    assert sales.monthly(full).collect() == sales.monthly(narrow).collect()
    first, second = sales.monthly(full).collect()
    assert tuple(first) == ("2026-01", 2, 1, 30.01, 15.01, 3, 1.0)
    assert tuple(second) == ("2026-02", 2, 2, 30.11, 15.06, 5, 0.5)


def test_category_channel_keeps_the_missing_category(df):
    got = [tuple(r) for r in sales.by_category_channel(sales.sales_rollup(df, sales.CHANNEL_KEYS)).collect()]
    assert got == [
        (None, "POS", 1, 1, 30.01, 30.01, 1),
        ("moda", "WEB", 1, 1, 20.01, 20.01, 1),
        ("hogar", "POS", 2, 2, 10.1, 5.05, 6),
    ]


def test_customers_and_top_customer_with_a_tie(df):
    customers = sales.by_customer(sales.sales_rollup(df))
    got = [tuple(r) for r in sales.customer_averages(customers).collect()]
    assert got == [
        (10, 2, 30.01, 15.01, 20.01, 10.0),
        (12, 1, 30.01, 30.01, 30.01, 30.01),
        (11, 1, 0.1, 0.1, 0.1, 0.1),
    ]
    assert tuple(sales.top_customer(customers).first()) == (10, 2, 30.01, 15.01, 3, 1)


def test_top_sales_rank_ties_by_id(df):
    more = df.withColumns({c: F.lit("x") for c in ("nombre_producto", "pais", "fecha_venta")}).withColumn(
        "precio_unitario", F.lit(1.0)
    )
    tied = more.withColumn("monto", F.lit(5.0))
    got = [(r.id_venta, r.ranking_venta) for r in sales.top_sales(tied, 3).collect()]
    assert got == [(1, 1), (2, 2), (3, 3)]


def test_top_sales_plan_keeps_k_rows_per_task(df, plan_of):
    more = df.withColumns({c: F.lit("x") for c in ("nombre_producto", "pais", "fecha_venta", "precio_unitario")})
    assert "TakeOrderedAndProject" in plan_of(sales.top_sales(more))


def test_web_activity(spark):
    data = [(1, 7, "a"), (2, 7, "a"), (3, 8, "b")]
    events = spark.createDataFrame(data, "event_id int, id_cliente int, session_id string").selectExpr(
        "*", "'2026-01' as anio_mes", "'login' as event_type", "'mobile' as device"
    )
    assert tuple(sales.web_activity(events).first())[3:] == (3, 2, 2)


def test_top_sales_of_a_table_push_the_kth_amount_into_the_scan(spark, df, tmp_path, plan_of):
    wide = df.withColumns({c: F.lit("x") for c in ("nombre_producto", "pais", "fecha_venta", "precio_unitario")})
    wide.write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    for k in (1, 2, 10):
        assert sales.top_sales_of_table(table, k).collect() == sales.top_sales(table, k).collect()
    plan = plan_of(sales.top_sales_of_table(table))
    assert "ReadSchema: struct<monto:double>" in plan and "DataFilters: [isnotnull(monto" in plan


def test_bitmaps_count_as_exactly_as_rows(spark, df):
    """Ids of zero, below zero, at the borders of groups and far apart; repeated customers; a category that is missing."""
    ids = [0, -1, -32768, -32769, 1, 32768, 32769, 65536, 65537, 10**12, 10**12, 1, 7, 7]
    rows = [(i, c, c % 5, 1, 1.0 + i, 0.5, f"2026-0{i % 3 + 1}", ["hogar", None][i % 2], "POS") for i, c in enumerate(ids)]
    wide = spark.createDataFrame(rows, SALES).repartition(4)
    for given in (df, wide, df.limit(0)):
        months = sales.bitmap_rollup(given, ("anio_mes",), margin=True)
        assert sales.monthly(months).collect() == sales.monthly(sales.sales_rollup(given, sales.MONTH_KEYS, margin=True)).collect()
        channels = sales.bitmap_rollup(given, ("categoria_final", "canal"))
        assert sales.by_category_channel(channels).collect() == sales.by_category_channel(sales.sales_rollup(given, sales.CHANNEL_KEYS)).collect()
        assert tuple(sales.overall_of_table(months, given).first()) == tuple(sales.overall(given).first())


def test_merged_bitmaps_count_a_customer_of_two_batches_once(df):
    first, second = (sales.bitmap_rollup(df.where(c), ("anio_mes",), margin=True) for c in ("id_venta < 3", "id_venta >= 2"))
    again = sales.merge_bitmaps(first.unionByName(second), ("anio_mes",))
    rows = sales.monthly(again).collect()
    assert [(r.anio_mes, r.clientes_unicos, r.total_ventas) for r in rows] == [("2026-01", 1, 3), ("2026-02", 2, 2)]


def test_bitmaps_are_used_for_dense_ids_only(spark):
    ids = spark.range(1000).selectExpr("id as id_cliente")
    assert sales.dense(ids) and not sales.dense(ids.selectExpr("id_cliente * 1000003 as id_cliente"))


def test_web_activity_by_bitmaps(spark):
    data = [(1, 7, "a", "2026-01", "m"), (2, 7, "a", "2026-01", "m"), (3, 8, "b", None, "m"), (4, 9, None, None, "m")]
    events = spark.createDataFrame(data, "event_id int, id_cliente bigint, session_id string, anio_mes string, device string")
    events = events.selectExpr("*", "'login' as event_type")
    assert sales.web_activity_by_bitmaps(events).collect() == sales.web_activity(events).collect()


def scanned_rows(df):
    """Rows that the scans of a query gave out, after row groups and pages were skipped, by the columns they read."""
    df.collect()
    out, left = [], [df._jdf.queryExecution().executedPlan()]
    while left:
        plan = left.pop()
        name = plan.nodeName()
        if name == "AdaptiveSparkPlan":
            left.append(plan.executedPlan())
        elif name.startswith("Scan parquet"):
            out.append((plan.output().length(), plan.metrics().apply("numOutputRows").value()))
        elif "QueryStage" in name:
            left.append(plan.plan())
        left += [plan.children().apply(i) for i in range(plan.children().length())]
    return out


def test_sorted_files_let_the_top_sales_skip_row_groups(spark, tmp_path):
    rows = spark.range(200_000, numPartitions=2).selectExpr(
        "id as id_venta", "id % 997 as id_cliente", "id % 31 as id_producto", "sha2(cast(id as string), 256) as nombre_producto",
        "'c' as categoria_final", "'POS' as canal", "'G' as pais", "'2026-01-05' as fecha_venta", "1 as cantidad",
        "1D as precio_unitario", "cast(pmod(hash(id), 1000000) as double) as monto",
    )
    read = {}
    for name, layout in {"as it comes": rows, "sorted": sinks.sorted_inside(rows, "monto")}.items():
        table = sinks.store(layout, str(tmp_path / name), "t", row_group_bytes=256 << 10)
        groups = [pq.ParquetFile(p).metadata.num_row_groups for p in (tmp_path / name).rglob("*.parquet")]
        assert min(groups) > 4
        top = sales.top_sales_of_table(table)
        wide = [n for columns, n in scanned_rows(top) if columns > 1]
        read[name] = sum(wide)
        assert [r.id_venta for r in top.collect()] == [r.id_venta for r in sales.top_sales(rows).collect()]
    assert 3 * read["sorted"] < read["as it comes"], read


def test_overall_keeps_no_sums_for_pairs_of_product_and_customer(df, plan_of):
    keys = re.findall(r"Aggregate\(keys=\[([^\]]*)\]", plan_of(sales.overall(df)))
    assert any("id_cliente" in k for k in keys)
    assert not any("id_cliente" in k and "id_producto" in k for k in keys)
