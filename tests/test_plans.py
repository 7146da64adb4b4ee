"""Plans of the registered reports: no join that a report does not use."""

import re
import threading
from pathlib import Path

import pytest

from contract.queries import QUERIES, sinks
from stratalake.operators import fleet
from stratalake.sources import star
from stratalake.streaming import gps

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="needs the star-schema tables")


@pytest.mark.parametrize("name", ["kpi_customer", "top_customer"])
def test_customer_reports_join_the_orders_only(spark, plan_of, name):
    plan = plan_of(QUERIES[name](spark, FOLDER))
    assert len(re.findall(r"(?:SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin) ", plan)) == 1
    assert "customer.parquet" not in plan and "part.parquet" not in plan


def test_the_ten_sales_are_taken_before_any_join(spark):
    """Which needs that every line has its order, and every order its customer and nation."""
    for name, key, other, other_key in (
        ("lineitem", "l_orderkey", "orders", "o_orderkey"),
        ("orders", "o_custkey", "customer", "c_custkey"),
        ("customer", "c_nationkey", "nation", "n_nationkey"),
    ):
        rows, known = (spark.read.parquet(f"{FOLDER}/{n}.parquet") for n in (name, other))
        assert rows.join(known.withColumnRenamed(other_key, key), key, "left_anti").count() == 0
    plan = QUERIES["top10_sales"](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.index("GlobalLimit 10", plan.index("Join"))


def test_distinct_counts_copy_no_sale(spark, plan_of):
    plan = plan_of(QUERIES["kpi_overall"](spark, FOLDER))
    assert "Expand" not in plan or plan.index("Expand") < plan.index("functions=[count(id_venta")


def test_a_message_is_read_once_whatever_is_filtered(spark):
    """Rules and alert conditions filter on many fields of a message; its text is parsed for none of them again."""
    envelope = star.envelope(spark, FOLDER, faulty=True)
    parsed = gps.parse(envelope)
    for df in (parsed, fleet.prepare(parsed), fleet.alerts(fleet.prepare(parsed)), gps.unreadable(parsed)):
        assert df._jdf.queryExecution().optimizedPlan().toString().lower().count("from_json(") == 1


def test_scores_are_computed_once(spark):
    plan = fleet.prepare(star.gps(spark, FOLDER))._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in plan.splitlines() if "Filter" in line]
    assert filters and not any("least(" in line or "CAM-" in line for line in filters)


def test_sketched_rollups_have_no_truck_among_their_keys(spark, plan_of):
    rollup = fleet.fleet_rollup(fleet.prepare(star.gps(spark, FOLDER)), fleet.SKETCH_KEYS)
    assert "camion" not in rollup.columns and fleet.SKETCH in rollup.columns
    assert re.search(r"keys=\[fecha_evento[^]]*estado_entrega#\d+\]", plan_of(rollup))


def test_the_tables_of_the_quality_report_are_written_side_by_side(spark, monkeypatch):
    all_begun = threading.Barrier(4)

    def write(df, path, name):
        all_begun.wait(60)
        return df, len(name)

    monkeypatch.setattr(sinks, "store_counted", write)
    rows = QUERIES["quality_report"](spark, FOLDER).collect()
    assert [(r.table_name, r.record_count) for r in rows] == [(n, len(n)) for n in ("ventas", "web_events", "productos", "ventas_enriquecidas")]
