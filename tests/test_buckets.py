"""Bucketed tables: what is kept, and that the history is not shuffled."""

import random

import pytest

from contract import queries
from stratalake.operators.dedup import latest
from stratalake.operators.enrich import enrich
from stratalake.sinks import buckets
from stratalake.sinks.versions import read_current

SCHEMA = "id bigint, at int, x double, s string"


def batch(spark, seed, n=300):
    rng = random.Random(seed)
    rows = [(rng.choice([None, 7, 7, *range(60)]), rng.choice([None, 1, 2, 3]), rng.choice([None, 0.5, 1.5]), rng.choice(["a", "b", None])) for _ in range(n)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def by_id(rows):
    return sorted(map(tuple, rows), key=str)


def test_batches_keep_what_all_rows_at_once_keep(spark, tmp_path):
    """A hot id, ids that come in one batch only, ties in all columns; a null id is one more id in every batch."""
    path, parts = str(tmp_path / "t"), [batch(spark, k).where("id is not null") for k in range(3)]
    for part in [*parts, parts[0], parts[1].limit(0)]:
        table = buckets.add_batch(part, path, ["id"], ["at"], 4)
    everything = parts[0].unionByName(parts[1]).unionByName(parts[2])
    assert by_id(table.collect()) == by_id(latest(everything, ["id"], ["at"]).collect())
    assert read_current(spark, path)["buckets"] == {"keys": ["id"], "n": 4}


def test_the_history_is_not_shuffled(spark, tmp_path, plan_of, no_broadcast):
    path = str(tmp_path / "t")
    table = buckets.add_batch(batch(spark, 1).where("id is not null"), path, ["id"], ["at"], 4)
    plan = plan_of(buckets.merge_latest(table, batch(spark, 2), ["id"], ["at"], 4))
    assert "Bucketed: true" in plan
    assert not any("Exchange" in line for line in above(plan, "Bucketed: true"))
    assert plan.count("Exchange hashpartitioning(id#") == 2 and ", 4), REPARTITION_BY_NUM" in plan


def above(plan, mark):
    """Lines of the operators that stand over the one with ``mark``."""
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if mark in line)
    depth = lambda line: next(i for i, c in enumerate(line) if c.isalpha() or c == "*")
    out, least = [], depth(lines[at])
    for line in reversed(lines[:at]):
        if depth(line) < least:
            least = depth(line)
            out.append(line)
    return out


def test_a_merge_makes_one_file_a_bucket(spark, tmp_path):
    path = tmp_path / "t"
    for seed in (1, 2):
        buckets.add_batch(batch(spark, seed).where("id is not null"), str(path), ["id"], ["at"], 4)
    folder = read_current(spark, str(path))["folders"][0]
    assert len(list((path / "_data" / folder).glob("*.parquet"))) == 4


def test_the_catalogue_is_joined_as_it_lies(spark, tmp_path, plan_of, no_broadcast):
    products = spark.range(50).selectExpr(
        "id as id_producto", "'n' as nombre_producto", "'c' as categoria", "'p' as proveedor", "1D as precio_base", "true as activo"
    )
    catalogue = buckets.add_batch(products, str(tmp_path / "p"), ["id_producto"], [], 4)
    sales = spark.range(100).selectExpr("id as id_venta", "id % 70 as id_producto", "1 as cantidad", "2D as monto", "'c' as categoria")
    joined = enrich(sales, catalogue)
    plan = plan_of(joined)
    assert plan.count("Exchange") == 1 and "Bucketed: true" in plan
    assert joined.where("margen_estimado is null").count() == sum(i % 70 >= 50 for i in range(100))


def test_buckets_grow_in_number_with_the_sales(spark, tmp_path):
    spark.range(100).write.parquet(f"{tmp_path}/lineitem.parquet")
    assert queries._buckets(spark, str(tmp_path)) == 16
    assert queries._buckets(spark, str(tmp_path), most=3) == 34
