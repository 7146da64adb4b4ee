from decimal import Decimal

from helpers import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stratalake.functions import text
from stratalake.functions.numbers import ExactSum, round_half_up


def test_half_way_values_round_up_on_their_decimal_reading(spark):
    df = spark.createDataFrame([(1.005,), (2.675,), (-1.005,), (0.125,), (None,)], "x double")
    assert rows(df.select(round_half_up("x", 2))) == [(1.01,), (2.68,), (-1.01,), (0.13,), (None,)]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.integers(-(10**9), 10**9)), min_size=1, max_size=60))
def test_sums_are_exact_in_any_order(spark, cents):
    amounts = [None if c is None else c / 100 for c in cents]
    exact = ExactSum("x")
    for parts in (1, 5):
        df = spark.createDataFrame([(i, a) for i, a in enumerate(amounts)], "k int, x double").repartition(parts)
        direct = df.agg(exact.total_of_rows(), exact.mean_of_rows()).first()
        merged = df.groupBy("k").agg(*exact.partial()).agg(exact.total(), exact.mean()).first()
        known = [c for c in cents if c is not None]
        expected = Decimal(sum(known)) / 100 if known else None
        assert direct[0] == merged[0] == expected
        assert direct[1] == merged[1]


def test_more_decimals_than_expected_are_kept(spark):
    df = spark.createDataFrame([(0.001234,)] * 1000, "x double")
    assert float(df.agg(ExactSum("x", 2).total_of_rows()).first()[0]) == 1.234


def test_what_no_decimal_holds_is_in_neither_sum_nor_count(spark):
    values = [1.0, 4.0, float("nan"), float("inf"), 1e30, 1e21, 1e25, -1e30]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    exact = ExactSum("x")
    assert tuple(df.agg(exact.total_of_rows(), exact.mean_of_rows()).first()) == (5, 2.5)
    assert tuple(df.agg(*exact.partial()).agg(exact.total(), exact.mean()).first()) == (5, 2.5)
    assert rows(df.select(round_half_up("x", 2)))[2:] == [(None,)] * 6


def test_large_values_and_totals_stay_exact(spark):
    df = spark.createDataFrame([(9e15,), (0.25,), (9e15,)], "x double").repartition(3)
    assert df.agg(ExactSum("x").total_of_rows()).first()[0] == Decimal("18000000000000000.25")
    many = spark.range(300_000).selectExpr("999999999999D as x", "id % 3 as k")
    merged = many.groupBy("k").agg(*ExactSum("x").partial()).agg(ExactSum("x").total()).first()[0]
    assert merged == 300_000 * Decimal(999999999999)


def test_tolerant_readings(spark):
    df = spark.createDataFrame([("3.7",), ("-3.7",), ("12",), ("x",), (None,)], "s string")
    assert rows(df.select(text.lenient_int(F.col("s")))) == [(3,), (-3,), (12,), (None,), (None,)]
    flags = spark.createDataFrame([("TRUE",), (" true ",), ("false",), ("1",), (None,)], "s string")
    assert rows(flags.select(text.is_true(F.col("s")))) == [(True,), (True,), (False,), (False,), (False,)]
