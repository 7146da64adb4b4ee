"""Cumulative share of the total by descending amount, without a single-task window.

The rows are laid out in slices ordered by (total descending, entity), which also cuts through a
group of equal totals. Each slice ranks and accumulates its own rows; what lies before a slice is
added from a table with one line per slice. The running total counts every row with an equal total
(a RANGE frame), so a group of equals that continues in later slices adds those rows, too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stratalake.functions.numbers import round_half_up
from stratalake.session import settle

# Segment names and threshold.
CONCENTRATED = "Clientes que concentran el 80% del ingreso"
REST = "Resto de clientes"
THRESHOLD = 0.80


def _slice_table(ranged: DataFrame, entity: str, total: str) -> DataFrame:
    """Per slice: rows and sum before it, its lowest total, and the equals of that in later slices."""
    bounds = settle(
        ranged.groupBy("_slice").agg(
            F.count(F.lit(1)).alias("rows"),
            F.sum(total).alias("amount"),
            F.max(total).alias("high"),
            F.min(total).alias("low"),
            F.min(entity).alias("first"),
        )
    )
    heads = (
        ranged.join(F.broadcast(bounds.select("_slice", "high")), "_slice")
        .filter(F.col(total) == F.col("high"))
        .groupBy("_slice")
        .agg(F.sum(total).alias("head"))
    )
    # From here on there is one row per slice, at most as many as shuffle partitions. Both tables are
    # used more than once below; settled, each costs one pass over the customers.
    bounds = settle(bounds.join(heads, "_slice"))
    position = [F.desc("high"), F.desc("low"), F.asc("first")]
    before = W.orderBy(*position).rowsBetween(W.unboundedPreceding, -1)
    everything = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    equals_later = W.partitionBy("high").orderBy(*position).rowsBetween(1, W.unboundedFollowing)
    placed = bounds.select(
        "_slice",
        "high",
        "low",
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"),
        F.coalesce(F.sum("amount").over(before), F.lit(0)).alias("amount_before"),
        F.sum("amount").over(everything).alias("grand_total"),
        F.coalesce(F.sum("head").over(equals_later), F.lit(0)).alias("same_as_high_later"),
        F.sum("head").over(W.partitionBy("high")).alias("same_as_high"),
    )
    # A slice whose lowest total opens other slices is followed by all of those.
    opened = placed.groupBy(F.col("high").alias("low")).agg(F.first("same_as_high").alias("opened"))
    later = F.when(F.col("low") == F.col("high"), F.col("same_as_high_later")).otherwise(
        F.coalesce("opened", F.lit(0))
    )
    return placed.join(opened, "low", "left").select(
        "_slice", "low", "rows_before", "amount_before", "grand_total", later.alias("low_later")
    )


def cumulative(df: DataFrame, entity: str, total: str, slices: int | None = None) -> DataFrame:
    """Add rank, running total (equals share it) and grand total to one row per ``entity``.

    ``total`` must be a decimal or whole number, so that sums do not depend on the order of addition. The layout is
    computed once into reliable storage: the two passes over it must see identical slices.
    """
    order = [F.desc(total), F.asc(entity)]
    ranged = df.repartitionByRange(slices, *order) if slices else df.repartitionByRange(*order)
    ranged = settle(ranged.withColumn("_slice", F.spark_partition_id()))
    placed = ranged.join(F.broadcast(_slice_table(ranged, entity, total)), "_slice")
    # rows_before tells slices apart and orders them: one shuffle both gathers the slices for the
    # windows and leaves the result sorted by rank.
    placed = placed.repartitionByRange("rows_before")
    within = W.partitionBy("rows_before")
    reached = F.sum(total).over(within.orderBy(F.desc(total)))
    unseen = F.when(F.col(total) == F.col("low"), F.col("low_later")).otherwise(F.lit(0))
    return placed.select(
        *df.columns,
        (F.row_number().over(within.orderBy(*order)) + F.col("rows_before")).alias("rank"),
        (F.col("amount_before") + reached + unseen).alias("running_total"),
        "grand_total",
    )


def pareto(customers: DataFrame, threshold: float = THRESHOLD, slices: int | None = None) -> DataFrame:
    """Customers in order of income with their cumulative share and segment.

    ``customers`` has id_cliente, ventas and total (decimal). The share is rounded before it is
    compared with the threshold.
    """
    cents = (F.col("total") * 100).cast("decimal(38,0)").alias("cents")
    ranked = cumulative(customers.select("id_cliente", "ventas", cents), "id_cliente", "cents", slices)
    share = F.try_divide(F.col("running_total").cast("double"), F.col("grand_total").cast("double"))
    percent = round_half_up(F.col("porcentaje_acumulado") * 100, 2)
    return ranked.select(
        "id_cliente",
        F.col("ventas").alias("cantidad_ventas"),
        (F.col("cents").cast("double") / 100).alias("total_comprado"),
        (F.col("grand_total").cast("double") / 100).alias("ingreso_global"),
        F.col("rank").cast("bigint").alias("ranking_cliente"),
        (F.col("running_total").cast("double") / 100).alias("ingreso_acumulado"),
        round_half_up(share, 4).alias("porcentaje_acumulado"),
    ).withColumns(
        {
            "porcentaje_acumulado_label": F.concat(percent.cast("string"), F.lit("%")),
            "segmento_pareto": F.when(F.col("porcentaje_acumulado") <= threshold, CONCENTRATED).otherwise(REST),
        }
    )


def pareto_summary(pareto_table: DataFrame) -> DataFrame:
    """Customers, income and highest share per segment; there is one row per customer."""
    income = F.sum(F.col("total_comprado").cast("decimal(28,2)"))
    table = pareto_table.groupBy("segmento_pareto").agg(
        F.count("id_cliente").alias("cantidad_clientes"),
        income.cast("double").alias("ingreso_segmento"),
        round_half_up(F.max("porcentaje_acumulado") * 100, 2).alias("porcentaje_acumulado_maximo"),
    )
    return table.orderBy(F.desc("ingreso_segmento"))
