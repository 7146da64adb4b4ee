"""Sales and web KPIs.

Each table is read off a rollup of the sales by its own keys and the customer, with mergeable sums: customers
are then counted exactly without copying rows, and each rollup scans only the columns it needs. ``id_venta``
is unique after cleaning, hence sales are counted without a distinct.

A rollup by customer has a row for every customer and key. Where ids are dense, such as sequence numbers, a row may stand
for a group of 32,768 ids instead and hold a bitmap of those that occur (``bitmap_rollup``): counts are as exact and
merge as well, and the rollup has as many rows as keys and groups.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stratalake.functions.numbers import ExactSum, round_half_up

AMOUNT = ExactSum("monto", 2)
MARGIN = ExactSum("margen_estimado", 2)
MONTH_KEYS = ("anio_mes", "id_cliente")
CHANNEL_KEYS = ("categoria_final", "canal", "id_cliente")
CUSTOMER_KEYS = ("id_cliente",)


def sales_rollup(sales: DataFrame, keys: tuple[str, ...] = CUSTOMER_KEYS, margin: bool = False) -> DataFrame:
    """Partial results per ``keys``; can be rolled up further without touching the sales again."""
    return sales.groupBy(*keys).agg(
        F.count("id_venta").alias("ventas"),
        F.sum("cantidad").alias("unidades"),
        F.max("monto").alias("monto_max"),
        F.min("monto").alias("monto_min"),
        *AMOUNT.partial(),
        *(MARGIN.partial() if margin else []),
    )


GROUP, MEMBERS = "_grupo", "_miembros"
#: A bitmap takes 4 KB, so with fewer ids a group than this a row for each of them is smaller.
LEAST_IDS_A_GROUP = 128


def bitmap_rollup(
    sales: DataFrame, keys: tuple[str, ...], member: str = "id_cliente", margin: bool = False
) -> DataFrame:
    """``sales_rollup`` by ``keys`` and groups of ``member`` ids, with a bitmap of those that occur."""
    grouped = sales.withColumn(GROUP, F.bitmap_bucket_number(member))
    return grouped.groupBy(*keys, GROUP).agg(
        F.count("id_venta").alias("ventas"),
        F.sum("cantidad").alias("unidades"),
        F.max("monto").alias("monto_max"),
        F.min("monto").alias("monto_min"),
        *AMOUNT.partial(),
        *(MARGIN.partial() if margin else []),
        F.bitmap_construct_agg(F.bitmap_bit_position(member)).alias(MEMBERS),
    )


def merge_bitmaps(rollup: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """One row for ``keys`` and group out of several, of rollups of other batches or of finer keys."""
    ends = {"monto_max": F.max, "monto_min": F.min, MEMBERS: F.bitmap_or_agg}
    values = [
        ends.get(name, F.sum)(name).cast(kind).alias(name)
        for name, kind in rollup.dtypes
        if name in ends or name in ("ventas", "unidades") or name.endswith(("_units", "_rest", "_n"))
    ]
    return rollup.groupBy(*keys, GROUP).agg(*values)


def dense(sales: DataFrame, member: str = "id_cliente") -> bool:
    """Whether bitmaps of the ids are smaller than a row for each; the results are the same."""
    ids, groups = sales.agg(F.approx_count_distinct(member), F.approx_count_distinct(F.bitmap_bucket_number(member))).first()
    return ids >= LEAST_IDS_A_GROUP * groups


def _customers(rollup: DataFrame) -> Column:
    if MEMBERS in rollup.columns:
        return F.coalesce(F.sum(F.bitmap_count(MEMBERS)), F.lit(0)).alias("clientes_unicos")
    return F.count_distinct("id_cliente").alias("clientes_unicos")


def distinct_ids(sales: DataFrame, member: str) -> DataFrame:
    """One row and column: the number of different ids, exact. A map task gives out one bitmap a group of ids."""
    maps = sales.groupBy(F.bitmap_bucket_number(member)).agg(F.bitmap_construct_agg(F.bitmap_bit_position(member)).alias(MEMBERS))
    return maps.select(F.coalesce(F.sum(F.bitmap_count(MEMBERS)), F.lit(0)).alias("n"))


def _sum(column: str, name: str) -> Column:
    return F.sum(column).cast("bigint").alias(name)


def overall(sales: DataFrame) -> DataFrame:
    """One row for the whole table, from partial results by customer; the products are counted beside them.

    A row for each (product, customer) would answer both distinct counts, but there are nearly as many pairs as sales, and a
    task that reduces them holds the sums of them all.
    """
    return overall_of_table(sales_rollup(sales, CUSTOMER_KEYS, margin=True), sales)


def overall_of_table(rollup: DataFrame, sales: DataFrame) -> DataFrame:
    """The same row from a rollup that exists and its ``sales``.

    Only the product ids are read from the sales, a column of its own in a written table, for the one distinct count the
    rollup can not answer, instead of three copies of every row. Shuffles that rollup and sales share are made once.
    """
    if MEMBERS in rollup.columns:
        products, rollup = distinct_ids(sales, "id_producto").scalar(), merge_bitmaps(rollup)
    else:
        products = sales.select(F.count_distinct("id_producto")).scalar()
    return rollup.agg(
        F.coalesce(F.sum("ventas"), F.lit(0)).cast("bigint").alias("total_ventas"),
        _customers(rollup),
        round_half_up(AMOUNT.total(), 2).alias("ingreso_total"),
        round_half_up(AMOUNT.mean(), 2).alias("ticket_promedio"),
        round_half_up(F.max("monto_max"), 2).alias("venta_maxima"),
        round_half_up(F.min("monto_min"), 2).alias("venta_minima"),
        _sum("unidades", "unidades_vendidas"),
        round_half_up(MARGIN.mean(), 2).alias("margen_promedio_estimado"),
    ).select(
        "total_ventas",
        "clientes_unicos",
        products.alias("productos_vendidos"),
        "ingreso_total",
        "ticket_promedio",
        "venta_maxima",
        "venta_minima",
        "unidades_vendidas",
        "margen_promedio_estimado",
    )


def monthly(rollup: DataFrame) -> DataFrame:
    table = rollup.groupBy("anio_mes").agg(
        _sum("ventas", "total_ventas"),
        _customers(rollup),
        round_half_up(AMOUNT.total(), 2).alias("ingreso_total"),
        round_half_up(AMOUNT.mean(), 2).alias("ticket_promedio"),
        _sum("unidades", "unidades_vendidas"),
        round_half_up(MARGIN.total(), 2).alias("margen_estimado_total"),
    )
    return table.orderBy("anio_mes")


def by_category_channel(rollup: DataFrame) -> DataFrame:
    table = rollup.groupBy("categoria_final", "canal").agg(
        _sum("ventas", "total_ventas"),
        _customers(rollup),
        round_half_up(AMOUNT.total(), 2).alias("ingreso_total"),
        round_half_up(AMOUNT.mean(), 2).alias("ticket_promedio"),
        _sum("unidades", "unidades_vendidas"),
    )
    return table.orderBy(F.desc("ingreso_total"), "categoria_final", "canal")


def by_customer(rollup: DataFrame) -> DataFrame:
    """One row per customer with every per-customer measure; totals stay exact decimals."""
    return rollup.groupBy("id_cliente").agg(
        _sum("ventas", "ventas"),
        _sum("unidades", "unidades"),
        F.round(AMOUNT.total(), 2).cast("decimal(28,2)").alias("total"),
        round_half_up(AMOUNT.mean(), 2).alias("promedio"),
        round_half_up(F.max("monto_max"), 2).alias("mayor"),
        round_half_up(F.min("monto_min"), 2).alias("menor"),
    )


def customer_averages(customers: DataFrame) -> DataFrame:
    """``customers`` as from ``by_customer``."""
    return customers.orderBy(F.desc("total"), "id_cliente").select(
        "id_cliente",
        F.col("ventas").alias("cantidad_ventas"),
        F.col("total").cast("double").alias("total_comprado"),
        F.col("promedio").alias("monto_promedio_venta"),
        F.col("mayor").alias("mayor_compra"),
        F.col("menor").alias("menor_compra"),
    )


def ranked_top(df: DataFrame, order: list[Column], k: int, rank: str) -> DataFrame:
    """The first ``k`` rows with their rank; the ranking window only ever sees those ``k`` rows."""
    return df.orderBy(*order).limit(k).withColumn(rank, F.row_number().over(W.orderBy(*order)))


def top_customer(customers: DataFrame, k: int = 1) -> DataFrame:
    best = ranked_top(customers, [F.desc("total"), F.asc("id_cliente")], k, "ranking_cliente")
    return best.select(
        "id_cliente",
        F.col("ventas").alias("cantidad_compras"),
        F.col("total").cast("double").alias("total_comprado"),
        F.col("promedio").alias("ticket_promedio_cliente"),
        F.col("unidades").alias("unidades_compradas"),
        "ranking_cliente",
    )


# Columns of the top-sales report.
TOP_SALES_COLUMNS = [
    "id_venta",
    "id_cliente",
    "id_producto",
    "nombre_producto",
    "categoria_final",
    "canal",
    "pais",
    "fecha_venta",
    "cantidad",
    "precio_unitario",
    "monto",
]


def top_sales(sales: DataFrame, k: int = 10) -> DataFrame:
    return ranked_top(sales.select(*TOP_SALES_COLUMNS), [F.desc("monto"), F.asc("id_venta")], k, "ranking_venta")


def top_sales_of_table(sales: DataFrame, k: int = 10) -> DataFrame:
    """The same rows from a written table: the amounts alone give the k-th one, and only row groups that
    reach it are read in full."""
    kth = sales.select("monto").orderBy(F.desc("monto")).limit(k).agg(F.min("monto")).scalar()
    return top_sales(sales.filter(F.col("monto") >= kth), k)


WEB_KEYS = ["anio_mes", "event_type", "device"]


def web_activity_by_bitmaps(events: DataFrame) -> DataFrame:
    """As ``web_activity``, for dense customer ids: one distinct count, that of the sessions, is left."""
    groups = events.groupBy(*WEB_KEYS, F.bitmap_bucket_number("id_cliente").alias(GROUP)).agg(
        F.count("event_id").alias("n"), F.bitmap_construct_agg(F.bitmap_bit_position("id_cliente")).alias(MEMBERS)
    )
    counts = groups.groupBy(*WEB_KEYS).agg(
        F.sum("n").alias("total_eventos"), F.sum(F.bitmap_count(MEMBERS)).alias("clientes_unicos")
    )
    sessions = events.groupBy(*[F.col(k).alias(f"_{k}") for k in WEB_KEYS]).agg(F.count_distinct("session_id").alias("sesiones_unicas"))
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in WEB_KEYS])
    return counts.join(sessions, same).drop(*[f"_{k}" for k in WEB_KEYS]).orderBy(*WEB_KEYS)


def web_activity(events: DataFrame) -> DataFrame:
    """Events, customers and sessions per month, event type and device."""
    keys = WEB_KEYS
    table = events.groupBy(*keys).agg(
        F.count("event_id").alias("total_eventos"),
        F.count_distinct("id_cliente").alias("clientes_unicos"),
        F.count_distinct("session_id").alias("sesiones_unicas"),
    )
    return table.orderBy(*keys)
