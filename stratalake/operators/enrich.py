"""Join sales with the product catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.functions.numbers import round_half_up

# Catalogue column -> name in the enriched table.
CATALOGUE_COLUMNS = {
    "id_producto": "id_producto",
    "nombre_producto": "nombre_producto",
    "categoria": "categoria_producto",
    "proveedor": "proveedor",
    "precio_base": "precio_base",
    "activo": "producto_activo",
}


def catalogue(products: DataFrame) -> DataFrame:
    return products.select(*[F.col(name).alias(new) for name, new in CATALOGUE_COLUMNS.items()])


def enrich(sales: DataFrame, products: DataFrame) -> DataFrame:
    """Left join; ``products`` has one row per id, so no sale is lost or repeated.

    Whether the catalogue is broadcast is left to its size statistics, which for a written table are in bytes; beyond
    the session's threshold it is a shuffle join, in which adaptive execution splits a hot product.
    """
    joined = sales.join(catalogue(products), "id_producto", "left")
    cost = F.col("precio_base") * F.col("cantidad")
    return joined.withColumns(
        {
            "categoria_final": F.coalesce("categoria_producto", "categoria"),
            "margen_estimado": round_half_up(F.col("monto") - cost, 2),
        }
    )
