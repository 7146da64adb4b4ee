"""JSON lines queried beyond the named fields: schema on read.

``sources.files.read_json`` gives the named fields and keeps each line as text. Here a line is read as a VARIANT, so that
any field can be asked for and fields that nobody named are reported. A line that is no JSON has none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.sources.files import RAW_LINE


def parsed(line: str = RAW_LINE) -> Column:
    return F.try_parse_json(line)


def field(path: str, kind: str, line: str = RAW_LINE) -> Column:
    """The value at a JSON path such as ``$.a.b[0]``; NULL if it is missing or is no ``kind``."""
    return F.try_variant_get(parsed(line), path, kind)


def fields(landed: DataFrame, line: str = RAW_LINE) -> DataFrame:
    """(campo, valor) for every field at the top of every line that is a JSON object; valor is a VARIANT."""
    lines = landed.select(parsed(line).alias("v"))
    each = lines.lateralJoin(landed.sparkSession.tvf.variant_explode(F.col("v").outer()))
    return each.where("key is not null").select(F.col("key").alias("campo"), F.col("value").alias("valor"))


def unknown_fields(landed: DataFrame, known: list[str], line: str = RAW_LINE) -> DataFrame:
    """(campo, tipo, filas): fields without a column of their own, by type, and in how many lines they stand."""
    others = fields(landed, line).where(~F.col("campo").isin(known))
    return others.groupBy("campo", F.schema_of_variant("valor").alias("tipo")).agg(F.count("*").alias("filas"))


def line_schema(landed: DataFrame, line: str = RAW_LINE) -> DataFrame:
    """One row: the schema that all lines together have, with the types each field needs."""
    return landed.select(parsed(line).alias("v")).agg(F.schema_of_variant_agg("v").alias("esquema"))
