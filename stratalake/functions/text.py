"""Text normalisers and tolerant casts (a bad cell becomes NULL, never an error)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def trimmed(c: Column) -> Column:
    return F.trim(c.cast("string"))


def trimmed_upper(c: Column) -> Column:
    return F.upper(trimmed(c))


def trimmed_lower(c: Column) -> Column:
    return F.lower(trimmed(c))


def trimmed_title(c: Column) -> Column:
    return F.initcap(trimmed(c))


def is_true(c: Column) -> Column:
    """Only the word "true" in any case counts; everything else, NULL too, is false."""
    return F.coalesce(trimmed_lower(c) == "true", F.lit(False))


def lenient_int(c: Column) -> Column:
    """Digits before the decimal point, as Spark 3 casts do ("3.7" -> 3)."""
    number = c.try_cast("double")
    whole = F.when(number < 0, F.ceil(number)).otherwise(F.floor(number))
    return F.coalesce(c.try_cast("int"), whole.try_cast("int"))



def whole(c: Column) -> Column:
    """Whole number as text: "7" and "7.0" are 7, "7.5" is none."""
    number = c.try_cast("decimal(38,10)")
    return F.when(number == F.floor(number), number.try_cast("bigint"))
