"""Expressions that are evaluated once a row, whatever is filtered or read off them later."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def once(df: DataFrame, keep: list[str], fields: dict[str, Column]) -> DataFrame:
    """The ``keep`` columns and the new ``fields``.

    A filter on a computed column is pushed below its projection, which writes the computation into the filter and
    runs it there again. Fields that come out of a generator are beyond that. Use it for dear expressions only:
    a filter on plain columns should go on reaching the scan.
    """
    row = F.struct(*[value.alias(name) for name, value in fields.items()])
    return df.select(*keep, F.inline(F.array(row)))
