"""Keep the latest row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest(df: DataFrame, keys: list[str], newest_by: list[str], tie_break: list[str] | None = None) -> DataFrame:
    """One row per key: the greatest by ``newest_by``, then by ``tie_break``, then by the other columns.

    Since all columns take part in the comparison, only fully equal rows tie and the survivor never
    depends on arrival order. It is a max aggregate: every map task first reduces its own copies of a
    key to one row, so a key that holds a large share of the table still reaches the reducer as at
    most one row per map task.
    """
    ranked = [*newest_by, *(tie_break or [])]
    others = [c for c in df.columns if c not in keys and c not in ranked]
    best = df.groupBy(*keys).agg(F.max(F.struct(*ranked, *others)).alias("_best"))
    return best.select(*[c if c in keys else F.col("_best")[c].alias(c) for c in df.columns])
