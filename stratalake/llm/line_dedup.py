"""Removal of lines in repeated three-line windows.

Every window of three consecutive lines is hashed. The first occurrence of a window, by (document,
position), stays; all later ones are covered, and a document loses the lines that any later window
covers. Only hashes and positions are shuffled to find the repeats; the aggregation reduces a frequent
window on the map side, and the join back to its occurrences is one that adaptive execution can split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import order_id

WIDTH = 3


def windows(lines: Column) -> Column:
    """Array of (position, two 64-bit hashes) of the windows that hold more than blank lines."""

    def window(i: Column) -> Column:
        part = [F.get(lines, i + k) for k in range(WIDTH)]
        return F.struct(
            i.alias("at"),
            F.xxhash64(*part).alias("a"),
            F.xxhash64(F.lit(1), *part).alias("b"),
            F.concat(*part).rlike(r"[^\x20\x09-\x0D]").alias("worded"),
        )

    count = F.size(lines)
    starts = F.when(count >= WIDTH, F.sequence(F.lit(0), count - WIDTH)).otherwise(F.array().cast("array<int>"))
    return F.filter(F.transform(starts, window), lambda w: w["worded"])


def drop_repeated_lines(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text, any other columns) with __lines, __removed and the remaining ``text``.

    Lines are split at \\n and compared exactly. A window is three consecutive lines, not all blank, so
    documents of fewer lines stay whole. Occurrences are ordered by doc_id (null last), then position; all
    but the first are later ones, in the same document, too. Rows with the same doc_id and text are one
    document here and have the same result. A null or empty text has no window and stays as it is. A text
    of which nothing is left is empty.
    """
    key = {"__id": order_id(), "__text": F.xxhash64("text")}
    split = F.split("text", "\n", -1)  # a column of its own: inside a lambda it would be split again for every line
    lines = F.col("__split")
    found = (
        docs.select(*[v.alias(k) for k, v in key.items()], split.alias("__split"))
        .select("__id", "__text", F.explode(windows(lines)).alias("w"))
        .select("__id", "__text", "w.at", "w.a", "w.b")
    )
    place = F.struct("__id", "at", "__text")
    repeated = (
        found.groupBy("a", "b")
        .agg(F.min(place).alias("first"), F.max(place).alias("last"))
        .where("first <> last")
        .drop("last")
    )
    later = found.join(repeated, ["a", "b"]).where(place != F.col("first"))
    covered = later.groupBy("__id", "__text").agg(F.collect_set("at").alias("__starts"))
    joined = docs.withColumns(key).join(covered, ["__id", "__text"], "left")
    hit = F.flatten(F.transform("__starts", lambda s: F.array(*[s + k for k in range(WIDTH)])))
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), hit)
    joined = joined.withColumn("__split", split)
    joined = joined.withColumn("__left", F.when(F.col("__starts").isNotNull(), left))
    text = F.when(
        F.col("__left").isNotNull(), F.array_join(F.transform("__left", lambda i: F.get(lines, i)), "\n")
    ).otherwise(F.col("text"))
    count = F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).cast("bigint")
    removed = F.when(F.col("__left").isNotNull(), count - F.size("__left")).otherwise(0).cast("bigint")
    return (
        joined.withColumns({"__lines": count, "__removed": removed, "__new": text})
        .drop("__id", "__text", "__starts", "__left", "__split", "text")
        .withColumnRenamed("__new", "text")
        .select(*docs.columns, "__lines", "__removed")
    )
