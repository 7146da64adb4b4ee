"""Mixing sources to target weights along a time-varying curriculum.

Targets: each source gets words in proportion to its weight, at most ``most`` times what it has; what is
cut off is shared among the others by weight. With caps ``most * size`` this is one water level, found
from the sources sorted by cap / weight.

Order: a source's documents stand in hash order and its words are taken from the front, round after round,
until its target is met. A source also has a schedule, a piecewise linear rate over training time 0..1. The
integral of the rate, scaled to the target, is the source's demand; the time at which the demand reaches
a document's first taken word is the document's training position. Documents are range-sorted by it.

Running word counts are taken per group of at most ``group_rows`` documents that follow one another in that order, and the
groups' sums are added up first. Groups are cut from a range partitioning in which rows are told apart down to their
number, so neither a hot source nor ids that are null or repeated come together in one task.

The table with one row a source is small: sources number in the thousands, not the millions of hosts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.llm.common import WORD, written

#: (time, rate) knots by weight; the rate is linear between them.
SCHEDULES = {
    3: [(0.0, 1.5), (0.5, 1.0), (1.0, 0.5)],
    1: [(0.0, 1.0), (1.0, 1.0)],
    2: [(0.0, 0.5), (0.25, 0.5), (1.0, 1.5)],
}
WEIGHTS = (3, 1, 2)


def words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def sorted_key(source: Column) -> Column:
    """Text that sorts as the source does by code point, with null last, and is never null."""
    return F.when(source.isNull(), "1").otherwise(F.concat(F.lit("0"), source))


def targets(sizes: DataFrame, share: float = 1.5, most: int = 2, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Add weight and target to (key, source_size); weights repeat along the sorted keys.

    One row a source is all that is looked at, so the windows over the whole table stay small.
    """
    every, ranked = Window.partitionBy(), Window.orderBy("key")
    before = Window.orderBy("ratio", "key").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.orderBy("ratio", "key").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    weight = F.get(F.array(*map(F.lit, weights)), (F.row_number().over(ranked) - 1) % len(weights))
    cap = most * F.col("source_size")
    level = (F.col("wanted") - F.coalesce(F.sum("cap").over(before), F.lit(0)).cast("double")) / F.sum(
        "weight"
    ).over(after)
    return (
        sizes.withColumn("weight", weight.cast("bigint"))
        .withColumns(
            {"cap": cap, "ratio": cap / F.col("weight"), "wanted": share * F.sum("source_size").over(every)}
        )
        .withColumn("level", level)
        # the level holds from the first source on that it does not fill to its cap
        .withColumn("level", F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "key", "level"))).over(every))
        .withColumn("most", F.col("cap").cast("double"))
        .withColumn("target", F.least("most", F.coalesce(F.col("level.level") * F.col("weight"), F.col("most"))))
        .select("key", "source_size", "weight", "target")
    )


def segments(knots: list[tuple[float, float]]) -> list[tuple[float, float, float, float, float]]:
    """(start, length, rate at start, change of rate, integral before) of each piece, integrals summing to 1."""
    pieces = list(zip(knots, knots[1:], strict=False))
    whole = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in pieces)
    if whole <= 0 or knots[0][0] != 0 or knots[-1][0] != 1 or any(b[0] <= a[0] for a, b in pieces):
        raise ValueError("a schedule runs from time 0 to 1 and has a positive integral")
    done, out = 0.0, []
    for a, b in pieces:
        out.append((a[0], b[0] - a[0], a[1] / whole, (b[1] - a[1]) / whole, done))
        done += (b[0] - a[0]) * (a[1] + b[1]) / 2 / whole
    return out


def time_of(part: Column, weight: Column, schedules: dict[int, list[tuple[float, float]]]) -> Column:
    """Time at which the integral of the schedule reaches ``part`` (0..1)."""
    out = F.lit(None).cast("double")
    for w, knots in schedules.items():
        inner = F.lit(None).cast("double")
        for start, length, rate, change, done in segments(knots):
            rest = part - F.lit(done)
            root = F.sqrt(F.greatest(F.lit(rate * rate) + rest * F.lit(2 * change / length), F.lit(0.0)))
            here = F.lit(start) + F.try_divide(rest * 2, F.lit(rate) + root)
            inner = F.when(part >= F.lit(done), here).otherwise(inner)
        out = F.when(weight == w, inner).otherwise(out)
    return out


def mix(
    docs: DataFrame,
    share: float = 1.5,
    most: int = 2,
    weights: tuple[int, ...] = WEIGHTS,
    schedules: dict[int, list[tuple[float, float]]] | None = None,
    group_rows: int = 1024,
) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, source, text), sorted by training position.

    Columns: doc_id, source, size (words), source_size, weight, target, taken (words the mix takes; the last
    document is cut where the target ends), first_position and second_position (in words of the whole mix;
    null where that round does not take the document). A null source is a source of its own, the last one;
    documents without words take nothing and have no position; rows alike in all columns are interchangeable.
    Other columns of ``docs`` are left out.
    """
    schedules = SCHEDULES if schedules is None else schedules
    if not set(weights) <= set(schedules):
        raise ValueError("every weight needs a schedule")
    digest = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    order = ["key", "digest", "size", "row"]
    rows = written(
        docs.select(
            F.col("doc_id"), F.col("source"), sorted_key(F.col("source")).alias("key"), words().alias("size"),
            digest.alias("digest"), F.monotonically_increasing_id().alias("row"),
        ),
        "mix-sizes",
    )
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("digest", "row")
    rows = written(rows.withColumn("at", F.monotonically_increasing_id()), "mix-order")
    # "at" is the number of the partition, then that of the row in it; a group is named by its first row
    inside = F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    rows = rows.withColumn("part", F.col("at") - F.pmod(inside, F.lit(group_rows)))
    sums = rows.groupBy("key", "part").agg(F.sum("size").alias("sum"))
    ahead = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = sums.select("key", "part", F.coalesce(F.sum("sum").over(ahead), F.lit(0)).alias("ahead"))
    goals = written(targets(sums.groupBy("key").agg(F.sum("sum").alias("source_size")), share, most, weights), "mix-goals")
    placed = parts.join(goals, "key")
    within = Window.partitionBy("key", "part").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    begin = F.col("ahead") + F.coalesce(F.sum("size").over(within), F.lit(0))
    goal = F.floor("target").cast("bigint")
    whole = F.col("whole")
    rows = rows.join(placed, ["key", "part"]).withColumn("begin", begin)
    rounds = {
        f"take{k}": F.greatest(F.least(F.col("size"), goal - F.col("source_size") * k - F.col("begin")), F.lit(0))
        for k in range(most)
    }
    names = ["first_position", "second_position"] if most == 2 else [f"position_{k + 1}" for k in range(most)]

    def position(k: int) -> Column:
        reached = F.try_divide((F.col("begin") + F.col("source_size") * k).cast("double"), F.col("target"))
        at = F.least(time_of(reached, F.col("weight"), schedules), F.lit(1.0)) * whole
        return F.when(F.col(f"take{k}") > 0, F.floor(at).cast("bigint"))

    total = goals.agg(F.sum("target").alias("whole")).first()["whole"] or 0.0
    out = rows.withColumns({**rounds, "whole": F.lit(float(total))}).select(
        "doc_id", "source", "size", "source_size", "weight", "target",
        sum((F.col(f"take{k}") for k in range(1, most)), F.col("take0")).alias("taken"),
        *[position(k).alias(n) for k, n in enumerate(names)],
    )
    return written(out, "mix").orderBy(F.col(names[0]).asc_nulls_last(), F.col("doc_id").asc_nulls_last())
