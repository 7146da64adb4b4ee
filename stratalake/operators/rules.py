"""Quality rules as data: a name and a SQL condition that a row has to meet; NULL does not."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FAILED = "_failed_rules"
HITS = "table_name string, quality_rule string, passed bigint, failed bigint"
Rules = dict[str, str]


def holds(condition: str) -> Column:
    return F.coalesce(F.expr(condition), F.lit(False))


def judged(rows: DataFrame, rules: Rules) -> DataFrame:
    """All rows, with the names of the rules each one breaks."""
    broken = [F.when(~holds(sql), F.lit(name)) for name, sql in rules.items()]
    return rows.withColumn(FAILED, F.array_compact(F.array(*broken)))


def rejects(rows: DataFrame, rules: Rules) -> DataFrame:
    return judged(rows, rules).filter(F.size(FAILED) > 0)


def counters(rules: Rules) -> dict[str, Column]:
    """Aggregates: all rows as ``n`` and for each rule the rows that meet it, by its number."""
    return {"n": F.count(F.lit(1)), **{f"r{i}": F.count_if(holds(sql)) for i, sql in enumerate(rules.values())}}


def hits(rows: DataFrame, rules: Rules) -> DataFrame:
    """(quality_rule, passed, failed): one row a rule, all from one pass."""
    counted = rows.agg(*[value.alias(name) for name, value in counters(rules).items()])
    pairs = ", ".join(f"'{name}', r{i}" for i, name in enumerate(rules))
    return counted.select("n", F.expr(f"stack({len(rules)}, {pairs}) as (quality_rule, passed)")).select(
        "quality_rule", "passed", (F.col("n") - F.col("passed")).alias("failed")
    )


def counted_hits(spark: SparkSession, counted: dict[str, tuple[Rules, dict[str, int]]]) -> DataFrame:
    """``HITS`` rows out of counters that were read while the tables were written."""
    rows = [
        (table, name, values[f"r{i}"], values["n"] - values[f"r{i}"])
        for table, (rules, values) in counted.items()
        for i, name in enumerate(rules)
    ]
    return spark.createDataFrame(rows, HITS)
