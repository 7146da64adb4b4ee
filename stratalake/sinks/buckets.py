"""Parquet tables in buckets of their key, so that joins and merges on it shuffle only what is new.

A bucketed table is published like any other (``sinks.versions``). Its pointer also names key and number of buckets, and reading
registers the present version with them in the session's catalogue, under a name made of the version: Spark then
knows how the rows lie. The number of buckets stays for the life of a table; choose it for a few hundred MB a bucket.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stratalake.operators.dedup import latest
from stratalake.sinks.versions import DATA, GRACE_SECONDS, VERSION, put_version, read_current


def publish_bucketed(df: DataFrame, path: str, keys: list[str], buckets: int, grace: float = GRACE_SECONDS) -> None:
    """Write a new version in ``buckets`` by ``keys``, each in order of them, and make it the current one.

    Rows that a task holds of one bucket become one file, so a plan that ends in that partitioning is written without
    a shuffle and with one file a bucket.
    """
    spark, version = df.sparkSession, f"{VERSION}={time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    name = f"bucketed_{uuid.uuid4().hex}"
    writer = df.write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
    writer.option("path", f"{path}/{DATA}/{version}").saveAsTable(name)
    spark.sql(f"drop table {name}")  # the files stay, they are at a path of their own
    put_version(df, path, [version], [], grace, buckets={"keys": keys, "n": buckets})


def read_bucketed(spark: SparkSession, path: str) -> DataFrame | None:
    """The present version with its buckets; None if there is none."""
    current = read_current(spark, path)
    if current is None or "buckets" not in current:
        return None
    folder, layout = current["folders"][0], current["buckets"]
    name = "bucketed_" + folder.partition("=")[2].replace("-", "_")
    if not spark.catalog.tableExists(name):
        schema = StructType.fromJson(current["schema"])
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        keys = ", ".join(f"`{k}`" for k in layout["keys"])
        place = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{DATA}/{folder}")
        place = place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toString()
        spark.sql(
            f"create table if not exists {name} ({columns}) using parquet "
            f"clustered by ({keys}) sorted by ({keys}) into {layout['n']} buckets location '{place}'"
        )
    return spark.table(name)


def merge_latest(history: DataFrame, batch: DataFrame, keys: list[str], newest_by: list[str], buckets: int) -> DataFrame:
    """The rows that ``latest`` keeps of both; ``history`` has one row a key already, and lies in ``buckets`` of the keys.

    Only the batch is shuffled: to be reduced, map-side first, and then into the buckets. A full join follows, in which a
    key has a row on each side at most, whatever its share of the batch.
    """
    fresh = latest(batch.select(history.columns), keys, newest_by).repartition(buckets, *keys)
    others = [*newest_by, *(c for c in history.columns if c not in keys and c not in newest_by)]
    known, new = (df.select(*keys, F.struct(*others).alias(name)) for df, name in ((history, "_known"), (fresh, "_new")))
    both = known.join(new, keys, "full").select(*keys, F.greatest("_known", "_new").alias("_row"))
    return both.select(*[c if c in keys else F.col("_row")[c].alias(c) for c in history.columns])


def add_batch(batch: DataFrame, path: str, keys: list[str], newest_by: list[str], buckets: int = 64) -> DataFrame:
    """Merge ``batch`` into the bucketed table at ``path``, which is made by the first one; the table after that."""
    history = read_bucketed(batch.sparkSession, path)
    if history is None:
        merged = latest(batch, keys, newest_by).repartition(buckets, *keys)
    else:
        buckets = read_current(batch.sparkSession, path)["buckets"]["n"]
        merged = merge_latest(history, batch, keys, newest_by, buckets)
    publish_bucketed(merged, path, keys, buckets)
    return read_bucketed(batch.sparkSession, path)
