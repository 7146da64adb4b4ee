"""Starting and ending streaming queries."""

from __future__ import annotations

import time
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, StructField, StructType

from stratalake.operators import fleet
from stratalake.operators.lineage import clocked
from stratalake.sinks.tables import clustered_for, side_by_side, store, write_table
from stratalake.sources.files import read_table


def start_append(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    every: str | None = None,
    partition_by: tuple[str, ...] = (),
) -> StreamingQuery:
    """Append a stream to a table. Without ``every`` it takes what is there now and ends."""
    writer = rows.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start(path)


def run_for(query: StreamingQuery | LiveQueries, seconds: int) -> bool:
    """Let a query run for a while, then stop it; True if it had ended by itself."""
    ended = query.awaitTermination(seconds)
    if not ended:
        query.stop()
    return bool(ended)


HOURLY_TABLE = "rt_toneladas_por_hora"


def fleet_tables(rollup: DataFrame) -> dict[str, DataFrame]:
    return {
        "rt_kpis_generales": fleet.overall(rollup),
        "rt_kpis_por_zona": fleet.by_zone(rollup),
        **({HOURLY_TABLE: fleet.by_hour(rollup)} if "hora_evento" in rollup.columns else {}),
        "rt_estado_flota": fleet.by_status(rollup),
    }


DAY, HOUR, BATCH = "fecha_evento", "hora_evento", "_batch"
#: What the tables over all time are read off: as many rows as trucks, zones and states, whatever the time.
STATE_KEYS = ("zona", "estado_entrega", "camion")
HOUR_KEYS = (DAY, HOUR, "camion")
Refresh = Callable[[DataFrame, int], None]


def _folder(spark: SparkSession, path: str):
    """Hadoop path and its file system."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def _forget(spark: SparkSession, *folders: str) -> None:
    for folder in folders:
        place, files = _folder(spark, folder)
        files.delete(place, True)


def _numbered(spark: SparkSession, path: str) -> dict[int, bool]:
    """Folders under ``path`` that are batch numbers, and whether each was written to its end."""
    place, files = _folder(spark, f"{path}/*")
    done = {}
    for status in files.globStatus(place) or []:
        name = status.getPath().getName()
        if name.isdigit():
            done[int(name)] = files.exists(_folder(spark, f"{path}/{name}/_SUCCESS")[0])
    return done


def totals_refresh(path: str, table_path: Callable[[str], str], fmt: str = "parquet", merge_every: int = 20) -> Refresh:
    """What to do with the changed totals of a micro-batch, as a stateful aggregation by ``STATE_KEYS`` gives them.

    Only the changed keys are written. The totals of all keys are the last one of each among the changes since the last
    merge and that merge; every ``merge_every`` batches there is a new one. A batch that is repeated after a failure
    gets the same changes from the state store, and writes and reads the same folders again.
    """

    def refresh(changed: DataFrame, batch_id: int) -> None:
        spark = changed.sparkSession
        if batch_id == 0:
            _forget(spark, path)
        changed.withColumn(BATCH, F.lit(batch_id)).write.mode("overwrite").parquet(f"{path}/changes/{batch_id}")
        merged = [n for n, done in _numbered(spark, f"{path}/merged").items() if done and n <= batch_id]
        start = max(merged, default=-1)
        later = [n for n in _numbered(spark, f"{path}/changes") if start < n <= batch_id]
        parts = [f"{path}/changes/{n}" for n in sorted(later)] + [f"{path}/merged/{n}" for n in merged if n == start]
        rows = spark.read.schema(StructType([*changed.schema.fields, StructField(BATCH, IntegerType())])).parquet(*parts)
        values = [c for c in rows.columns if c not in STATE_KEYS]
        totals = rows.groupBy(*STATE_KEYS).agg(F.max(F.struct(BATCH, *[c for c in values if c != BATCH])).alias("last"))
        totals = totals.select(*STATE_KEYS, "last.*")
        if batch_id % merge_every == merge_every - 1 and start < batch_id:
            totals.write.mode("overwrite").parquet(f"{path}/merged/{batch_id}")
            totals = spark.read.schema(totals.schema).parquet(f"{path}/merged/{batch_id}")
            # the last merge and the changes after it stay, for a repeat of this batch
            old = [f"{path}/changes/{n}" for n in _numbered(spark, f"{path}/changes") if n <= start]
            _forget(spark, *old, *[f"{path}/merged/{n}" for n in merged if n < start])
        tables = fleet_tables(totals.drop(BATCH))
        side_by_side(partial(write_table, clocked(table), table_path(name), fmt) for name, table in tables.items())

    return refresh


def hours_refresh(path: str, table_path: Callable[[str], str], fmt: str = "parquet") -> Refresh:
    """What to do with the prepared events of a micro-batch to bring the hourly table up to date.

    The batch aggregates its own events and merges them into the rollup of the days that it touches, which is partitioned
    by day and batch: nothing else is listed, read or written. A batch that is repeated after a failure starts from the
    same state, because each day keeps the version before its last one.
    """

    def refresh(events: DataFrame, batch_id: int) -> None:
        fresh = store(fleet.fleet_rollup(events, HOUR_KEYS), f"{path}_fresh", "fleet_hours")
        _merge_hours(fresh, HOUR_KEYS, path, table_path(HOURLY_TABLE), fmt, batch_id)

    return refresh


def _merge_hours(fresh: DataFrame, keys: tuple[str, ...], path: str, table: str, fmt: str, batch_id: int) -> None:
    """Merge the written rollup of a batch, by ``keys``, into the days that it touches, and replace those of the table."""
    spark = fresh.sparkSession
    if batch_id == 0:
        _forget(spark, path)
    days = [str(row[0]) for row in fresh.select(DAY).distinct().collect()]
    if not days and batch_id > 0:
        return
    rows, older = fresh, _versions(spark, path, days, batch_id)
    if older:
        folders = [f"{path}/{DAY}={day}/{BATCH}={max(known)}" for day, known in older.items()]
        before = spark.read.schema(fresh.schema).option("basePath", path).parquet(*folders).drop(BATCH)
        rows = fleet.merge_rollups(before.unionByName(fresh), keys)
    rows = clustered_for(rows, DAY).withColumn(BATCH, F.lit(batch_id))
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY, BATCH)
    writer.parquet(path)
    _forget(spark, *[f"{path}/{DAY}={day}/{BATCH}={n}" for day, known in older.items() for n in sorted(known)[:-1]])
    folders = [f"{path}/{DAY}={day}/{BATCH}={batch_id}" for day in days]
    now = spark.read.schema(fresh.schema).option("basePath", path).parquet(*folders).drop(BATCH) if days else fresh
    write_table(clocked(fleet.by_hour(now)), table, fmt, (DAY,), only_touched_partitions=batch_id > 0)


def _versions(spark: SparkSession, path: str, days: list[str], batch_id: int) -> dict[str, list[int]]:
    """Batches before this one that wrote the days."""
    out: dict[str, list[int]] = {}
    for day in days:
        place, files = _folder(spark, f"{path}/{DAY}={day}/{BATCH}=*")
        known = [int(status.getPath().getName().partition("=")[2]) for status in files.globStatus(place) or []]
        if any(n < batch_id for n in known):
            out[day] = [n for n in known if n < batch_id]
    return out


def sketch_refresh(path: str, table_path: Callable[[str], str], fmt: str = "parquet") -> Refresh:
    """What to do with the prepared events of a micro-batch when trucks are estimated: one pass over the events gives all.

    A rollup row is a zone and state, or an hour, however many trucks there are, so the totals are rewritten whole:
    two folders take turns, a batch reads the one its predecessor wrote.
    """

    def totals(fresh: DataFrame, batch_id: int) -> None:
        rows = fleet.merge_rollups(fresh, STATE_KEYS[:2])
        if batch_id > 0:
            before = read_table(fresh.sparkSession, f"{path}/totals/{(batch_id - 1) % 2}", "fleet_totals")
            rows = fleet.merge_rollups(before.unionByName(rows), STATE_KEYS[:2])
        rows = store(rows, f"{path}/totals/{batch_id % 2}", "fleet_totals")
        for name, table in fleet_tables(rows).items():
            write_table(clocked(table), table_path(name), fmt)

    def refresh(events: DataFrame, batch_id: int) -> None:
        fresh = store(fleet.fleet_rollup(events, fleet.SKETCH_KEYS), f"{path}/fresh", "fleet_rollup")
        keys = HOUR_KEYS[:2]
        hours = partial(_merge_hours, fleet.merge_rollups(fresh, keys), keys, f"{path}/hours", table_path(HOURLY_TABLE), fmt)
        side_by_side([partial(totals, fresh, batch_id), partial(hours, batch_id)])

    return refresh


class LiveQueries:
    """Several streaming queries that are waited for and stopped together."""

    def __init__(self, queries: list[StreamingQuery]):
        self.queries = queries

    @property
    def isActive(self) -> bool:  # noqa: N802 - as a single query has it
        return any(query.isActive for query in self.queries)

    def awaitTermination(self, timeout: float | None = None) -> bool | None:  # noqa: N802
        if timeout is None:
            for query in self.queries:
                query.awaitTermination()
            return None
        end = time.monotonic() + timeout
        return all([query.awaitTermination(max(0.1, end - time.monotonic())) for query in self.queries])

    def stop(self) -> None:
        for query in self.queries:
            query.stop()


def start_fleet_refresh(
    bronze_rows: DataFrame,
    rollup_path: str,
    table_path: Callable[[str], str],
    checkpoint: str,
    fmt: str = "parquet",
    every: str | None = None,
    approximate: bool = False,
    merge_every: int = 20,
) -> LiveQueries:
    """Keep the fleet KPI tables up to date from a stream.

    Exactly, two queries do: one keeps the totals by zone, state and truck in its state store and gives out those that
    change, the other merges hours. The state grows with trucks, not with time. ``approximate`` estimates trucks by
    sketches, in one query without state.
    """
    prepared = fleet.prepare(bronze_rows)

    def start(rows: DataFrame, name: str, refresh: Refresh, mode: str = "append") -> StreamingQuery:
        writer = rows.writeStream.outputMode(mode).foreachBatch(refresh).option("checkpointLocation", f"{checkpoint}/{name}")
        return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()

    if approximate:
        return LiveQueries([start(prepared, "sketch", sketch_refresh(f"{rollup_path}/sketch", table_path, fmt))])
    totals = totals_refresh(f"{rollup_path}/totals", table_path, fmt, merge_every)
    return LiveQueries(
        [
            start(fleet.fleet_rollup(prepared, STATE_KEYS), "totals", totals, "update"),
            start(prepared, "hours", hours_refresh(f"{rollup_path}/hours", table_path, fmt)),
        ]
    )
