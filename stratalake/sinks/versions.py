"""Parquet tables that stay readable while they are replaced.

A table is a folder ``_data`` of versions, ``__version=<id>/<partition columns>``, and small files ``_current.<time>``, the
newest of which names the schema and the folders in use. A write makes new folders, then a new pointer; a reader
that has read an older one goes on with the older folders, so it never misses a file and never sees two versions
mixed. No file is ever replaced, so this needs no more of a file system than to list what is there. A later write deletes
folders and pointers that have been out of use for ``GRACE_SECONDS``, the longest time a reader may take.

One writer a table at a time. There is no log and no going back.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

DATA, CURRENT, VERSION = "_data", "_current", "__version"
GRACE_SECONDS = 3600


def _files(spark: SparkSession, path: str):
    """Hadoop path and its file system."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def _pointers(spark: SparkSession, path: str) -> list[str]:
    place, files = _files(spark, f"{path}/{CURRENT}.*")
    return sorted(status.getPath().getName() for status in files.globStatus(place) or [])


def read_current(spark: SparkSession, path: str) -> dict | None:
    """What the newest pointer says; None for a table without versions."""
    known = _pointers(spark, path)
    if not known:
        return None
    place, files = _files(spark, f"{path}/{known[-1]}")
    stream = files.open(place)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _put_current(spark: SparkSession, path: str, content: dict, grace: float) -> None:
    """A pointer that is newer than all others, and complete as soon as it has its name."""
    older, now = _pointers(spark, path), time.time_ns()
    first, files = _files(spark, f"{path}/_new.{uuid.uuid4().hex}")
    stream = files.create(first, True)
    try:
        stream.write(bytearray(json.dumps(content).encode()))
    finally:
        stream.close()
    if not files.rename(first, _files(spark, f"{path}/{CURRENT}.{now:020d}")[0]):
        raise OSError(f"could not name the new version of {path}")
    # a pointer is out of use since the next one was made
    for name, following in zip(older, older[1:], strict=False):
        if now - int(following.rpartition(".")[2]) > grace * 1e9:
            files.delete(_files(spark, f"{path}/{name}")[0], False)


def read_version(spark: SparkSession, path: str, current: dict) -> DataFrame:
    """The table as ``current`` has it."""
    schema = StructType.fromJson(current["schema"])
    base = f"{path}/{DATA}"
    reader = spark.read.schema(schema.add(VERSION, "string")).option("basePath", base)
    names = [f"`{name}`" for name in current["columns"]]
    return reader.parquet(*[f"{base}/{folder}" for folder in current["folders"]]).select(*names)


def publish(
    df: DataFrame,
    path: str,
    partition_by: tuple[str, ...] = (),
    only_touched: bool = False,
    options: dict[str, str] | None = None,
    grace: float = GRACE_SECONDS,
) -> None:
    """Write a new version and make it the current one; with ``only_touched`` replace only the partitions in ``df``."""
    spark, version = df.sparkSession, f"{VERSION}={time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    before = read_current(spark, path) or {"folders": [], "retired": []}
    writer = df.write.options(**(options or {}))
    writer = writer.partitionBy(*partition_by) if partition_by else writer
    writer.parquet(f"{path}/{DATA}/{version}")
    new, kept = [version], []
    if only_touched and partition_by:
        inside = "/".join(["*=*"] * len(partition_by))
        new = _folders(spark, path, f"{version}/{inside}")
        old = [f if "/" in f else _folders(spark, path, f"{f}/{inside}") for f in before["folders"]]
        old = [f for fs in old for f in ([fs] if isinstance(fs, str) else fs)]
        replaced = {_partition(f) for f in new}
        kept = [f for f in old if _partition(f) not in replaced]
        before["folders"] = old
    put_version(df, path, new, kept, grace, before, partition_by)


def put_version(
    df: DataFrame,
    path: str,
    new: list[str],
    kept: list[str],
    grace: float,
    before: dict | None = None,
    partition_by: tuple[str, ...] = (),
    **more: object,
) -> None:
    """Make the ``new`` and the ``kept`` folders the table, and delete what has been out of use long enough."""
    spark, now = df.sparkSession, time.time()
    before = before or read_current(spark, path) or {"folders": [], "retired": []}
    retired = [*before["retired"], *([f, now] for f in before["folders"] if f not in kept)]
    gone = [f for f, since in retired if now - since > grace]
    inner = [f for f in df.schema.fields if f.name not in partition_by]
    schema = StructType([*inner, *[df.schema[name] for name in partition_by]])
    content = {
        "schema": json.loads(schema.json()),
        "columns": df.columns,
        "folders": sorted([*kept, *new]),
        "retired": [r for r in retired if r[0] not in gone],
        **more,
    }
    _put_current(spark, path, content, grace)
    for folder in gone:
        place, files = _files(spark, f"{path}/{DATA}/{folder}")
        files.delete(place, True)


def _partition(folder: str) -> str:
    return folder.partition("/")[2]


def _folders(spark: SparkSession, path: str, pattern: str) -> list[str]:
    """Folders under ``_data`` that match, as relative paths."""
    place, files = _files(spark, f"{path}/{DATA}")
    start = files.makeQualified(place).toString().rstrip("/") + "/"
    found = files.globStatus(spark._jvm.org.apache.hadoop.fs.Path(place, pattern)) or []
    return [status.getPath().toString().removeprefix(start) for status in found]
