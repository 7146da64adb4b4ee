"""Layer-table and extract writers."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from stratalake.config import EXTRACT_ORDER, FOLDER_EXTRACTS
from stratalake.sinks.versions import publish
from stratalake.sources.files import read_table


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    partition_by: tuple[str, ...] = (),
    mode: str = "overwrite",
    only_touched_partitions: bool = False,
    row_group_bytes: int | None = None,
) -> None:
    """Write a table, replacing data and schema unless told otherwise.

    ``only_touched_partitions`` replaces just the partitions present in ``df``. Readers of a Parquet table are not
    disturbed (``sinks.versions``); read it with ``read_table``. Other formats have their own means.
    """
    options = {} if row_group_bytes is None else {"parquet.block.size": str(row_group_bytes)}
    if fmt == "parquet" and mode == "overwrite":
        publish(df, path, partition_by, only_touched_partitions, options)
        return
    writer = df.write.format(fmt).mode(mode).options(**options)
    if only_touched_partitions:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    elif mode == "overwrite":
        writer = writer.option("overwriteSchema", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def clustered_for(df: DataFrame, *partition_columns: str) -> DataFrame:
    """Bring rows of one partition value together before a partitioned write.

    REBALANCE lets adaptive execution cut a large month into several tasks and pack small ones, so
    the write does not depend on how many months there are.
    """
    return df.hint("rebalance", *partition_columns)


#: Row groups of a sorted table, a quarter of the usual size: what a filter on the sorted column reads at least of a file.
SORTED_ROW_GROUP = 32 << 20


def sorted_inside(df: DataFrame, *columns: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Rows of each file in order of ``columns``, so that a filter on the first one skips row groups and pages.

    Sorts inside the tasks that write, without a shuffle; ``partition_by`` comes first, as the writer needs it.
    """
    return df.sortWithinPartitions(*partition_by, *columns)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("encoding", "UTF-8").csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


#: Rows of an XML file at most: the built-in reader reads a file in one task.
XML_ROWS_A_FILE = 200_000


def write_xml(df: DataFrame, path: str, root_tag: str, row_tag: str, rows_a_file: int = XML_ROWS_A_FILE) -> None:
    """XML files of ``rows_a_file`` rows at most each; 0 for one file a task, whatever its size."""
    writer = df.write.mode("overwrite").option("rootTag", root_tag).option("rowTag", row_tag)
    writer.option("maxRecordsPerFile", rows_a_file).xml(path)


def write_extract(df: DataFrame, path: str, order: Sequence[str] = (), one_file: bool = True) -> None:
    """CSV for BI tools in the given order ("-" before a column: descending).

    ``one_file`` is for tables of bounded size: one task sorts and writes them. Others become a folder of files
    that are in order one after another.
    """
    by = [F.desc(c[1:]) if c.startswith("-") else F.asc(c) for c in order]
    if one_file:
        df = df.coalesce(1)
        df = df.sortWithinPartitions(*by) if by else df
    elif by:
        df = df.orderBy(*by)
    write_csv(df, path)


def write_dataset_extract(df: DataFrame, path: str, dataset: str) -> None:
    """Extract of a published data set in its fixed layout and order."""
    write_extract(df, path, EXTRACT_ORDER.get(dataset, ()), dataset not in FOLDER_EXTRACTS)


def store(df: DataFrame, path: str, name: str, fmt: str = "parquet", **options) -> DataFrame:
    """Write once and hand back the written table, so that nothing downstream recomputes it."""
    write_table(df, path, fmt, **options)
    return read_table(df.sparkSession, path, name, fmt)


def store_counted(df: DataFrame, path: str, name: str, fmt: str = "parquet", **options) -> tuple[DataFrame, int]:
    """``store``, and the number of rows that were written, counted by the write itself."""
    seen = Observation()
    written = store(df.observe(seen, F.count(F.lit(1)).alias("n")), path, name, fmt, **options)
    return written, seen.get.get("n", 0)


def side_by_side(writes: Iterable[Callable[[], object]], at_once: int = 4) -> list:
    """Run independent writes a few at a time, so that small jobs do not leave the cluster idle."""
    with ThreadPoolExecutor(at_once) as pool:
        return [done.result() for done in [pool.submit(write) for write in writes]]
