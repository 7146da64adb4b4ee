"""Tables that are replaced while they are read."""

import threading

import pytest
from pyspark.sql import functions as F

from stratalake.sinks import versions
from stratalake.sinks.tables import store, write_table
from stratalake.sources.files import MissingDataset, read_table


def numbered(spark, n, rows=400):
    """A table whose rows all name the same write."""
    return spark.range(rows, numPartitions=4).withColumn("write", F.lit(n))


def test_readers_never_fail_and_never_see_two_writes(spark, tmp_path):
    path, seen, faults, stop = str(tmp_path / "t"), [], [], threading.Event()
    write_table(numbered(spark, 0), path)

    def read():
        while not stop.is_set():
            try:
                rows = read_table(spark, path, "t").groupBy("write").count().collect()
                seen.append([tuple(r) for r in rows])
            except Exception as error:  # noqa: BLE001 - any failure of a reader is what the test looks for
                faults.append(str(error))

    readers = [threading.Thread(target=read) for _ in range(2)]
    for reader in readers:
        reader.start()
    for n in range(1, 13):
        write_table(numbered(spark, n), path)
    stop.set()
    for reader in readers:
        reader.join()
    assert not faults
    assert all(len(rows) == 1 and rows[0][1] == 400 for rows in seen)
    assert len({rows[0][0] for rows in seen}) > 2


def test_a_reader_that_began_before_ends_with_what_it_began(spark, tmp_path):
    path = str(tmp_path / "t")
    old = store(numbered(spark, 1), path, "t")
    for n in (2, 3):
        write_table(numbered(spark, n), path)
    assert {r.write for r in old.collect()} == {1}
    assert {r.write for r in read_table(spark, path, "t").collect()} == {3}


def test_folders_out_of_use_go_after_the_grace(spark, tmp_path):
    path, data = str(tmp_path / "t"), tmp_path / "t" / versions.DATA
    for n in range(4):
        versions.publish(numbered(spark, n), path)
    assert len(list(data.iterdir())) == 4
    versions.publish(numbered(spark, 4), path, grace=-1)
    assert len(list(data.iterdir())) == 1
    assert versions.read_current(spark, path)["retired"] == []
    assert read_table(spark, path, "t").count() == 400
    versions.publish(numbered(spark, 5), path, grace=-1)
    assert len(list((tmp_path / "t").glob("_current.*"))) <= 2 and not list((tmp_path / "t").glob("_new.*"))


def test_a_write_that_fails_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(numbered(spark, 1), path)
    with pytest.raises(Exception, match="no more"):
        write_table(numbered(spark, 2).withColumn("x", F.raise_error(F.lit("no more"))), path)
    assert {r.write for r in read_table(spark, path, "t").collect()} == {1}
    with pytest.raises(Exception, match="no more"):
        write_table(numbered(spark, 2).withColumn("x", F.raise_error(F.lit("no more"))), str(tmp_path / "new"))
    with pytest.raises(MissingDataset):
        read_table(spark, str(tmp_path / "new"), "new")


def months(spark, *rows):
    return spark.createDataFrame(list(rows), "anio_mes string, dia date, x int").withColumn("dia", F.to_date(F.lit("2026-01-05")))


def test_touched_partitions_of_whole_and_single_writes(spark, tmp_path):
    path, by = str(tmp_path / "t"), ("anio_mes",)
    write_table(months(spark, ("2026-01", None, 1), ("2026-02", None, 2), (None, None, 9)), path, partition_by=by)
    write_table(months(spark, ("2026-02", None, 3)), path, partition_by=by, only_touched_partitions=True)
    write_table(months(spark, ("2026-03", None, 4), ("2026-01", None, 5)), path, partition_by=by, only_touched_partitions=True)
    table = read_table(spark, path, "t")
    assert table.columns == ["anio_mes", "dia", "x"]
    assert sorted((str(r.anio_mes), r.x) for r in table.collect()) == [
        ("2026-01", 5), ("2026-02", 3), ("2026-03", 4), ("None", 9),
    ]
    write_table(months(spark), path, partition_by=by, only_touched_partitions=True)
    assert read_table(spark, path, "t").count() == 4
    write_table(months(spark), path, partition_by=by)
    assert read_table(spark, path, "t").count() == 0
    assert read_table(spark, path, "t").schema["x"].dataType.simpleString() == "int"


def test_filters_reach_partitions_and_files(spark, tmp_path, plan_of):
    path = str(tmp_path / "t")
    write_table(months(spark, ("2026-01", None, 1), ("2026-02", None, 2)), path, partition_by=("anio_mes",))
    plan = plan_of(read_table(spark, path, "t").where("anio_mes = '2026-02' and x > 1"))
    assert "PartitionFilters: [isnotnull(anio_mes" in plan and "GreaterThan(x,1)" in plan


def test_empty_tables_and_strange_names(spark, tmp_path):
    empty = spark.createDataFrame([], "`a b` int, `c.d` string")
    assert store(empty, str(tmp_path / "t"), "t").columns == ["a b", "c.d"]
    full = spark.createDataFrame([(1, "x")], "`a b` int, `c.d` string")
    assert [tuple(r) for r in store(full, str(tmp_path / "t"), "t").collect()] == [(1, "x")]
