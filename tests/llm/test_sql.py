"""Every text query with SQL against that SQL, over whole tables."""

from collections import Counter

import pytest

duckdb = pytest.importorskip("duckdb")

from stratalake.llm.queries import ORACLE, QUERIES  # noqa: E402


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_result(spark, folder, name):
    engine = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "labels"):
        engine.execute(f"create view {table} as select * from '{folder}/{table}.parquet'")
    df = QUERIES[name](spark, folder)
    answer = engine.execute(ORACLE[name])
    names = [c[0] for c in answer.description]
    assert sorted(names) == sorted(df.columns)
    expected = Counter(tuple(dict(zip(names, row, strict=True))[c] for c in sorted(names)) for row in answer.fetchall())
    assert Counter(tuple(row[c] for c in sorted(names)) for row in df.collect()) == expected
    assert expected


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
