"""The Merkle manifest against brute force, with superblocks of several heights, and on odd rows."""

from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from stratalake.llm import merkle

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, add=0):
    values = [row.doc_id, row.source, row.lang, None if row.n_chars is None else row.n_chars + add, row.text]
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([h(*last[i : i + 2]) for i in range(0, len(last), 2)])
    return levels


def proof(levels, at):
    out = []
    for level in levels[:-1]:
        if at % 2:
            out.append("<" + level[at - 1])
        else:
            out.append(">" + level[at + 1] if at + 1 < len(level) else "")
        at //= 2
    return out


def expected(rows, tampered):
    groups = {}
    for row in rows:
        groups.setdefault(row.lang, []).append(row)
    langs = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees, out = {}, []
    for lang in langs:
        groups[lang].sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf_of(r)))
        trees[lang] = tree([leaf_of(r) for r in groups[lang]])
    over = tree([trees[g][-1][0] for g in langs])
    root = over[-1][0]
    for place, lang in enumerate(langs):
        for at, row in enumerate(groups[lang]):
            path = proof(trees[lang], at) + proof(over, place)
            node = leaf_of(row, 1 if tampered(row) else 0)
            for step in path:
                node = h(step[1:], node) if step[:1] == "<" else h(node, step[1:])
            out.append((row.doc_id, leaf_of(row), trees[lang][-1][0], root, tuple(path), node, node == root))
    return out


def found(docs, **settings):
    tampered = F.when(F.col("doc_id") % 3 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    rows = merkle.manifest(docs, FIELDS, shown={"n_chars": tampered}, **settings).collect()
    return [(r[0], r[1], r[2], r[3], tuple(r.proof), r.folded_root, r.verified) for r in rows]


def key(row):
    return (row[0] is not None, row[0] or 0, *row[1:])


def tampered(row):
    return row.doc_id is not None and row.doc_id % 3 == 0


@pytest.mark.parametrize("height", [1, 2, 12])
def test_odd_rows(odd_docs, height):
    rows = odd_docs.collect()
    want = expected(rows, tampered)
    assert sorted(found(odd_docs, height=height), key=key) == sorted(want, key=key)
    assert {r[-1] for r in want} == {True, False}


def test_given_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert sorted(found(docs, height=3), key=key) == sorted(expected(docs.collect(), tampered), key=key)


def test_a_lone_row_is_its_own_root_and_no_rows_give_none(spark, odd_docs, no_docs):
    one = odd_docs.where("doc_id = 6")
    row = found(one)[0]
    assert row[1] == row[2] == row[3] and row[4] == () and row[5] != row[1]
    assert found(no_docs) == []


def test_one_large_tree_is_dealt_out(spark):
    rows = spark.range(3000).selectExpr("id as doc_id", "'x' as source", "'en' as lang", "id as n_chars", "'t' as text")
    got = found(rows.repartition(7), height=4)
    assert sorted(got, key=key) == sorted(expected(rows.collect(), tampered), key=key)


def test_a_proof_shows_any_change(odd_docs):
    """A proof folds to the root for its own leaf only."""
    for _, leaf, _, root, path, _, _ in found(odd_docs, height=2):
        assert merkle.fold(leaf, list(path)) == root
        assert merkle.fold(h(leaf), list(path)) != root
