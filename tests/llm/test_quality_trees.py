"""Boosted trees: statistics and traversal against brute force, held-out accuracy, odd rows."""

import math
import random
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratalake.llm import quality_trees as trees

LARGER = "/root/testdata/sf0.01"
needs_tables = pytest.mark.skipif(not Path(LARGER, "documents.parquet").exists(), reason="needs the text tables")


def plain_statistics(text):
    """The same statistics, one text at a time."""
    raw = text.encode()
    n = max(len(raw), 1)
    out = {k: sum(b in kind for b in raw) / n for k, kind in trees.KINDS.items()}
    words = [w for w in raw.replace(b"\x1c", b"_").split() if w] if raw else []
    some = max(len(words), 1)
    lines = [x for x in raw.split(b"\n") if x]
    letter = lambda b: 65 <= b <= 90 or 97 <= b <= 122 or b >= 128
    runs = [tuple(words[i : i + 3]) for i in range(len(words) - 2)] or ([tuple(words)] if words else [])
    capital = [sum(map(letter, w)) > 1 and sum(map(letter, w)) == sum(65 <= b <= 90 for b in w) for w in words]
    out |= {
        "words": math.log1p(len(words)),
        "word_bytes": sum(map(len, words)) / some,
        "longest_word": math.log1p(max(map(len, words), default=0)),
        "lines": math.log1p(len(lines)),
        "line_words": len(words) / max(len(lines), 1),
        "repeated_lines": (len(lines) - len(set(lines))) / max(len(lines), 1),
        "different_words": len(set(words)) / some,
        "repeated_runs": (len(runs) - len(set(runs))) / max(len(runs), 1),
        "commonest_word": max(Counter(words).values(), default=0) / some,
        "capital_words": sum(capital) / some,
        "signed_words": sum(any(b in trees.KINDS["signs"] for b in w) for w in words) / some,
        "short_words": sum(len(w) <= 2 for w in words) / some,
        "byte_entropy": -sum(c / n * math.log2(c / n) for c in Counter(raw).values()),
    }
    return [out[name] for name in trees.STATISTICS]


def test_statistics(odd_rows):
    texts = [r[1] for r in odd_rows] + ["WORD word A1 ## x!x", "a a a b\nb\n\nb", "é É 漢字 ok."]
    got = trees.statistics([None if t is None else t.encode() for t in texts])
    assert np.allclose(got, [plain_statistics(t or "") for t in texts], atol=1e-5)
    assert trees.statistics([]).shape == (0, len(trees.STATISTICS))


def by_hand(model, row):
    total = model.base
    for tree in range(len(model.feature)):
        node = 0
        while node < model.feature.shape[1]:
            node = 2 * node + 1 + int(row[model.feature[tree, node]] > model.threshold[tree, node])
        total += model.value[tree, node - model.feature.shape[1]]
    return total


@pytest.fixture(scope="module")
def made():
    rng = np.random.default_rng(5)
    rows = rng.normal(size=(1500, 6)).astype(np.float32)
    rows[:, 3] = np.round(rows[:, 3])
    good = ((rows[:, 0] > 0.3) ^ (rows[:, 3] > 0)).astype(float)
    return rows, good


def test_flat_arrays_walk_like_trees(made):
    rows, good = made
    model = trees.fit(rows[:500], good[:500], trees=7, depth=3)
    assert np.allclose(model.margins(rows[:50]), [by_hand(model, r) for r in rows[:50]])


def test_trees_learn_what_no_single_statistic_tells(made):
    rows, good = made
    model = trees.fit(rows[:1000], good[:1000])
    assert ((model.scores(rows[1000:]) >= 0.5) == good[1000:]).mean() > 0.95


def test_first_split_is_the_best_of_all(made):
    rows, good = made
    model = trees.fit(rows, good, trees=1, depth=1, bins=16)
    p = (good.sum() + 0.5) / (len(good) + 1)

    def gain(mask):
        g, h = (good - p)[mask].sum(), p * (1 - p) * mask.sum()
        return g * g / (h + 1)

    cuts = [(k, c) for k in range(6) for c in np.unique(np.quantile(rows[:, k], np.arange(1, 16) / 16, method="lower"))]
    best = max(cuts, key=lambda kc: gain(rows[:, kc[0]] > kc[1]) + gain(rows[:, kc[0]] <= kc[1]))
    assert (model.feature[0, 0], model.threshold[0, 0]) == (best[0], np.float32(best[1]))


def test_one_kind_of_label_or_none():
    rows = np.ones((4, 6), np.float32)
    assert np.allclose(trees.fit(rows, np.ones(4)).scores(rows), 0.9)
    assert np.allclose(trees.fit(rows[:0], np.ones(0)).scores(rows), 0.5)
    # nothing to split by: every leaf is the same
    assert np.ptp(trees.fit(rows, np.array([0.0, 1, 1, 1])).scores(rows)) == 0


@needs_tables
def test_held_out_documents(spark):
    from stratalake.llm.queries import QUERIES

    found = QUERIES["op13_quality_trees"](spark, LARGER)
    labels = spark.read.parquet(f"{LARGER}/labels.parquet")
    rows = found.join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    held = [r for r in rows if r.held_out]
    assert len(held) > 50
    for label in (0, 1):
        mine = [r.predicted == label for r in held if r.quality == label]
        assert sum(mine) / len(mine) > (0.95 if label else 0.85)
    assert found.count() == spark.read.parquet(f"{LARGER}/documents.parquet").count()


def test_held_out_labels_change_nothing(spark, folder):
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    kept = labels.where(~trees.held_out())
    turned = labels.withColumn("quality", F.when(trees.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    one, two = (trees.train(docs, x, trees=5) for x in (kept, turned.where(~trees.held_out())))
    assert (one.value == two.value).all() and (one.threshold == two.threshold).all()


def test_odd_rows(spark, odd_docs, no_docs):
    rng = random.Random(2)
    labels = [(i, rng.randrange(2)) for i in range(19)] + [(None, 1), (3, None), (10_000, 0), (7, 0), (7, 1), (7, 1)]
    labels = spark.createDataFrame(labels, "doc_id bigint, quality int")
    model = trees.train(odd_docs, labels, trees=3)
    rows = trees.score(odd_docs, model).collect()
    assert len(rows) == odd_docs.count() and all(0 < r["__score"] < 1 for r in rows)
    assert len({r["__score"] for r in rows if not r.text}) == 1
    assert trees.score(no_docs, model).count() == 0
    none = trees.train(no_docs, labels)
    assert {r["__score"] for r in trees.score(odd_docs, none).collect()} == {0.5}
    assert not any(r[0] for r in odd_docs.where("doc_id is null").select(trees.held_out()).collect())
