"""Near-duplicate documents by min-max hashing.

Each permutation of the shingle hashes gives two signature values, its minimum and its maximum, so that
``permutations`` hash evaluations a shingle give twice as many values. Bands of ``rows`` values propose
candidates; links are confirmed on the full shingle sets. With 70 permutations and bands of 5, a pair
at similarity 0.85 shares no band with probability (1 - 0.85**5)**28 < 1e-7.

Documents with the same set form one class, and everything after the signatures is about classes:

1. Every class that shares a band with another one is a candidate. It is first compared with one leader, the
   candidate of its bands that shares most of them, so a group of n copies costs n comparisons, not n * n.
2. Bands whose classes are still in different components are compared inside, in blocks of at most
   ``block`` x ``block`` classes; a block gives links that span what it connects, not all its pairs.
   Bands of the same classes are compared once.

No band, group or candidate is capped or dropped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import order_id, pieces, written
from stratalake.llm.components import connected_components
from stratalake.llm.words import SPACED, Texts, mix

NONE = 2**63 - 1  # stands for a null doc_id


def _sets(texts: list[bytes | None], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted within it, and the border of each text's part."""
    t = Texts(texts, SPACED, lower=True)
    values, doc = t.shingles(width)
    order = np.lexsort((values, doc))
    values, doc = values[order], doc[order]
    keep = np.ones(len(values), bool)
    keep[1:] = (values[1:] != values[:-1]) | (doc[1:] != doc[:-1])
    values, doc = values[keep], doc[keep]
    return values, np.searchsorted(doc, np.arange(t.count + 1))


def _key() -> list[Column]:
    """id and (h, g), a 128-bit hash of the text. Rows with the same three are copies of each other."""
    text = F.col("text").cast("binary")
    return [order_id().alias("id"), F.xxhash64(text).alias("h"), F.xxhash64(F.lit(29), text).alias("g")]


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, text, id, h, g) of ``docs`` (doc_id, text, any other columns)."""
    return docs.select("doc_id", "text", *_key())


def sketch(docs: DataFrame, width: int = 3, permutations: int = 70, rows: int = 5) -> DataFrame:
    """(id, h, g, n, a, b, bands) of every row of ``docs`` (doc_id, text); id, h and g as in ``_key``.

    n is the size of the shingle set, (a, b) a 128-bit hash of it, bands one hash for each band; the last three
    are null for a text without words. A text of fewer than ``width`` words is one shingle.
    """
    seeds = np.random.default_rng(11).integers(1, 2**63, (2, permutations), dtype=np.int64).astype(np.uint64)
    factors, shifts = seeds[0] | np.uint64(1), seeds[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 3):
            values, border = _sets(batch.column(3).to_pylist(), width)
            size = np.diff(border)
            some = np.flatnonzero(size)
            first = border[some]
            n = len(some)
            a, b = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
            bands = np.zeros((n, 2 * permutations // rows), np.uint64)
            if n:
                a, b = np.add.reduceat(mix(values), first), np.add.reduceat(mix(values ^ shifts[0]), first)
                for p in range(permutations):
                    h = (values ^ shifts[p]) * factors[p]
                    for k, least in enumerate((np.minimum.reduceat(h, first), np.maximum.reduceat(h, first))):
                        at = p // rows + k * (permutations // rows)
                        bands[:, at] = mix(bands[:, at] * factors[0] + least)
            place = np.full(len(size), -1)
            place[some] = np.arange(n)
            taken = pa.array(place, mask=place < 0)
            flat = pa.array(bands.view(np.int64).ravel())
            lists = pa.FixedSizeListArray.from_arrays(flat, bands.shape[1]).cast(pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:3],
                    pa.array(size.astype(np.int64)),
                    pa.array(a.view(np.int64)).take(taken),
                    pa.array(b.view(np.int64)).take(taken),
                    lists.take(taken),
                ],
                names=["id", "h", "g", "n", "a", "b", "bands"],
            )

    if permutations % rows:
        raise ValueError("permutations is a multiple of rows")
    narrow = keyed(docs).select("id", "h", "g", F.col("text").cast("binary"))
    return narrow.mapInArrow(run, "id bigint, h bigint, g bigint, n bigint, a bigint, b bigint, bands array<bigint>")


def shingle_sets(docs: DataFrame, width: int) -> DataFrame:
    """(id, shingles: sorted 64-bit hashes as bytes) of ``docs`` (id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 1):
            values, border = _sets(batch.column(1).to_pylist(), width)
            parts = [values[s:e].tobytes() for s, e in zip(border, border[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(parts, pa.binary())], names=["id", "shingles"])

    return docs.mapInArrow(run, "id bigint, shingles binary")


def _alike(common: np.ndarray, x: np.ndarray, y: np.ndarray, percent: int) -> np.ndarray:
    return 100 * common >= percent * (x + y - common)


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The ``pairs`` (x, y) whose sets are alike."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 2):
            left, right = ([np.frombuffer(v, np.uint64) for v in batch.column(k).to_pylist()] for k in (2, 3))
            common = np.array([len(np.intersect1d(s, t, True)) for s, t in zip(left, right, strict=True)], np.int64)
            size = [np.array([len(s) for s in side], np.int64) for side in (left, right)]
            yield batch.select([0, 1]).filter(pa.array(_alike(common, *size, percent)))

    wide = (
        pairs.join(sets.toDF("y", "sy"), "y").join(sets.toDF("x", "sx"), "x").select("x", "y", "sx", "sy")
    )
    return wide.mapInArrow(run, "x bigint, y bigint")


def _spanning(x: np.ndarray, y: np.ndarray, nodes: int) -> list[int]:
    """Positions of links that connect all that the links connect."""
    root = list(range(nodes))

    def top(n: int) -> int:
        while root[n] != n:
            root[n] = root[root[n]]
            n = root[n]
        return n

    out = []
    for i, (u, v) in enumerate(zip(x.tolist(), y.tolist(), strict=True)):
        u, v = top(u), top(v)
        if u != v:
            root[u] = v
            out.append(i)
    return out


def _compare_block(ids: np.ndarray, sets: list[np.ndarray], component: np.ndarray, side: np.ndarray, percent: int):
    """Links between the two sides of a block, or within one: only such pairs as are in different components."""
    left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
    size = np.array([len(s) for s in sets], np.int64)
    owner = np.repeat(np.arange(len(sets)), size)
    values, inverse, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = counts[inverse] > 1
    column = (np.cumsum(counts > 1) - 1)[inverse[shared]]
    owner = owner[shared]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    common = np.zeros((len(left), len(right)), np.float32)
    at_left, at_right = np.full(len(sets), -1), np.full(len(sets), -1)
    at_left[left], at_right[right] = np.arange(len(left)), np.arange(len(right))
    step = 4096
    for begin in range(0, int((counts > 1).sum()), step):
        s, e = np.searchsorted(column, (begin, begin + step))
        m, n = np.zeros((len(left), step), np.float32), np.zeros((len(right), step), np.float32)
        o, c = owner[s:e], column[s:e] - begin
        m[at_left[o[at_left[o] >= 0]], c[at_left[o] >= 0]] = 1
        n[at_right[o[at_right[o] >= 0]], c[at_right[o] >= 0]] = 1
        common += m @ n.T
    linked = _alike(common.astype(np.int64), size[left][:, None], size[right][None, :], percent)
    linked &= component[left][:, None] != component[right][None, :]
    x, y = (k[v] for k, v in zip((left, right), np.nonzero(linked), strict=True))
    keep = _spanning(x, y, len(ids))
    return ids[x[keep]], ids[y[keep]]


def near_duplicates(
    docs: DataFrame,
    width: int = 3,
    percent: int = 85,
    permutations: int = 70,
    rows: int = 5,
    block: int = 256,
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs`` (doc_id, text, any other columns).

    A-Z are lower-cased and words are runs of anything but ASCII white space. Documents are linked where
    100 * common >= percent * all of their distinct ``width``-word shingles; component_id is the smallest doc_id
    that can be reached, and the document that has it is kept. A text without words, or null, is linked with
    nothing. Rows that repeat a doc_id are judged each by its own text; those that have the smallest doc_id of their
    component are all kept. A null doc_id comes after all others and names no document: of a component without any
    other id one row is kept, and its component_id is null.
    """
    found = verdicts(docs, width, percent, permutations, rows, block)
    return found.select(
        F.when(F.col("id") != NONE, F.col("id")).alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.when(F.col("real") != NONE, F.col("real")).alias("component_id"),
        "kept",
    )


def drop_near_duplicates(docs: DataFrame, **settings: int) -> DataFrame:
    """The rows of ``docs`` that ``near_duplicates`` keeps, with all their columns, whatever their names."""
    found = verdicts(docs, **settings).groupBy("id", "h", "g").agg(F.max("kept").alias("some"), F.min("kept").alias("all"))
    key = "__key"
    while key in docs.columns:
        key += "_"
    cut = written(found.where("not all").select(F.struct("id", "h", "g").alias(key), "some"), "gone")
    rows = docs.withColumn(key, F.struct(*_key()))
    out = rows.join(cut, key, "left_anti").select(docs.columns)
    single = cut.where("some")
    if single.limit(1).count():  # copies without id, one of which stays
        copies = rows.join(single, key, "left_semi")
        least = copies.groupBy(key).agg(F.min(F.struct(*docs.columns)).alias("row"))
        out = out.union(least.select("row.*"))
    return out


def verdicts(
    docs: DataFrame, width: int = 3, percent: int = 85, permutations: int = 70, rows: int = 5, block: int = 256
) -> DataFrame:
    """(id, h, g, n, real, kept) of every row of ``docs``: its key, the size of its set, the smallest id of its
    component and whether it is kept, as ``near_duplicates`` has it."""
    numbered = sketch(docs, width, permutations, rows).withColumn("row", F.monotonically_increasing_id())
    found = written(numbered, "sketch")
    # a class is a node of its own, also where ids are null or repeated; its owner is its first row
    classes = found.where("n > 0").groupBy("a", "b").agg(
        F.min(F.struct("id", "h", "g", "row")).alias("owner"), F.first("bands").alias("bands")
    )
    classes = written(classes.withColumn("x", F.monotonically_increasing_id()), "classes")
    banded = classes.select("x", F.posexplode("bands").alias("k", "band"))
    shared = banded.groupBy("k", "band").agg(F.min("x").alias("l"), F.max("x").alias("r")).where("l <> r")
    members = written(banded.join(shared.select("k", "band"), ["k", "band"]), "members")
    candidates = members.groupBy("x").agg(F.count("*").alias("bands"))
    owners = classes.join(candidates, "x").select("x", "owner.id", "owner.h", "owner.g")
    texts = keyed(docs).join(owners, ["id", "h", "g"])
    sets = written(shingle_sets(texts.select("x", F.col("text").cast("binary")), width), "sets")
    if docs_repeat(sets):
        sets = written(_one_set(sets), "sets")

    # 1: one leader for each candidate
    sizes = members.groupBy("k", "band").agg(F.count("*").alias("size"))
    weight = members.join(sizes, ["k", "band"]).groupBy("x").agg(F.sum("size").alias("weight"))
    rank = F.struct("weight", (-F.col("x")).alias("minus"))
    ranked = members.join(weight, "x")
    leaders = ranked.groupBy("k", "band").agg(F.max(rank).alias("top"))
    best = members.join(leaders, ["k", "band"]).groupBy("x").agg(F.max("top").alias("top"))
    pairs = best.select((-F.col("top.minus")).alias("y"), "x").where("x <> y").select("x", "y")
    links = written(confirmed(pairs, sets, percent), "linked")
    component = connected_components(links)

    # 2: what is left, band by band
    placed = members.join(component, members["x"] == component["node"], "left").select(
        "k", "band", "x", F.coalesce("component", "x").alias("component")
    )
    placed = written(placed, "placed")
    open_bands = (
        placed.groupBy("k", "band")
        .agg(
            F.min("component").alias("l"),
            F.max("component").alias("r"),
            F.count("*").alias("size"),
            F.sum(F.xxhash64("x").cast("decimal(38,0)")).alias("same"),
            F.bit_xor(F.xxhash64(F.lit(1), "x")).alias("too"),
        )
        .where("l <> r")
        .groupBy("size", "same", "too")
        .agg(F.min(F.struct("k", "band")).alias("one"))
        .select("one.k", "one.band", "size")
    )
    # deal the members of a band out to parts; a block is a pair of parts, each member goes to every block of its part
    parts = F.ceil(F.col("size") / block).cast("int")
    dealt = (
        placed.join(open_bands, ["k", "band"])
        .withColumn("parts", parts)
        .withColumn("part", F.pmod(F.xxhash64("x", F.lit(5)), F.col("parts")).cast("int"))
        .select(
            "k", "band", "x", "component", "part",
            F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"),
        )
        .select(
            "k", "band", "x", "component",
            F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"),
            F.when(F.col("part") == F.col("other"), 2).when(F.col("part") < F.col("other"), 0).otherwise(1).alias("side"),
        )
        .join(sets.withColumnRenamed("id", "x"), "x")
    )

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        # part against part: a member of the diagonal is on both sides
        ids, component = frame["x"].to_numpy(), frame["component"].to_numpy()
        sets = [np.frombuffer(v, np.uint64) for v in frame["shingles"]]
        x, y = _compare_block(ids, sets, component, frame["side"].to_numpy(), percent)
        return pd.DataFrame({"x": x, "y": y})

    more = dealt.groupBy("k", "band", "i", "j").applyInPandas(compare, "x bigint, y bigint")
    all_links = written(links.union(more), "linked")
    component = connected_components(all_links)

    # every row gets the first row of its component
    named = written(
        classes.select("a", "b", "owner", "x")
        .join(component, F.col("x") == F.col("node"), "left")
        .select("a", "b", "owner", F.coalesce("component", "x").alias("component")),
        "named",
    )
    first = named.groupBy("component").agg(F.min("owner").alias("first"))
    named = named.join(first, "component").select("a", "b", "first")
    real = F.coalesce("first.id", "id")
    return (
        found.drop("bands")
        .join(named, ["a", "b"], "left")
        .select(
            "id", "h", "g", "n", real.alias("real"),
            ((F.col("id") == real) & ((F.col("id") != NONE) | (F.col("row") == F.coalesce("first.row", "row")))).alias("kept"),
        )
    )


def docs_repeat(sets: DataFrame) -> bool:
    """Whether an id has several rows."""
    return sets.groupBy("id").count().where("count > 1").limit(1).count() > 0


def _one_set(sets: DataFrame) -> DataFrame:
    return sets.groupBy("id").agg(F.min("shingles").alias("shingles"))
