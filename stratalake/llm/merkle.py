"""Merkle manifest of a dataset: a leaf for every row, a tree for every group of rows, a root over the trees.

Rows of a group are numbered in order, and every run of ``2**height`` consecutive nodes is a superblock. The way up
reduces each superblock to one node, round by round, until a tree has one. The way down is a cogrouped exchange: the
nodes of a superblock meet, in one task, the few nodes outside of it that their proofs need (one row a superblock), and
reduce, join proofs and fold right there. No task holds more than a superblock and one path, whatever the size of a
group, and neither texts nor whole levels are moved.

A step of a proof is "<" or ">" and the digest of the sibling on that side, or "" where a node has none and is hashed
alone.
"""

from __future__ import annotations

from functools import reduce
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stratalake.llm.common import written

NODE = "tree string, pos bigint, node string, size bigint"
PATH = "tree string, pos bigint, subroot string, root string, path array<string>"


def digest(*parts: str) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def leaf(values: list[Column]) -> Column:
    """Digest of the values, each as "-" if null, else as its number of UTF-8 bytes, ":" and itself."""

    def field(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def above(nodes: list[str]) -> list[str]:
    """The next level: the digest of every two nodes, of the last one alone if it has no partner."""
    return [digest(*nodes[i : i + 2]) for i in range(0, len(nodes), 2)]


def levels(nodes: list[str], size: int, height: int) -> list[list[str]]:
    """Levels of a superblock from its ``nodes`` up to one node, in a tree whose present level has ``size`` nodes."""
    out = [nodes]
    for _ in range(min(height, (size - 1).bit_length())):
        out.append(above(out[-1]))
    return out


def paths(known: list[list[str]], outer: list[str]) -> list[list[str]]:
    """Proof of each of the lowest nodes, given the proof of the highest one."""
    found = [outer]
    for nodes in reversed(known[:-1]):
        found = [[_step(nodes, i), *found[i // 2]] for i in range(len(nodes))]
    return found


def _step(nodes: list[str], i: int) -> str:
    if i % 2:
        return "<" + nodes[i - 1]
    return ">" + nodes[i + 1] if i + 1 < len(nodes) else ""


def fold(node: str, path: list[str]) -> str:
    """The root that a node and its proof give."""
    return reduce(lambda n, s: digest(s[1:], n) if s[:1] == "<" else digest(n, s[1:]), path, node)


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` (tree, ...) with pos, their place in the tree by ``order``, and size, the number of its rows.

    Rows are range-partitioned by (tree, order), numbered inside a partition and shifted by a table with one row for
    each partition and tree, so a tree may spread over all partitions.
    """
    by = ["tree", *order]
    placed = rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("at", F.monotonically_increasing_id())
    placed = written(placed.withColumn("part", F.shiftright("at", 33)), "placed")
    slices = placed.groupBy("tree", "part").agg(F.min("at").alias("low"), F.count("*").alias("n"))
    tree = W.partitionBy("tree")
    before = F.sum("n").over(tree.orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    slices = slices.select(
        "tree", "part", (F.coalesce(before, F.lit(0)) - F.col("low")).alias("shift"), F.sum("n").over(tree).alias("size")
    )
    both = placed.join(written(slices, "slices"), ["tree", "part"])
    return both.withColumn("pos", F.col("at") + F.col("shift")).drop("at", "part", "shift")


def climb(nodes: DataFrame, height: int) -> list[DataFrame]:
    """The tables of the rounds, from ``nodes`` (tree, pos, node, size) to the one in which every tree has one node."""

    def reduced(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("pos")
        size, pos = int(frame["size"].iloc[0]), int(frame["pos"].iloc[0]) >> height
        top = levels(frame["node"].tolist(), size, height)[-1]
        left = 1 + ((size - 1) >> height)
        return pd.DataFrame({"tree": frame["tree"].iloc[:1], "pos": [pos], "node": top, "size": [left]})

    rounds, most = [nodes], nodes.agg(F.max("size")).first()[0] or 0
    while most > 1:
        groups = rounds[-1].groupBy("tree", F.shiftright("pos", height).alias("block"))
        rounds.append(written(groups.applyInPandas(reduced, NODE), "nodes"))
        most = 1 + ((most - 1) >> height)
    return rounds


def _meet(nodes: DataFrame, outer: DataFrame, height: int):
    """Nodes and the proof of their superblock, cogrouped by it."""
    block = F.shiftright("pos", height).alias("block")
    return nodes.groupBy("tree", block).cogroup(outer.groupBy("tree", F.col("pos").alias("block")))


def hand_down(rounds: list[DataFrame], outer: DataFrame, height: int) -> DataFrame:
    """Proofs (tree, pos, subroot, root, path) of the lowest superblocks, given those of the trees' subroots.

    ``rounds`` are those of ``climb`` without the last one, in which the subroots stand alone.
    """

    def joined(nodes: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        nodes, over = nodes.sort_values("pos"), outer.iloc[0]
        known = levels(nodes["node"].tolist(), int(nodes["size"].iloc[0]), height)
        found = paths(known, list(over["path"]))
        fixed = {"subroot": over["subroot"], "root": over["root"]}
        return pd.DataFrame({"tree": nodes["tree"], "pos": nodes["pos"], **fixed, "path": found})

    for nodes in reversed(rounds):
        outer = _meet(nodes, outer, height).applyInPandas(joined, PATH)
    return outer


def manifest(
    docs: DataFrame,
    fields: list[str],
    tree: str = "lang",
    order: str = "doc_id",
    shown: dict[str, Column] | None = None,
    height: int = 12,
) -> DataFrame:
    """(``order``, leaf, subroot, root, proof, folded_root, verified) of every row of ``docs``.

    A leaf is the digest of ``fields``. Rows with the same ``tree`` value are one tree, in order of ``order`` (a whole
    number, null first; equal ones by leaf). The subroots, by the trees' values (null first, by UTF-8 bytes), are the
    leaves of the tree of ``root``. A lone leaf is its own root. folded_root is what the proof gives for the row as it
    is ``shown``: with those columns in place of the given ones. Null fields, empty and very long texts have leaves
    like all others; repeated rows have a leaf each; other columns do not matter. No rows give no rows.
    """
    shown = shown or {}
    own, other = ([v.get(name, F.col(name)) for name in fields] for v in ({}, shown))
    key = F.coalesce(F.concat(F.lit("="), F.col(tree).cast("string")), F.lit(""))
    changed = reduce(Column.__or__, [~value.eqNullSafe(F.col(name)) for name, value in shown.items()], F.lit(False))
    rows = docs.select(
        key.alias("tree"),
        F.col(order).cast("bigint").alias("key"),
        leaf(own).alias("node"),
        F.when(changed, leaf(other)).alias("shown"),
        F.monotonically_increasing_id().alias("row"),
    )
    rows = numbered(written(rows, "leaves"), ["key", "node", "row"]).drop("row")
    # as text, since pandas has no whole numbers with nulls
    rows = rows.withColumn("key", F.col("key").cast("string"))
    rounds = climb(rows, height)
    tops = rounds[-1].select(F.lit("").alias("tree"), F.col("tree").alias("name"), "node")
    tops = numbered(tops, ["name"])
    over = climb(tops, height)
    root = over[-1].select("tree", "pos", F.col("node").alias("subroot"), F.col("node").alias("root"))
    root = root.withColumn("path", F.array().cast("array<string>"))
    proofs = hand_down(over[:-1], root, height).select("pos", "root", "path")
    outer = tops.select("pos", F.col("name").alias("tree"), F.col("node").alias("subroot")).join(proofs, "pos")
    outer = outer.select("tree", F.lit(0).cast("bigint").alias("pos"), "subroot", "root", "path")
    outer = hand_down(rounds[1:-1], outer, height)

    def finish(nodes: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        nodes, over = nodes.sort_values("pos"), outer.iloc[0]
        known = levels(nodes["node"].tolist(), int(nodes["size"].iloc[0]), height)
        proofs = paths(known, list(over["path"]))
        given = nodes["shown"].where(nodes["shown"].notna(), nodes["node"])
        folded = [fold(n, p) for n, p in zip(given, proofs, strict=True)]
        fixed = {"subroot": over["subroot"], "root": over["root"]}
        return pd.DataFrame(
            {"key": nodes["key"], "leaf": nodes["node"], **fixed, "proof": proofs, "folded_root": folded}
        )

    kinds = "key string, leaf string, subroot string, root string, proof array<string>, folded_root string"
    found = _meet(rows, outer, height).applyInPandas(finish, kinds)
    found = found.withColumn("key", F.col("key").cast("bigint")).withColumnRenamed("key", order)
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


def siblings(proof: str = "proof") -> Column:
    """The digests of a proof, one after another."""
    return F.array_join(F.transform(proof, lambda s: F.substring(s, 2, 64)), "")
