"""Quality scores by histogram gradient-boosted trees over statistics of the text.

The statistics (``STATISTICS``) are shares of kinds of characters, words and lines and a few sizes; nothing else about a
document goes in. Training rows become bins between quantiles; every tree grows level by level from sums of first and
second derivatives of the logistic loss by (node, statistic, bin), and leaves are Newton steps. Trees are complete
binary ones in three arrays (statistic, threshold, value), so a batch of documents goes down all trees at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import pieces
from stratalake.llm.words import SPACED, Texts

#: Shares of all bytes.
KINDS = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "digits": b"0123456789",
    "blanks": b" \t\r\x0b\x0c",
    "breaks": b"\n",
    "stops": b".?",
    "shouts": b"!",
    "commas": b",;:",
    "quotes": b"\"'`",
    "brackets": b"()[]{}<>",
    "signs": b"#*$%&|@^~_=+\\/",
    "dashes": b"-",
    "beyond": bytes(range(128, 256)),
}
STATISTICS = [
    *KINDS, "words", "word_bytes", "longest_word", "lines", "line_words", "repeated_lines", "different_words", "repeated_runs",
    "commonest_word", "capital_words", "signed_words", "short_words", "byte_entropy",
]
_MEMBERS = np.zeros((256, len(KINDS)), bool)
for _k, _kind in enumerate(KINDS.values()):
    _MEMBERS[list(_kind), _k] = True
_LINE = np.array([b != 10 for b in range(256)])


def _runs(values: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Document and count of every distinct (document, value)."""
    order = np.lexsort((values, doc))
    values, doc = values[order], doc[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    return doc[first], np.diff(np.append(first, len(values)))


def statistics(texts: list[bytes | None]) -> np.ndarray:
    """One row of ``STATISTICS`` for each text; all zero for a null or empty one."""
    t, lines = Texts(texts, SPACED), Texts(texts, _LINE)
    n = t.count
    size = np.maximum(t.ends - t.begins, 1).astype(np.float64)
    out = {name: t.count_bytes(_MEMBERS[t.buffer, k]) / size for k, name in enumerate(KINDS)}
    words, hashes, length = t.per_doc(t.doc), t.hashes(), (t.stops - t.starts).astype(np.float64)
    some = np.maximum(words, 1)
    out["words"] = np.log1p(words)
    out["word_bytes"] = np.bincount(t.doc, length, n) / some
    longest = np.zeros(n)
    np.maximum.at(longest, t.doc, length)
    out["longest_word"] = np.log1p(longest)
    rows = lines.per_doc(lines.doc)
    out["lines"], out["line_words"] = np.log1p(rows), words / np.maximum(rows, 1)
    own, _ = _runs(lines.hashes(), lines.doc)
    out["repeated_lines"] = (rows - np.bincount(own, minlength=n)) / np.maximum(rows, 1)
    own, often = _runs(hashes, t.doc)
    out["different_words"] = np.bincount(own, minlength=n) / some
    most = np.zeros(n)
    np.maximum.at(most, own, often)
    out["commonest_word"] = most / some
    runs, at = t.shingles(3)
    own, _ = _runs(runs, at)
    there = t.per_doc(at)
    out["repeated_runs"] = (there - np.bincount(own, minlength=n)) / np.maximum(there, 1)
    letters, capitals, signs = (
        np.concatenate(([0], np.cumsum(_MEMBERS[t.buffer][:, k].any(axis=1), dtype=np.int64))) for k in ([0, 1, 12], [0], [10])
    )
    inside = [c[t.stops] - c[t.starts] for c in (letters, capitals, signs)]
    out["capital_words"] = np.bincount(t.doc, (inside[0] > 1) & (inside[1] == inside[0]), n) / some
    out["signed_words"] = np.bincount(t.doc, inside[2] > 0, n) / some
    out["short_words"] = np.bincount(t.doc, length <= 2, n) / some
    out["byte_entropy"] = _entropy(t)
    return np.stack([out[name] for name in STATISTICS], axis=1).astype(np.float32)


def _entropy(t: Texts) -> np.ndarray:
    out = np.zeros(t.count)
    for i, (s, e) in enumerate(zip(t.begins.tolist(), t.ends.tolist(), strict=True)):
        if e > s:
            share = np.bincount(t.buffer[s:e], minlength=256) / (e - s)
            share = share[share > 0]
            out[i] = -(share * np.log2(share)).sum()
    return out


@dataclass(frozen=True)
class Trees:
    """Complete trees of one depth. ``feature`` and ``threshold`` are (trees, inner nodes), children of k are 2k + 1 and
    2k + 2; ``value`` is (trees, leaves). A value above the threshold goes right."""

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    def margins(self, rows: np.ndarray) -> np.ndarray:
        trees, inner = self.feature.shape
        if not trees:
            return np.full(len(rows), self.base)
        node, tree = np.zeros((len(rows), trees), np.int64), np.arange(trees)
        at = np.arange(len(rows))[:, None]
        for _ in range((inner + 1).bit_length() - 1):
            node = 2 * node + 1 + (rows[at, self.feature[tree, node]] > self.threshold[tree, node])
        return self.base + self.value[tree, node - inner].sum(axis=1)

    def scores(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margins(rows)))


def fit(
    rows: np.ndarray, good: np.ndarray, trees: int = 80, depth: int = 4, bins: int = 64, rate: float = 0.15,
    penalty: float = 1.0, least: float = 2.0,
) -> Trees:
    """Boosted trees for ``good`` (0 or 1). ``least`` is the smallest sum of second derivatives of a leaf. With one kind of
    label, or none, there is no tree and every score is the smoothed share of good ones."""
    n, width = rows.shape
    share = (good.sum() + 0.5) / (n + 1)
    base = float(np.log(share / (1 - share)))
    inner = 2**depth - 1
    if n == 0 or good.min() == good.max():
        return Trees(base, np.zeros((0, inner), np.int64), np.zeros((0, inner), np.float32), np.zeros((0, inner + 1)))
    cuts = [np.unique(np.quantile(rows[:, k], np.arange(1, bins) / bins, method="lower")) for k in range(width)]
    binned = np.stack([np.searchsorted(c, rows[:, k]) for k, c in enumerate(cuts)], axis=1)
    # beyond a statistic's last cut there is nothing to split off
    usable = np.arange(bins) < np.array([len(c) for c in cuts])[:, None]
    place = binned + np.arange(width) * bins
    feature = np.zeros((trees, inner), np.int64)
    threshold = np.full((trees, inner), np.inf, np.float32)
    value, margin = np.zeros((trees, inner + 1)), np.full(n, base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = good - p, p * (1 - p)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, count = 2**level - 1, 2**level
            cell = ((node - first)[:, None] * (width * bins) + place).ravel()
            sums = [np.bincount(cell, np.repeat(v, width), count * width * bins).reshape(count, width, bins) for v in (g, h)]
            left = [np.cumsum(s, axis=2) for s in sums]
            right = [s[:, :, -1:] - s for s in left]
            gain = left[0] ** 2 / (left[1] + penalty) + right[0] ** 2 / (right[1] + penalty)
            whole = [s[:, 0, -1] for s in left]
            gain = np.where(usable & (left[1] >= least) & (right[1] >= least), gain, -np.inf).reshape(count, -1)
            best = gain.argmax(axis=1)
            split = gain[np.arange(count), best] > whole[0] ** 2 / (whole[1] + penalty) + 1e-6
            which, cut = best // bins, best % bins
            own = first + np.arange(count)
            feature[t, own] = np.where(split, which, 0)
            threshold[t, own] = [cuts[w][c] if s else np.inf for w, c, s in zip(which, cut, split, strict=True)]
            node = 2 * node + 1 + (rows[np.arange(n), feature[t, node]] > threshold[t, node])
        leaf = node - inner
        sums = [np.bincount(leaf, v, inner + 1) for v in (g, h)]
        value[t] = rate * sums[0] / (sums[1] + penalty)
        margin += value[t][leaf]
    return Trees(base, feature, threshold, value)


def counted(docs: DataFrame) -> DataFrame:
    """(doc_id, good, statistics) of ``docs`` (doc_id, good, text); texts stay in the tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 2):
            rows = [r.tobytes() for r in statistics(batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(rows, pa.binary())], names=["doc_id", "good", "row"])

    return docs.mapInArrow(run, "doc_id bigint, good double, row binary")


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = 20_000, **settings: float) -> Trees:
    """Trees from at most about ``sample_rows`` documents that ``labels`` (doc_id, quality 0 or 1) marks.

    Documents are chosen by a hash of their id. Labels that are null or of unknown documents are passed over; one with
    several labels is good if most say so. Of documents that share an id one is used.
    """
    rows = labels.where("doc_id is not null and quality is not null").groupBy("doc_id")
    rows = rows.agg((F.avg("quality") >= 0.5).cast("double").alias("good"))
    share = min(1.0, sample_rows / max(1, rows.count()))
    chosen = rows.where(F.pmod(F.xxhash64("doc_id", F.lit(23)), F.lit(1 << 30)) < int(share * (1 << 30)))
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    # about sample_rows ids and labels are broadcast, and as many rows of statistics come back
    found = counted(texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "good", "text"))
    held: pd.DataFrame = found.groupBy("doc_id").agg(F.min(F.struct("good", "row")).alias("r")).select("doc_id", "r.*").toPandas()
    held = held.sort_values("doc_id", kind="stable")
    table = np.frombuffer(b"".join(bytes(r) for r in held["row"]), np.float32).reshape(-1, len(STATISTICS))
    return fit(table, held["good"].to_numpy(float), **settings)


def score(docs: DataFrame, trees: Trees) -> DataFrame:
    """``docs`` (text and any other columns) with __score, the probability of a good text. The whole text is read; a null
    text is an empty one and gets a score like any other."""
    place = docs.columns.index("text")
    shared = docs.sparkSession.sparkContext.broadcast(trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, place):
            rows = statistics(batch.column(place).cast(pa.large_binary()).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(shared.value.scores(rows))], names=[*batch.schema.names, "__score"]
            )

    return docs.mapInArrow(run, ", ".join([*(f"`{n}` {t}" for n, t in docs.dtypes), "__score double"]))


def held_out(name: str = "doc_id") -> Column:
    """Rows kept out of training: those whose id's checksum leaves 2 when divided by 4; a null id is not one of them."""
    return F.coalesce(F.crc32(F.col(name).cast("string")) % 4 == 2, F.lit(False))
