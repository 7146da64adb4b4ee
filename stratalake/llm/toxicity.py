"""Toxicity grades by cumulative-link ordinal regression.

One weight vector over sparse text features and ordered thresholds t1 < t2 < t3 give
``P(grade >= k) = sigmoid(w.x - t_k)``; the expected severity is the sum of these probabilities. Features are hashed
words and word beginnings, counted and divided by the square root of the number of words.

The labels tell toxic or not. Toxic training texts are graded 1 to 3 by how much of the text is made of words that
mark toxic texts in the training sample, split at the terciles.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import pieces
from stratalake.llm.words import Texts

CELLS = 1 << 19
BEGINNINGS = (4, 5, 6)
GRADES = 3
#: Letters, and everything beyond ASCII.
LETTERS = np.array([0x61 <= b <= 0x7A or b >= 0x80 for b in range(256)])


def cells(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, cell) of every word and word beginning, and the number of words of each document."""
    t = Texts(texts, LETTERS, lower=True)
    docs, hashed = [t.doc], [t.hashes()]
    for size in BEGINNINGS:
        long = np.flatnonzero(t.stops - t.starts > size)
        docs.append(t.doc[long])
        hashed.append(t.hashes(t.starts[long], t.starts[long] + size) ^ np.uint64(size))
    return np.concatenate(docs), (np.concatenate(hashed) % np.uint64(CELLS)).astype(np.int64), t.per_doc(t.doc)


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # of each cell
    thresholds: np.ndarray  # ascending, one for each grade above 0

    def above(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= k), one column for k = 1, 2, ..."""
        return 1 / (1 + np.exp(-np.clip(scores[:, None] - self.thresholds, -40, 40)))


def counted_cells(docs: DataFrame) -> DataFrame:
    """(doc_id, toxic, words, cells, counts) of ``docs`` (doc_id, toxic, text): the distinct cells of each text and how
    often they occur, as bytes of 32-bit numbers. Texts stay in the tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 2):
            doc, cell, words = cells(batch.column(2).to_pylist())
            key, counts = np.unique(doc * CELLS + cell, return_counts=True)
            cut = np.searchsorted(key, np.arange(len(words) + 1) * CELLS)
            cell, counts = (key % CELLS).astype(np.int32), counts.astype(np.int32)
            parts = [[v[s:e].tobytes() for s, e in zip(cut, cut[1:], strict=False)] for v in (cell, counts)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(words), *[pa.array(v, pa.binary()) for v in parts]],
                names=["doc_id", "toxic", "words", "cells", "counts"],
            )

    return docs.mapInArrow(run, "doc_id bigint, toxic boolean, words bigint, cells binary, counts binary")


class Sample:
    """Training texts as sparse rows over the cells that tell something: those that occur in ``least`` texts at least,
    and in toxic and other texts at rates that differ ``ratio`` times at least."""

    def __init__(
        self, words: np.ndarray, cells: list[bytes], counts: list[bytes], toxic: np.ndarray, weight: np.ndarray,
        least: int = 3, ratio: float = 3.0,
    ):
        self.words, self.n = words, len(words)
        doc = np.repeat(np.arange(self.n, dtype=np.int32), [len(c) // 4 for c in cells])
        cell = np.frombuffer(b"".join(cells), np.int32)
        there = (np.bincount(cell, (toxic * weight)[doc], CELLS) + 0.5) / (toxic @ weight + 1)
        other = (np.bincount(cell, (~toxic * weight)[doc], CELLS) + 0.5) / (~toxic @ weight + 1)
        telling = (np.bincount(cell, minlength=CELLS) >= least) & (np.abs(np.log(there / other)) >= np.log(ratio))
        often = telling[cell]
        self.doc = doc[often]
        self.count = np.frombuffer(b"".join(counts), np.int32)[often].astype(np.float64)
        self.cells, self.column = np.unique(cell[often], return_inverse=True)
        self.value = self.count / np.sqrt(np.maximum(words, 1))[self.doc]

    def dot(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.doc, self.value * weights[self.column], self.n)

    def back(self, gaps: np.ndarray) -> np.ndarray:
        return np.bincount(self.column, self.value * gaps[self.doc], len(self.cells))


def grades(sample: Sample, toxic: np.ndarray) -> np.ndarray:
    """0 for texts that are not toxic, else 1 to GRADES by the share of marking words."""
    there = np.bincount(sample.column, toxic[sample.doc], len(sample.cells))
    other = np.bincount(sample.column, ~toxic[sample.doc], len(sample.cells))
    marks = (there + 0.5) / max(toxic.sum(), 1) > 10 * (other + 0.5) / max((~toxic).sum(), 1)
    share = np.bincount(sample.doc, sample.count * marks[sample.column], sample.n) / np.maximum(sample.words, 1)
    cuts = np.quantile(share[toxic], np.arange(1, GRADES) / GRADES) if toxic.any() else np.zeros(GRADES - 1)
    return np.where(toxic, 1 + np.searchsorted(cuts, share, side="left"), 0)


def fit(sample: Sample, grade: np.ndarray, weight: np.ndarray, rounds: int = 250, step: float = 0.1, decay: float = 1e-4) -> Model:
    """Maximum likelihood with a quadratic penalty, by Adam over all rows; thresholds stay ordered as first one and gaps."""
    w, free = np.zeros(len(sample.cells)), np.array([1.0, *[0.0] * (GRADES - 1)])
    moments = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(free), np.zeros_like(free)]
    weight = weight / weight.sum()
    lower, upper = np.maximum(grade - 1, 0), np.minimum(grade, GRADES - 1)
    for k in range(1, rounds + 1):
        t = np.cumsum(np.concatenate((free[:1], np.exp(free[1:]))))
        score = sample.dot(w)
        a = np.where(grade > 0, 1 / (1 + np.exp(-np.clip(score - t[lower], -30, 30))), 1.0)
        b = np.where(grade < GRADES, 1 / (1 + np.exp(-np.clip(score - t[upper], -30, 30))), 0.0)
        p = np.maximum(a - b, 1e-12)
        g_w = sample.back(weight * (1 - a - b)) - decay * w
        g_t = np.zeros(GRADES)
        np.add.at(g_t, lower, np.where(grade > 0, -weight * a * (1 - a) / p, 0))
        np.add.at(g_t, upper, np.where(grade < GRADES, weight * b * (1 - b) / p, 0))
        tail = np.cumsum(g_t[::-1])[::-1]
        g_f = np.concatenate((tail[:1], tail[1:] * np.exp(free[1:])))
        for value, g, m, v in ((w, g_w, *moments[:2]), (free, g_f, *moments[2:])):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            value += step * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-9)
    weights = np.zeros(CELLS, np.float32)
    weights[sample.cells] = w
    return Model(weights, np.cumsum(np.concatenate((free[:1], np.exp(free[1:])))))


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = 8_000) -> Model | None:
    """Model from about ``sample_rows`` labelled texts, half of them toxic if there are so many; None unless both
    kinds occur. Labels that are null or of unknown documents are passed over; a document with several labels is
    toxic if one says so. Rows are chosen by a hash of their id and weigh what they stand for."""
    rows = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg((F.max("toxic") > 0).alias("toxic"))
    counts = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    if set(counts) != {True, False}:
        return None
    share = {t: min(1.0, sample_rows / 2 / n) for t, n in counts.items()}
    drawn = F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(1 << 30))
    chosen = rows.where(drawn < F.when(F.col("toxic"), int(share[True] * (1 << 30))).otherwise(int(share[False] * (1 << 30))))
    texts = docs.where("text is not null").select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("text")
    )
    # about sample_rows ids and flags are broadcast, and as many rows of counts come back
    held = counted_cells(texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "toxic", "text")).toPandas()
    held = held.sort_values("doc_id", kind="stable").drop_duplicates("doc_id")
    toxic = held["toxic"].to_numpy(bool)
    if toxic.all() or not toxic.any():
        return None
    weight = np.where(toxic, 1 / share[True], 1 / share[False])
    sample = Sample(held["words"].to_numpy(), held["cells"].tolist(), held["counts"].tolist(), toxic, weight)
    return fit(sample, grades(sample, toxic), weight)


def score(docs: DataFrame, model: Model | None, least: float = 0.2) -> DataFrame:
    """``docs`` (text and any other columns) with __severity (0 to GRADES), __grade, __p_toxic and __toxic.

    __toxic: P(grade >= 1) is at least ``least``. The whole text is read. A null text, or one without a letter, has no
    feature and gets the grade of the thresholds alone. Without a model the four are null.
    """
    kinds = "__severity double, __grade int, __p_toxic double, __toxic boolean"
    if model is None:
        return docs.selectExpr("*", *[f"cast(null as {k}) as {n}" for n, k in (x.split() for x in kinds.split(", "))])
    place = docs.columns.index("text")
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.thresholds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Model(*shared.value)
        for batch in pieces(batches, place):
            doc, cell, words = cells(batch.column(place).cast(pa.large_binary()).to_pylist())
            sums = np.bincount(doc, known.weights[cell], len(words)) / np.sqrt(np.maximum(words, 1))
            above = known.above(sums)
            part = np.concatenate((np.ones((len(sums), 1)), above), axis=1)
            part[:, :-1] -= above
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array(above.sum(axis=1)),
                    pa.array(part.argmax(axis=1).astype(np.int32)),
                    pa.array(above[:, 0]),
                    pa.array(above[:, 0] >= least),
                ],
                names=[*batch.schema.names, "__severity", "__grade", "__p_toxic", "__toxic"],
            )

    return docs.mapInArrow(run, ", ".join([*(f"`{n}` {t}" for n, t in docs.dtypes), kinds]))
