"""Quality rules as a ledger of failure bits.

Every rule is evaluated once for each document and leaves one bit; the measurements stay beside the bits.
A policy is a mask of rules under a version name: applying one, or asking what a rule alone would drop, is
bitwise arithmetic over the ledger and never reads the texts again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import pieces, written
from stratalake.llm.words import Texts, mix

MEASURES = [
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_chars", "n_letters", "n_upper",
]

#: Bit number -> (name, condition that fails the document). Bits are never given to another rule later.
RULES: dict[int, tuple[str, Callable[[], Column]]] = {
    0: ("few_words", lambda: F.col("n_words") < 50),
    1: ("repeated_words", lambda: 100 * F.col("n_repeat_words") > 50 * F.col("n_words")),
    2: ("many_symbols", lambda: 10 * F.col("n_symbols") > 10 * F.col("n_words")),
    3: ("some_symbols", lambda: 10 * F.col("n_symbols") > 3 * F.col("n_words")),
    4: ("repeated_lines", lambda: (F.col("n_lines") >= 4) & (2 * F.col("n_dup_lines") > F.col("n_lines"))),
    5: ("long_words", lambda: F.col("word_chars") > 30 * F.col("n_words")),
    6: ("short_words", lambda: 2 * F.col("word_chars") < 3 * F.col("n_words")),
    7: ("upper_case", lambda: 10 * F.col("n_upper") > 8 * F.col("n_letters")),
    8: ("few_letters", lambda: 2 * F.col("n_letters") < F.col("word_chars")),
}
#: Failing one of these rules decides alone, under every policy.
BASE = 0b11
#: Version -> rules that decide.
POLICIES = {"v1": 0b101110111, "v2": 0b111111111}


def measure(docs: DataFrame) -> DataFrame:
    """doc_id and the measurements of every row of ``docs`` (doc_id, text), whole texts; a null text has no words.

    Characters are code points; letters are a-z, A-Z and everything beyond ASCII, upper ones A-Z; lines are the
    pieces between \\n that hold a word, and a duplicate line equals an earlier one.
    """
    letters = np.array([0x41 <= (b & 0xDF) <= 0x5A or b >= 0xC0 for b in range(256)])
    upper = np.array([0x41 <= b <= 0x5A for b in range(256)])
    starting = np.array([not 0x80 <= b <= 0xBF for b in range(256)])
    symbol = np.array([chr(b) in "#*$%&|<>" for b in range(256)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 1):
            t = Texts(batch.column(1).to_pylist())
            words = t.per_doc(t.doc)
            # runs of three words that are found twice in their text
            n = max(0, len(t.doc) - 2)
            same = np.flatnonzero(t.doc[:n] == t.doc[2:]) if n else np.zeros(0, np.int64)
            h = t.hashes()
            run3 = np.zeros(len(same), np.uint64)
            for k in range(3):
                run3 = mix(run3 * np.uint64(31) + h[same + k])
            run3 = mix(run3 + t.doc[same].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            _, inverse, counts = np.unique(run3, return_inverse=True, return_counts=True)
            hit = np.zeros(len(t.doc), bool)
            for k in range(3):
                hit[same[counts[inverse] > 1] + k] = True
            # lines that hold a word, those after their first occurrence
            cuts = np.flatnonzero(t.buffer == 10)
            begin, end = np.concatenate(([0], cuts + 1)), np.concatenate((cuts, [len(t.buffer)]))
            worded = np.searchsorted(t.starts, end) > np.searchsorted(t.starts, begin)
            begin, end = begin[worded], end[worded]
            line_doc = np.searchsorted(t.ends, begin, side="right")
            lines = mix(t.hashes(begin, end) + line_doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            _, first = np.unique(lines, return_index=True)
            again = np.ones(len(lines), bool)
            again[first] = False
            values = {
                "n_words": words,
                "word_chars": t.count_bytes(t.inside & starting[t.buffer]),
                "n_symbols": t.count_bytes(symbol[t.buffer]),
                "n_dup_lines": t.per_doc(line_doc[again]),
                "n_repeat_words": t.per_doc(t.doc[hit]),
                "n_lines": t.per_doc(line_doc),
                "n_chars": t.count_bytes(starting[t.buffer]),
                "n_letters": t.count_bytes(letters[t.buffer]),
                "n_upper": t.count_bytes(upper[t.buffer]),
            }
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(values[m]) for m in MEASURES]], names=["doc_id", *MEASURES]
            )

    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return narrow.mapInArrow(run, "doc_id bigint, " + ", ".join(f"{m} bigint" for m in MEASURES))


def ledger(docs: DataFrame) -> DataFrame:
    """The measurements with ``failed``, the bits of the rules that each document fails."""
    bits = [F.when(rule(), F.lit(1 << bit)).otherwise(F.lit(0)) for bit, (_, rule) in RULES.items()]
    return measure(docs).withColumn("failed", reduce(Column.bitwiseOR, bits).cast("bigint"))


def apply_policy(entries: DataFrame, version: str) -> DataFrame:
    """Add base_failed and kept. Works on any table with ``failed``."""
    base, mask = F.lit(BASE).cast("bigint"), F.lit(POLICIES[version] | BASE).cast("bigint")
    return entries.withColumns(
        {"base_failed": F.col("failed").bitwiseAND(base) != 0, "kept": F.col("failed").bitwiseAND(mask) == 0}
    )


def ablations(entries: DataFrame) -> DataFrame:
    """For each policy and rule: documents that fail the rule, and those that no other rule of the policy fails.

    One aggregation over the ledger; without documents all counts are 0.
    """
    pairs = [(v, bit) for v, mask in POLICIES.items() for bit in RULES if mask >> bit & 1]

    def fails(mask: int, exactly: bool, bit: int) -> Column:
        part = F.col("failed").bitwiseAND(F.lit(mask).cast("bigint"))
        return part == F.lit(1 << bit) if exactly else part.bitwiseAND(F.lit(1 << bit).cast("bigint")) != 0

    sums = [
        F.struct(
            F.lit(v).alias("policy"),
            F.lit(RULES[bit][0]).alias("rule"),
            F.count_if(fails(POLICIES[v], False, bit)).alias("fails"),
            F.count_if(fails(POLICIES[v], True, bit)).alias("fails_alone"),
        ).alias(f"x{i}")
        for i, (v, bit) in enumerate(pairs)
    ]
    return entries.agg(*sums).select(F.inline(F.array(*[f"x{i}" for i in range(len(pairs))])))


def stored(docs: DataFrame) -> DataFrame:
    """The ledger of ``docs``, written once; policies and ablations read it, never the texts again."""
    return written(ledger(docs), "ledger")


def sole_rule(entries: DataFrame, version: str) -> DataFrame:
    """Add only_rule, the rule without which the policy would keep the document (null if there is none or it is kept
    anyway), and n_only_rule, the documents that the policy drops for that rule alone (0 without one)."""
    mask = F.lit(POLICIES[version] | BASE).cast("bigint")
    names = F.create_map(*[F.lit(x) for bit, (name, _) in RULES.items() for x in (1 << bit, name)])
    known = entries.withColumn("only_rule", names[F.col("failed").bitwiseAND(mask).cast("int")])
    alone = ablations(entries).where(F.col("policy") == version).select(F.col("rule").alias("only_rule"), "fails_alone")
    # a row a rule
    both = known.join(F.broadcast(alone), "only_rule", "left")
    return both.withColumn("n_only_rule", F.coalesce("fails_alone", F.lit(0)).cast("bigint")).drop("fails_alone")
