"""Benchmark decontamination with a generalised suffix automaton.

The automaton holds the normalised word sequences of the benchmark items. A document's words are streamed
through it; after each word it knows the longest stretch that ends there and occurs in an item. Where that
stretch reaches ``window`` words, or ends with a whole shorter item, its last words are hit.

An automaton takes about 650 bytes a word, so items are dealt out to shards of about ``max_words`` words. Only the
items of one shard at a time are sent to the tasks, which build its automaton themselves and keep it for the next
task. One shard, the usual case, is one pass without a shuffle. With more of them every shard is a pass that
leaves only the documents it hits, by key, and the passes are merged per document by an aggregation.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from functools import partial, reduce

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import order_id, pieces, written

_WORDS = re.compile(rb"[0-9a-z\x80-\xff]+")


def words(text: bytes | None) -> list[bytes]:
    """A-Z lower-cased runs of digits, letters and everything beyond ASCII."""
    return _WORDS.findall(text.lower()) if text else []


class Automaton:
    """Minimal automaton of all substrings of the items' word sequences.

    A state stands for substrings that end at the same places; ``longest[s]`` is the length of its longest
    one and ``link[s]`` the state of the longest proper suffix that ends at more places.
    """

    def __init__(self, items: list[tuple[int, list[bytes]]], window: int):
        self.window = window
        self.words: dict[bytes, int] = {}
        self.step: list[dict[int, int]] = [{}]
        self.link, self.longest = [-1], [0]
        coded = [(i, [self.words.setdefault(w, len(self.words)) for w in ws]) for i, ws in items if ws]
        for _, codes in coded:
            at = 0
            for c in codes:
                at = self._extend(at, c)
        self._mark(coded)

    def _extend(self, at: int, c: int) -> int:
        """State of the item read so far plus ``c``."""
        known = self.step[at].get(c)
        if known is not None:
            return known if self.longest[known] == self.longest[at] + 1 else self._split(at, c, known)
        new = len(self.step)
        self.step.append({})
        self.longest.append(self.longest[at] + 1)
        self.link.append(0)
        while at >= 0 and c not in self.step[at]:
            self.step[at][c] = new
            at = self.link[at]
        if at >= 0:
            known = self.step[at][c]
            self.link[new] = known if self.longest[known] == self.longest[at] + 1 else self._split(at, c, known)
        return new

    def _split(self, at: int, c: int, known: int) -> int:
        """Part the substrings of ``known`` that are not longer than those of ``at`` plus ``c``."""
        part = len(self.step)
        self.step.append(dict(self.step[known]))
        self.longest.append(self.longest[at] + 1)
        self.link.append(self.link[known])
        self.link[known] = part
        while at >= 0 and self.step[at].get(c) == known:
            self.step[at][c] = part
            at = self.link[at]
        return part

    def _mark(self, coded: list[tuple[int, list[int]]]) -> None:
        """``full[s]``: the state of the window that ends in s; ``owners``: its items; ``short[s]``: whole
        shorter items that end in s, with their lengths."""
        n, w = len(self.step), self.window
        self.full, self.owners, self.short = [-1] * n, {}, {}
        order = sorted(range(1, n), key=self.longest.__getitem__)
        for s in order:
            if self.longest[s] >= w:
                self.full[s] = s if self.longest[self.link[s]] < w else self.full[self.link[s]]
        own: dict[int, list[tuple[int, int]]] = {}
        for item, codes in coded:
            at = 0
            for k, c in enumerate(codes):
                at = self.step[at][c]
                if k + 1 >= w:
                    self.owners.setdefault(self.full[at], set()).add(item)
            if len(codes) < w:
                while self.longest[self.link[at]] >= len(codes):
                    at = self.link[at]
                own.setdefault(at, []).append((len(codes), item))
        for s in order:
            found = own.get(s, []) + self.short.get(self.link[s], [])
            if found:
                self.short[s] = found
        self.least = min([w, *[length for found in own.values() for length, _ in found]])

    def tables(self) -> dict:
        """What ``stream`` needs, as plain values."""
        names = ["words", "step", "link", "longest", "window", "least", "full", "owners", "short"]
        return {n: getattr(self, n) for n in names}


def stream(tables: dict, text: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
    """Hit stretches [start, end) of words, merged and in order, and the items that hit."""
    code, step, link, longest = tables["words"].get, tables["step"], tables["link"], tables["longest"]
    window, least, full, short = tables["window"], tables["least"], tables["full"], tables["short"]
    owners = tables["owners"]
    spans: list[tuple[int, int]] = []
    items: set[int] = set()
    state = length = 0
    for i, word in enumerate(text):
        c = code(word)
        if c is None:
            state = length = 0
            continue
        to = step[state].get(c)
        while to is None and state:
            state = link[state]
            length = longest[state]
            to = step[state].get(c)
        if to is None:
            length = 0
            continue
        state, length = to, length + 1
        if length < least:
            continue
        reach = 0
        if length >= window:
            reach = window
            items |= owners[full[state]]
        for size, item in short.get(state, ()):
            if size <= length:
                reach = max(reach, size)
                items.add(item)
        if reach:
            start = i + 1 - reach
            while spans and spans[-1][1] >= start:
                start = min(start, spans.pop()[0])
            spans.append((start, i + 1))
    return spans, items


_BUILT: dict[str, dict] = {}


def built(name: str, items: Broadcast, window: int) -> dict:
    """Tables of the automaton of broadcast items, made once in a Python worker, which holds one automaton at a time."""
    if name not in _BUILT:
        _BUILT.clear()
        _BUILT[name] = Automaton([(i, words(t)) for i, t in items.value], window).tables()
    return _BUILT[name]


def shards(benchmark: DataFrame, max_words: int, unnamed: bool) -> list[DataFrame]:
    """The items (item_id, text) with a word, dealt out by a hash to shards of about ``max_words`` words."""
    rows = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("binary").alias("text"))
    rows = rows.where("text is not null" if unnamed else "text is not null and item_id is not null")
    total = rows.select(F.coalesce(F.sum(word_count(F.col("text").cast("string"))), F.lit(0))).first()[0]
    count = max(1, -(-total // max_words))
    shard = F.pmod(F.xxhash64("text", F.lit(41)), F.lit(count))
    return [rows.where(shard == k) if count > 1 else rows for k in range(count)]


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")).cast("bigint")


SPANS = "array<struct<start:bigint,end:bigint,first:bigint,last:bigint>>"
SPAN_TYPE = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "end", "first", "last")]))


def judged(
    batches: Iterator[pa.RecordBatch], place: int, only_hits: bool, name: str, items: Broadcast, window: int
) -> Iterator[pa.RecordBatch]:
    """The batches with the number of words, the hits and the items of the text in column ``place``."""
    tables = built(name, items, window)
    for batch in pieces(batches, place):
        counts, hits, found = [], [], []
        for text in batch.column(place).cast(pa.large_binary()).to_pylist():
            tokens = words(text)
            spans, own = stream(tables, tokens)
            counts.append(len(tokens))
            hits.append(_placed(text, spans) if spans else [])
            found.append(sorted(own, key=lambda i: (i is None, i or 0)))
        more = [pa.array(counts, pa.int64()), pa.array(hits, SPAN_TYPE), pa.array(found, pa.list_(pa.int64()))]
        out = pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*batch.schema.names, "__n_words", "__hits", "__items"])
        yield out.filter(pa.array([bool(h) for h in hits])) if only_hits else out


def _placed(text: bytes, spans: list[tuple[int, int]]) -> list[dict[str, int]]:
    """Stretches of words with their first and last byte."""
    at = [m.span() for m in _WORDS.finditer(text.lower())]
    return [{"start": s, "end": e, "first": at[s][0], "last": at[e - 1][1]} for s, e in spans]


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, window: int = 10, max_words: int = 200_000, unnamed: bool = False
) -> DataFrame:
    """``docs`` (doc_id, text and any other columns) with __n_words, __hits and __items.

    __hits are stretches of hit words, [start, end), with the bytes [first, last) that they take. A window is ``window``
    consecutive words of an item; an item of fewer words, but not none, is one window. A document word inside any
    occurrence of a window is hit. Null texts have no words. Items without words never hit. Those without id hit only
    if ``unnamed``; all of them are then one null, the last in __items. Without items nothing is hit. Repeated rows are
    judged alike. Automata hold about ``max_words`` words, or one longer item.
    """
    parts = shards(benchmark, max_words, unnamed)
    if len(parts) == 1:
        kinds = ", ".join([*(f"`{n}` {t}" for n, t in docs.dtypes), f"__n_words bigint, __hits {SPANS}, __items array<bigint>"])
        return docs.mapInArrow(_judge(parts[0], window, docs.columns.index("text"), False)[0], kinds)
    text = F.col("text").cast("binary")
    key = F.struct(order_id().alias("id"), F.xxhash64(text).alias("h"), F.xxhash64(F.lit(29), text).alias("g"))
    narrow = docs.select(key.alias("key"), text.alias("text"))
    kinds = f"key struct<id:bigint,h:bigint,g:bigint>, text binary, __n_words bigint, __hits {SPANS}, __items array<bigint>"
    passes = []
    for part in parts:
        run, items = _judge(part, window, 1, True)
        passes.append(written(narrow.mapInArrow(run, kinds).drop("text", "__n_words"), "hits"))
        items.destroy()
    found = reduce(DataFrame.union, passes).groupBy(F.col("key").alias("__key"))
    found = found.agg(F.flatten(F.collect_set("__hits")).alias("__hits"), F.flatten(F.collect_set("__items")).alias("__items"))
    found = found.withColumns({"__hits": merged("__hits"), "__items": F.array_sort(F.array_distinct("__items"))})
    name = "__key"
    while name in docs.columns:
        name += "_"
    both = docs.withColumn(name, key).join(found.withColumnRenamed("__key", name), name, "left")
    return both.select(
        *docs.columns,
        F.coalesce(word_count(F.col("text").cast("string")), F.lit(0)).alias("__n_words"),
        *[F.coalesce(c, F.array().cast(t)).alias(c) for c, t in (("__hits", SPANS), ("__items", "array<bigint>"))],
    )


def _judge(part: DataFrame, window: int, place: int, only_hits: bool):
    held = [(item, bytes(text)) for item, text in part.toLocalIterator()]  # about max_words words
    items = part.sparkSession.sparkContext.broadcast(held)
    return partial(judged, place=place, only_hits=only_hits, name=uuid.uuid4().hex, items=items, window=window), items


def merged(spans: str) -> Column:
    """Overlapping and touching stretches as one, in order."""

    def put(done: Column, s: Column) -> Column:
        last = F.element_at(done, -1)
        both = F.struct(
            last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"),
            last["first"].alias("first"), F.greatest(last["last"], s["last"]).alias("last"),
        )
        joined = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(both))
        return F.when((F.size(done) > 0) & (s["start"] <= last["end"]), joined).otherwise(F.concat(done, F.array(s)))

    return F.aggregate(F.array_sort(spans), F.array().cast(SPANS), put)


def remove_leaks(found: DataFrame, max_coverage: float = 0.5) -> DataFrame:
    """Cut the hit stretches out of the texts; drop documents whose words are hit to more than ``max_coverage``.

    Takes what ``find_leaks`` gives and returns the columns it was given. Documents without a hit are untouched.
    """
    hit = F.aggregate("__hits", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    kept = found.where(hit <= F.coalesce("__n_words", F.lit(0)) * max_coverage)
    # cuts are at the borders of words, never inside a character
    raw, zero = F.col("text").cast("binary"), F.lit(0).cast("bigint")
    starts = F.concat(F.array(zero), F.transform("__hits", lambda s: s["last"]))
    ends = F.concat(F.transform("__hits", lambda s: s["first"]), F.array(F.octet_length("text").cast("bigint")))
    left = F.zip_with(
        starts, ends, lambda s, e: F.substring(raw, (s + 1).cast("int"), (e - s).cast("int")).cast("string")
    )
    text = F.when(F.size("__hits") > 0, F.array_join(left, "")).otherwise(F.col("text"))
    return kept.withColumn("text", text).drop("__n_words", "__hits", "__items")
