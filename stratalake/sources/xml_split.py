"""XML records read in parallel inside one file.

A file is read in byte ranges that end at a ``>``. Whether a range starts in plain content, in a comment, in CDATA or in a
quoted attribute depends on all that stands before it, so every range first works out, for each state it might
start in, the state it ends in. These small maps are composed in the order of the ranges, which gives every range its
true start, and a second pass cuts the records out. A record that goes over a border comes in parts, which are
put together by the range in which it begins.

A task holds one stretch of its range as text (``STRETCH_BYTES``), for which all this goes as for a range of its own; the driver
holds one map entry a stretch.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Lexical states between two ranges, by what ends them.
TEXT, COMMENT, CDATA, INSTRUCTION, DOUBLE, SINGLE, DOCTYPE = range(7)
ENDS = {COMMENT: "-->", CDATA: "]]>", INSTRUCTION: "?>"}
OPENS = (("<!--", COMMENT), ("<![CDATA[", CDATA), ("<?", INSTRUCTION))
#: What the last record tag of a range says: none there, one opened, one closed.
NONE, OPENED, CLOSED = range(3)
UTF8 = ["utf-8", "utf8", "us-ascii"]
_ENCODING = re.compile(r"<\?xml[^>]*encoding\s*=\s*[\"']([^\"']+)[\"']")


@dataclass
class Scan:
    """A walk over ``text`` from a lexical state: its end, the places where it was in plain content, and the record tags
    as (place, OPENED or CLOSED); the place of an opened one is its first character, of a closed one behind its last."""

    state: int
    places: list[int]
    tags: list[tuple[int, int]]


def _quoted(text: str, at: int, quote: str) -> tuple[int, int]:
    """Go on inside a quoted attribute: (state, place behind the tag), or the state at the end of the text."""
    while True:
        at = text.find(quote, at)
        if at < 0:
            return (DOUBLE if quote == '"' else SINGLE), len(text)
        state, at, quote = _tag_end(text, at + 1)
        if state is not None:
            return state, at


def _tag_end(text: str, at: int) -> tuple[int | None, int, str]:
    """Go on inside a tag, outside quotes: its end, or the next quote."""
    end = text.find(">", at)
    if end < 0:
        return TEXT, len(text), ""
    double, single = text.find('"', at, end), text.find("'", at, end)
    if double < 0 and single < 0:
        return TEXT, end + 1, ""
    if single < 0 or 0 <= double < single:
        return None, double + 1, '"'
    return None, single + 1, "'"


def scan(text: str, state: int, row_tag: str) -> Scan:
    """Walk over ``text``; it begins behind a ``>`` or at the start of a file."""
    out, at = Scan(state, [], []), 0
    start_tag = re.compile(rf"<(/?){re.escape(row_tag)}(?=[\s/>])")
    if state in ENDS:
        at = _behind(text, ENDS[state], 0)
    elif state in (DOUBLE, SINGLE):
        state, at = _quoted(text, 0, '"' if state == DOUBLE else "'")
        if state != TEXT:
            return Scan(state, [], [])
    elif state == DOCTYPE:
        found = re.compile(r"\]\s*>").search(text)
        at = found.end() if found else -1
    if at < 0:
        return out
    while True:
        out.places.append(at)
        begin = text.find("<", at)
        if begin < 0:
            out.state = TEXT
            return out
        for opening, kind in OPENS:
            if text.startswith(opening, begin):
                at = _behind(text, ENDS[kind], begin + len(opening))
                if at < 0:
                    out.state = kind
                    return out
                break
        else:
            if text.startswith("<!DOCTYPE", begin) and "[" in text[begin : text.find(">", begin) + 1]:
                found = re.compile(r"\]\s*>").search(text, begin)
                if not found:
                    out.state = DOCTYPE
                    return out
                at = found.end()
                continue
            state, at, quote = _tag_end(text, begin)
            if state is None:
                state, at = _quoted(text, at, quote)
            found = start_tag.match(text, begin)
            if found and not found[1]:
                out.tags.append((begin, OPENED))
            if found and state == TEXT and (found[1] or text[at - 2 : at] == "/>"):
                out.tags.append((at, CLOSED))
            if state != TEXT:
                out.state = state
                return out


def _behind(text: str, end: str, at: int) -> int:
    found = text.find(end, at)
    return found + len(end) if found >= 0 else -1


def transitions(text: str, row_tag: str) -> tuple[list[int], list[int]]:
    """For each lexical state at the start: the one at the end, and what the last record tag says."""
    main = scan(text, TEXT, row_tag)
    ends, said = [main.state], [main.tags[-1][1] if main.tags else NONE]
    # where the last record tag begins at the earliest: a closed one begins before its place
    last = main.tags[-1][0] - (main.tags[-1][1] == CLOSED) if main.tags else -1
    for state in range(1, 7):
        first = _first_text(text, state)
        if first is None:
            other = scan(text, state, row_tag)
            ends.append(other.state)
            said.append(NONE)
            continue
        before = bisect_right(main.places, first) - 1
        following = text.find("<", main.places[before]) if before >= 0 else 0
        if before >= 0 and (following < 0 or following >= first):
            # the walk from plain content is in plain content here, too, so from here on both are one
            ends.append(main.state)
            said.append(main.tags[-1][1] if last >= first else NONE)
        else:
            other = scan(text, state, row_tag)
            ends.append(other.state)
            said.append(other.tags[-1][1] if other.tags else NONE)
    return ends, said


def _first_text(text: str, state: int) -> int | None:
    """Where a walk from that state comes to plain content first; None if it does not."""
    if state in ENDS:
        at = _behind(text, ENDS[state], 0)
        return at if at >= 0 else None
    if state == DOCTYPE:
        found = re.compile(r"\]\s*>").search(text)
        return found.end() if found else None
    state, at = _quoted(text, 0, '"' if state == DOUBLE else "'")
    return at if state == TEXT else None


def compose(ranges: list[tuple[int, list[int], list[int]]]) -> dict[int, tuple[int, int | None]]:
    """True start of each range (place, ends, said) of a file: its lexical state, and the range in which the record that
    is open there begins."""
    out: dict[int, tuple[int, int | None]] = {}
    state, owner = TEXT, None
    for start, ends, said in sorted(ranges):
        out[start] = (state, owner)
        owner = {NONE: owner, OPENED: start, CLOSED: None}[said[state]]
        state = ends[state]
    return out


def cut(text: str, state: int, owner: int | None, start: int, row_tag: str) -> Iterator[tuple[int | None, str]]:
    """Whole records of a range, with None, and parts of others, with the range in which they begin."""
    begin, inside = 0, owner is not None
    for place, kind in scan(text, state, row_tag).tags:
        if kind == OPENED and not inside:
            begin, inside, owner = place, True, start
        elif kind == CLOSED and inside:
            yield (owner if owner != start else None), text[begin:place]
            inside, owner = False, None
    if inside:
        yield owner, text[begin:]


def _text(pieces: list[bytes]) -> str:
    """Bytes that are no UTF-8 become replacement characters, as in the built-in reader."""
    return b">".join([*pieces, b""]).decode("utf-8", "replace")


#: A task takes its byte range in stretches of about so many bytes, one after another, and holds one of them as text.
STRETCH_BYTES = 8 << 20


def _ranges(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[str, int, str]]:
    """(path, start, text) of the stretches of each byte range, from its pieces in order. Later
    stretches of a range are named one byte short of the bytes before them: their first piece may begin where the range ends,
    and the next range is named by that."""
    key, pieces, start, held, done = None, [], 0, 0, 0
    for batch in batches:
        for path, block, value in zip(*[batch.column(k).to_pylist() for k in range(3)], strict=True):
            if key != (path, block) or held >= most:
                if key:
                    yield key[0], start, _text(pieces)
                done = done + held if key == (path, block) else 0
                key, pieces, start, held = (path, block), [], block + max(done - 1, 0), 0
            pieces.append(value)
            held += len(value) + 1
    if key:
        yield key[0], start, _text(pieces)


def records(spark: SparkSession, path: str, row_tag: str, most: int = STRETCH_BYTES) -> DataFrame | None:
    """(record) of every ``row_tag`` element of UTF-8 files as its text; None if a file declares another encoding."""
    parts = spark.read.option("lineSep", ">").text(path)
    parts = parts.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), F.col("value").cast("binary"))

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, start, text in _ranges(batches, most):
            ends, said = transitions(text, row_tag)
            declared = _ENCODING.search(text[:300]) if start == 0 else None
            yield pa.RecordBatch.from_pylist(
                [{"path": name, "start": start, "ends": ends, "said": said, "encoding": declared[1] if declared else None}], MAP
            )

    kinds = "path string, start bigint, ends array<bigint>, said array<bigint>, encoding string"
    found: pd.DataFrame = parts.mapInArrow(mapped, kinds).toPandas()
    if not found["encoding"].dropna().str.lower().isin(UTF8).all():
        return None
    starts = {
        name: compose(list(zip(rows["start"].tolist(), rows["ends"], rows["said"], strict=True)))
        for name, rows in found.groupby("path")
    }
    shared = spark.sparkContext.broadcast(starts)

    def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, start, text in _ranges(batches, most):
            state, owner = shared.value[name][start]
            rows = [{"path": name, "owner": o, "start": start, "text": t} for o, t in cut(text, state, owner, start, row_tag)]
            for k in range(0, len(rows), 5000):
                yield pa.RecordBatch.from_pylist(rows[k : k + 5000], CUT)

    cuts = parts.mapInArrow(cut_out, "path string, owner bigint, start bigint, text string")
    parts = cuts.where("owner is not null").groupBy("path", "owner")
    joined = parts.agg(F.array_sort(F.collect_list(F.struct("start", "text"))).alias("parts"))
    whole = cuts.where("owner is null").select(F.col("text").alias("record"))
    return whole.union(joined.select(F.array_join(F.transform("parts", lambda p: p["text"]), "")))


CUT = pa.schema([("path", pa.string()), ("owner", pa.int64()), ("start", pa.int64()), ("text", pa.string())])
MAP = pa.schema(
    [("path", pa.string()), ("start", pa.int64()), ("ends", pa.list_(pa.int64())), ("said", pa.list_(pa.int64())), ("encoding", pa.string())]
)
