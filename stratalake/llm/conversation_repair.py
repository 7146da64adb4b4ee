"""Repair of conversations to the form ``(s?(ua)+)?`` at least cost, by dynamic programming over a grammar.

A turn is one symbol: the class of its role (s, u, a, x for any other; capital if its text is truncated), or b and d for
blank and duplicate turns, which must go. Every symbol is a 4 x 4 min-plus matrix over what the repaired roles so far
end in, with the cheapest edits as a rope beside each cost. Symbol pairs that are frequent in all conversations become
rules (Re-Pair), round by round; a rule's matrix is the product of two that are known, made once, bottom-up, and shared
by all conversations. A conversation is the product over its compressed symbols.

Edits of equal cost are compared as text. Neither of two different ones is the beginning of the other (it would cost
less), so the least of a whole is made of the least of its parts, and products may be taken in any grouping.

Turns are range-partitioned by (conversation, turn), so one conversation may spread over many tasks. Each task folds its
sorted turns into chunks of at most ``ROWS`` turns and about ``BYTES`` of text, or one long turn. A chunk that is certainly a whole
conversation is repaired on the spot. The others send only their matrices, one row a chunk, to a task that joins them
in order; the texts are repaired in the chunks again, and only the digest of such a conversation reads its chunks one
after another, as a hash has to.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from hashlib import sha256

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import pieces, written

ROWS, BYTES = 256, 256 << 10
BLANKS = "\t\n\x0b\x0c\r "
LEGAL = {"su", "ua", "au"}
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
#: Where a kept role leads; a repaired conversation ends in START (empty) or ASSISTANT.
NEXT = {(START, "s"): SYSTEM, **{(s, "u"): USER for s in (START, SYSTEM, ASSISTANT)}, (USER, "a"): ASSISTANT}
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
FIRST_RULE = 0xE000


class Rope:
    """Edits of a stretch, put together only when they are read."""

    __slots__ = ("left", "right", "flat")

    def __init__(self, left: Rope | None = None, right: Rope | None = None, flat: str | None = None):
        self.left, self.right, self.flat = left, right, flat

    def text(self) -> str:
        if self.flat is None:
            out, left = [], [self.right, self.left]
            while left:
                rope = left.pop()
                if rope.flat is None:
                    left += [rope.right, rope.left]
                else:
                    out.append(rope.flat)
            self.flat, self.left, self.right = "".join(out), None, None
        return self.flat


#: A cost and its rope, or None where there is no way.
Entry = tuple[int, Rope] | None
Matrix = list[list[Entry]]


def better(a: Entry, b: Entry) -> Entry:
    if a is None or b is None:
        return b if a is None else a
    if a[0] != b[0]:
        return a if a[0] < b[0] else b
    return a if a[1].text() <= b[1].text() else b


def row_times(row: list[Entry], matrix: Matrix) -> list[Entry]:
    out: list[Entry] = [None] * 4
    for p, entry in enumerate(row):
        if entry is not None:
            for q, more in enumerate(matrix[p]):
                if more is not None and (out[q] is None or out[q][0] >= entry[0] + more[0]):
                    out[q] = better(out[q], (entry[0] + more[0], Rope(entry[1], more[1])))
    return out


def times(a: Matrix, b: Matrix) -> Matrix:
    return [row_times(row, b) for row in a]


def _entry(cost: int, edits: str) -> Entry:
    return cost, Rope(flat=edits)


def inserts() -> Matrix:
    """Turns put in between two others: none, one or two."""
    out: Matrix = [[_entry(0, "") if p == q else None for q in STATES] for p in STATES]
    for p in (START, SYSTEM, ASSISTANT):
        out[p][USER] = _entry(INSERT, "I")
    out[USER][ASSISTANT] = _entry(INSERT, "I")
    for p in (START, SYSTEM):
        out[p][ASSISTANT] = _entry(2 * INSERT, "II")
    return out


def turn(symbol: str) -> Matrix:
    """One turn of that kind."""
    out: Matrix = [[None] * 4 for _ in STATES]
    for p in STATES:
        out[p][p] = _entry(DELETE, "D")
        if symbol not in "bd":
            more = TRUNCATED if symbol.isupper() else 0
            q = ASSISTANT if p == USER else USER
            out[p][q] = better(out[p][q], _entry(REROLE + more, "R"))
            q = NEXT.get((p, symbol.lower()))
            if q is not None:
                out[p][q] = better(out[p][q], _entry(KEEP + more, "K"))
    return out


class Grammar:
    """Rules (pair, symbol) in the order they are applied, and the matrix of every symbol with the inserts after it."""

    def __init__(self, rules: list[tuple[str, str]]):
        self.rules, self.between = rules, inserts()
        self.known = {s: times(turn(s), self.between) for s in "suaxSUAXbd"}
        for pair, symbol in rules:
            self.known[symbol] = times(self.known[pair[0]], self.known[pair[1]])

    def compressed(self, symbols: str) -> str:
        for pair, symbol in self.rules:
            symbols = symbols.replace(pair, symbol)
        return symbols

    def matrix(self, symbols: str) -> Matrix:
        """Of a stretch of a conversation, with the inserts before and after it."""
        out = self.between
        for s in self.compressed(symbols):
            out = times(out, self.known[s])
        return out

    def repaired(self, symbols: str) -> tuple[int, str]:
        """Cost and edits of a whole conversation."""
        row = self.between[START]
        for s in self.compressed(symbols):
            row = row_times(row, self.known[s])
        cost, rope = better(row[START], row[ASSISTANT])
        return cost, rope.text()


def learn(sequences: DataFrame, rounds: int = 5, each: int = 8) -> list[tuple[str, str]]:
    """Rules for the symbol sequences in column ``symbols``, by the numbers of all their pairs.

    A round takes up to ``each`` of the most frequent pairs that share no symbol. Only counts of pairs of symbols, of
    which there are at most 10 + rounds * each, leave the tasks.
    """
    rules: list[tuple[str, str]] = []
    counted = written(sequences.groupBy("symbols").agg(F.count("*").alias("n")), "sequences")
    for _ in range(rounds):
        text = F.col("symbols")
        for pair, symbol in rules:
            text = F.replace(text, F.lit(pair), F.lit(symbol))
        now = counted.select(text.alias("symbols"), "n").where(F.length("symbols") > 1)
        places = F.sequence(F.lit(1), F.length("symbols") - 1)
        pairs = now.select(F.explode(F.transform(places, lambda i: F.substr("symbols", i, F.lit(2)))).alias("pair"), "n")
        best = pairs.groupBy("pair").agg(F.sum("n").alias("n")).where("n > 1").orderBy(F.desc("n"), "pair").limit(4 * each)
        used: set[str] = set()
        before = len(rules)
        for row in best.collect():
            if len(rules) - before < each and not used & set(row["pair"]):
                used |= set(row["pair"])
                rules.append((row["pair"], chr(FIRST_RULE + len(rules))))
        if len(rules) == before:
            break
    return rules


# --- turns to chunks ------------------------------------------------------------------------------

CHUNK = (
    "conv string, sure boolean, low bigint, high bigint, kinds bigint, initials string, symbols string, "
    "h array<bigint>, g array<bigint>, roles array<string>, texts array<string>"
)


class _Chunk:
    def __init__(self, conv: str | None, opens: bool):
        self.conv, self.opens, self.size = conv, opens, 0
        self.turns: list[int] = []
        self.kinds = 0
        self.initials: list[str] = []
        self.symbols: list[str] = []
        self.seen: dict[tuple[int, int], None] = {}
        self.h, self.g, self.roles, self.texts = [], [], [], []

    def add(self, turn: int | None, role: str, text: str, key: tuple[int, int]) -> None:
        if turn is not None:
            self.kinds += not self.turns or self.turns[-1] != turn
            self.turns = [*self.turns[:1], turn]
        initial = role[:1] if role[:1] in {"s", "u", "a"} else "x"
        end = text.rstrip(BLANKS)[-1:]
        fine = end in (".", "!", "?")
        symbol = "b" if not end else "d" if key in self.seen else initial if fine else initial.upper()
        self.seen[key] = None
        self.initials.append(initial)
        self.symbols.append(symbol)
        self.h.append(key[0])
        self.g.append(key[1])
        self.roles.append(role)
        self.texts.append(text)
        self.size += len(text)

    def row(self, sure: bool) -> dict:
        return {
            "conv": self.conv, "sure": sure,
            "low": self.turns[0] if self.turns else None, "high": self.turns[-1] if self.turns else None, "kinds": self.kinds,
            "initials": "".join(self.initials), "symbols": "".join(self.symbols),
            "h": self.h, "g": self.g, "roles": self.roles, "texts": self.texts,
        }


CHUNK_TYPE = pa.schema(
    [
        ("conv", pa.string()), ("sure", pa.bool_()), ("low", pa.int64()), ("high", pa.int64()), ("kinds", pa.int64()),
        ("initials", pa.string()), ("symbols", pa.string()), ("h", pa.list_(pa.int64())), ("g", pa.list_(pa.int64())),
        ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())),
    ]
)


def _folded(batches: Iterator[pa.RecordBatch], rows: int, size: int) -> Iterator[pa.RecordBatch]:
    """Chunks of the sorted turns of a partition. The first and the last conversation may go on in another partition;
    any other one that is a single chunk is surely whole."""
    ready: list[dict] = []
    held = 0
    chunk, first = None, True
    for batch in batches:
        for part in pieces(iter([batch]), 4):
            for conv, moment, there, role, text, h, g in zip(*[c.to_pylist() for c in part.columns], strict=True):
                if chunk is None or chunk.conv != conv:
                    if chunk is not None:
                        ready.append(chunk.row(chunk.opens and not first))
                        held += chunk.size
                        first = False
                    chunk = _Chunk(conv, True)
                elif len(chunk.roles) >= rows or chunk.size >= size:
                    ready.append(chunk.row(False))
                    held += chunk.size
                    chunk = _Chunk(conv, False)
                if there:
                    chunk.add(moment, role, (text or b"").decode(), (h, g))
                if held >= 4 * size or len(ready) >= 2000:
                    yield pa.RecordBatch.from_pylist(ready, CHUNK_TYPE)
                    ready, held = [], 0
    if chunk is not None:
        ready.append(chunk.row(False))
        yield pa.RecordBatch.from_pylist(ready, CHUNK_TYPE)


def chunks(turns: DataFrame, there: Column | None = None, rows: int = ROWS, size: int = BYTES) -> DataFrame:
    """``CHUNK`` rows and ``at``, their order, from ``turns`` (conv_id, turn, role, text); nulls are one space.

    Rows for which ``there`` is false only say that the conversation exists. Turns are in order of ``turn`` (null first);
    of equal ones, those of the same role and text stand together.
    """
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    placed = turns.select(
        F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")).alias("conv"),
        F.col("turn").cast("bigint").alias("turn"),
        (F.lit(True) if there is None else there).alias("there"),
        role.alias("role"),
        text.cast("binary").alias("text"),
        F.xxhash64(role, text).alias("h"),
        F.xxhash64(F.lit(31), text, role).alias("g"),
    )
    order = ["conv", "turn", "h", "g"]
    placed = placed.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(*order, "row")
    placed = placed.sortWithinPartitions(*order).drop("row")
    return written(placed.mapInArrow(partial(_folded, rows=rows, size=size), CHUNK).withColumn("at", F.monotonically_increasing_id()), "chunks")


# --- chunks to verdicts ---------------------------------------------------------------------------

VERDICT = (
    "conv string, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, "
    "audit string"
)
TURNS = "turns array<struct<role:string,text:string>>"
TURNS_TYPE = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))


def counts(symbols: str, initials: str) -> dict[str, int]:
    """Turns by their first fault, and neighbours that may not follow each other."""
    return {
        "blank": symbols.count("b"),
        "duplicate": symbols.count("d"),
        "truncated": sum(map(str.isupper, symbols)),
        "illegal": sum(initials[i : i + 2] not in LEGAL for i in range(len(initials) - 1)),
    }


def edited(state: int, audit: str, roles: list[str], texts: list[str]) -> list[dict[str, str]]:
    """The turns that the edits leave, from ``state`` on."""
    out, at = [], 0
    for edit in audit:
        if edit == "D":
            at += 1
            continue
        role, text = ("assistant" if state == USER else "user"), ""
        if edit == "K":
            role = roles[at]
        if edit != "I":
            text = texts[at]
            at += 1
        state = NEXT[state, role[:1]]
        out.append({"role": role, "text": text})
    return out


def _whole(found: DataFrame, grammar: Broadcast) -> DataFrame:
    """Verdict and repaired turns of chunks that are whole conversations."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, seen = Grammar(grammar.value), {}
        for batch in batches:
            columns = {n: batch.column(n).to_pylist() for n in ("low", "high", "kinds", "initials", "symbols", "roles", "texts")}
            out = {n: [] for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "turns")}
            for low, high, kinds, initials, symbols, roles, texts in zip(*columns.values(), strict=True):
                if symbols not in seen:
                    if len(seen) >= 10_000:
                        seen.clear()
                    seen[symbols] = known.repaired(symbols)
                cost, audit = seen[symbols]
                for name, n in counts(symbols, initials).items():
                    out[name].append(n)
                out["gaps"].append(0 if low is None else high - low + 1 - kinds)
                out["cost"].append(cost)
                out["audit"].append(audit)
                out["turns"].append(edited(START, audit, roles, texts))
            types = [*[pa.int64()] * 6, pa.string(), TURNS_TYPE]
            arrays = [pa.array(v, t) for v, t in zip(out.values(), types, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("conv"), *arrays], names=["conv", *out])

    return found.mapInArrow(run, f"{VERDICT}, {TURNS}")


def repeated_later(found: DataFrame) -> DataFrame:
    """(at, places): turns of a chunk whose role and text stand in an earlier chunk of the conversation."""
    turns = found.select("conv", "at", F.posexplode(F.arrays_zip("h", "g")).alias("place", "key"))
    key = ["conv", "key.h", "key.g"]
    several = turns.groupBy(*key).agg(F.min("at").alias("first"), F.max("at").alias("last")).where("first < last")
    turns = turns.select("conv", "at", "place", "key.h", "key.g").join(several, ["conv", "h", "g"]).where("at > first")
    return turns.groupBy("at").agg(F.collect_list("place").alias("places"))


MATRIX = "conv string, at bigint, low bigint, high bigint, kinds bigint, ends string, blank bigint, duplicate bigint, " \
    "truncated bigint, illegal bigint, costs array<bigint>, audits array<string>"  # fmt: skip


def _matrices(found: DataFrame, grammar: Broadcast) -> DataFrame:
    """One row a chunk: its counts and its matrix, of 16 entries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Grammar(grammar.value)
        for batch in batches:
            out = {n: [] for n in ("ends", "blank", "duplicate", "truncated", "illegal", "costs", "audits")}
            for initials, symbols, places in zip(*[batch.column(n).to_pylist() for n in ("initials", "symbols", "places")], strict=True):
                now = list(symbols)
                for p in places or ():
                    now[p] = "b" if now[p] == "b" else "d"
                symbols = "".join(now)
                entries = [e for row in known.matrix(symbols) for e in row]
                out["ends"].append(initials[:1] + initials[-1:])
                for name, n in counts(symbols, initials).items():
                    out[name].append(n)
                out["costs"].append([None if e is None else e[0] for e in entries])
                out["audits"].append([None if e is None else e[1].text() for e in entries])
            types = [pa.string(), *[pa.int64()] * 4, pa.list_(pa.int64()), pa.list_(pa.string())]
            arrays = [pa.array(v, t) for v, t in zip(out.values(), types, strict=True)]
            old = ["conv", "at", "low", "high", "kinds"]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in old], *arrays], names=[*old, *out])

    return found.drop("roles", "texts", "h", "g").mapInArrow(run, MATRIX)


class _Joined:
    """Chunks of one conversation, joined in order. What all live ways have in common is settled and given out."""

    def __init__(self, conv: str):
        self.conv = conv
        self.row: list[Entry] = [_entry(0, ""), None, None, None]
        self.base = 0
        self.open: list[tuple[int, list]] = []  # chunk, and for each state after it: state before, edits
        self.pieces: list[str] = []
        self.sums = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
        self.low = self.high = None
        self.kinds, self.end = 0, ""

    def add(self, chunk: dict) -> list[dict]:
        for name in self.sums:
            self.sums[name] += chunk[name]
        if chunk["ends"]:
            self.sums["illegal"] += bool(self.end) and self.end + chunk["ends"][0] not in LEGAL
            self.end = chunk["ends"][-1]
        if chunk["low"] is not None:
            self.kinds += chunk["kinds"] - (self.high == chunk["low"])
            self.low = chunk["low"] if self.low is None else self.low
            self.high = chunk["high"]
        row: list[Entry] = [None] * 4
        came: list = [None] * 4
        for p, entry in enumerate(self.row):
            if entry is None:
                continue
            for q in STATES:
                cost = chunk["costs"][4 * p + q]
                if cost is None:
                    continue
                edits = chunk["audits"][4 * p + q]
                way = (entry[0] + cost, Rope(entry[1], Rope(flat=edits)))
                if better(row[q], way) is way:
                    row[q], came[q] = way, (p, edits)
        self.row = row
        self.open.append((chunk["at"], came))
        return self._settle({q for q in STATES if row[q] is not None})

    def _settle(self, live: set[int]) -> list[dict]:
        """Give out the chunks up to the last point that all live ways share."""
        for k in range(len(self.open) - 1, -1, -1):
            live = {self.open[k][1][q][0] for q in live}
            if len(live) == 1 and k > 0:
                out = self._given(live.pop(), k)
                length = sum(len(r["audit"]) for r in out)
                self.row = [e and (e[0], Rope(flat=e[1].text()[length:])) for e in self.row]
                return out
        return []

    def _given(self, state: int, upto: int) -> list[dict]:
        out = []
        for at, came in reversed(self.open[:upto]):
            before, edits = came[state]
            out.append({"conv": self.conv, "at": at, "state": before, "audit": edits})
            state = before
        del self.open[:upto]
        out.reverse()
        self.pieces += [r["audit"] for r in out]
        return out

    def close(self) -> list[dict]:
        best = better(self.row[START], self.row[ASSISTANT])
        state = START if best is self.row[START] else ASSISTANT
        out = self._given(state, len(self.open))
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.kinds
        whole = {"gaps": gaps, **self.sums, "cost": best[0], "audit": "".join(self.pieces)}
        return [*out, {"conv": self.conv, "whole": whole}]


WHOLE = "struct<gaps:bigint,blank:bigint,duplicate:bigint,truncated:bigint,illegal:bigint,cost:bigint,audit:string>"
WAY = f"conv string, at bigint, state int, audit string, whole {WHOLE}"
WAY_TYPE = pa.schema(
    [
        ("conv", pa.string()), ("at", pa.int64()), ("state", pa.int32()), ("audit", pa.string()),
        ("whole", pa.struct([*[(n, pa.int64()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")], ("audit", pa.string())])),
    ]
)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edits of every chunk and the verdict of every conversation, from sorted matrices."""
    open_one: _Joined | None = None
    for batch in batches:
        for i in range(batch.num_rows):
            chunk, out = batch.slice(i, 1).to_pylist()[0], []
            if open_one is None or open_one.conv != chunk["conv"]:
                out += open_one.close() if open_one else []
                open_one = _Joined(chunk["conv"])
            out += open_one.add(chunk)
            if out:
                yield pa.RecordBatch.from_pylist(out, WAY_TYPE)
    if open_one:
        yield pa.RecordBatch.from_pylist(open_one.close(), WAY_TYPE)


def _edited(found: DataFrame) -> DataFrame:
    """Repaired turns of every chunk with its edits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*[batch.column(n).to_pylist() for n in ("state", "audit", "roles", "texts")], strict=True)
            turns = pa.array([edited(*row) for row in rows], TURNS_TYPE)
            yield pa.RecordBatch.from_arrays([batch.column("conv"), batch.column("at"), turns], names=["conv", "at", "turns"])

    return found.select("conv", "at", "state", "audit", "roles", "texts").mapInArrow(run, f"conv string, at bigint, {TURNS}")


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of every conversation from its sorted chunks, one at a time."""
    conv, hashed, begun = None, None, False
    for batch in batches:
        done: list[tuple[str, str]] = []
        for i in range(batch.num_rows):
            name, body = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
            if hashed is None or name != conv:
                if hashed is not None:
                    done.append((conv, hashed.hexdigest()))
                conv, hashed, begun = name, sha256(), False
            if body is not None:
                hashed.update((b"\n" if begun else b"") + body)
                begun = True
        if done:
            yield pa.RecordBatch.from_pylist([{"conv": c, "repaired_sha256": d} for c, d in done], DIGEST_TYPE)
    if hashed is not None:
        yield pa.RecordBatch.from_pylist([{"conv": conv, "repaired_sha256": hashed.hexdigest()}], DIGEST_TYPE)


DIGEST_TYPE = pa.schema([("conv", pa.string()), ("repaired_sha256", pa.string())])


def lines() -> Column:
    """Turns as ``role:text``, one a line; null for none."""
    each = F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"]))
    return F.when(F.size("turns") > 0, F.array_join(each, "\n"))


def repair(
    turns: DataFrame, there: Column | None = None, rows: int = ROWS, size: int = BYTES
) -> tuple[DataFrame, DataFrame]:
    """Verdicts (conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256), one a conversation of
    ``turns`` (conv_id, turn, role, text, any other columns), and the repaired turns (conv_id, at, turns): every
    conversation's chunks, in order of ``at``.

    Null roles and texts are one space; a null turn comes first; a null conv_id is a conversation, too. A role that does not
    begin with s, u or a, an empty one as well, can not be kept. Of repeated rows the first one is no duplicate.
    Long texts are read whole. Rows for which ``there`` is false are no turns, but their conversations get a verdict:
    zeros, no edits and the digest of nothing. No rows give no rows.
    """
    kind = turns.schema["conv_id"].dataType
    found = chunks(turns, there, rows, size)
    grammar = turns.sparkSession.sparkContext.broadcast(learn(found.select("symbols")))
    sure = _whole(found.where("sure"), grammar).withColumn("at", F.lit(0).cast("bigint"))
    unsure = found.where("not sure")
    matrices = _matrices(unsure.join(repeated_later(unsure), "at", "left"), grammar)
    dealt = matrices.repartition("conv").sortWithinPartitions("conv", "at")
    ways = written(dealt.mapInArrow(_joined, WAY), "ways")
    left = _edited(unsure.join(ways.where("whole is null").drop("conv", "whole"), "at"))
    body = lines().cast("binary").alias("body")
    ordered = left.select("conv", "at", body).repartition("conv").sortWithinPartitions("conv", "at").select("conv", "body")
    digests = ordered.mapInArrow(_digested, "conv string, repaired_sha256 string")
    names = [c.split()[0] for c in VERDICT.split(", ")]
    joined = ways.where("whole is not null").select("conv", "whole.*").join(digests, "conv").select(*names, "repaired_sha256")
    here = sure.select(*names, F.sha2(F.coalesce(lines(), F.lit("")), 256).alias("repaired_sha256"))
    conv = F.when(F.col("conv") != "", F.substr("conv", F.lit(2))).cast(kind).alias("conv_id")
    verdicts = here.union(joined).select(conv, *names[1:], "repaired_sha256")
    return verdicts, sure.select(conv, "at", "turns").union(left.select(conv, "at", "turns"))


def damaged(turns: DataFrame) -> tuple[DataFrame, Column]:
    """``turns`` (conv_id, turn, role, text) with planted faults by the remainder of a checksum, and which rows stay.

    Fixed values, by remainder: 0 the row goes, 1 its text is emptied, 2 loses its ``.!?``, 3 the row is repeated, 4 its role
    becomes user.
    """
    text = F.coalesce("text", F.lit(" "))
    place = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    fault = F.crc32(F.concat(place[0], F.lit(":"), place[1])) % 20
    rows = turns.select(
        "conv_id",
        "turn",
        F.when(fault == 4, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        (fault != 0).alias("there"),
        F.explode(F.array_repeat(F.lit(0), F.when(fault == 3, 2).otherwise(1))).alias("copy"),
    )
    return rows.drop("copy"), F.col("there")
