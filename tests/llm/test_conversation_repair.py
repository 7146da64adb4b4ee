"""Conversation repair against brute force: all edit sequences of short conversations, and the whole given table."""

import itertools
import random
import re
import zlib
from hashlib import sha256

import pytest

from stratalake.llm import conversation_repair as repair

FORM = re.compile(r"(s?(ua)+)?")
SCHEMA = "conv_id bigint, turn bigint, role string, text string, conv string, at int, symbols string"
WHITE = "\t\n\x0b\x0c\r "


def faults(turns):
    out, seen = [], set()
    for role, text in turns:
        end = text.rstrip(WHITE)[-1:]
        out.append("blank" if not end else "duplicate" if (role, text) in seen else "" if end in ".!?" else "truncated")
        seen.add((role, text))
    return out


def cheapest(turns):
    """Least (cost, audit) and the turns it leaves, by a table over turns and what the roles so far end in."""
    kinds = faults(turns)
    best = {"": (0, "", ())}

    def offer(table, end, way):
        if end not in table or way[:2] < table[end][:2]:
            table[end] = way

    def filled(table):
        for end, role, to in (("", "user", "u"), ("s", "user", "u"), ("a", "user", "u"), ("u", "assistant", "a"), ("a", "user", "u")):
            if end in table:
                cost, audit, rows = table[end]
                offer(table, to, (cost + 2, audit + "I", (*rows, (role, ""))))
        return table

    best = filled(best)
    for (role, text), kind in zip(turns, kinds, strict=True):
        after = {}
        for end, (cost, audit, rows) in best.items():
            offer(after, end, (cost + 3, audit + "D", rows))
            if kind in ("blank", "duplicate"):
                continue
            more = kind == "truncated"
            to = "assistant" if end == "u" else "user"
            offer(after, to[0], (cost + 2 + more, audit + "R", (*rows, (to, text))))
            if role[:1] and role[0] in {"": "su", "s": "u", "u": "a", "a": "u"}[end]:
                offer(after, role[0], (cost + more, audit + "K", (*rows, (role, text))))
        best = filled(after)
    return min(best[e] for e in ("", "a") if e in best)


def every_way(turns):
    """All edits, with up to two inserts in each place."""
    kinds = faults(turns)
    inserts = [(), ("user",), ("assistant",), ("user", "assistant"), ("assistant", "user")]
    edits = [["D"] if k in ("blank", "duplicate") else ["K", "D", "user", "assistant"] for k in kinds]
    for choice in itertools.product(*edits):
        for put in itertools.product(inserts, repeat=len(turns) + 1):
            cost, audit, initials = 2 * sum(map(len, put)), "I" * len(put[0]), "".join(r[0] for r in put[0])
            for edit, (role, _), kind, more in zip(choice, turns, kinds, put[1:], strict=True):
                cost += {"K": 0, "D": 3}.get(edit, 2) + (kind == "truncated" and edit != "D")
                audit += {"K": "K", "D": "D"}.get(edit, "R") + "I" * len(more)
                initials += {"K": role[:1] or "?", "D": ""}.get(edit, edit[0]) + "".join(r[0] for r in more)
            if FORM.fullmatch(initials):
                yield cost, audit


def expected(rows):
    """Verdict of each conversation of rows (conv_id, turn, role, text)."""
    out = {}
    for conv in {r[0] for r in rows}:
        mine = [(t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows if c == conv]
        mine.sort(key=lambda t: (t[0] is not None, t[0] or 0))
        turns = [t[1:] for t in mine]
        known = [t[0] for t in mine if t[0] is not None]
        kinds, initials = faults(turns), [r[:1] for r, _ in turns]
        cost, audit, left = cheapest(turns)
        out[conv] = (
            max(known) - min(known) + 1 - len(set(known)) if known else 0,
            *[kinds.count(k) for k in ("blank", "duplicate", "truncated")],
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False)),
            cost,
            audit,
            sha256("\n".join(f"{r}:{x}" for r, x in left).encode()).hexdigest(),
        )
    return out


def found(verdicts):
    rows = verdicts.collect()
    out = {r.conv_id: tuple(r)[1:] for r in rows}
    assert len(out) == len(rows)
    return out


def made(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA).repartition(5)


def random_rows(seed, conversations, most):
    rng = random.Random(seed)
    texts = ["Fine.", "Cut", "", " \n", "Same!", "Why? ", "é漢", "a b."]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None]
    rows = []
    for conv in range(conversations):
        turn = 0
        for _ in range(rng.randrange(1, most)):
            rows.append((conv, turn, rng.choice(roles), rng.choice([*texts, None, f"own {rng.random()}."])))
            turn += rng.choice([1, 1, 1, 2, 5])
    return rows


def test_the_table_is_the_least_of_all_ways():
    rng = random.Random(3)
    for _ in range(60):
        turns = [(rng.choice(["user", "assistant", "system", "tool"]), rng.choice(["A.", "b", "", "c!"])) for _ in range(rng.randrange(4))]
        assert cheapest(turns)[:2] == min(every_way(turns))


@pytest.mark.parametrize("rows, size", [(256, 1 << 18), (3, 1 << 18), (1, 1 << 18), (256, 12)])
def test_random_conversations_in_chunks_of_any_size(spark, rows, size):
    given = random_rows(rows + size, 60, 30)
    assert found(repair.repair(made(spark, given), rows=rows, size=size)[0]) == expected(given)


@pytest.mark.parametrize("others", [0, 100])
def test_one_long_conversation(spark, others):
    """Alone, or with a third of all rows; most of its chunks can be passed in several states."""
    rng = random.Random(9)
    kinds = ["user", "assistant", "assistant", "system"]
    given = [(1000, i, rng.choice(kinds), rng.choice([f"t{i}.", f"t{i}", "again."])) for i in range(700)]
    given += random_rows(2, others, 28)
    assert found(repair.repair(made(spark, given), rows=16)[0]) == expected(given)


def test_odd_rows(spark):
    given = [
        (None, 0, "user", "A."), (None, 1, "assistant", "B."),
        (1, None, "user", "A."), (1, 5, "assistant", "B."), (1, 9, "user", None),
        (2, None, None, None), (2, None, None, None),
        (3, 0, "user", "A."), (3, 0, "user", "A."), (3, 1, "assistant", "long " * 100_000 + "."),
        (4, 2**62, "assistant", "A."), (4, -5, "user", "é."),
    ]
    verdicts, turns = repair.repair(made(spark, given))
    assert found(verdicts) == expected(given)
    left = {r.conv_id: [tuple(t) for t in r.turns] for r in turns.collect()}
    assert left[1] == [("user", "A."), ("assistant", "B.")]
    assert left[2] == []
    empty = repair.repair(made(spark, given).limit(0))[0]
    assert empty.count() == 0 and empty.columns == verdicts.columns


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        row = (conv, turn, "user" if fault == 4 else role, text)
        out += [] if fault == 0 else [row] * (2 if fault == 3 else 1)
    return out


NOTHING = (0, 0, 0, 0, 0, 0, "", sha256(b"").hexdigest())


def test_whole_table_after_damage(spark, folder):
    from stratalake.llm.queries import QUERIES

    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = {r[0]: NOTHING for r in rows} | expected(damaged(rows))
    assert found(QUERIES["op12_conversation_repair"](spark, folder)) == want


def test_a_conversation_that_loses_all_rows_is_still_there(spark):
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    given = [(gone, 0, "user", "A."), (None, None, "user", "A."), (gone + 100_000, 3, "user", "B.")]
    turns, there = repair.damaged(made(spark, given))
    want = {r[0]: NOTHING for r in given} | expected(damaged(given))
    assert found(repair.repair(turns, there)[0]) == want and want[gone] == NOTHING


def test_rules_change_no_result():
    one, two, three, four = (chr(repair.FIRST_RULE + k) for k in range(4))
    plain, rng = repair.Grammar([]), random.Random(1)
    ruled = repair.Grammar([("ua", one), (one + one, two), ("bd", three), ("U" + one, four)])
    for _ in range(200):
        symbols = "".join(rng.choice("suaxSUAXbduaua") for _ in range(rng.randrange(30)))
        assert plain.repaired(symbols) == ruled.repaired(symbols)


def test_frequent_pairs_become_rules(spark):
    rows = spark.createDataFrame([("uauaua",)] * 5 + [("suaua",)] * 3 + [("b",), ("",)], "symbols string")
    one, two = chr(repair.FIRST_RULE), chr(repair.FIRST_RULE + 1)
    assert repair.learn(rows)[:2] == [("ua", one), (one + one, two)]
    assert repair.learn(rows.limit(0)) == []
