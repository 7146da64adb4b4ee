import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from stratalake.llm import suffix_dedup
from stratalake.llm.run_length_index import NONE, RunLengthIndex
from stratalake.llm.suffix_dedup import remove_repeats


def brute(rows, length):
    """(id, bytes, spans, kept) by a table of all strings."""
    first = {}
    texts = [(2**63 - 1 if i is None else i, (t or "").encode()) for i, t in rows]
    for i, t in texts:
        for p in range(len(t) - length + 1):
            w = t[p : p + length]
            first[w] = min(first.get(w, i), i)
    out = []
    for i, t in texts:
        marked = np.zeros(len(t) + 2, bool)
        for p in range(len(t) - length + 1):
            if first[t[p : p + length]] < i:
                marked[p + 1 : p + 1 + length] = True
        turn = np.flatnonzero(np.diff(marked.astype(int)))
        kept = bytes(c for c, m in zip(t, marked[1:], strict=False) if not m)
        out.append((None if i == 2**63 - 1 else i, len(t), tuple(map(tuple, turn.reshape(-1, 2).tolist())), kept))
    return sorted(out, key=str)


def found(docs, **options):
    rows = remove_repeats(docs, **options).collect()
    return sorted(((r.doc_id, r.n_bytes, tuple((s.start, s.end) for s in r.spans), bytes(r.kept)) for r in rows), key=str)


def test_odd_rows(odd_docs, odd_rows):
    assert found(odd_docs, block_bytes=20_000) == brute([r[:2] for r in odd_rows], 50)


def test_random_overlaps(spark):
    rng = random.Random(9)
    pool = ["".join(rng.choice("abcd ") for _ in range(90)) for _ in range(6)]
    rows = []
    for i in range(60):
        parts = [rng.choice(pool)[rng.randrange(30) : 60 + rng.randrange(30)] for _ in range(rng.randrange(4))]
        rows.append((i, "".join(p + rng.choice("xyz") for p in parts)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    for options in ({"block_bytes": 500}, {"length": 30, "block_bytes": 1 << 20}):
        assert found(docs, **options) == brute(rows, options.get("length", 50))


def test_no_rows(no_docs):
    assert remove_repeats(no_docs).count() == 0


def test_result_does_not_depend_on_blocks(odd_docs):
    one = remove_repeats(odd_docs, block_bytes=1 << 30)
    many = remove_repeats(odd_docs, block_bytes=300)
    digest = [F.sum(F.xxhash64("doc_id", "kept").cast("decimal(38,0)"))]
    assert one.agg(*digest).first() == many.agg(*digest).first()


def test_pieces_grow_as_the_input():
    # every block writes to every shard, and there are as many shards as blocks
    for total in (1 << 30, 10 << 30, 100 << 30, 1 << 40):
        assert suffix_dedup._blocks(total, 2 << 20) ** 2 < 300 * (total / (2 << 20))
    assert suffix_dedup._blocks(100 << 20, 2 << 20) == 50
    assert suffix_dedup._blocks(0, 2 << 20) == 1


def test_larger_blocks(spark, monkeypatch):
    rng = random.Random(5)
    pool = ["".join(rng.choice("abcd ") for _ in range(80)) for _ in range(4)]
    rows = [(i, "".join(rng.choice(pool)[rng.randrange(20) :] + str(i % 7) for _ in range(3))) for i in range(80)]
    monkeypatch.setattr(suffix_dedup, "BLOCKS", 4)
    assert found(spark.createDataFrame(rows, "doc_id bigint, text string"), block_bytes=300) == brute(rows, 50)


def test_indexes_of_a_passage_in_many_texts_are_small(monkeypatch):
    rng = random.Random(8)
    passage = bytes(rng.randrange(97, 123) for _ in range(120))
    rows = [(i, bytes(rng.randrange(256) for _ in range(60)) + passage + rng.randbytes(60)) for i in range(300)]
    ids, texts = zip(*rows, strict=True)

    def spans(i, texts):
        # shared strings follow one another, so there is one span
        if i == 0:
            return []
        held = {t[p : p + 50] for t in texts[:i] for p in range(len(t) - 49)}
        hits = [p for p in range(len(texts[i]) - 49) if texts[i][p : p + 50] in held]
        return [(hits[0], hits[-1] + 50)]

    block = pa.table({"block": [0] * len(ids), "id": ids, "text": pa.array(texts, pa.binary())})
    sizes = []

    class Index(RunLengthIndex):
        def __init__(self, strings, owners, depth):
            sizes.append(sum(map(len, strings)))
            super().__init__(strings, owners, depth)

    monkeypatch.setattr(suffix_dedup, "RunLengthIndex", Index)
    monkeypatch.setattr(suffix_dedup, "INDEXED", 1000, raising=False)
    monkeypatch.setattr(suffix_dedup, "MOST", 1000, raising=False)
    known = suffix_dedup._known_passages(suffix_dedup._passages_of(50, 1)(block))
    anchors = suffix_dedup._anchors_of(50, 1, 1)(block, known)
    repeated = [suffix_dedup._repeated(anchors.slice(i, 1)) for i in range(anchors.num_rows)]
    stretches = suffix_dedup._stretches_of(50, 1, 1)(block, pa.concat_tables(repeated))
    marks = pa.concat_tables([suffix_dedup._marks_of(50)(stretches.slice(i, 1)) for i in range(stretches.num_rows)])
    assert len(sizes) > 1 and max(sizes) < 2500
    cut = suffix_dedup._cut(block, marks).to_pylist()
    # bytes beside the passage may be those of a smaller document, too
    assert [r["spans"] for r in cut] == [[{"start": b, "end": e} for b, e in spans(i, texts)] for i in ids]
    assert cut[0]["kept"] == texts[0] and all(len(r["kept"]) <= 120 for r in cut[1:])


def test_copies_of_a_text_are_told_by_their_passages():
    rng = random.Random(4)
    text = bytes(rng.randrange(97, 123) for _ in range(5000))
    rows = [(7, text), (3, text), (3, text), (9, b"x" * 40 + text[:4000]), (None, text), (None, text)]
    ids, texts = [2**63 - 1 if i is None else i for i, _ in rows], [t for _, t in rows]
    block = pa.table({"block": [0] * len(ids), "id": ids, "text": pa.array(texts, pa.binary())})
    known = suffix_dedup._known_passages(suffix_dedup._passages_of(50, 1)(block))
    anchors = suffix_dedup._anchors_of(50, 1, 1)(block, known)
    repeated = pa.concat_tables([suffix_dedup._repeated(anchors.slice(i, 1)) for i in range(anchors.num_rows)])
    stretches = suffix_dedup._stretches_of(50, 1, 1)(block, repeated)
    # the passages that hold no edge of the shorter copy go by their hash, also in the block itself
    assert sum(len(r["stretches"]) for r in stretches.to_pylist()) < 2 * len(text)
    marks = pa.concat_tables([suffix_dedup._marks_of(50)(stretches.slice(i, 1)) for i in range(stretches.num_rows)])
    kept = [(r["id"], r["kept"]) for r in suffix_dedup._cut(block, marks).to_pylist()]
    assert kept == [(3, text), (3, text), (7, b""), (9, b"x" * 40), (2**63 - 1, b""), (2**63 - 1, b"")]


def test_texts_of_many_passages(spark):
    rng = random.Random(6)
    pool = ["".join(rng.choice("abcdefgh ") for _ in range(2500)) for _ in range(5)]
    rows = []
    for i in range(40):
        t = rng.choice(pool)
        b = rng.randrange(1000)
        t = t[b:] + rng.choice(pool)[: rng.randrange(1500)] if i % 3 else t
        cut = rng.randrange(len(t))
        rows.append((rng.choice([i, 5, None]), t if i % 4 else t[:cut] + "#" + t[cut:]))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    for size in (4000, 1 << 20):
        assert found(docs, block_bytes=size) == brute(rows, 50)


def test_index_against_brute_force():
    rng = random.Random(3)
    for _ in range(60):
        letters = rng.choice([b"ab", b"abc\x00\xff", bytes(range(256))])
        base = bytes(rng.choice(letters) for _ in range(rng.randint(1, 60)))
        held = []
        for _ in range(rng.randint(1, 10)):
            s = bytearray(base)
            for _ in range(rng.randint(0, 3)):
                s[rng.randrange(len(s))] = rng.choice(letters)
            held.append(bytes(s))
        owners, depth = np.array([rng.randint(0, 9) for _ in held]), rng.choice([4, 5, 13, 50])
        index = RunLengthIndex(held, owners, depth)
        assert len(index.starts) <= index.n
        for s, (match, place, owner) in zip(held, index.stream(held), strict=True):
            for i in range(len(s)):
                assert match[i] == len(s) - i
                w = s[i : i + depth]
                if len(w) < depth:
                    assert owner[i] == NONE
                else:
                    assert owner[i] == min(int(o) for o, t in zip(owners, held, strict=True) if w in t)
                    if place[i] >= 0:
                        text = bytes((index.text[place[i] : place[i] + depth] - 1).astype(np.uint8))
                        assert text == w


def test_matching_statistics_of_other_texts():
    rng = random.Random(12)
    for _ in range(40):
        held = [bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 40))) for _ in range(rng.randint(1, 6))]
        owners = np.arange(len(held))[::-1].copy()
        index = RunLengthIndex(held, owners, 4)
        texts = [bytes(rng.choice(b"abcd") for _ in range(rng.randint(1, 40))) for _ in range(5)] + [b""]
        for text, (match, _, owner) in zip(texts, index.stream(texts), strict=True):
            for i in range(len(text)):
                size = max(k for k in range(len(text) - i + 1) if any(text[i : i + k] in h for h in held))
                assert match[i] == size
                if size >= 4:
                    assert owner[i] == min(o for o, h in zip(owners, held, strict=True) if text[i : i + 4] in h)
                else:
                    assert owner[i] == NONE


def test_repetitive_strings_have_few_runs():
    base = bytes(np.random.default_rng(1).integers(97, 123, 2000, dtype=np.uint8))
    index = RunLengthIndex([base] * 20, np.arange(20), 50)
    assert len(index.starts) < index.n / 10


def test_unknown_text_matches_nothing():
    index = RunLengthIndex([b"abcdefgh"], np.array([1]), 4)
    ((match, _, owner),) = index.stream([b"abcdXefgh"])
    assert match.tolist() == [4, 3, 2, 1, 0, 4, 3, 2, 1]
    assert owner.tolist() == [1, NONE, NONE, NONE, NONE, 1, NONE, NONE, NONE]
