"""Removal of long repeated strings with run-length Burrows-Wheeler indexes.

Every ``length``-byte string of a text is kept under an anchor, the smallest hash of the 24-byte strings inside it.
Equal strings have equal anchors, so repeats are found within an anchor, wherever the documents are:

1. Documents are dealt out to blocks of a few megabytes. A block cuts its texts into passages of about 450 bytes, at
   anchors, and lists a 128-bit hash of each. A passage that a smaller document has, too, is repeated from end to end and
   takes no further part: that document has all its strings.
2. Of the rest a block lists the anchors once each, five bytes for each, dealt out to buckets of anchors, and gets back
   a bit for each: whether several documents have it.
3. For those a block cuts out the stretch of text around each occurrence that holds the strings under the anchor,
   about 65 bytes, and lists equal stretches once. Stretches are dealt out by anchor to shards, compressed.
4. A stretch that a smaller document has, too, is repeated from end to end. What remains, the first holder of each
   distinct stretch, may share strings with other stretches of the anchor: a shard takes the parts whose strings are
   in several of them, builds run-length indexes over the distinct parts and streams them through these. Matching
   statistics of ``length`` or more tell the smallest document that holds the string.
5. Marked stretches go back to the blocks, which merge and cut them.

Nothing is compared with everything: the text around repeated anchors is all that a shard sees. Blocks grow with the
square root of the input, since each writes to each bucket and shard (or are one long document), and an anchor's rows
in its shard are at most one for each block and distinct stretch.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import order_id
from stratalake.llm.run_length_index import RunLengthIndex
from stratalake.llm.words import mix

ANCHOR = 24
#: Runs of strings with one anchor in a passage, on average.
PASSAGE = 32
#: Anchors that a bucket looks at together, while there are no more buckets than blocks.
BUCKET = 1 << 18
#: A run of strings with the same anchor is cut into parts of so many strings.
LONGEST_RUN = 64
#: Blocks of the least size; more input makes blocks larger, too.
BLOCKS = 256
#: Bytes of an index, or of one anchor if that has more.
INDEXED = 1 << 18
#: What stretches of an anchor share is indexed string by string beyond so many bytes.
MOST = 1 << 20
_CHUNK = 1 << 16
_FACTORS = np.random.default_rng(13).integers(1, 2**63, 3, dtype=np.int64).astype(np.uint64) | np.uint64(1)


def _rows(frame: pa.Table) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """Ids and texts of a block in an order that does not depend on how the rows arrived, and where each text ends
    when they stand one after another."""
    ids, texts = frame.column("id").to_pylist(), [t or b"" for t in frame.column("text").to_pylist()]
    order = sorted(range(len(ids)), key=lambda i: (ids[i], texts[i]))
    ends = np.cumsum(np.array([len(texts[i]) for i in order], np.int64))
    return np.array([ids[i] for i in order], np.int64), [texts[i] for i in order], ends


def _counted(counts: np.ndarray) -> np.ndarray:
    """0, 1, 2, ... for each count."""
    return np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)


def _runs(buffer: bytes, ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of consecutive ``length``-byte strings of a text under one anchor: first start, number, anchor.
    ``buffer`` holds the texts one after another, and ANCHOR bytes more."""
    total, reach = len(buffer) - ANCHOR, length - ANCHOR + 1
    # where a text begins, and where the strings that start in it go beyond its end
    edges = np.sort(np.concatenate((ends, np.maximum(ends - length + 1, np.append(0, ends[:-1])[: len(ends)]))))
    starts, counts, anchors = [], [], []
    for begin in range(0, total, _CHUNK):
        n = min(total, begin + _CHUNK + reach - 1) - begin  # hashes needed for the strings that start in this chunk
        eight = np.ndarray((n + 16,), "<u8", buffer, begin, (1,))
        least = eight[:n] * _FACTORS[0] + eight[8 : n + 8] * _FACTORS[1] + eight[16:] * _FACTORS[2]
        least = mix(least ^ least >> np.uint64(32))
        done = 1
        while done < reach:
            by = min(done, reach - done)
            least = np.minimum(least[:-by], least[by:])
            done += by
        new = np.ones(len(least), bool)
        new[1:] = least[1:] != least[:-1]
        new[edges[np.searchsorted(edges, begin) : np.searchsorted(edges, begin + len(least))] - begin] = True
        first = np.flatnonzero(new)
        number = np.diff(np.append(first, len(least)))
        whole = first + begin + length <= ends[np.searchsorted(ends, first + begin, side="right")]
        first, number = first[whole], number[whole]
        parts = (number + LONGEST_RUN - 1) // LONGEST_RUN
        part = _counted(parts)
        starts.append(np.repeat(first, parts) + part * LONGEST_RUN + begin)
        counts.append(np.minimum(np.repeat(number, parts) - part * LONGEST_RUN, LONGEST_RUN))
        anchors.append(np.repeat(least[first], parts))
    if not starts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(starts), np.concatenate(counts), np.concatenate(anchors)


def _keys(anchor: np.ndarray, buckets: int) -> np.ndarray:
    """(bucket, low 40 bits) of an anchor as one sortable value; what two anchors share by chance is told apart later."""
    a = mix(anchor)  # anchors are smallest hashes, so by themselves they crowd near 0
    return (((a >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)) << np.uint64(40) | a & np.uint64((1 << 40) - 1)


def _passages(buffer: bytes, runs: tuple[np.ndarray, ...], length: int) -> tuple[np.ndarray, np.ndarray]:
    """First run of each passage, and its 128-bit hash as two numbers. Passages are runs that follow one another up to
    an anchor that the hash tells, so texts that share more than a few passages have the same ones."""
    start, count, anchor = runs
    new = np.ones(len(start), bool)
    new[1:] = start[1:] != start[:-1] + count[:-1]
    new[1:] |= (mix(anchor[1:]) % np.uint64(PASSAGE) == 0) & (anchor[1:] != anchor[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start))[: len(first)] - 1
    spans = zip(start[first].tolist(), (start[last] + count[last] + length - 1).tolist(), strict=True)
    digests = b"".join([hashlib.blake2b(buffer[b:e], digest_size=16).digest() for b, e in spans])
    return first, np.frombuffer(digests, "<u8").reshape(-1, 2)


def _distinct_passages(digests: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Passages in order of their hash, where the distinct ones begin in that order, and the bucket of these."""
    order = np.lexsort((digests[:, 1], digests[:, 0]))
    high, low = digests[order].T
    first = _heads(high)
    if len(first):
        first = np.flatnonzero(np.append(True, (high[1:] != high[:-1]) | (low[1:] != low[:-1])))
    return order, first, ((high[first] >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _passages_of(length: int, buckets: int):
    def run(frame: pa.Table) -> pa.Table:
        """(bucket, block, digests, docs): the block's passages, each once, and the smallest document of each."""
        ids, texts, ends = _rows(frame)
        buffer = b"".join([*texts, bytes(ANCHOR)])
        runs = _runs(buffer, ends, length)
        run_of, digests = _passages(buffer, runs, length)
        order, first, bucket = _distinct_passages(digests, buckets)
        doc = ids[np.searchsorted(ends, runs[0][run_of], side="right")][order]
        doc = np.minimum.reduceat(doc, first) if len(first) else doc
        digests = digests[order][first]
        cut = np.append(_heads(bucket), len(bucket))
        pairs = list(zip(cut.tolist(), cut[1:].tolist(), strict=False))
        block = frame.column("block")[0].as_py()
        return pa.table(
            {"bucket": pa.array(bucket[cut[:-1]]), "block": pa.array(np.full(len(pairs), block)),
             "digests": pa.array([digests[s:e].tobytes() for s, e in pairs], pa.binary()),
             "docs": pa.array([_packed_numbers(doc[s:e]) for s, e in pairs], pa.binary())}
        )

    return run


def _known_passages(frame: pa.Table) -> pa.Table:
    """(block, bucket, bits): which of the block's passages in the bucket a smaller document of another block has."""
    digests = [np.frombuffer(d, "<u8").reshape(-1, 2) for d in frame.column("digests").to_pylist()]
    cut = np.concatenate(([0], np.cumsum([len(d) for d in digests]))).tolist()
    doc = np.concatenate([_unpacked_numbers(d, 1)[0] for d in frame.column("docs").to_pylist()])
    order, first, _ = _distinct_passages(np.concatenate(digests), 1)
    number = np.diff(np.append(first, len(doc)))
    known = np.zeros(len(doc), bool)
    known[order] = doc[order] > np.repeat(np.minimum.reduceat(doc[order], first), number)
    bits = [np.packbits(known[s:e]).tobytes() for s, e in zip(cut, cut[1:], strict=False)]
    return pa.table(
        {"block": frame.column("block"), "bucket": frame.column("bucket"), "bits": pa.array(bits, pa.binary())}
    )


def _repeats(
    buffer: bytes, ids: np.ndarray, ends: np.ndarray, runs: tuple[np.ndarray, ...], known: pa.Table, length: int,
    buckets: int,
) -> np.ndarray:
    """Which runs stand in a passage that a smaller document has, too."""
    run_of, digests = _passages(buffer, runs, length)
    order, first, bucket = _distinct_passages(digests, buckets)
    number = np.diff(np.append(first, len(order)))
    elsewhere = np.zeros(len(first), bool)
    begin, stop = (np.searchsorted(bucket, known.column("bucket").to_numpy(), side=side) for side in ("left", "right"))
    for b, e, bits in zip(begin.tolist(), stop.tolist(), known.column("bits").to_pylist(), strict=True):
        elsewhere[b:e] = np.unpackbits(np.frombuffer(bits, np.uint8), count=e - b)
    doc = ids[np.searchsorted(ends, runs[0][run_of], side="right")][order]
    later = np.repeat(elsewhere, number)
    if len(first):
        later |= doc > np.repeat(np.minimum.reduceat(doc, first), number)
    out = np.zeros(len(order), bool)
    out[order] = later
    return np.repeat(out, np.diff(np.append(run_of, len(runs[0]))))


def _anchors_of(length: int, buckets: int, passage_buckets: int):
    def run(frame: pa.Table, known: pa.Table) -> pa.Table:
        """(bucket, block, keys): the block's anchors, each once, five bytes each, and a bit for each that tells
        whether several documents of the block have it. Runs in passages that a smaller document has are left out; which
        these are is a row of its own, with a bucket below 0."""
        if not frame.num_rows:
            return pa.table([[]] * 4, pa.schema([(n, pa.int64()) for n in ("bucket", "block", "size")] + [("keys", pa.binary())]))
        ids, texts, ends = _rows(frame)
        buffer = b"".join([*texts, bytes(ANCHOR)])
        runs = _runs(buffer, ends, length)
        repeats = _repeats(buffer, ids, ends, runs, known, length, passage_buckets)
        start, _, anchor = (c[~repeats] for c in runs)
        key, doc = _keys(anchor, buckets), ids[np.searchsorted(ends, start, side="right")]
        order = np.argsort(key)
        key, doc = key[order], doc[order]
        first = _heads(key)
        several = np.maximum.reduceat(doc, first) > np.minimum.reduceat(doc, first) if len(first) else np.zeros(0, bool)
        key = key[first]
        bucket = (key >> np.uint64(40)).astype(np.int64)
        cut = np.append(_heads(bucket), len(bucket))
        block = frame.column("block")[0].as_py()
        five = np.ascontiguousarray(key).view(np.uint8).reshape(-1, 8)[:, :5]
        parts = [five[s:e].tobytes() + np.packbits(several[s:e]).tobytes() for s, e in zip(cut, cut[1:], strict=False)]
        parts.append(_packed(np.packbits(repeats).tobytes()))
        return pa.table(
            {"bucket": pa.array(np.append(bucket[cut[:-1]], -1 - block)), "block": pa.array(np.full(len(parts), block)),
             "size": pa.array(np.append(np.diff(cut), 0)), "keys": pa.array(parts, pa.binary())}
        )

    return run


def _repeated(frame: pa.Table) -> pa.Table:
    """(block, bucket, bits): which of the block's anchors in the bucket several documents have, here or elsewhere.
    What a block says of its passages goes back to it."""
    if frame.column("bucket")[0].as_py() < 0:
        return frame.select(["block", "bucket", "keys"]).rename_columns(["block", "bucket", "bits"])
    sizes = frame.column("size").to_numpy()
    keys, several = [], []
    for n, raw in zip(sizes.tolist(), frame.column("keys").to_pylist(), strict=True):
        wide = np.zeros((n, 8), np.uint8)
        wide[:, :5] = np.frombuffer(raw, np.uint8, 5 * n).reshape(n, 5)
        keys.append(wide.view(np.uint64).ravel())
        several.append(np.unpackbits(np.frombuffer(raw, np.uint8, offset=5 * n), count=n).astype(bool))
    key, again = np.concatenate(keys), np.concatenate(several)
    order = np.argsort(key)
    first = _heads(key[order])
    number = np.diff(np.append(first, len(key)))
    again[order] = np.repeat((number > 1) | np.logical_or.reduceat(again[order], first), number)
    cut = np.concatenate(([0], np.cumsum(sizes)))
    bits = [np.packbits(again[s:e]).tobytes() for s, e in zip(cut, cut[1:], strict=False)]
    return pa.table(
        {"block": frame.column("block"), "bucket": frame.column("bucket"), "bits": pa.array(bits, pa.binary())}
    )


def _heads(sorted_values: np.ndarray) -> np.ndarray:
    """Position of the first of each group of equal values."""
    if not len(sorted_values):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.append(True, sorted_values[1:] != sorted_values[:-1]))


def _packed(raw: bytes) -> bytes:
    return len(raw).to_bytes(8, "little") + (pa.compress(raw, "zstd", asbytes=True) if raw else b"")


def _unpacked(packed: bytes) -> bytes:
    size = int.from_bytes(packed[:8], "little")
    return pa.decompress(packed[8:], size, "zstd", asbytes=True) if size else b""


def _packed_numbers(*columns: np.ndarray) -> bytes:
    """Columns of whole numbers: all first bytes, then all second bytes and so on, compressed."""
    values = np.concatenate([np.array([len(c) for c in columns], np.int64), *columns]).astype(np.int64, copy=False)
    return _packed(values.view(np.uint8).reshape(-1, 8).T.tobytes())


def _unpacked_numbers(packed: bytes, columns: int) -> list[np.ndarray]:
    planes = np.frombuffer(_unpacked(packed), np.uint8).reshape(8, -1)
    values = np.ascontiguousarray(planes.T).view(np.int64).ravel()
    return np.split(values[columns:], np.cumsum(values[: columns - 1]))


def _steps(values: np.ndarray) -> np.ndarray:
    """Differences, which are small where values grow slowly; their running sums are the values."""
    return np.diff(values, prepend=0)


def _stretches_of(length: int, buckets: int, shards: int):
    def run(texts: pa.Table, repeated: pa.Table) -> pa.Table:
        """(shard, block, numbers, stretches): the distinct stretches of a block under repeated anchors, packed.
        numbers are which stretch, place and document of each occurrence, and anchor and size of each stretch.
        Marks of the passages that a smaller document has are a row of their own, with a shard below 0."""
        names, shard_list, numbers, joined = ("shard", "block", "numbers", "stretches"), [], [], []
        if texts.num_rows and repeated.num_rows:
            ids, held, ends = _rows(texts)
            buffer = b"".join([*held, bytes(ANCHOR)])
            runs = _runs(buffer, ends, length)
            number = texts.column("block")[0].as_py()
            own = repeated.filter(pc.less(repeated.column("bucket"), 0)).column("bits")[0].as_py()
            repeated = repeated.filter(pc.greater_equal(repeated.column("bucket"), 0))
            repeats = np.unpackbits(np.frombuffer(_unpacked(own), np.uint8), count=len(runs[0])).astype(bool)
            if repeats.any():
                begin, stop = runs[0][repeats], (runs[0] + runs[1])[repeats]
                new = np.append(True, begin[1:] != stop[:-1])
                last = np.append(np.flatnonzero(new)[1:], len(stop)) - 1
                numbers.append(_packed_numbers(_steps(begin[new]), stop[last] - begin[new] + length - 1))
                joined.append(b"")
                shard_list.append(-1 - number)
            start, count, anchor = (c[~repeats] for c in runs)
            key = _keys(anchor, buckets)
            order = np.argsort(key)
            key = key[order]
            first = _heads(key)
            listed = key[first]
            again = np.zeros(len(listed), bool)
            bucket = repeated.column("bucket").to_numpy().astype(np.uint64)
            begin = np.searchsorted(listed, bucket << np.uint64(40))
            stop = np.searchsorted(listed, (bucket + np.uint64(1)) << np.uint64(40))
            for b, e, bits in zip(begin.tolist(), stop.tolist(), repeated.column("bits").to_pylist(), strict=True):
                again[b:e] = np.unpackbits(np.frombuffer(bits, np.uint8), count=e - b)
            hit = np.sort(order[np.repeat(again, np.diff(np.append(first, len(key))))])
            mixed = mix(anchor[hit])
            shard = (mixed % np.uint64(shards)).astype(np.int64)
            order = np.argsort(shard, kind="stable")
            hit, shard, head = hit[order], shard[order], (mixed[order] >> np.uint64(32)).astype(np.int64)
            start = start[hit]
            stop, doc = start + count[hit] + length - 1, ids[np.searchsorted(ends, start, side="right")]
            cut = np.append(_heads(shard), len(shard))
            for s, e in zip(cut.tolist(), cut[1:].tolist(), strict=False):
                found: dict[bytes, int] = {}
                spans = zip(start[s:e].tolist(), stop[s:e].tolist(), strict=True)
                which = np.array([found.setdefault(buffer[b:t], len(found)) for b, t in spans], np.int64)
                new = s + np.flatnonzero(np.diff(np.maximum.accumulate(which), prepend=-1))
                numbers.append(
                    _packed_numbers(
                        _steps(which), _steps(start[s:e]), _steps(doc[s:e]), head[new], stop[new] - start[new]
                    )
                )
                joined.append(_packed(b"".join(found)))
            shard_list += shard[cut[:-1]].tolist()
        block = np.full(len(numbers), texts.column("block")[0].as_py() if texts.num_rows else 0)
        kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
        columns = (shard_list, block, numbers, joined)
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], list(names))

    return run


def _shared_parts(texts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """The longest parts of each text of which every ``length``-byte string is in another text, too, or again in this
    one: number of the text, place in it, and the part. A few strings more may pass, none less."""
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    flat = b"".join([*texts, bytes(8)])
    windows = size - length + 1
    text = np.repeat(np.arange(len(texts)), windows)
    place = _counted(windows)
    at = np.repeat(np.cumsum(size) - size, windows) + place
    eight = np.ndarray((len(flat) - 7,), "<u8", flat, 0, (1,))
    value = np.zeros(len(at), np.uint64)
    for k, offset in enumerate([*range(0, length - 8, 8), length - 8]):
        value = (value ^ value >> np.uint64(29)) * _FACTORS[k % 3] + eight[at + offset]
    value = mix(value)
    order = np.argsort(value)
    same = np.flatnonzero(value[order[1:]] == value[order[:-1]])
    again = np.zeros(len(at) + 1, bool)
    again[order[same]] = again[order[same + 1]] = True
    edge = np.append(True, text[1:] != text[:-1]) if len(text) else np.zeros(0, bool)
    first = np.flatnonzero(again[:-1] & (edge | ~np.append(False, again[:-2])[: len(edge)]))
    last = np.flatnonzero(again[:-1] & (np.append(edge[1:], True)[: len(edge)] | ~again[1:]))
    spans = zip(at[first].tolist(), (at[last] + length).tolist(), strict=True)
    return text[first], place[first], [flat[b:e] for b, e in spans]


def _numbered(parts: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
    """Number of each part, equal ones alike, and the distinct parts."""
    numbers: dict[bytes, int] = {}
    return np.array([numbers.setdefault(p, len(numbers)) for p in parts], np.int64), list(numbers)


def _earlier(texts: list[bytes], anchor: np.ndarray, holder: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Stretches whose strings a smaller document has in another of the texts: text, begin, end.

    Only what stretches of an anchor share is indexed, equal parts once: what stands around a passage in many documents
    counts as far as it is the same in some of them. Indexes are of as many anchors as fill INDEXED. Where parts of one
    anchor are more than MOST, their strings are parts of their own, so that they can be dealt out, too.
    """
    order = np.argsort(anchor, kind="stable")
    text, place, found = _shared_parts([texts[i] for i in order.tolist()], length)
    text = order[text]
    part, parts = _numbered(found)
    if not parts:
        return (np.zeros(0, np.int64),) * 3
    size = np.fromiter(map(len, parts), np.int64, len(parts))
    of = np.zeros(len(parts), anchor.dtype)
    of[part] = anchor[text]
    border = _heads(of)  # parts come by anchor
    many = np.repeat(np.add.reduceat(size, border) > MOST, np.diff(np.append(border, len(parts))))
    if many.any():
        split = many[part]
        number = (size[part] - length + 1)[split]
        at = _counted(number)
        strings = zip(np.repeat(part[split], number).tolist(), at.tolist(), strict=True)
        strings = [parts[k][a : a + length] for k, a in strings]
        text = np.concatenate((text[~split], np.repeat(text[split], number)))
        place = np.concatenate((place[~split], np.repeat(place[split], number) + at))
        part, parts = _numbered([parts[k] for k in part[~split].tolist()] + strings)
        size = np.fromiter(map(len, parts), np.int64, len(parts))
        border = np.concatenate((_heads(of[~many]), np.arange(np.count_nonzero(~many), len(parts))))
    owner = np.full(len(parts), np.iinfo(np.int64).max)
    np.minimum.at(owner, part, holder[text])
    windows = size - length + 1
    full = (np.cumsum(size) - size) // INDEXED
    border = border[np.append(True, full[border[1:]] != full[border[:-1]])]
    least = []
    for b, e in zip(border.tolist(), [*border[1:].tolist(), len(parts)], strict=True):
        index = RunLengthIndex(parts[b:e], owner[b:e], length)
        least += [smallest[: len(smallest) - length + 1] for _, _, smallest in index.stream(parts[b:e])]
    least = np.concatenate(least)
    number = windows[part]
    at = _counted(number)
    early = least[np.repeat((np.cumsum(windows) - windows)[part], number) + at] < np.repeat(holder[text], number)
    run, at = np.repeat(np.arange(len(part)), number)[early], at[early]
    new = np.ones(len(at), bool)
    new[1:] = (run[1:] != run[:-1]) | (at[1:] != at[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at))[: len(first)] - 1
    return text[run[first]], place[run[first]] + at[first], place[run[first]] + at[last] + length


def _marks_of(length: int):
    def run(frame: pa.Table) -> pa.Table:
        """(block, marks): the marked stretches of each block that has any, begin and size."""
        if frame.column("shard")[0].as_py() < 0:
            return frame.select(["block", "numbers"]).rename_columns(["block", "marks"])
        texts: dict[bytes, int] = {}
        which, anchors, occurs, docs, starts, blocks = ([] for _ in range(6))
        columns = (frame.column(c).to_pylist() for c in ("block", "numbers", "stretches"))
        for block, numbers, joined in zip(*columns, strict=True):
            local, start, doc, head, size = _unpacked_numbers(numbers, 5)
            joined, end = _unpacked(joined), np.cumsum(size).tolist()
            names = [texts.setdefault(joined[s:e], len(texts)) for s, e in zip([0, *end], end, strict=False)]
            which.append(np.array(names, np.int64))
            anchors.append(head)
            occurs.append(which[-1][np.cumsum(local)])
            docs.append(np.cumsum(doc))
            starts.append(np.cumsum(start))
            blocks.append(np.full(len(local), block))
        distinct = list(texts)
        size = np.fromiter(map(len, distinct), np.int64, len(distinct))
        of, doc, start, block = (np.concatenate(c) for c in (occurs, docs, starts, blocks))
        holder = np.full(len(distinct), np.iinfo(np.int64).max)
        np.minimum.at(holder, of, doc)
        later = doc > holder[of]
        whole = np.flatnonzero(later)
        marks = [(whole, np.zeros(len(whole), np.int64), size[of[whole]])]
        # first holders of a stretch whose anchor has other stretches, too
        anchor_of = np.zeros(len(distinct), np.int64)
        anchor_of[np.concatenate(which)] = np.concatenate(anchors)
        _, inverse, counts = np.unique(anchor_of, return_inverse=True, return_counts=True)
        shared = np.flatnonzero(counts[inverse] > 1)
        if len(shared):
            owner, begin, end = _earlier([distinct[i] for i in shared.tolist()], anchor_of[shared], holder[shared], length)
            owner = shared[owner]
            first = np.flatnonzero(~later)
            first = first[np.argsort(of[first], kind="stable")]
            low, high = np.searchsorted(of[first], owner), np.searchsorted(of[first], owner, side="right")
            take = np.repeat(np.arange(len(owner)), high - low)
            spot = first[np.repeat(low - (np.cumsum(high - low) - (high - low)), high - low) + np.arange(len(take))]
            marks.append((spot, begin[take], end[take]))
        spot, begin, end = (np.concatenate([m[k] for m in marks]) for k in range(3))
        begin, size = begin + start[spot], end - begin
        order = np.lexsort((begin, block[spot]))
        block, begin, size = block[spot][order], begin[order], size[order]
        cut = np.append(_heads(block), len(block))
        parts = [_packed_numbers(_steps(begin[s:e]), size[s:e]) for s, e in zip(cut, cut[1:], strict=False)]
        return pa.table({"block": pa.array(block[cut[:-1]]), "marks": pa.array(parts, pa.binary())})

    return run


def _cut(texts: pa.Table, marked: pa.Table) -> pa.Table:
    """(id, n_bytes, spans, kept): each text of a block without its marked bytes."""
    spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    ids, held, ends = _rows(texts) if texts.num_rows else (np.zeros(0, np.int64), [], np.zeros(0, np.int64))
    parts = [_unpacked_numbers(m, 2) for m in marked.column("marks").to_pylist()]
    begin = np.concatenate([np.zeros(0, np.int64), *[np.cumsum(p[0]) for p in parts]])
    stop = begin + np.concatenate([np.zeros(0, np.int64), *[p[1] for p in parts]])
    by = np.argsort(begin)
    begin, stop = begin[by], stop[by]
    # marks that overlap or touch are one span, within a text
    row = np.searchsorted(ends, begin, side="right")
    done = np.maximum.accumulate(stop)
    new = np.ones(len(begin), bool)
    new[1:] = (begin[1:] > done[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    row = row[first]
    base = (ends - np.fromiter(map(len, held), np.int64, len(held)))[row]
    start = (begin[first] - base).tolist()
    end = (done[np.append(first[1:], len(begin))[: len(first)] - 1] - base).tolist()
    cuts = np.searchsorted(row, np.arange(len(held) + 1)).tolist()
    spans, kept = [], []
    for text, s, e in zip(held, cuts, cuts[1:], strict=False):
        left = [text[a:b] for a, b in zip([0, *end[s:e]], [*start[s:e], len(text)], strict=True)]
        kept.append(b"".join(left))
        spans.append([{"start": a, "end": b} for a, b in zip(start[s:e], end[s:e], strict=True)])
    return pa.table(
        {
            "id": pa.array(ids),
            "n_bytes": pa.array([len(t) for t in held], pa.int64()),
            "spans": pa.array(spans, spans_type),
            "kept": pa.array(kept, pa.binary()),
        }
    )


def _blocks(total: int, block_bytes: int) -> int:
    """Number of blocks: of ``block_bytes`` each up to BLOCKS of them, then larger ones, with the square root of the
    total. Every block writes to every bucket and shard, so pieces grow in number as the input, not as its square."""
    least = max(1, math.ceil(total / block_bytes))
    return min(least, math.ceil(math.sqrt(BLOCKS * least)))


def remove_repeats(docs: DataFrame, length: int = 50, block_bytes: int = 2 << 20) -> DataFrame:
    """(doc_id, n_bytes, spans, kept) of every row of ``docs`` (doc_id, text, any other columns).

    spans are the maximal runs of bytes covered by a ``length``-byte string that also starts in a document with a
    smaller doc_id; kept are the other bytes. Texts are UTF-8 bytes, whole; a null one is empty. A null doc_id is
    larger than any other, and rows with the same doc_id (null, too) never mark each other.
    """
    if length < ANCHOR:
        raise ValueError(f"length is {ANCHOR} at least")
    narrow = docs.select(order_id().alias("id"), F.col("text").cast("binary").alias("text"))
    total = narrow.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = _blocks(total, block_bytes)
    dealt = narrow.select(F.pmod(F.xxhash64("id", F.lit(23)), F.lit(blocks)).alias("block"), "id", "text")
    by_block = dealt.groupBy("block")
    buckets = min(blocks, max(1, math.ceil(total / 14 / BUCKET)))  # about one anchor in 14 bytes
    groups = math.ceil(blocks / 16)  # a passage is about 450 bytes and needs about 20
    passages = by_block.applyInArrow(
        _passages_of(length, groups), "bucket bigint, block bigint, digests binary, docs binary"
    )
    known = passages.groupBy("bucket").applyInArrow(_known_passages, "block bigint, bucket bigint, bits binary")
    anchors = by_block.cogroup(known.groupBy("block")).applyInArrow(
        _anchors_of(length, buckets, groups), "bucket bigint, block bigint, size bigint, keys binary"
    )
    repeated = anchors.groupBy("bucket").applyInArrow(_repeated, "block bigint, bucket bigint, bits binary")
    stretches = by_block.cogroup(repeated.groupBy("block")).applyInArrow(
        _stretches_of(length, buckets, blocks), "shard bigint, block bigint, numbers binary, stretches binary"
    )
    marks = stretches.groupBy("shard").applyInArrow(_marks_of(length), "block bigint, marks binary")
    cut = by_block.cogroup(marks.groupBy("block")).applyInArrow(
        _cut, "id bigint, n_bytes bigint, spans array<struct<start:bigint,end:bigint>>, kept binary"
    )
    return cut.select(F.when(F.col("id") != 2**63 - 1, F.col("id")).alias("doc_id"), "n_bytes", "spans", "kept")
