"""URL filter by a Bloom filter cascade.

A cascade is a row of small Bloom filters. The first holds the listed keys; the second holds the
keys of the *universe* that the first wrongly lets through; the third the listed keys that the second
wrongly lets through, and so on until nobody is wrong. The universe is every key any url of the corpus
can be asked for, so the answer is exact for each of them, and a url is judged by testing bits of
constants: no join and no shuffle.

The constants are bounded by the rules, not by the corpus: the first filter has about
``1.44 * log2(universe / listed)`` bits a listed key, each later one about 1.44 bits for each of its keys,
of which there are at most about as many as listed keys. ``max_bits`` is checked while building.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import ascii_lower, written

Rule = tuple[str, str]  # (host/path, verdict)


@dataclass(frozen=True)
class Level:
    """One Bloom filter: ``words`` are 64-bit pieces of ``bits`` bits, ``hashes`` tests a key."""

    seed: int
    bits: int
    hashes: int
    words: tuple[int, ...]

    def has(self, key: Column) -> Column:
        words = F.array(*[F.lit(w).cast("bigint") for w in self.words])

        def hit(place: Column) -> Column:
            word = F.get(words, F.shiftright(place, 6).cast("int"))
            return F.getbit(word, (place % 64).cast("int")) == 1

        return F.forall(places(key, self.seed, self.bits, self.hashes), hit)


def places(key: Column, seed: int, bits: int, hashes: int) -> Column:
    """Bit positions of a key: double hashing of one 64-bit hash."""
    whole = F.xxhash64(F.lit(seed), key)
    low, step = whole.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(whole, 32)
    return F.array(*[(low + step * i) % bits for i in range(1, hashes + 1)])


def level_of(keys: DataFrame, seed: int, count: int, rate: float, max_bits: int) -> Level:
    """Bloom filter of the ``count`` values in column ``key``, built by a bitwise aggregation."""
    hashes = max(1, round(-math.log2(rate)))
    bits = max(64, 64 * math.ceil(count * hashes / math.log(2) / 64))
    if bits > max_bits:
        raise ValueError(f"the rules need a filter of {bits} bits; max_bits is {max_bits}")
    place = keys.select(F.explode(places(F.col("key"), seed, bits, hashes)).alias("place"))
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("place") % 64).cast("int"))
    packed = place.groupBy(F.shiftright("place", 6).cast("int").alias("at")).agg(F.bit_or(one).alias("word"))
    words = [0] * (bits // 64)  # at most max_bits / 64 rows come back
    for row in packed.collect():
        words[row["at"]] = row["word"]
    return Level(seed, bits, hashes, tuple(words))


@dataclass(frozen=True)
class Cascade:
    levels: tuple[Level, ...]

    def has(self, key: Column) -> Column:
        """Exact membership for every key of the universe the cascade was built over."""
        found = F.lit(len(self.levels) % 2 == 1)
        for i, level in reversed(list(enumerate(self.levels))):
            found = F.when(level.has(key), found).otherwise(F.lit(i % 2 == 1))
        return found


def build(listed: DataFrame, universe: DataFrame, max_bits: int = 1 << 22, seed: int = 0) -> Cascade:
    """Cascade for the distinct non-null ``listed`` keys over all keys of ``universe`` (columns ``key``).

    ``universe`` may hold repeats and need not hold the listed keys. No listed key: nothing is listed.
    """
    inside = listed.where("key is not null").distinct()
    count = inside.count()
    if not count:
        return Cascade(())
    total = universe.agg(F.approx_count_distinct("key")).first()[0]
    levels: list[Level] = []
    encoded, rate = inside, min(0.5, count / max(total, 1))
    others: DataFrame | None = None
    while count:
        level = level_of(encoded, seed + len(levels), count, rate, max_bits)
        levels.append(level)
        if len(levels) > 64:
            raise RuntimeError("the cascade does not end; repeat with another seed")
        if others is None:  # all keys of the corpus are asked once
            wrong = universe.where(level.has(F.col("key"))).distinct().join(inside, "key", "left_anti")
        else:
            wrong = others.where(level.has(F.col("key")))
        wrong = written(wrong, "cascade")
        others, encoded, count, rate = encoded, wrong, wrong.count(), 0.5
    return Cascade(tuple(levels))


def split_url(url: Column) -> tuple[Column, Column]:
    """Host, A-Z lower-cased, and path; both empty for a null url or one without ``://``."""
    start = F.instr(url, "://")
    rest = F.when(start > 0, F.substr(url, start + 3)).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^[^?#]*", 0)
    return ascii_lower(host), path


def candidates(host: Column, path: Column, rules: list[Rule]) -> Column:
    """Keys a url can be listed under: its host's suffixes with its path's prefixes, for the label counts
    and path lengths that occur among the rules only, so their number does not depend on the url."""
    shapes = sorted({(r.partition("/")[0].count(".") + 1, len(r) - r.index("/")) for r, _ in rules})
    labels = F.split(host, r"\.")

    def key(count: int, length: int) -> Column:
        suffix = F.array_join(F.slice(labels, F.greatest(F.size(labels) - count, F.lit(0)) + 1, count), ".")
        return F.when(
            (F.size(labels) >= count) & (F.length(path) >= length), F.concat(suffix, F.substring(path, 1, length))
        )

    return F.filter(F.array(*[key(*s) for s in shapes]), lambda k: k.isNotNull())


def judge(urls: DataFrame, rules: list[Rule], default: str = "allow", url: str = "url") -> DataFrame:
    """Add host, path, rule and verdict to every row of ``urls``.

    A rule ``host/path`` fits its host and all subdomains where the url's path starts with the rule's;
    the longest fitting rule wins, and among equally long ones the greater text. The rules of each verdict
    make one cascade. Without a rule the verdict is ``default``: what is not listed is not blocked. A null
    or broken url has an empty host and path and so fits no rule. Columns of ``urls`` named like the four
    are replaced. Rules need a ``/`` and may not be listed twice.
    """
    if any("/" not in r for r, _ in rules) or len({r for r, _ in rules}) != len(rules):
        raise ValueError("every rule needs a / and may be listed once")
    spark = urls.sparkSession
    host, path = split_url(F.col(url))
    parted = urls.withColumns({"host": host, "path": path})
    if not rules:
        return parted.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    keys = candidates(F.col("host"), F.col("path"), rules)
    universe = parted.select(F.explode(keys).alias("key"))
    kinds = sorted({v for _, v in rules})
    lists = {k: spark.createDataFrame([(r,) for r, v in rules if v == k], "key string") for k in kinds}
    cascades = {k: build(lists[k], universe, seed=1000 * i) for i, k in enumerate(kinds)}

    def listed(key: Column) -> Column:
        kind = reduce(lambda other, k: F.when(cascades[k].has(key), F.lit(k)).otherwise(other), kinds, F.lit(None))
        return F.struct(F.length(key).alias("length"), key.alias("key"), kind.cast("string").alias("kind"))

    best = F.array_max(F.filter(F.transform(keys, listed), lambda x: x["kind"].isNotNull()))
    return (
        parted.withColumn("__best", best)
        .withColumns({"rule": F.col("__best.key"), "verdict": F.coalesce("__best.kind", F.lit(default))})
        .drop("__best")
    )
