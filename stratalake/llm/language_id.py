"""Language identification by Bayesian evidence fusion.

Four kinds of evidence are multiplied for each language: the likelihood of the text under byte trigram models
trained on labelled rows, the language that the markup declares, the suffix of an address, and a prior of the
host that is smoothed towards that of its site (the last two labels), and that towards the prior of all documents.
Everything but the trigram models comes from grouped aggregations over all rows; how often a declaration, a suffix or a host goes with a language is counted
with the language that the text alone suggests.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import pieces, written
from stratalake.llm.html_text import blocks
from stratalake.llm.url_filter import split_url

CELLS = 1 << 14
#: Texts of a label that are sampled however many labels there are.
LEAST_TEXTS = 100
#: Trigrams overlap, so that their likelihoods count for a third.
TEMPER = 1 / 3
_FOLD = np.array([b | 0x20 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)], np.uint32)


def trigrams(text: bytes) -> np.ndarray:
    """Hashed trigrams of the letters of a text; everything else is a blank, and blanks alone are no trigram."""
    letters = _FOLD[np.frombuffer(b" " + text + b" ", np.uint8)]
    whole = letters[:-2] << np.uint32(16) | letters[1:-1] << np.uint32(8) | letters[2:]
    whole = whole[(letters[1:-1] != 0x20)]
    return (whole * np.uint32(2654435761)) >> np.uint32(18)


@dataclass(frozen=True)
class Model:
    """Log probabilities of the trigram cells, one column a language."""

    languages: tuple[str, ...]
    logs: np.ndarray


def train(docs: DataFrame, label: str, sample_rows: int = 20_000, min_rows: int = 5) -> Model:
    """Trigram models of the labels that have ``min_rows`` rows at least, from about ``sample_rows`` distinct texts.

    Every label has an equal part of the sample, ``LEAST_TEXTS`` at least, or all of its texts if it has fewer. The texts are
    chosen by their hash, so the sample does not depend on the layout; only sums of trigram counts, at most
    ``CELLS`` a language, reach the driver.
    """
    labelled = docs.where(F.col(label).isNotNull() & F.col("text").isNotNull()).select(F.col(label).alias("label"), "text")
    hashed = labelled.groupBy("label", F.xxhash64("text", F.lit(3)).alias("hash")).count()
    sizes = hashed.groupBy("label").agg(F.sum("count").alias("rows"), F.count("*").alias("texts"))
    sizes = sizes.where(F.col("rows") >= min_rows).collect()
    if not sizes:
        return Model((), np.zeros((CELLS, 0), np.float32))
    each = max(LEAST_TEXTS, sample_rows // len(sizes))
    limits = [(F.lit(r["label"]), F.lit(int(min(1.0, each / r["texts"]) * (1 << 30)))) for r in sizes]
    limit = F.try_element_at(F.create_map(*[c for pair in limits for c in pair]), F.col("label"))
    chosen = labelled.where(F.pmod(F.xxhash64("text", F.lit(3)), F.lit(1 << 30)) < limit).distinct()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                sums[name] = sums.get(name, 0) + np.bincount(trigrams(text), minlength=CELLS)
        for name, sum_ in sums.items():
            cells = np.flatnonzero(sum_)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([name] * len(cells), pa.string()),
                    pa.array(cells.astype(np.int64)),
                    pa.array(sum_[cells].astype(np.int64)),
                ],
                names=["label", "cell", "n"],
            )

    narrow = chosen.select("label", F.col("text").cast("binary").alias("text"))
    sums = narrow.mapInArrow(count, "label string, cell bigint, n bigint").groupBy("label", "cell").agg(
        F.sum("n").alias("n")
    )
    names = tuple(sorted(r["label"] for r in sizes))
    tables = {n: np.zeros(CELLS) for n in names}
    for row in sums.collect():
        tables[row["label"]][row["cell"]] = row["n"]
    counts = np.array([tables[n] for n in names]) + 0.5
    return Model(names, np.log(counts / counts.sum(axis=1, keepdims=True)).T.astype(np.float32))


def text_scores(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with __scores, the tempered log likelihood of each language; null for a text without a letter."""
    place = docs.columns.index("text")
    logs = docs.sparkSession.sparkContext.broadcast(model.logs)  # CELLS x languages

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, place):
            scores = []
            for text in batch.column(place).cast(pa.large_binary()).to_pylist():
                cells = trigrams(text) if text else ()
                scores.append(
                    (np.bincount(cells, minlength=CELLS) @ logs.value * TEMPER).tolist() if len(cells) > 1000
                    else (logs.value[cells].sum(axis=0, dtype=np.float64) * TEMPER).tolist() if len(cells) else None
                )
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores, pa.list_(pa.float64()))], names=[*batch.schema.names, "__scores"]
            )

    return docs.mapInArrow(run, ", ".join(f"`{n}` {t}" for n, t in docs.dtypes) + ", __scores array<double>")


def _counts(rows: DataFrame, key: str, n: int) -> DataFrame:
    """(key, count of each language) for the keys that are not null."""
    each = [F.count_if(F.col("__top") == i).cast("double") for i in range(n)]
    return rows.where(f"{key} is not null and __top is not null").groupBy(key).agg(F.array(*each).alias("counts"))


def site_of(host: Column) -> Column:
    """Last two labels of a host that has two; null otherwise."""
    return F.nullif(F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1), F.lit(""))


def _whole(counts: Column) -> Column:
    return F.aggregate(counts, F.lit(0.0), lambda s, v: s + v)


def _smoothed(counts: Column, i: int, weight: float, prior: Column) -> Column:
    """Share of language i in ``counts`` (null: none) with ``weight`` documents of the prior added."""
    seen = F.coalesce(F.get(counts, F.lit(i)), F.lit(0.0))
    return (seen + weight * prior) / (F.coalesce(_whole(counts), F.lit(0.0)) + weight)


def _host_shares(rows: DataFrame, n: int, weight: float, base: list[float]) -> DataFrame:
    """(__host, share of each language), smoothed through the host's site."""
    sites = _counts(rows.withColumn("__site", site_of(F.col("__host"))), "__site", n)
    hosts = _counts(rows, "__host", n).withColumn("__site", site_of(F.col("__host")))
    joined = hosts.join(sites.withColumnRenamed("counts", "site_counts"), "__site", "left")
    shares = [
        _smoothed(F.col("counts"), i, weight, _smoothed(F.col("site_counts"), i, weight, F.lit(base[i]))) for i in range(n)
    ]
    return joined.select("__host", F.array(*shares).alias("shares"))


def identify(
    docs: DataFrame,
    model: Model,
    declared: Column,
    host: Column,
    suffix: Column,
    strength: float = 10.0,
    least: float = 0.6,
) -> DataFrame:
    """``docs`` (text and any other columns) with __language, __probability and __kept.

    ``declared``, ``host`` and ``suffix`` are string columns over ``docs``; a null one is no evidence. The prior
    of a host with n documents has the weight n against ``strength`` for that of its site, and likewise the site's
    against that of all documents. A document is
    rejected (__kept false) if no language reaches the probability ``least``, or if it has no letter; then its
    __language is the best one all the same, or null without a letter. Without any language in ``model`` nothing
    is rejected and both are null. Equal probabilities: the first language by name.
    """
    n = len(model.languages)
    names = {"__declared": F.lower(F.trim(declared)), "__host": F.lower(host), "__suffix": F.lower(suffix)}
    if not n:
        return docs.withColumns(
            {"__language": F.lit(None).cast("string"), "__probability": F.lit(None).cast("double"), "__kept": F.lit(True)}
        )
    scored = text_scores(docs.withColumns(names), model)
    top = F.array_position("__scores", F.array_max("__scores")) - 1
    rows = text_scores(docs.select(*[c.alias(k) for k, c in names.items()], "text"), model).select(*names, top.alias("__top"))
    rows = written(rows, "language-evidence")
    total = [v + 1.0 for v in rows.agg(*[F.count_if(F.col("__top") == i) for i in range(n)]).first()]
    base = [v / sum(total) for v in total]

    sums = [F.get("__scores", F.lit(i)) + F.lit(float(np.log(base[i]))) for i in range(n)]
    out = scored
    # P(evidence | language) is P(language | evidence) / P(language) up to a factor that all languages share
    tables = {"__host": _host_shares(rows, n, strength, base)}
    for key, weight in (("__declared", 1.0), ("__suffix", strength)):
        shares = [_smoothed(F.col("counts"), i, weight, F.lit(base[i])) for i in range(n)]
        tables[key] = _counts(rows, key, n).select(key, F.array(*shares).alias("shares"))
    for key, table in tables.items():
        logs = F.array(*[F.log(F.get("shares", F.lit(i))) - float(np.log(base[i])) for i in range(n)])
        out = out.join(written(table.select(key, logs.alias(f"{key}_log")), "language-shares"), key, "left")
        sums = [s + F.coalesce(F.get(f"{key}_log", F.lit(i)), F.lit(0.0)) for i, s in enumerate(sums)]
    out = out.withColumn("__sums", F.when(F.col("__scores").isNotNull(), F.array(*sums)))
    best = F.array_max("__sums")
    spread = reduce(Column.__add__, [F.exp(F.get("__sums", F.lit(i)) - best) for i in range(n)])
    language = F.get(F.array(*map(F.lit, model.languages)), (F.array_position("__sums", best) - 1).cast("int"))
    return out.withColumns({"__language": language, "__probability": 1 / spread}).select(
        *docs.columns, "__language", "__probability", (F.coalesce("__probability", F.lit(0.0)) >= least).alias("__kept")
    )


def identify_documents(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """``identify`` for ``documents``: lang is the declared language and the training label, source the host, and
    the suffix is the last label of the first address in the text. Without a ``model`` one is trained on ``docs``."""
    address = F.nullif(F.regexp_extract("text", r"://[^/?#:\s]*\.([A-Za-z]{2,24})(?![A-Za-z0-9.-])", 1), F.lit(""))
    return identify(docs, model or train(docs, "lang"), F.col("lang"), F.col("source"), address)


def shown_texts(pages: DataFrame) -> DataFrame:
    """``pages`` (html and any other columns) with text, all that a page shows, in place of html."""
    place = pages.columns.index("html")
    kept = [(n, t) for n, t in pages.dtypes if n != "html"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, place):
            texts = [
                " ".join(b.text for b in blocks(raw.decode("utf-8", "replace"))) if raw else None
                for raw in batch.column(place).cast(pa.large_binary()).to_pylist()
            ]
            columns = [batch.column(i) for i in range(batch.num_columns) if i != place]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], names=[*(n for n, _ in kept), "text"])

    return pages.mapInArrow(run, ", ".join(f"`{n}` {t}" for n, t in kept) + ", text string")


def identify_pages(pages: DataFrame, model: Model) -> DataFrame:
    """(page_id, declared, __language, __probability, __kept) of every row of ``pages`` (page_id, url, html).

    The declared language is the main part of the html element's lang, the text all that the page shows, and the url
    gives the host and the suffix. ``model`` comes from other, labelled texts.
    """
    host = F.regexp_replace(split_url(F.col("url"))[0], r"^.*@|\.?(:[0-9]*)?$", "")
    declared = F.regexp_extract("html", r"(?i)<html(?=[\s/])[^>]*[\s\"'/]lang\s*=\s*[\"']?\s*([A-Za-z]{2,8})(?![A-Za-z])", 1)
    parts = pages.withColumns({
        "declared": F.nullif(F.lower(declared), F.lit("")),
        "host": F.nullif(host, F.lit("")),
        "suffix": F.nullif(F.regexp_extract(host, r"\.([a-z][a-z0-9-]*)$", 1), F.lit("")),
    }).select("page_id", "declared", "host", "suffix", "html")
    texts = written(shown_texts(parts), "page-texts")
    found = identify(texts, model, F.col("declared"), F.col("host"), F.col("suffix"))
    return found.select("page_id", "declared", "__language", "__probability", "__kept")
