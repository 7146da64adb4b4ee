"""Toxicity, HTML extraction and language identification: held-out accuracy, invariants and odd rows."""

import math
import random
import time
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratalake.llm import html_text, language_id, toxicity

LARGER = "/root/testdata/sf0.01"
needs_tables = pytest.mark.skipif(not Path(LARGER, "documents.parquet").exists(), reason="needs the text tables")

# --- toxicity -------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def rude(spark, texts_of):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(600):
        words = texts_of(rng, rng.randrange(20, 200)).split()
        bad = rng.choice([0, 0, 1, 2, 3])
        for _ in range(len(words) * bad // 15):
            words[rng.randrange(len(words))] = rng.choice(["vilex", "vilot", "grubber"]) + rng.choice(["", "a", "ity"])
        rows.append((i, " ".join(words), bad))
        labels.append((i, int(bad > 0)))
    return spark.createDataFrame(rows, "doc_id bigint, text string, toxic int"), spark.createDataFrame(labels, "doc_id bigint, toxic int")


def test_severity_is_learnt_and_ordered(rude):
    docs, labels = rude
    model = toxicity.train(docs, labels.where("doc_id < 400"))
    assert (np.diff(model.thresholds) > 0).all()
    rows = toxicity.score(docs.where("doc_id >= 400").withColumnRenamed("toxic", "bad"), model).collect()
    bad, severity = np.array([r.bad for r in rows]), np.array([r["__severity"] for r in rows])
    flagged = np.array([r["__toxic"] for r in rows])
    assert flagged[bad > 0].mean() > 0.95 and flagged[bad == 0].mean() < 0.05
    means = [severity[bad == k].mean() for k in range(4)]
    assert means == sorted(means)
    assert all(0 <= r["__severity"] <= toxicity.GRADES and r["__grade"] in range(4) for r in rows)


def test_toxicity_of_odd_rows(spark, rude, odd_docs, no_docs):
    model = toxicity.train(*rude)
    rows = toxicity.score(odd_docs, model).collect()
    assert len(rows) == odd_docs.count() and not any(r["__toxic"] for r in rows)
    plain = {r["__severity"] for r in rows if not (r.text or "").strip()}
    assert len(plain) == 1
    assert toxicity.score(no_docs, model).count() == 0
    none = spark.createDataFrame([(None, None), (1, None), (None, 1), (5, 0)], "doc_id bigint, toxic int")
    assert toxicity.train(odd_docs, none) is None
    assert toxicity.score(odd_docs, None).where("__toxic is null").count() == odd_docs.count()


def test_one_weight_vector_serves_all_thresholds():
    model = toxicity.Model(np.zeros(4, np.float32), np.array([0.5, 1.5, 4.0]))
    above = model.above(np.array([-1.0, 0.0, 2.0]))
    assert (np.diff(above, axis=1) < 0).all() and (np.diff(above, axis=0) > 0).all()


# --- html -----------------------------------------------------------------------------------------


def blocks(page):
    return [b.text for b in html_text.blocks(page)]


def test_leaf_blocks():
    page = (
        '<!DOCTYPE html><head><title>T</title><style>p{}</style></head><body><p>a<b>b</b>c &amp; d<br>e<p>next\n line'
        '<script>var t="</p>x";</script><!-- no --><ul><li>one<li>two</ul><img alt=">" src=x>tail &lt;b&gt; 1 < 2 &copy; &am;'
    )
    assert blocks(page) == ["abc & d e", "next line", "one", "two", "tail <b> 1 < 2 © &am;"]
    assert blocks("") == [] and blocks("<p> \n </p>") == [] and blocks("plain") == ["plain"]
    assert blocks("<script>never closed <p>x") == [] and blocks("</div></p>x</li>") == ["x"]
    assert blocks("<textarea>a <b> c</textarea>") == ["a <b> c"]


def test_gradient_finds_the_likeliest_labels():
    rng = np.random.default_rng(2)
    pages = []
    for _ in range(80):
        labels = np.repeat(rng.integers(0, 2, 4), 3)
        pages.append(([np.array([10 + (y if rng.random() < 0.8 else 1 - y)]) for y in labels], labels))
    model = html_text.fit(pages[:60])
    assert model.transition[0, 0] > model.transition[0, 1] and model.transition[1, 1] > model.transition[1, 0]
    right = np.concatenate([model.decode(model.emissions(c)) == y for c, y in pages[60:]]).mean()
    alone = np.concatenate([model.emissions(c).argmax(axis=1) == y for c, y in pages[60:]]).mean()
    assert right > alone


def test_viterbi_is_the_best_of_all_labellings():
    rng = np.random.default_rng(3)
    model = html_text.Crf(rng.normal(size=(20, 2)), rng.normal(size=(2, 2)))
    for n in range(1, 9):
        cells = [rng.integers(0, 20, 2) for _ in range(n)]
        scores = model.emissions(cells)

        def value(ys, scores=scores):
            return sum(scores[i, y] for i, y in enumerate(ys)) + sum(model.transition[a, b] for a, b in zip(ys, ys[1:], strict=False))

        best = max((tuple((k >> i) & 1 for i in range(n)) for k in range(2**n)), key=value)
        assert math.isclose(value(tuple(model.decode(scores))), value(best))


LONG = {
    "open tags": "<a " * 100_000,
    "open tags with a late end": "<a " * 100_000 + ">x",
    "unclosed parts": "<div>" * 60_000 + "deep" + "<p>x" * 2000,
    "unclosed parts with names": "".join(f'<div class="c{i}">t{i}' for i in range(20_000)),
    "ends of nothing": "<div>" * 30_000 + "</b>" * 75_000 + "x",
    "open quotes": '<a href="x>' * 30_000,
    "ends in quotes": '<a x=">" ' * 30_000,
    "open comments": "<!-- " * 60_000,
    "stray marks": "<" * 300_000,
    "one name": "<" + "a" * 300_000 + ">x",
    "items": "<ul><li>" * 20_000 + "x",
    "cells": "<table><tr><td><p>" * 15_000 + "x",
}


@pytest.mark.parametrize("kind", LONG)
def test_long_broken_pages_take_seconds(kind):
    model = html_text.fit(html_text.seed_pages(["A sentence of some length that ends with a stop.", "Two words"]), rounds=2)
    began = time.perf_counter()
    page = html_text._Page(LONG[kind]).read()
    labels = model.decode(model.page_emissions(page))
    assert time.perf_counter() - began < 20 and len(labels) == len(page.blocks)


def test_an_element_adds_the_same_to_all_blocks_in_it():
    rng = np.random.default_rng(1)
    model = html_text.Crf(rng.normal(size=(html_text.CELLS, 2)).astype(np.float32), np.zeros((2, 2)))
    page = (
        '<html class="a"><body class="no-sidebar a"><div class="a b"><p>one<nav class="b"><a>two</a></nav><article id="a post">three'
        '<section class="post c"><p>four<article class="comment"><p>five</article></section>six</article>seven<main><div>eight</div></main></div>nine'
    )
    read = html_text._Page(page).read()
    assert len(read.blocks) == 9
    assert np.allclose(model.page_emissions(read), model.emissions(html_text.features(read.blocks)), atol=1e-4)
    assert list(html_text.marked_labels(read.blocks)) == [0, 0, 1, 1, 0, 1, 0, 1, 0]


def test_content_of_every_kind_is_kept():
    assert blocks("<p>E <math><mi>a</mi><mo>=</mo><mn>2</mn></math> so") == ["E a=2 so"]
    assert blocks("<object data=x>no film</object><svg><text>drawn</text></svg><noscript>plain</noscript>") == ["no film", "drawn", "plain"]
    assert blocks("<p>a<table><tr><td><p>b</table>c<p>d") == ["a", "b", "c", "d"]
    assert blocks('<p title="a>b">x</p><p title="a>b>y') == ["x", "b>y"]
    deep = html_text.blocks("<p>" + "<b>" * 12 + "x<p>y")
    assert [b.node.tag for b in deep] == ["b", "p"] and deep[1].node.parent is None
    many = html_text.blocks(f'<div class="{" ".join("n" + chr(97 + i % 26) * 3 for i in range(40))} footer">x')
    assert many[0].node.other


@needs_tables
def test_held_out_pages(spark):
    pages = spark.read.parquet(f"{LARGER}/pages.parquet")
    model = html_text.train(pages, sample_pages=100)
    texts = {r.page_id: r["__text"] for r in html_text.extract(pages, model).collect()}
    wrong = 0
    for r in pages.collect():
        inner = r.html[r.html.index("<article>") + 9 : r.html.index("</article>")]
        wrong += " ".join(blocks(inner)) != texts[r.page_id]
    assert wrong <= len(texts) // 100
    unseen = (
        '<body><div class="topbar"><a>Home</a></div><article><header><h1>Title of it</h1></header><p>Para one is long enough to be'
        ' text.</p><aside>Side note</aside><p>Para two is here, too.</p></article><form><p>Write to us</p></form><section id="comments">'
        "<p>A reader says that this is fine.</p></section><footer>End</footer></body>"
    )
    odd = spark.createDataFrame([(1, None, "a"), (2, "", "b"), (3, unseen, "c"), (3, unseen, "c"), (4, "<p>" * 3000, "d")], "page_id int, html string, text string")
    got = [(r.page_id, r["__text"]) for r in html_text.extract(odd, model).orderBy("page_id").collect()]
    main = "Title of it Para one is long enough to be text. Para two is here, too."
    assert got == [(1, ""), (2, ""), (3, main), (3, main), (4, "")]
    assert html_text.extract(odd.limit(0), html_text.train(odd.limit(0))).count() == 0


# --- language -------------------------------------------------------------------------------------


@needs_tables
def test_held_out_languages(spark):
    docs = spark.read.parquet(f"{LARGER}/documents.parquet")
    model = language_id.train(docs.where("doc_id % 2 = 0"), "lang")
    none = F.lit(None).cast("string")
    rows = language_id.identify(docs.where("doc_id % 2 = 1 and length(text) > 60"), model, none, none, none).collect()
    assert np.mean([r["__language"] == r.lang for r in rows]) > 0.99


def test_evidence_decides_where_texts_do_not(spark, texts_of):
    rng = random.Random(5)
    rows = [(i, texts_of(rng, 30).replace("o", "u"), "aa", f"h{i % 3}") for i in range(120)]
    rows += [(200 + i, texts_of(rng, 30).replace("u", "o"), "bb", f"k{i % 3}") for i in range(120)]
    rows += [(900, "zzz", None, "h1"), (901, "zzz", None, "k1"), (902, "zzz", "bb", None), (903, "12 !", "aa", "h1"), (904, None, "aa", "h1"), (905, "", None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    got = {r.doc_id: r for r in language_id.identify_documents(docs).collect()}
    assert [got[i]["__language"] for i in (900, 901, 902)] == ["aa", "bb", "bb"]
    assert all(got[i]["__kept"] for i in (900, 901, 902))
    assert not any(got[i]["__kept"] for i in (903, 904, 905)) and got[903]["__language"] is None
    assert all(r["__language"] == r.lang for r in rows_of(got) if r.doc_id < 900)
    assert all(0.5 <= r["__probability"] <= 1 for r in rows_of(got) if r["__probability"] is not None)


def test_a_new_host_leans_on_its_site(spark, texts_of):
    rng = random.Random(8)
    rows = [(texts_of(rng, 20).replace("o", "u"), f"h{i % 9}.one.org") for i in range(90)]
    rows += [(texts_of(rng, 20).replace("u", "o"), f"h{i % 9}.two.org") for i in range(90)]
    rows += [("zz", "new.one.org"), ("zz", "new.two.org"), ("zz", "plain"), ("zz", None)]
    docs = spark.createDataFrame([(t, h, None if t == "zz" else "ab"["two" in h]) for t, h in rows], "text string, host string, lang string")
    none = F.lit(None).cast("string")
    model = language_id.train(docs, "lang")
    got = language_id.identify(docs, model, none, F.col("host"), none).where("text = 'zz'").collect()
    chance = {r.host: r["__probability"] if r["__language"] == "a" else 1 - r["__probability"] for r in got}
    assert chance["new.one.org"] > 0.6 > chance["plain"] and chance["new.two.org"] < 0.4 < chance["plain"]
    assert abs(chance["plain"] - chance[None]) < 0.1


def rows_of(found):
    return found.values()


def test_languages_of_odd_rows(odd_docs, no_docs):
    found = language_id.identify_documents(odd_docs)
    assert found.columns == [*odd_docs.columns, "__language", "__probability", "__kept"]
    assert found.count() == odd_docs.count()
    assert language_id.identify_documents(no_docs).count() == 0
    unlabelled = language_id.identify_documents(odd_docs.withColumn("lang", F.lit(None).cast("string")))
    assert unlabelled.where("__kept and __language is null").count() == odd_docs.count()


def test_a_rare_language_has_a_model_beside_a_large_one(spark, texts_of):
    rng = random.Random(12)
    rows = [(texts_of(rng, 12).replace("o", "u"), "large") for _ in range(2000)]
    rows += [(rows[0][0], "large")] * 1000  # a text that a third of the rows share counts once
    rows += [(texts_of(rng, 60).replace("u", "o"), "rare") for _ in range(12)] + [("few", "few")] * 4
    docs = spark.createDataFrame(rows, "text string, lang string")
    model = language_id.train(docs, "lang", sample_rows=40)
    assert model.languages == ("large", "rare")
    assert model.logs.shape == (language_id.CELLS, 2)
    shared = np.unique(language_id.trigrams(rows[0][0].encode()))
    assert np.exp(model.logs[shared, 0]).sum() < 0.9
    none = F.lit(None).cast("string")
    found = language_id.identify(docs.where("lang = 'rare'"), model, none, none, none).collect()
    assert len(found) == 12 and sum(r["__language"] == "rare" for r in found) > 10


def test_pages_are_judged_by_markup_and_address(spark, folder, texts_of):
    from stratalake.llm.queries import QUERIES

    rng = random.Random(13)
    rows = [(texts_of(rng, 30).replace("o", "u"), "aa") for _ in range(60)] + [(texts_of(rng, 30).replace("u", "o"), "bb") for _ in range(60)]
    model = language_id.train(spark.createDataFrame(rows, "text string, lang string"), "lang")
    pages = [(i, f"http://h{i % 3}.{lang}.org/x", f"<html class=x lang='{lang}-XX'><body><p>{text}</p></body></html>") for i, (text, lang) in enumerate(rows)]
    pages += [(500, "https://new.aa.org/", "<html><p>zz</p>"), (501, "https://new.bb.org:80/", "<html><p>zz</p>")]
    pages += [(502, None, '<html LANG="bb"><p>zz</p>'), (503, None, None), (None, "http://x.aa.org", '<html lang="aa"><script>var a</script>')]
    got = language_id.identify_pages(spark.createDataFrame(pages, "page_id bigint, url string, html string"), model).collect()
    assert len(got) == len(pages)
    found = {r.page_id: r for r in got}
    assert [found[i]["__language"] for i in (500, 501, 502, 503, None)] == ["aa", "bb", "bb", None, None]
    assert [found[i].declared for i in (0, 60, 500, 502, None)] == ["aa", "bb", None, "bb", "aa"]
    whole = QUERIES["op10_language_id"](spark, folder).groupBy(F.col("page_id").isNull().alias("of")).count().collect()
    counts = {r.of: r["count"] for r in whole}
    assert counts == {of: spark.read.parquet(f"{folder}/{t}.parquet").count() for of, t in ((True, "documents"), (False, "pages"))}
