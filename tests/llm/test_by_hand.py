"""Toxicity and language fusion against plain re-computations, one row and one number at a time."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from stratalake.llm import language_id, toxicity
from stratalake.llm.words import Texts

# --- toxicity -------------------------------------------------------------------------------------


def cell_of(word):
    return int(Texts([word], toxicity.LETTERS, lower=True).hashes()[0] % np.uint64(toxicity.CELLS))


def features(text):
    """Words and word beginnings of one text with their counts, over the square root of the number of words."""
    words = "".join(c if c.isalpha() or ord(c) > 127 else " " for c in text.lower()).split()
    out = {}
    for word in words:
        raw = word.encode()
        for size in (None, *toxicity.BEGINNINGS):
            if size is None:
                cell = cell_of(raw)
            elif len(raw) > size:
                begin = Texts([raw[:size]], toxicity.LETTERS).hashes()[0] ^ np.uint64(size)
                cell = int(begin % np.uint64(toxicity.CELLS))
            else:
                continue
            out[cell] = out.get(cell, 0) + 1
    return {c: n / math.sqrt(max(len(words), 1)) for c, n in out.items()}


def sigmoid(x):
    return 1 / (1 + math.exp(-x))


def rude_rows(texts_of, n=240):
    rng = random.Random(3)
    rows = []
    for i in range(n):
        words = texts_of(rng, rng.randrange(5, 60)).split()
        bad = rng.random() < 0.4
        for _ in range(len(words) // 4 if bad else 0):
            words[rng.randrange(len(words))] = rng.choice(["vilex", "vilot", "grubberish"])
        rows.append((i, " ".join(words), int(bad)))
    return rows


def test_scores_by_hand(spark, texts_of):
    rows = rude_rows(texts_of) + [(1000, "", 0), (1001, None, 0), (1002, "Vilex! VILEX, é漢 x", 0)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")
    model = toxicity.train(docs, spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id bigint, toxic int"))
    for r in toxicity.score(docs, model).collect():
        total = sum(model.weights[c] * v for c, v in features(r.text or "").items())
        above = [sigmoid(total - t) for t in model.thresholds]
        assert math.isclose(r["__severity"], sum(above), abs_tol=1e-5)
        assert math.isclose(r["__p_toxic"], above[0], abs_tol=1e-5)
        shares = [a - b for a, b in zip([1, *above], [*above, 0], strict=True)]
        assert max(shares) - shares[r["__grade"]] < 1e-5
        assert r["__toxic"] == (r["__p_toxic"] >= 0.2)


def test_weights_and_thresholds_are_the_likeliest():
    """No step away from the fit, in any weight or threshold, makes the penalised likelihood better."""
    rng = np.random.default_rng(4)
    grade = rng.integers(0, 4, 400)
    cells, counts = [], []
    for g in grade:
        own = np.unique(rng.choice(12, 3 + g, p=np.arange(1, 13) ** (0.4 * g) / (np.arange(1, 13) ** (0.4 * g)).sum()))
        cells.append(own.astype(np.int32).tobytes())
        counts.append(rng.integers(1, 4, len(own)).astype(np.int32).tobytes())
    weight = rng.uniform(0.5, 2, 400)
    sample = toxicity.Sample(np.full(400, 9), cells, counts, grade > 0, weight, least=1, ratio=1.0)
    decay = 1e-2
    model = toxicity.fit(sample, grade, weight, rounds=4000, step=0.01, decay=decay)

    def loss(w, t):
        out = 0.0
        for i in range(400):
            mine = sample.doc == i
            total = (sample.value[mine] * w[sample.column[mine]]).sum()
            above = [1.0, *[sigmoid(total - x) for x in t], 0.0]
            out -= weight[i] / weight.sum() * math.log(max(above[grade[i]] - above[grade[i] + 1], 1e-12))
        return out + decay / 2 * (w**2).sum()

    w, t = model.weights[sample.cells].astype(float), model.thresholds
    best = loss(w, t)
    for k in range(len(w) + 3):
        for step in (-0.05, 0.05):
            w2, t2 = w.copy(), t.copy()
            if k < len(w):
                w2[k] += step
            else:
                t2[k - len(w)] += step
            if (np.diff(t2) > 0).all():
                assert loss(w2, t2) > best - 1e-6


# --- language -------------------------------------------------------------------------------------

DOCS = "text string, tag string, host string, end string, n int"


def smoothed(counts, weight, prior):
    whole = sum(counts)
    return [(c + weight * p) / (whole + weight) for c, p in zip(counts, prior, strict=True)]


def test_fusion_by_hand(spark):
    rng = random.Random(5)
    letters = {"aa": "abcde", "bb": "defgh", "cc": "ghijk"}
    rows = []
    for i in range(90):
        lang = rng.choice(list(letters))
        text = " ".join("".join(rng.choice(letters[lang]) for _ in range(4)) for _ in range(rng.choice([1, 2, 12])))
        tag = rng.choice([lang, " " + lang.upper(), rng.choice(list(letters)), None, "zz"])
        host = rng.choice([f"{lang}.one.org", "mixed.one.org", "lone", "b.two.org", None])
        rows.append((text if i % 15 else rng.choice([None, "", "12 34"]), tag, host, rng.choice([lang, "org", None]), i))
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    model = language_id.train(docs.where("tag in ('aa', 'bb', 'cc')"), "tag")
    names, n = model.languages, len(model.languages)
    assert n == 3
    scores = {r.n: r["__scores"] for r in language_id.text_scores(docs, model).collect()}
    top = {i: s.index(max(s)) for i, s in scores.items() if s is not None}

    def table(key):
        out = {}
        for row in rows:
            value = key(row)
            if value is not None and row[4] in top:
                out.setdefault(value, [0] * n)[top[row[4]]] += 1
        return out

    clean = lambda v: None if v is None else v.strip(" ").lower()
    site = lambda v: ".".join(v.split(".")[-2:]) if v and v.count(".") else None
    total = [1 + sum(t == i for t in top.values()) for i in range(n)]
    base = [t / sum(total) for t in total]
    hosts, sites, tags, ends = table(lambda r: r[2]), table(lambda r: site(r[2])), table(lambda r: clean(r[1])), table(lambda r: r[3])
    got = {r.n: r for r in language_id.identify(docs, model, F.col("tag"), F.col("host"), F.col("end")).collect()}
    judged = 0
    for text, tag, host, end, i in rows:
        if scores[i] is None:
            assert got[i]["__language"] is None and not got[i]["__kept"]
            continue
        sums = [s + math.log(b) for s, b in zip(scores[i], base, strict=True)]
        parts = []
        if host in hosts:
            parts.append(smoothed(hosts[host], 10, smoothed(sites.get(site(host), [0] * n), 10, base)))
        if clean(tag) in tags:
            parts.append(smoothed(tags[clean(tag)], 1, base))
        if end in ends:
            parts.append(smoothed(ends[end], 10, base))
        for part in parts:
            sums = [s + math.log(p) - math.log(b) for s, p, b in zip(sums, part, base, strict=True)]
        whole = sum(math.exp(s - max(sums)) for s in sums)
        assert got[i]["__language"] == names[sums.index(max(sums))]
        assert math.isclose(got[i]["__probability"], 1 / whole, rel_tol=1e-6)
        assert got[i]["__kept"] == (1 / whole >= 0.6)
        judged += 1
    assert judged > 70
