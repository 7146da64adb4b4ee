import itertools
import random
import re

from pyspark.sql import functions as F

from stratalake.llm.components import connected_components
from stratalake.llm.minhash import drop_near_duplicates, near_duplicates, sketch


def shingles(text, width=3):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if len(words) < width:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def brute(rows, percent=85):
    """{doc_id: (set size, component)} for rows with distinct ids."""
    sets = {i: shingles(t) for i, t in rows}
    top = {i: i for i in sets}

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    for a, b in itertools.combinations(sets, 2):
        common = len(sets[a] & sets[b])
        if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
            x, y = sorted((root(a), root(b)))
            top[y] = x
    return {i: (len(s), root(i)) for i, s in sets.items()}


def test_odd_rows(odd_docs, odd_rows):
    rows = {(r.doc_id, r.n_shingles): r for r in near_duplicates(odd_docs).collect()}
    expected = brute([r[:2] for r in odd_rows if r[0] is not None])
    for i, (n, component) in expected.items():
        assert rows[i, n].component_id == component
        assert rows[i, n].kept == (i == component)
    assert rows[None, 118].component_id == 0 and not rows[None, 118].kept
    assert rows[None, 0].component_id is None and rows[None, 0].kept
    assert near_duplicates(odd_docs).count() == len(odd_rows)


def test_chains_and_large_groups(spark, texts_of):
    """Groups in which many pairs are near the limit, some on either side: whatever leads, no link may be lost."""
    rng = random.Random(2)
    rows = []
    for group in range(6):
        base = texts_of(rng, 90).split()
        for k in range(40):
            words = list(base)
            for _ in range(rng.randrange(6)):
                words[rng.randrange(len(words))] = f"w{rng.randrange(1000)}"
            if k % 5 == 0:
                base = words  # the group drifts
            rows.append((1000 * group + rng.randrange(10**6) * 10_000 + k, " ".join(words)))
    rows += [(10**12 + i, texts_of(rng, 40)) for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(docs, block=16).collect()}
    assert got == brute(rows)


def test_no_rows(no_docs):
    assert near_duplicates(no_docs).count() == 0


def test_both_ends_of_each_permutation_estimate_similarity(spark):
    words = [f"w{i}" for i in range(400)]
    a, b = words[:300], words[60:360]
    docs = spark.createDataFrame([(1, " ".join(a)), (2, " ".join(b))], "doc_id bigint, text string")
    one, two = [r.bands for r in sketch(docs, permutations=500, rows=1).orderBy("id").collect()]
    true = len(shingles(" ".join(a)) & shingles(" ".join(b))) / len(shingles(" ".join(a)) | shingles(" ".join(b)))
    for half in (slice(0, 500), slice(500, 1000)):
        assert abs(sum(x == y for x, y in zip(one[half], two[half], strict=True)) / 500 - true) < 0.08


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5, 5), (2000, 1999)]
    random.Random(0).shuffle(links)
    got = dict(connected_components(spark.createDataFrame(links, "x bigint, y bigint")).collect())
    assert {got[i] for i in range(41)} == {0}
    assert {got[1000 + i] for i in range(300)} == {1000}
    assert got[2000] == got[1999] == 1999
    assert len(got) == 41 + 300 + 2
    empty = spark.createDataFrame([], "x bigint, y bigint")
    assert connected_components(empty).agg(F.count("*")).first()[0] == 0


def test_null_and_repeated_ids_keep_their_own_texts(spark, texts_of):
    """Every text is judged by itself, whatever shares its id; a null id stands for no document."""
    rng = random.Random(8)

    def near(text):
        words = text.split()
        return " ".join([*words[:-1], "changed"])

    a, b, c, d, e = (texts_of(rng, 100) for _ in range(5))
    lone = [texts_of(rng, 60) for _ in range(3)]
    rows = [(1, a), (None, near(a)), (2, b), (None, near(b)), *[(None, t) for t in lone], (None, "")]
    rows += [(None, c), (None, c), (None, near(c))]  # only null ids: one stays
    rows += [(7, d), (7, lone[0] + " more of it"), (3, near(d)), (7, e), (8, near(e))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = near_duplicates(docs).collect()
    assert len(got) == len(rows)
    assert sum(r.kept for r in got if r.doc_id is None) == 4  # lone[1], lone[2], the empty one, one of c
    assert sorted(r.kept for r in got if r.doc_id == 7) == [False, True, True]
    assert {r.component_id for r in got if r.doc_id == 8} == {7}
    left = sorted((r.doc_id or 0, r.text) for r in drop_near_duplicates(docs).collect())
    of_c = [t for _, t in left if t in (c, near(c))]
    assert len(of_c) == 1
    kept = [(1, a), (2, b), (3, near(d)), (7, lone[0] + " more of it"), (7, e)]
    assert left == sorted([*kept, (0, ""), (0, lone[1]), (0, lone[2]), (0, of_c[0])])


def test_columns_of_any_name_keep_their_values(spark, texts_of):
    rng = random.Random(12)
    text = texts_of(rng, 50)
    rows = [(1, text, 111, "h1", "g1", 1, "k1"), (2, text, 222, "h2", "g2", 2, "k2"), (None, texts_of(rng, 50), 333, "h3", "g3", 3, "k3")]
    rows += [(None, rows[2][1], 444, "h4", "g4", 4, "k4")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, id int, h string, g string, n int, __key string")
    left = drop_near_duplicates(docs)
    assert left.columns == docs.columns
    assert sorted(map(tuple, left.collect()), key=str) == sorted([rows[0], rows[2]], key=str)
