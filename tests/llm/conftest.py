import random
from pathlib import Path

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, id bigint, key string, block string, n int"


def prose(rng: random.Random, words: int) -> str:
    vocabulary = ["the", "and", "of"] + [a + b + c for a in "bcdfg" for b in "aeiou" for c in ("n", "rt", "st", "l")]
    return " ".join(rng.choice(vocabulary) for _ in range(words))


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty, blank and very long texts, repeated rows, ties and columns with clashing names."""
    rng = random.Random(4)
    base = prose(rng, 120)
    edited = base.split()
    edited[50] = "changed"
    passage = prose(rng, 30)
    texts = {
        0: base, 1: base, 2: " ".join(edited), 3: None, 4: "", 5: " \n\t ", 6: "one", 7: "one two", 8: "One  TWO three",
        9: prose(rng, 60) + " " + passage, 10: passage + " " + prose(rng, 5), 11: prose(rng, 30_000),
        12: "\n".join(f"line {i} of text" for i in range(40)), 13: "\n".join(f"line {i} of text" for i in range(5, 12)) + "\nown end",
        14: "same\nsame\nsame\nsame\nsame\nsame", 15: "é漢字 ünï\x0bcode ## $$ 漢字", 16: "a" * 5000, 17: "a" * 70, 18: "\n\n\n\n",
    }
    sources = ["x", None, "", "ab", "x"]
    rows = [(i, t, ["en", None, "fr"][i % 3], sources[i % 5], len(t or "")) for i, t in texts.items()]
    rows += [(7, "one two", "en", "x", None), (None, base, "en", "x", 1), (None, None, None, None, None)]
    return [(*r, 1, "k", None, None) for r in rows]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def folder():
    path = Path("/root/testdata/sf0.001")
    if not (path / "documents.parquet").exists():
        pytest.skip("needs the text tables")
    return str(path)


@pytest.fixture(scope="session")
def texts_of():
    return prose
