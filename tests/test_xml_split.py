"""XML read in byte ranges against the built-in reader and against one walk over the whole text."""

import random

import pyarrow as pa
import pytest

from stratalake.sinks import tables as sinks
from stratalake.sources import files, xml_split

COLUMNS = ["id", "name", "note"]
TRICKY = """<?xml version="1.0" encoding="UTF-8"?>
<!DOCTYPE items [ <!ENTITY x "<item>"> <!ELEMENT item (id)> ]>
<items a="1 > 0">
<!-- <item><id>no</id></item> > -->
<item k="a>b" l='c>"d'><id>1</id><name>one &amp; only</name></item>
<item><id>2</id><!-- </item> --><name><![CDATA[ </item> <item> ]]></name></item>
<?note <item><id>no</id></item> ?>
<item/><item
 m="x"><id>3</id>
<name>é漢 &lt;b&gt;</name><note/></item><items2><item2>no</item2></items2>
<![CDATA[<item><id>no</id></item>]]>
<item><id>4</id><name>a</name></item ><item><id>5</id></item>
</items>
"""


@pytest.fixture
def small_ranges(spark):
    settings = {"spark.sql.files.maxPartitionBytes": "40", "spark.sql.files.openCostInBytes": "0"}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name in settings:
        spark.conf.unset(name)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def read(spark, path, **options):
    return files.read_xml(spark, str(path), "item", COLUMNS, **options)


def pieces(text, cuts):
    """Ranges that end behind the ``>`` with these numbers."""
    ends = [i + 1 for i, c in enumerate(text) if c == ">"]
    borders = [0, *sorted({ends[c % len(ends)] for c in cuts}), len(text)]
    return [(s, text[s:e]) for s, e in zip(borders, borders[1:], strict=False)]


def joined(parts):
    starts = xml_split.compose([(s, *xml_split.transitions(t, "item")) for s, t in parts])
    whole, open_ones = [], {}
    for start, text in parts:
        for owner, found in xml_split.cut(text, *starts[start], start, "item"):
            if owner is None:
                whole.append(found)
            else:
                open_ones[owner] = open_ones.get(owner, "") + found
    return sorted([*whole, *open_ones.values()])


def test_any_ranges_give_the_records_of_the_whole():
    whole = joined([(0, TRICKY)])
    assert len(whole) == 6 and "<item/>" in whole and sum("<id>no" in r for r in whole) == 0
    rng = random.Random(4)
    ends = TRICKY.count(">")
    for cuts in [range(ends), *([c] for c in range(ends)), *([rng.randrange(ends) for _ in range(rng.randrange(9))] for _ in range(300))]:
        assert joined(pieces(TRICKY, cuts)) == whole


def test_states_of_random_mark_up():
    rng = random.Random(8)
    bits = ["<item>", "</item>", "<item/>", "<a b='>'>", '<a b="\'>">', "<!--", "-->", "<![CDATA[", "]]>", "<?p", "?>", "x", "'", '"', "<b>", " > "]
    for _ in range(400):
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(1, 40))) + ">"
        for state in range(7):
            ends, said = xml_split.transitions(text, "item")
            one = xml_split.scan(text, state, "item")
            assert ends[state] == one.state
            assert said[state] == (one.tags[-1][1] if one.tags else xml_split.NONE)


def test_same_rows_as_the_built_in_reader(spark, tmp_path, small_ranges):
    (tmp_path / "x").mkdir()
    (tmp_path / "x" / "a.xml").write_text(TRICKY, encoding="utf-8")
    (tmp_path / "x" / "b.xml").write_text(TRICKY.replace("<id>", "<id>7"), encoding="utf-8")
    got = read(spark, tmp_path / "x", split=True)
    assert len({r[0] for r in spark.read.option("lineSep", ">").text(str(tmp_path / "x")).selectExpr("_metadata.file_block_start").collect()}) > 5
    rows = rows_of(got)
    assert [r[0] for r in rows if r[0] and not r[0].startswith("7")] == ["1", "2", "3", "4", "5"]
    assert rows == rows_of(read(spark, tmp_path / "x"))


def test_a_file_is_read_by_several_tasks(spark, tmp_path):
    body = "".join(f"<item><id>{i}</id><name>{'n' * 200} {i}</name></item>" for i in range(60_000))
    (tmp_path / "a.xml").write_text(f"<items>{body}</items>")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2m")
    try:
        got = read(spark, tmp_path / "a.xml", split=True)
        assert got.rdd.getNumPartitions() >= 7
        assert got.selectExpr("count(*)", "count(distinct id)", "sum(cast(id as bigint))").first() == (60_000, 60_000, 1_799_970_000)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_odd_files(spark, tmp_path):
    for name, text in {"empty.xml": "", "none.xml": "<items></items>", "one.xml": "<item><id>1</id></item>", "open.xml": "<items><item><id>1</id>"}.items():
        (tmp_path / name).write_text(text)
    assert [rows_of(read(spark, tmp_path / n, split=True)) for n in ("empty.xml", "none.xml", "one.xml")] == [[], [], [("1", None, None)]]
    assert read(spark, tmp_path / "open.xml", split=True).count() <= 1
    (tmp_path / "latin.xml").write_bytes('<?xml version="1.0" encoding="ISO-8859-1"?><items><item><name>é</name></item></items>'.encode("latin-1"))
    assert xml_split.records(spark, str(tmp_path / "latin.xml"), "item") is None
    assert read(spark, tmp_path / "latin.xml", split=True).count() == 1
    with pytest.raises(files.MissingDataset):
        read(spark, tmp_path / "nowhere.xml", split=True)


def test_task_holds_a_stretch_of_its_range(spark, tmp_path):
    (tmp_path / "a.xml").write_text(TRICKY)
    (tmp_path / "b.xml").write_text(TRICKY.replace("<id>", "<id>1"))
    whole = rows_of(xml_split.records(spark, str(tmp_path), "item"))
    assert len(whole) == 12
    for most in (2, 30, 100):
        assert rows_of(xml_split.records(spark, str(tmp_path), "item", most)) == whole


def test_stretches_are_bounded_and_named_apart():
    pieces = [b"x" * 9] * 50
    batch = pa.RecordBatch.from_pydict({"path": ["f"] * 100, "start": [0] * 50 + [500] * 50, "value": pieces * 2})
    found = list(xml_split._ranges(iter([batch]), 40))
    assert max(len(text) for _, _, text in found) == 40
    assert "".join(text for _, _, text in found) == ("x" * 9 + ">") * 100
    starts = [start for _, start, _ in found]
    assert starts == sorted(set(starts)) and {0, 500} <= set(starts)


def test_xml_is_written_in_files_of_bounded_rows(spark, tmp_path):
    rows = spark.range(25).selectExpr("cast(id as string) id", "'n' name").coalesce(1)
    sinks.write_xml(rows, str(tmp_path / "x"), "items", "item", rows_a_file=10)
    assert len(list((tmp_path / "x").glob("part-*"))) == 3
    assert files.read_xml(spark, str(tmp_path / "x"), "item", ["id", "name"]).count() == 25
    sinks.write_xml(rows, str(tmp_path / "one"), "items", "item", rows_a_file=0)
    assert len(list((tmp_path / "one").glob("part-*"))) == 1
