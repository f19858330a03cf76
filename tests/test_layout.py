import random

import pytest
from pyspark.sql import functions as F

from quernstone.operators import layout as L


def word(text, x0, top, size=10.0, width=None):
    return {"text": text, "x0": float(x0), "x1": float(x0) + (width or 6.0 * len(text)), "top": float(top), "bottom": float(top) + size, "size": size}


def test_lines_by_height_then_place():
    got = L.group_lines([word("world", 60, 10.4), word("hello", 10, 10), word("next", 10, 24), word("x", 40, 24.1, 6.0)])
    assert [x["text"] for x in got] == ["hello world", "next x"]
    assert got[1]["size"] == 10.0 and got[0]["top"] == 10.0
    assert L.group_lines([]) == []


def columns(n=30):
    left = [word("left", 50, 20 + 14 * k) for k in range(n)]
    right = [word("right", 350, 20 + 14 * k) for k in range(n)]
    return [w for pair in zip(left, right, strict=True) for w in pair]


def test_columns_are_read_one_after_the_other():
    cut = L.gutter(columns(), 600.0)
    assert 80 < cut < 350
    lines = [x["text"] for x in L.read_lines(columns(), 600.0)]
    assert lines == ["left"] * 30 + ["right"] * 30
    assert L.gutter(columns(10), 600.0) is None  # too few words
    wide = [word("a", 10, k, width=560) for k in range(50)]
    assert L.gutter(wide, 600.0) is None and L.gutter(columns(), 0.0) is None


@pytest.fixture(scope="module")
def pages(spark):
    rows = []
    for page in (1, 2, 3):
        rows.append((page, word("Header", 10, 5)))
        rows.append((page, word(str(page), 300, 790)))
    rows += [(1, word("Main title", 10, 30, 20.0)), (1, word("Part", 10, 60, 14.0))]
    rows += [(1, word(f"body{k}", 10, 90 + 12 * k)) for k in range(5)] + [(1, word("apart", 10, 200))]
    rows += [(2, word("Other part", 10, 30, 14.0)), (2, word("text", 10, 60)), (3, word("end", 10, 60))]
    data = [("d", p, w["text"], 600.0, w["x0"], w["x1"], w["top"], w["bottom"], w["size"]) for p, w in rows]
    return spark.createDataFrame(data, "doc_id string, page int, text string, width double, x0 double, x1 double, top double, bottom double, size double")


def test_blocks_of_a_document(pages):
    lines = L.page_lines(pages)
    assert L.body_size(lines).first()["body"] == 10.0
    assert {(r.size, r.level) for r in L.title_sizes(lines).collect()} == {(20.0, 1), (14.0, 2)}
    got = [(r.text, r.kind, r.level, r.path, r.page) for r in L.document_blocks(lines).orderBy("pos").collect()]
    assert got == [
        ("Main title", "title", 1, [], 1),
        ("Part", "title", 2, ["Main title"], 1),
        ("body0 body1 body2 body3 body4", "paragraph", None, ["Main title", "Part"], 1),
        ("apart", "paragraph", None, ["Main title", "Part"], 1),
        ("Other part", "title", 2, ["Main title"], 2),
        ("text", "paragraph", None, ["Main title", "Other part"], 2),
        ("end", "paragraph", None, ["Main title", "Other part"], 3),
    ]
    assert L.page_lines(pages.limit(0)).count() == 0 and L.document_blocks(lines.limit(0)).count() == 0


def test_unreadable_pages_are_recognised(spark):
    long = "a readable page with enough characters to count as text"
    lines = spark.createDataFrame(
        [("d", 1, 0, "(cid:12)(cid:7) (cid:9)"), ("d", 2, 0, long), ("d", 3, 0, "L i f e c y c l e cost"), ("e", 1, 0, "short"), ("f", 1, 0, "(cid:1)(cid:2) but words")],
        "doc_id string, page int, line int, text string",
    ).selectExpr("*", "10.0D as size", "1.0D as top", "2.0D as bottom", "0.0D as x0")
    listed = spark.createDataFrame([("d", 1), ("d", 2), ("d", 3), ("e", 1), ("e", 2), ("f", 1)], "doc_id string, page int")
    assert {(r.doc_id, r.page) for r in L.unreadable_pages(lines, listed).collect()} == {("d", 1), ("d", 3), ("e", 1), ("e", 2), ("f", 1)}
    seen = spark.createDataFrame([("d", 1, 0, "now it reads", 90.0), ("d", 1, 1, "twice", 80.0), ("d", 2, 0, "not asked", 99.0), ("e", 2, 0, "blank no more", 70.0), ("f", 1, 0, "x", 50.0)], "doc_id string, page int, line int, text string, conf double")
    after, facts = L.with_recognised(lines, listed, seen)
    texts = {(r.doc_id, r.page): r.text for r in after.orderBy("line").collect()}
    assert texts["d", 1] == "twice" and texts["d", 2] == long and texts["d", 3].startswith("L i f") and texts["f", 1].endswith("words")
    said = {r.doc_id: r for r in facts.collect()}
    assert said["d"].recognised_pages == [1] and said["d"].pages_not_bettered == [3] and said["d"].confidence == 85.0
    assert said["e"].recognised_pages == [2] and not said["e"].cut_off
    blocks = L.document_blocks(after).where("doc_id = 'd' and kind = 'ocr'").orderBy("pos")
    assert [r.text for r in blocks.collect()] == ["now it reads", "twice"]
    assert L.with_recognised(lines, listed, seen, 1)[1].where("doc_id = 'd'").first().cut_off


def test_useful_text(spark):
    df = spark.createDataFrame([("(cid:4) real a b word",), ("",)], "t string")
    assert [r[0] for r in df.select(L.useful_text(F.col("t"))).collect()] == ["real word", ""]
    assert [r[0] for r in df.select(L.looks_like_title(F.col("t"))).collect()] == [True, False]


def test_pages_in_batches_equal_pages_alone(spark):
    rng = random.Random(5)
    rows, want = [], []
    for p in range(40):
        words = columns() if p % 5 == 0 else [word(f"w{k}", rng.choice([0, 5, 5, 9, 200]), rng.choice([0, 0.15, 0.25, 1.9, 2, 4.1, 30]), rng.choice([6.0, 10.04, 10.06, 40.0])) for k in range(rng.randrange(60))]
        rows.append((f"d{p % 3}", p, rng.choice([600.0, 0.0, None]) if p % 5 else 600.0, words))
        want += [(f"d{p % 3}", p, k, *line.values()) for k, line in enumerate(L.read_lines(words, rows[-1][2] or 0.0))]
    pages = spark.createDataFrame(rows, "doc_id string, page int, width double, words array<struct<text: string, x0: double, x1: double, top: double, bottom: double, size: double>>")
    got = L.lines_of_pages(pages)
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    assert L.lines_of_pages(pages.limit(0)).count() == 0
