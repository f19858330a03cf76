import json

import pytest
from pyspark.sql import functions as F

from quernstone.operators import contract as K
from quernstone.sources import artefacts as A

BLOCKS = "array<struct<text: string, kind: string, level: int, path: array<string>, page: int, atomic: boolean, data: map<string, string>>>"
SCHEMA = f"doc_id string, source string, format string, phenomenon int, language string, blocks {BLOCKS}, meta map<string, string>, errors array<string>"


def block(text="Text.", kind="paragraph", level=None, path=(), page=None, atomic=False):
    return (text, kind, level, list(path), page, atomic, {})


def doc(blocks, **changed):
    row = {"doc_id": "F1-AB-001", "source": "a.txt", "format": "txt", "phenomenon": 1, "language": "es", "blocks": blocks, "meta": {}, "errors": []} | changed
    return tuple(row.values())


def violations(spark, *docs):
    return {r.source: r.violations for r in K.document_violations(spark.createDataFrame(list(docs), SCHEMA)).collect()}


def test_sound_documents(spark):
    derived = spark.range(1).select(A.T.document_id(F.lit("b.txt")).alias("i"), A.T.document_id(F.lit("x/c.txt")).alias("j")).first()
    good = [block("T", "title", 1), block("U", "title", 3, ["T"]), block(path=["T", "U"]), block("V", "title", 2, ["T"]), block(path=["T", "V"], page=1)]
    assert violations(spark, doc(good), doc([], doc_id=derived.i, source="b.txt"), doc(good, doc_id=derived.j, source="c.txt", meta={"ruta_relativa": "x/c.txt"})) == {}


@pytest.mark.parametrize(
    ("changed", "message"),
    [
        ({"source": " "}, "source is empty"), ({"doc_id": ""}, "doc_id is empty"), ({"doc_id": "odd"}, "doc_id is not traceable"), ({"format": "doc"}, "unknown format"),
        ({"phenomenon": 4}, "unknown phenomenon"), ({"language": None}, "unknown language"), ({"meta": None}, "meta is missing"), ({"errors": [None]}, "errors is no list of texts"), ({"blocks": None}, "blocks are missing"),
        ({"blocks": [block(None)]}, "block 0: text is missing"), ({"blocks": [block(" ")]}, "block 0: text is empty"), ({"blocks": [block("a  b")]}, "block 0: text is not normalised"),
        ({"blocks": [block(kind="odd")]}, "block 0: unknown kind"), ({"blocks": [block(kind="title")]}, "block 0: a title without a level"), ({"blocks": [block(kind="title", level=7)]}, "block 0: level out of range"),
        ({"blocks": [block(level=2)]}, "block 0: a level on a block that is no title"), ({"blocks": [block(page=0)]}, "block 0: page under 1"), ({"blocks": [block(atomic=None)]}, "block 0: atomic is missing"),
        ({"blocks": [block("T", "title", 2), block("S", "title", 2, ["T"])]}, "block 1: path is not that of the headings above"), ({"blocks": [block(path=["x"])]}, "block 0: path is not that of the headings above"),
    ],
)
def test_broken_documents(spark, changed, message):
    found = violations(spark, doc(**{"blocks": [block()]} | changed))
    assert list(found.values()) == [[message]]


def test_fragments_of_a_corpus(spark):
    text = " ".join(f"Sentence number {k} has some words." for k in range(200))
    docs = spark.createDataFrame([doc([block("Head", "title", 1), block(text, path=["Head"])], meta={"observatorio": "Obs", "titulo": "Tit"}), doc([], doc_id="F1-AB-002", errors=["broken: why"])], SCHEMA)
    made = K.fragment_corpus(docs).cache()
    assert K.fragment_violations(made).count() == 0
    assert made.where(F.col("enriched").startswith("Obs · Tit · Head\n")).count() == made.count() > 5
    report = K.fragmentation_report(docs, made).first()
    assert (report.n_documents, report.n_without_blocks, report.n_fragments) == (2, 1, made.count())
    assert report.by_format == {"txt": made.count()} and sum(report.histogram.values()) == made.count() and report.n_indivisible == 0
    assert [r.doc_id for r in K.without_blocks(docs).collect()] == ["F1-AB-002"]
    assert [(r.reason, r.n) for r in K.failure_reasons(docs).collect()] == [("broken", 1)]
    assert [(r.format, r.docs, r.blocks) for r in K.extraction_summary(docs).collect()] == [("txt", 2, 2)]
    assert {(r.check, r.passed) for r in K.acceptance(docs).collect()} == {("documents that break the contract", True), ("documents with blocks", False), ("paths of three levels", False)}
    assert K.same_rows(made, K.fragment_corpus(docs)) and not K.same_rows(made, made.limit(1))
    broken = {
        "n_words": F.lit(3), "n_tokens": F.lit(1), "chunk_id": F.lit("x-c0000"), "unit": F.lit("odd"), "text": F.lit("a  b"), "enriched": F.lit("nothing"),
        "page": F.lit(0), "n_sentences": F.lit(0), "overlaps": F.lit(None).cast("boolean"), "source": F.lit(""), "position": F.lit(-1), "format": F.lit("x"), "language": F.lit("xx"), "phenomenon": F.lit(9),
    }
    for column, value in broken.items():
        found = K.fragment_violations(made.withColumn(column, value))
        assert found.count() > 0, column
        assert all(json.dumps(r.violations) for r in found.collect())


def test_rows_keep_their_data(spark):
    rows = [("Name: a", "row", None, [], None, True, {"id": "7"}), ("Name: b", "row", None, [], None, True, {})]
    made = K.fragment_corpus(spark.createDataFrame([doc(rows)], SCHEMA)).first()
    assert (made.unit, made.text, made.data) == ("atomic", "Name: a · Name: b", [{"id": "7"}])


def test_percentage(spark):
    r = spark.range(1).select(K.percentage(F.lit(1), F.lit(3)).alias("a"), K.percentage(F.lit(1), F.lit(0)).alias("b")).first()
    assert (r.a, r.b) == (33.3, 0.0)
