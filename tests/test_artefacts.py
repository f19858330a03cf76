import json

import pytest
from pyspark.sql import functions as F

from quernstone.operators import chunk as C
from quernstone.sources import artefacts as A
from quernstone.sources import lines as L


def document(doc_id="d1", **changed):
    block = {"texto": "Hello", "tipo": "titulo", "nivel": 1, "ruta": [], "pagina": None, "atomico": False}
    return {"doc_id": doc_id, "fuente": "f.txt", "formato": "texto", "fenomeno": 2, "idioma": "es", "bloques": [block], "meta": {"observatorio": "O", "fuente_ambigua": True, "ruta_relativa": "a/f.txt"}, "errores": []} | changed


def write(folder, docs):
    for d in docs:
        (folder / f"{d['doc_id']}.json").write_text(json.dumps(d, indent=1), encoding="utf-8")


def test_documents_in_manifest_order(spark, tmp_path):
    write(tmp_path, [document("b"), document("a"), document("c")])
    assert [r.doc_id for r in A.read_documents(spark, str(tmp_path)).orderBy("place").collect()] == ["a", "b", "c"]
    (tmp_path / A.MANIFEST).write_text('{"doc_id": "c"}\n\n{"doc_id": "a"}\n', encoding="utf-8")
    rows = A.read_documents(spark, str(tmp_path)).orderBy("place").collect()
    assert [r.doc_id for r in rows] == ["c", "a"]
    assert rows[0].format == "txt" and rows[0].blocks[0].kind == "title" and rows[0].blocks[0].data == {} and rows[0].meta["fuente_ambigua"] == "true"
    (tmp_path / A.MANIFEST).write_text('{"doc_id": "gone"}\n', encoding="utf-8")
    with pytest.raises(Exception, match="without a file"):
        A.read_documents(spark, str(tmp_path)).collect()
    with pytest.raises(ValueError):
        A.read_documents(spark, str(tmp_path / "none"))


def test_missing_fields_raise(spark, tmp_path):
    bad = document()
    del bad["errores"]
    write(tmp_path, [bad])
    with pytest.raises(Exception, match="a document lacks fields: errores"):
        A.read_documents(spark, str(tmp_path)).collect()
    bad = document()
    del bad["bloques"][0]["ruta"]
    write(tmp_path, [bad])
    with pytest.raises(Exception, match="a block lacks fields: ruta"):
        A.read_documents(spark, str(tmp_path)).collect()


def test_documents_round_trip(spark, tmp_path):
    write(tmp_path, [document("a"), document("b", errores=["x"], bloques=[])])
    docs = A.read_documents(spark, str(tmp_path))
    A.write_documents(docs, f"{tmp_path}/out")
    lines = [r.value for r in spark.read.text(f"{tmp_path}/out").collect()]
    assert list(json.loads(lines[0])) == sorted(A.DOCUMENT_FIELDS) and json.loads(lines[0])["bloques"][0]["pagina"] is None
    again = A.document_of_json(spark.read.text(f"{tmp_path}/out"))
    key = lambda df: sorted(map(str, df.drop("place").collect()))
    assert key(again) == key(docs)
    A.write_manifest(A.manifest_rows(docs), f"{tmp_path}/m", ["source", "doc_id"])
    rows = A.read_manifest(spark, f"{tmp_path}/m").orderBy("doc_id").collect()
    assert [(r.doc_id, r.n_blocks, r.n_chars, r.n_errors, r.observatory, r.ambiguous_name) for r in rows] == [("a", 1, 5, 0, "O", True), ("b", 0, 0, 1, "O", True)]
    A.write_document_files(docs, f"{tmp_path}/each")
    A.write_document_files(docs.where("doc_id = 'a'"), f"{tmp_path}/each")  # the run before goes
    assert A.document_of_json(spark.read.text(f"{tmp_path}/each", wholetext=True).select("value")).count() == 1


def test_fragments_round_trip(spark, tmp_path):
    text = " ".join(f"This is sentence number {k} of a longer text." for k in range(60))
    write(tmp_path, [document("a", bloques=[{"texto": text, "tipo": "parrafo", "nivel": None, "ruta": [], "pagina": 3, "atomico": False, "datos": {"k": "v"}}])])
    docs = A.read_documents(spark, str(tmp_path))
    made = C.fragment_documents(docs.select("doc_id", "blocks", F.lit("O").alias("observatory"), F.lit(None).cast("string").alias("title")))
    whole = A.complete_fragments(made, docs)
    A.write_fragments(whole, f"{tmp_path}/chunks")
    line = json.loads(spark.read.text(f"{tmp_path}/chunks").first()[0])
    assert list(line) == sorted(A.FRAGMENT_FIELDS) and line["tipo_unidad"] == "prosa" and line["ruta_relativa"] == "a/f.txt" and line["pagina"] == 3
    rows = A.read_fragments(spark, f"{tmp_path}/chunks").orderBy("row_id").collect()
    assert [r.row_id for r in rows] == list(range(len(rows))) and [r.position for r in rows] == list(range(len(rows))) and rows[0].unit == "prose"
    A.write_metadata(A.read_fragments(spark, f"{tmp_path}/chunks"), f"{tmp_path}/meta")
    assert "texto_enriquecido" not in json.loads(spark.read.text(f"{tmp_path}/meta").first()[0])
    assert [r.doc_id for r in A.documents_with_vectors(spark, f"{tmp_path}/meta").collect()] == ["a"]
    hit = A.metadata_of(spark.createDataFrame([("q1", 1)], "query_id string, row_id long"), L.line_index(spark, f"{tmp_path}/meta"), ["chunk_id"])
    assert hit.first().chunk_id == "a-c0001"
    (tmp_path / "bad.jsonl").write_text('{"doc_id": "a"}\n', encoding="utf-8")
    with pytest.raises(Exception, match="without the text to encode"):
        A.read_fragments(spark, f"{tmp_path}/bad.jsonl").collect()
    (tmp_path / "none.jsonl").write_text("\n", encoding="utf-8")
    with pytest.raises(ValueError):
        A.read_fragments(spark, f"{tmp_path}/none.jsonl")


def test_scan_by_lines(spark, tmp_path):
    lines = [json.dumps({"doc_id": f"d{k}", "chunk_id": f"d{k}-c0000", "texto": "" if k == 3 else f"t{k}", "fenomeno": None if k == 4 else 1}) for k in range(8)]
    lines[5] = "{broken"
    (tmp_path / "m.jsonl").write_text("\n".join(lines), encoding="utf-8")
    ids = lambda **x: [r.doc_id for r in A.scan_fragments(spark, f"{tmp_path}/m.jsonl", **x).orderBy("line").collect()]
    assert ids() == ["d0", "d1", "d2", "d4", "d6", "d7"]
    assert ids(first=2, end=7) == ["d2", "d4", "d6"] and ids(first=2, most=2) == ["d2", "d4"]
    assert A.scan_fragments(spark, f"{tmp_path}/m.jsonl").where("doc_id = 'd4'").first().phenomenon == 0


def test_answers(spark, tmp_path):
    queries = spark.createDataFrame([("q1", "one?"), ("q2", "two?")], "query_id string, query string")
    docs = spark.createDataFrame([("q1", 2, "b", 0.12345678, 1), ("q1", 1, "a", 0.9, 2)], "query_id string, place int, doc_id string, score double, n_fragments long")
    parts = spark.createDataFrame([("q1", 1, "a-c0001", "a", 0.9)], "query_id string, place int, chunk_id string, doc_id string, score double")
    rows = A.result_rows(queries, docs, parts)
    A.write_results(rows, f"{tmp_path}/r")
    said = [json.loads(r.value) for r in spark.read.text(f"{tmp_path}/r").collect()]
    assert [x["puesto"] for x in said[0]["documentos"]] == [1, 2] and said[0]["documentos"][1]["score"] == 0.123457
    assert said[1]["documentos"] == [] and "fragmentos" not in said[1]
    read = A.read_results(spark, f"{tmp_path}/r")
    assert {(r.kind, r.rank, r.item) for r in read.collect()} == {("document", 1, "a"), ("document", 2, "b"), ("fragment", 1, "a-c0001")}
    (tmp_path / "twice.jsonl").write_text('{"query_id": "q1"}\n{"query_id": "q1"}\n', encoding="utf-8")
    with pytest.raises(ValueError, match="not unique"):
        A.read_results(spark, f"{tmp_path}/twice.jsonl")
    (tmp_path / "t.json").write_text(json.dumps([{"question_id": "q1", "relevant_chunks": [{"rank": 1, "chunk_id": "a-c0001"}, {"rank": 2, "chunk_id": "a-c0002"}]}]), encoding="utf-8")
    truth = A.read_truth(spark, f"{tmp_path}/t.json")
    assert {(r.item, r.rank, r.doc_id) for r in truth.collect()} == {("a-c0001", 1, "a"), ("a-c0002", 2, "a")}
    (tmp_path / "odd.json").write_text(json.dumps([{"question_id": "q1", "relevant_chunks": [{"rank": 1, "chunk_id": "odd"}]}]), encoding="utf-8")
    with pytest.raises(Exception, match="not a fragment id"):
        A.read_truth(spark, f"{tmp_path}/odd.json").collect()


def test_small_files(spark, tmp_path):
    table = spark.createDataFrame([(120, 0, "a|b"), (190, 1, None)], "target int, overlap int, note string")
    assert A.markdown(table).splitlines() == ["| target | overlap | note |", "| --- | --- | --- |", "| 120 | 0 | a\\|b |", "| 190 | 1 |  |"]
    A.write_report(spark, {"b": 1, "a": "é"}, f"{tmp_path}/r.json")
    assert (tmp_path / "r.json").read_text(encoding="utf-8") == '{\n  "a": "é",\n  "b": 1\n}\n'
    nodes = spark.createDataFrame([("a", "A & B", "ORG", 3)], "node string, name string, kind string, mentions long")
    edges = spark.createDataFrame([("a", "firma", "a", 2)], "a string, relation string, b string, weight long")
    A.write_graphml(nodes, edges, f"{tmp_path}/g")
    A.join_parts(spark, f"{tmp_path}/g", f"{tmp_path}/g.xml")
    xml = (tmp_path / "g.xml").read_text(encoding="utf-8")
    assert '<node id="A &amp; B">' in xml and ">2</data></edge>" in xml
    A.write_partial(nodes, edges, nodes.limit(0), f"{tmp_path}/p")
    assert A.read_partial(spark, f"{tmp_path}/p")[1].first().weight == 2
    (tmp_path / "x.jsonl").write_text("1\n2\n", encoding="utf-8")
    assert A.bundle(spark, {"x.jsonl": f"{tmp_path}/x.jsonl"}, f"{tmp_path}/d") == {"x.jsonl": 2}
    with pytest.raises(ValueError):
        A.bundle(spark, {"y": f"{tmp_path}/y"}, f"{tmp_path}/d")


def uneven(folder, sizes):
    """Parts whose sizes rise, so that Spark packs them in another order than their names'."""
    folder.mkdir()
    lines, at = [], 0
    for part, n in enumerate(sizes):
        own = [json.dumps({"doc_id": f"d{at + k}", "chunk_id": f"c{at + k}", "texto": f"t{at + k} " + "é" * (part * 40), "texto_enriquecido": "e", "posicion": at + k}, ensure_ascii=False) for k in range(n)]
        (folder / f"part-{part:05d}").write_text("".join(f"{x}\n" for x in own), encoding="utf-8")
        lines += own
        at += n
    return lines


def test_lines_of_uneven_parts_are_in_name_order(spark, tmp_path):
    lines = uneven(tmp_path / "parts", (3, 40, 5, 300, 120, 1))
    for size in ("512", "4096", "128m"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            got = L.numbered_lines(spark, f"{tmp_path}/parts").orderBy("line").collect()
            assert [(r.line, r.value) for r in got] == list(enumerate(lines))
            index = L.line_index(spark, f"{tmp_path}/parts", 700)
            entries = index.orderBy("first").collect()
            assert sum(e.lines for e in entries) == len(lines) and all(a["first"] + a["lines"] == b["first"] for a, b in zip(entries, entries[1:], strict=False))
            some = spark.createDataFrame([(0,), (2,), (3,), (3,), (47,), (48,), (468,), (469,), (-1,), (None,)], "line long")
            assert sorted(map(tuple, L.lines_at(index, some).collect())) == [(k, lines[k]) for k in (0, 2, 3, 47, 48, 468)]
            assert [tuple(r) for r in L.line_range(index, 40, 350).orderBy("line").collect()] == [(k, lines[k]) for k in range(40, 350)]
            frame = A.read_fragments(spark, f"{tmp_path}/parts")
            assert frame.where("row_id <> position OR doc_id <> concat('d', row_id)").count() == 0 and frame.count() == len(lines)
            assert [r.doc_id for r in A.scan_fragments(spark, f"{tmp_path}/parts", 41, 45).orderBy("line").collect()] == ["d41", "d42", "d43", "d44"]
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_few_lines_are_read_by_few_bytes(spark, tmp_path, monkeypatch):
    uneven(tmp_path / "parts", (200, 3000))
    index = L.line_index(spark, f"{tmp_path}/parts", 2000)
    wanted = spark.createDataFrame([(7,), (8,), (2900,)], "row_id long")
    read = []
    monkeypatch.setattr(L, "_lines_of", lambda entries: read.extend(entries.collect()))
    L.lines_at(index, wanted, "row_id")
    assert len(read) == 2 and sum(r["bytes"] for r in read) < 2 * 3000 and sorted(n for r in read for n in r["wanted"]) == [7, 8, 2900]


def test_blank_and_carriage_returned_lines(spark, tmp_path):
    (tmp_path / "a.jsonl").write_bytes("x\r\n\r\n \té\n\nlast".encode())
    assert [tuple(r) for r in L.numbered_lines(spark, f"{tmp_path}/a.jsonl").orderBy("line").collect()] == [(0, "x"), (1, ""), (2, " \té"), (3, ""), (4, "last")]
    assert [tuple(r) for r in L.numbered_lines(spark, f"{tmp_path}/a.jsonl", blank=False).orderBy("line").collect()] == [(0, "x"), (1, " \té"), (2, "last")]
    assert [tuple(r) for r in L.line_range(L.line_index(spark, f"{tmp_path}/a.jsonl"), 0).orderBy("line").collect()] == [(0, "x"), (1, ""), (2, " \té"), (3, ""), (4, "last")]
    (tmp_path / "none.jsonl").write_bytes(b"")
    assert L.line_index(spark, f"{tmp_path}/none.jsonl").count() == 0


def test_manifest_of_several_parts_keeps_its_order(spark, tmp_path):
    names = [f"n{(k * 37) % 101:03d}" for k in range(101)]
    write(tmp_path, [document(n) for n in names])
    (tmp_path / A.MANIFEST).mkdir()
    for part, (a, z) in enumerate(((0, 2), (2, 60), (60, 64), (64, 101))):
        (tmp_path / A.MANIFEST / f"part-{part}").write_text("".join(json.dumps({"doc_id": n}) + "\n" for n in names[a:z]))
    assert [r.doc_id for r in A.read_documents(spark, str(tmp_path)).orderBy("place").collect()] == names


def test_graphml_in_ordered_parts(spark, tmp_path):
    import xml.etree.ElementTree as tree

    nodes = spark.range(3000).select(F.format_string("n%05d", "id").alias("node"), F.format_string('N "%d" <é>', "id").alias("name"), F.when(F.col("id") % 2 == 0, "ORG").alias("kind"), F.array(F.lit(1), F.lit(2)).alias("phenomena"))
    edges = spark.range(2999).select(F.format_string("n%05d", "id").alias("a"), F.lit("firma").alias("relation"), F.format_string("n%05d", F.col("id") + 1).alias("b"), (F.col("id") * 2).alias("weight"))
    edges = edges.unionByName(spark.createDataFrame([("n00000", "apoya", "gone", 1)], edges.schema))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        manifest = A.write_graphml(nodes.repartition(5), edges.repartition(3), f"{tmp_path}/g")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(manifest["parts"]) > 2
    assert A.join_parts(spark, f"{tmp_path}/g", f"{tmp_path}/g.xml") == manifest["bytes"] == (tmp_path / "g.xml").stat().st_size
    space = "{http://graphml.graphdrawing.org/xmlns}"
    graph = tree.parse(tmp_path / "g.xml").getroot().find(f"{space}graph")
    names = [n.get("id") for n in graph.iter(f"{space}node")]
    assert names == [f'N "{k}" <é>' for k in range(3000)] and [len(n) for n in graph.iter(f"{space}node")][:2] == [2, 1]
    ends = [(e.get("source"), e.get("target")) for e in graph.iter(f"{space}edge")]
    assert ends[0] == (names[0], "gone") and ends[1:] == list(zip(names, names[1:], strict=False))
    (tmp_path / "g" / A.PARTS).unlink()
    with pytest.raises(ValueError, match="no finished file"):
        A.join_parts(spark, f"{tmp_path}/g", f"{tmp_path}/again.xml")
