import io
import json
import zipfile

import pytest

from quernstone.sources import extract as X
from quernstone.sources.queries import queries_of_text, read_queries
from quernstone.sources.keyed import KeyedTable
from quernstone.streaming.ingest import ingest


def texts(found):
    return [(b["text"], b["kind"], b["path"]) for b in found[0]]


def test_markdown():
    data = b"SOURCE: http://x.y\nSCRAPED: 2024\n==========\n# Uno\n\npar a\nsigue\n\n## Dos\n- item\n\n```\n# no\n```\n\n12\n"
    found = X.from_text(data, "a.md")
    assert texts(found) == [("Uno", "title", []), ("par a sigue", "paragraph", ["Uno"]), ("Dos", "title", ["Uno"]), ("item", "list", ["Uno", "Dos"]), ("# no", "paragraph", ["Uno", "Dos"])]
    assert found[1] == {"source": "http://x.y", "scraped": "2024"}
    assert X.from_text(b"a\0b", "a.txt")[2] == ["binary data, not text"]
    pages = "\f".join(f"pie\n\ntexto {k} propio" for k in "abc")
    assert [b["text"] for b in X.from_text(pages.encode(), "a.txt")[0]] == [f"texto {k} propio" for k in "abc"]


def test_csv_and_caps(monkeypatch):
    found = X.from_csv("país;año;url\nPerú;2024;http://a.b/c\n;;\nChile;2023;x".encode("cp1252"), "a.csv")
    assert [b["text"] for b in found[0]] == ["país: Perú | año: 2024", "país: Chile | año: 2023 | url: x"] and found[1]["delimiter"] == ";"
    monkeypatch.setattr(X, "ROW_CAP", 3)
    found = X.from_csv(b"a,b\n" + b"".join(b"x,%d\n" % i for i in range(5)), "a.csv")
    assert len(found[0]) == 3 and found[2] == ["2 rows beyond the first 3 are left out"]
    known = X.from_csv(b"pmid,title,journal,extra\n1,Titulo,Revista,zz\n", "a.csv")
    assert [b["text"] for b in known[0]] == ["title: Titulo | journal: Revista"] and known[1]["schema"] == "litcovid"


def test_json_shapes():
    load = lambda v: X.from_json(json.dumps(v).encode(), "a.json")
    article = load({"title": "T", "abstract": "Un resumen", "body_paragraphs": ["p uno", "http://x.y"], "body_text": "no", "sections": [{"heading": "S", "paragraphs": ["p dos"]}], "doi": "10.1/x"})
    assert texts(article) == [("T", "title", []), ("Un resumen", "paragraph", ["T"]), ("p uno", "paragraph", ["T"]), ("S", "title", ["T"]), ("p dos", "paragraph", ["T", "S"])]
    geo = load({"type": "FeatureCollection", "features": [{"properties": {"b": 1, "a": "x"}, "geometry": {"coordinates": [[[1, 2], [3, -4]]]}}]})
    assert [b["text"] for b in geo[0]] == ["a: x | b: 1"] and json.loads(geo[1]["bbox"]) == [1, -4, 3, 2]
    assert [b["text"] for b in load([{"a": 1, "b": "x"}, "una frase"])[0]] == ["a: 1 | b: x", "una frase"]
    tree = load({"z": {"k": ["hola mundo", "http://a.b"]}, "a": "otra frase"})
    assert texts(tree) == [("a", "title", []), ("otra frase", "paragraph", ["a"]), ("z", "title", []), ("k", "title", ["z"]), ("0", "title", ["z", "k"]), ("hola mundo", "paragraph", ["z", "k", "0"])]
    assert load([])[2] == ["an empty list"] and X.from_json(b"{", "a.json")[2][0].startswith("not JSON")


def workbook():
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", f"<workbook {ns}><sheets><sheet name='Hoja'/><sheet name='Vacía'/></sheets></workbook>")
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}><si><t>país</t></si><si><t>Perú</t></si></sst>")
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {ns}><sheetData><row><c r='A1' t='s'><v>0</v></c><c r='C1' t='inlineStr'><is><t>n</t></is></c></row><row><c r='A2' t='s'><v>1</v></c><c r='C2'><v>3.0</v></c></row></sheetData></worksheet>")
        z.writestr("xl/worksheets/sheet2.xml", f"<worksheet {ns}><sheetData/></worksheet>")
    return out.getvalue()


def test_xlsx():
    assert texts(X.from_xlsx(workbook(), "a.xlsx")) == [("Hoja", "title", []), ("país: Perú | n: 3", "row", ["Hoja"])]


def test_extract_files(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "uno.txt").write_text("El informe de la agencia sobre el espacio.")
    (tmp_path / "sub" / "dos.csv").write_text("a,b\nx,1\n")
    (tmp_path / "sub" / "tres.xlsx").write_bytes(b"broken")
    (tmp_path / "sub" / "cuatro.pdf").write_bytes(b"%PDF")
    (tmp_path / ".DS_Store").write_bytes(b"x")
    (tmp_path / "nada.zzz").write_bytes(b"x")
    listed = {r.relative: r.format for r in X.scan_files(spark, str(tmp_path)).collect()}
    assert listed == {"uno.txt": "txt", "sub/dos.csv": "csv", "sub/tres.xlsx": "xlsx", "sub/cuatro.pdf": "pdf", "nada.zzz": None}
    docs = {r.path: r for r in X.extract_files(spark, str(tmp_path)).collect()}
    assert set(docs) == set(listed) - {"nada.zzz"} and docs["uno.txt"].language == "es"
    assert [b.text for b in docs["sub/dos.csv"].blocks] == ["a: x | b: 1"]
    assert docs["sub/tres.xlsx"].blocks == [] and "BadZipFile" in docs["sub/tres.xlsx"].errors[0]
    summary = {r.path: (r.n_blocks, r.n_errors) for r in X.manifest(X.extract_files(spark, str(tmp_path))).collect()}
    assert summary["sub/cuatro.pdf"] == (0, 1) and summary["uno.txt"] == (1, 0)


def test_queries(spark, tmp_path):
    text = lambda t: [tuple(r) for r in queries_of_text(spark.createDataFrame([(t,)], "value string")).collect()]
    assert text("intro\nq001. uno\nsigue\n Q 02) dos") == [("q001", "uno sigue"), ("q02", "dos")]
    assert text("una\n\n  otra  cosa") == [("q001", "una"), ("q002", "otra cosa")]
    with pytest.raises(ValueError, match="not unique"):
        text("q1: a\nq1: b")
    path = tmp_path / "q.jsonl"
    path.write_text('{"id": "a", "pregunta": "hola  tu"}\n{"query_id": "b", "text": "x"}\n')
    assert [tuple(r) for r in read_queries(spark, str(path)).collect()] == [("a", "hola tu"), ("b", "x")]


def test_incremental_ingest(spark, tmp_path):
    source, root, check = (str(tmp_path / n) for n in ("in", "table", "check"))
    schema = "k int, v string, at int"
    for rows in ([(1, "a", 1), (2, "b", 1)], [(2, "c", 2), (2, "d", 3), (3, "e", 1)]):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(source)
        table = KeyedTable(spark, root, "k", 8)
        ingest(spark.readStream.schema(schema).parquet(source), table, check, "at").awaitTermination()
    assert table.versions() == [1, 2] and sorted(map(tuple, table.read(1).collect())) == [(1, "a", 1), (2, "b", 1)]
    assert sorted(map(tuple, table.read().collect())) == [(1, "a", 1), (2, "d", 3), (3, "e", 1)]
