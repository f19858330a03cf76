import io
import struct
import zipfile

import pytest
from pyspark.sql import functions as F

from quernstone.sources import images, inventory, tiles
from quernstone.sources.extract import extract_files, feature_text, from_image, from_json, from_tile, scan_files
from quernstone.sources.sheets import sheets

HEADER = ["Fenómeno", "Observatorio", "Código Observatorio", "DOC_ID", "Nombre estandarizado", "Carpeta", "Tipo"]
ROWS = [["F1", "Obs A", "OA", "F1-OA-001", "a.txt", "F1_x/in", "TXT"], ["f2", "Obs B", "OB", "F2-OB-001", "a.txt", "F2_y\\deep", "TXT"], [None] * 7, ["F3", "Obs C", "OC", "F3-OC-001", "c.csv", "", "CSV"]]


def workbook(tables, styles=""):
    """An XLSX whose first sheet is stored last, so that only relations tell them apart."""
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        n = len(tables)
        listed = "".join(f'<sheet name="{name}" sheetId="{k}" r:id="r{k}"/>' for k, name in enumerate(tables))
        z.writestr("xl/workbook.xml", f'<workbook {main} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets>{listed}</sheets></workbook>')
        links = "".join(f'<Relationship Id="r{k}" Target="worksheets/sheet{n - k}.xml"/>' for k in range(n))
        z.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{links}</Relationships>')
        if styles:
            z.writestr("xl/styles.xml", f"<styleSheet {main}>{styles}</styleSheet>")
        for k, rows in enumerate(tables.values()):
            body = ""
            for i, row in enumerate(rows, 1):
                cells = "".join(v if str(v).startswith("<c") else f'<c r="{chr(65 + j)}{i}" t="inlineStr"><is><t>{v}</t></is></c>' for j, v in enumerate(row) if v is not None)
                body += f'<row r="{i}">{cells}</row>'
            z.writestr(f"xl/worksheets/sheet{n - k}.xml", f"<worksheet {main}><sheetData>{body}</sheetData></worksheet>")
    return out.getvalue()


def saved(tmp_path, rows, header=HEADER, sheet=inventory.SHEET):
    (tmp_path / "index.xlsx").write_bytes(workbook({"Other": [["x"]], sheet: [header, *rows]}))
    return f"{tmp_path}/index.xlsx"


def test_typed_cells():
    styles = '<numFmts><numFmt numFmtId="170" formatCode="dd/mm/yyyy"/></numFmts><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="170"/></cellXfs>'
    row = ['<c r="A1" s="1"><v>45000</v></c>', '<c r="B1" s="2"><v>45000.5</v></c>', '<c r="C1" t="b"><v>1</v></c>', '<c r="E1"><v>3.0</v></c>']
    (name, rows), _ = sheets(workbook({"One": [row], "Two": [["z"]]}, styles))
    assert name == "One"
    assert [inventory.cell_text(v) for v in rows[0]] == ["2023-03-15", "2023-03-15 12:00:00", "True", "", "3"]


def test_inventory(spark, tmp_path):
    got = {r.doc_id: r for r in inventory.read_inventory(spark, saved(tmp_path, ROWS)).collect()}
    assert {k: (r.relative, r.phenomenon) for k, r in got.items()} == {"F1-OA-001": ("F1_x/in/a.txt", 1), "F2-OB-001": ("F2_y/deep/a.txt", 2), "F3-OC-001": ("c.csv", 3)}
    order = [4, 0, 6, 2, 5, 1, 3]
    again = inventory.read_inventory(spark, saved(tmp_path, [[r[k] for k in order] for r in ROWS], [f" {HEADER[k]} " for k in order]))
    assert {r.doc_id for r in again.collect()} == set(got)


@pytest.mark.parametrize(
    ("change", "message"),
    [((0, "F9"), "an unknown phenomenon"), ((1, " "), "Observatorio is empty"), ((3, "a/b"), "cannot name a file"), ((3, "F2-OB-001"), "not unique"), ((4, None), "Nombre estandarizado is empty")],
)
def test_bad_inventories(spark, tmp_path, change, message):
    rows = [list(r) for r in ROWS]
    rows[0][change[0]] = change[1]
    with pytest.raises(Exception, match=message):
        inventory.read_inventory(spark, saved(tmp_path, rows)).collect()


def test_bad_sheets(spark, tmp_path):
    with pytest.raises(ValueError, match="lacks columns"):
        inventory.read_inventory(spark, saved(tmp_path, [], HEADER[:-1]))
    with pytest.raises(ValueError, match="no sheet"):
        inventory.read_inventory(spark, saved(tmp_path, ROWS, sheet="Else"))
    twice = [ROWS[0], [*ROWS[0][:3], "F1-OA-002", *ROWS[0][4:]]]
    with pytest.raises(ValueError, match="relative is not unique"):
        inventory.read_inventory(spark, saved(tmp_path, twice))


def test_identity_and_coverage(spark, tmp_path):
    root = tmp_path / "corpus"
    for name in ("F1_x/in/a.txt", "F2_y/other/a.txt", "fenomeno_3/b.txt", "plain/c.txt", "F1_x/odd.docx", "._x.txt"):
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_text(f"text of {name}", encoding="utf-8")
    index = inventory.read_inventory(spark, saved(tmp_path, ROWS))
    c = inventory.cover(scan_files(spark, str(root)), index)
    assert [r.relative for r in c.without_extractor.collect()] == ["F1_x/odd.docx"]
    assert {r.relative for r in c.orphans.collect()} == {"F2_y/deep/a.txt", "c.csv"}
    assert {r.relative for r in c.outside.collect()} == {"F2_y/other/a.txt", "fenomeno_3/b.txt", "plain/c.txt"}
    assert [(r.doc_id, r.phenomenon, r.id_origin) for r in c.identity.collect()] == [("F1-OA-001", 1, "indice")]
    free = inventory.cover(scan_files(spark, str(root)), None, 2)
    got = {r.relative: (r.phenomenon, r.phenomenon_origin, r.ambiguous_name) for r in free.identity.collect()}
    assert got == {"F1_x/in/a.txt": (1, "carpeta", True), "F2_y/other/a.txt": (2, "carpeta", True), "fenomeno_3/b.txt": (3, "carpeta", False), "plain/c.txt": (2, "defecto", False)}
    assert inventory.collision_notice(free.identity).startswith("1 file name on 2 paths")
    assert inventory.collision_notice(c.identity) is None
    counts = {(r.what, r.kind): r.n for r in free.report().collect()}
    assert counts["phenomenon by origin", "carpeta"] == 3 and counts["files with such a name", ""] == 2 and counts["in the index, not on disk", ""] == 0
    empty = inventory.cover(scan_files(spark, str(root)), index.limit(0))
    assert empty.identity.count() == 0 and empty.outside.count() == 4
    docs = inventory.with_identity(extract_files(spark, str(root)), c.identity).collect()
    assert [(d.doc_id, d.source, d.meta["observatorio"], d.meta["fuente_ambigua"]) for d in docs] == [("F1-OA-001", "a.txt", "Obs A", "false")]
    with pytest.raises(ValueError):
        scan_files(spark, f"{tmp_path}/none")


# Tiles and images


def varint(n):
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def field(number, value):
    return varint(number << 3) + varint(value) if isinstance(value, int) else varint(number << 3 | 2) + varint(len(value)) + value


def tile():
    keys = [b"fid", b"name", b"flag", b"off", b"area"]
    values = [field(4, 12), field(1, "Río".encode()), field(7, 1), field(1, b"FALSO"), varint(3 << 3 | 1) + struct.pack("<d", 2.5), field(6, 3), field(4, 2)]
    features = [[0, 0, 1, 1, 2, 2, 3, 3, 4, 4], [0, 6, 1, 1]]
    layer = field(15, 2) + field(1, b"zones") + b"".join(field(2, field(2, bytes(f))) for f in features) + b"".join(field(3, k) for k in keys) + b"".join(field(4, v) for v in values)
    return field(3, layer) + field(3, field(1, b"empty"))


def test_tiles(spark, tmp_path):
    assert tiles.layers(tile()) == {"zones": [{"fid": 12, "name": "Río", "flag": True, "off": "FALSO", "area": 2.5}, {"fid": 2, "name": "Río"}], "empty": []}
    blocks, meta, errors = from_tile(tile(), "1.pbf")
    assert [b["text"] for b in blocks] == ["zones", "fid: 2 | name: Río", "area: 2.5 | fid: 12 | flag: True | name: Río"]
    assert meta == {"layers": "zones", "n_features": "2"} and not errors and blocks[1]["path"] == ["zones"]
    assert from_tile(b"\x0a\x09OSMHeader", "x")[2] == ["a map dump, not a vector tile"]
    assert feature_text({"a": False, " ": "x", "b": "https://x.y/z"}) == ""
    assert [p.get("fid") for p in tiles.in_order([{"fid": "b"}, {}, {"fid": 3}, {"fid": "a"}, {"fid": 1}])] == [1, 3, None, "a", "b"]
    folder = tmp_path / "tiles/6/17"
    folder.mkdir(parents=True)
    (folder / "OBS_31.pbf").write_bytes(tile())
    (folder / "broken.pbf").write_bytes(b"\x1a\xff\x01")
    rows = {r.source: r for r in extract_files(spark, f"{tmp_path}/tiles").collect()}
    good = rows["OBS_31.pbf"]
    assert good.meta["zoom"] == "6" and good.meta["tile_y"] == "31" and good.meta["bbox"].startswith("[-84.375,")
    assert rows["broken.pbf"].blocks == [] and rows["broken.pbf"].errors
    assert tiles.place_of("a/b/c.pbf") is None and tiles.place_of("3/4/x.pbf") == (3, 4, None)


def test_images(spark):
    tags = struct.pack("<2sHI", b"II", 42, 8) + struct.pack("<H", 2) + struct.pack("<HHII", 34665, 4, 1, 40) + struct.pack("<HHII", 34853, 4, 1, 99) + struct.pack("<I", 0)
    tags = tags.ljust(40, b"\0") + struct.pack("<H", 1) + struct.pack("<HHII", 36867, 2, 20, 60)
    tags = tags.ljust(60, b"\0") + b"2024:01:02 03:04:05\0"
    app = b"Exif\0\0" + tags
    jpeg = b"\xff\xd8\xff\xe1" + struct.pack(">H", len(app) + 2) + app + b"\xff\xc0" + struct.pack(">HBHHB", 17, 8, 30, 40, 3)
    png = b"\x89PNG\r\n\x1a\n" + struct.pack(">I4sIIBBBBBI", 13, b"IHDR", 7, 9, 8, 6, 0, 0, 0, 0)
    assert images.header(png) == {"width": "7", "height": "9", "image_format": "PNG", "mode": "RGBA"}
    assert images.header(jpeg) == {"width": "40", "height": "30", "image_format": "JPEG", "mode": "RGB", "captured": "2024:01:02 03:04:05", "has_place": "true"}
    blocks, meta, errors = from_image(png, "x.png")
    assert blocks == [] and meta["needs_recognition"] == "true" and errors
    assert images.noted(b"II*\0\xff\xff\xff\xff") == {}
    with pytest.raises(ValueError):
        images.header(b"nothing")


def test_article_metadata():
    import json

    article = {"title": "T", "authors": ["A", "B", "A"], "keywords": ["k"], "tags": ["k", " l "], "links": [1, 2], "alerta_meta": {"codigo": "7", "deep": {}}, "body_text": "A long text here"}
    _, meta, errors = from_json(json.dumps(article).encode(), "x.json")
    assert json.loads(meta["authors"]) == ["A", "B"] and json.loads(meta["tags"]) == ["k", "l"] and meta["n_links"] == "2" and json.loads(meta["alerta_meta"]) == {"codigo": "7"} and not errors
    assert [from_json(x, "x")[2] for x in (b"[]", b"{}", b"3")] == [["an empty list"], ["an empty object"], ["a lone int, not a document"]]


def test_rows_keep_what_is_not_indexed(spark, tmp_path):
    (tmp_path / "p.csv").write_text("PMID,Title,Authors,Citation,Journal/Book,Publication Year\n7,A title,An author,Cited,A journal,2020\n", encoding="utf-8")
    block = extract_files(spark, str(tmp_path)).select(F.explode("blocks").alias("b")).first().b
    assert block.text == "Title: A title | Authors: An author | Journal/Book: A journal | Publication Year: 2020" and block.data == {"PMID": "7", "Citation": "Cited"}


def box(kind, *parts):
    body = b"".join(parts)
    return (8 + len(body)).to_bytes(4, "big") + kind + body


def avif(exif=b"", large=False, primary=2):
    """Two items: a thumbnail and the primary one; properties 1 to 3; tags as an item where given."""
    full = lambda kind, version, flags, *parts: box(kind, bytes([version]) + flags.to_bytes(3, "big"), *parts)
    short = lambda n: n.to_bytes(2, "big")
    long = lambda n: n.to_bytes(4, "big")
    ispe = lambda w, h: full(b"ispe", 0, 0, long(w), long(h))
    number = short if large else lambda n: bytes([n])
    ipma = full(b"ipma", 0, int(large), long(2), short(1), b"\x01", number(1), short(2), b"\x02", number(2 | (0x8000 if large else 0x80)), number(3))
    iprp = box(b"iprp", box(b"ipco", ispe(16, 12), ispe(640, 480), full(b"pixi", 0, 0, b"\x04\x08\x08\x08\x08")), ipma)
    infe = lambda n, kind: full(b"infe", 2, 0, short(n), short(0), kind, b"\0")
    items = [infe(1, b"av01"), infe(2, b"av01"), *([infe(3, b"Exif")] if exif else [])]
    start = box(b"ftyp", b"mif1", long(0), b"avif", b"miaf")
    payload = long(0) + exif

    def meta(at):
        iloc = full(b"iloc", 0, 0, b"\x44\x00", short(1 if exif else 0), *([short(3), short(0), short(1), long(at), long(len(payload))] if exif else []))
        return full(b"meta", 0, 0, full(b"pitm", 0, 0, short(primary)), full(b"iinf", 0, 0, short(len(items)), *items), iloc, iprp)

    return start + meta(len(start) + len(meta(0)) + 8) + box(b"mdat", payload)


def test_avif_boxes():
    tags = b"MM\0*\0\0\0\x08\0\x02" + b"\x87\x69\0\x04\0\0\0\x01\0\0\0\x26" + b"\x88\x25\0\x04\0\0\0\x01\0\0\0\x00" + b"\0\0\0\0" + b"\0\x01" + b"\x90\x03\0\x02\0\0\0\x14\0\0\0\x38" + b"\0\0\0\0" + b"2024:01:02 03:04:05\0"
    for large in (False, True):
        assert images.header(avif(large=large)) == {"width": "640", "height": "480", "image_format": "AVIF", "mode": "RGBA"}
        assert images.header(avif(tags, large)) == {"width": "640", "height": "480", "image_format": "AVIF", "mode": "RGBA", "captured": "2024:01:02 03:04:05", "has_place": "true"}
    assert images.header(avif(primary=1))["width"] == "16"
    with pytest.raises(ValueError):
        images.header(avif()[:60])
    with pytest.raises(ValueError):
        images.header(box(b"ftyp", b"heic", bytes(4)))
