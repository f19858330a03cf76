import base64
import zlib

import pytest
from pyspark.sql import functions as F

from quernstone.sources import pdf
from quernstone.sources import pdf_streams as streams
from quernstone.sources.extract import extract_files
from quernstone.sources.queries import read_queries


def file(*pages, fonts=b"", packed=False, extra=b""):
    """A PDF of content streams; objects 3 and 4 are its first font and its Unicode map."""
    n = len(pages)
    kids = b" ".join(b"%d 0 R" % (10 + 2 * k) for k in range(n))
    objects = [
        b"1 0 obj << /Type /Catalog /Pages 2 0 R >> endobj",
        b"2 0 obj << /Type /Pages /Kids [%s] /Count %d /MediaBox [0 0 600 800] /Resources << /Font << /F1 3 0 R /F2 5 0 R >> >> >> endobj" % (kids, n),
        b"3 0 obj << /Type /Font /Subtype /Type1 /Encoding << /Differences [64 /uni00E9 /A] >> >> endobj",
        fonts,
    ]
    for k, body in enumerate(pages):
        data = zlib.compress(body) if packed else body
        head = b"<< /Length %d%s >>" % (len(data), b" /Filter /FlateDecode" if packed else b"")
        objects += [b"%d 0 obj << /Type /Page /Parent 2 0 R /Contents %d 0 R >> endobj" % (10 + 2 * k, 11 + 2 * k), b"%d 0 obj %s stream\n%s\nendstream endobj" % (11 + 2 * k, head, data)]
    return b"%PDF-1.4\n" + b"\n".join(objects) + extra + b"\n%%EOF"


def said(data):
    return [(n, [w["text"] for w in words]) for n, _, words in pdf.pages(data)]


@pytest.mark.parametrize("packed", [False, True])
def test_words(packed):
    one = b"BT /F1 10 Tf 50 700 Td (Hello \\(nested (brackets\\) )world) Tj 0 -14 Td [(sp) -20 (lit) -900 (gap)] TJ ET % note"
    two = b"q 2 0 0 2 0 0 cm BT /F1 6 Tf 1 0 0 1 30 300 Tm <48692040> Tj T* 12 TL (x) ' ET Q BT /F1 8 Tf 10 10 Td (low) Tj ET"
    assert said(file(one, two, b"", packed=packed)) == [(1, ["Hello", "(nested", "(brackets)", ")world"][:2] + ["(brackets)", ")world"] + ["split", "gap"]), (2, ["Hi", "é", "x", "low"]), (3, [])]
    words = {w["text"]: w for _, _, ws in pdf.pages(file(one, two, packed=packed)) for w in ws}
    assert (words["Hello"]["x0"], words["Hello"]["bottom"], words["Hello"]["size"]) == (50, 100, 10)
    assert (words["Hi"]["x0"], words["Hi"]["size"], words["Hi"]["bottom"]) == (60, 12, 200)


def test_composite_fonts():
    body = b"1 beginbfchar <0001> <0041> endbfchar 1 beginbfrange <0002> <0004> <0062> endbfrange 1 beginbfrange <0005> <0006> [<00660069> <0078>] endbfrange"
    fonts = b"5 0 obj << /Type /Font /Subtype /Type0 /ToUnicode 4 0 R /DescendantFonts [6 0 R] >> endobj 6 0 obj << /DW 600 /W [1 [700 500] 3 4 400] >> endobj 4 0 obj << /Length %d >> stream\n%s\nendstream endobj" % (len(body), body)
    data = file(b"BT /F2 10 Tf 0 0 Td <000100020003000500060009> Tj ET", fonts=fonts)
    assert said(data) == [(1, ["Abcfix(cid:9)"])]
    (_, _, (word,)), = pdf.pages(data)
    assert word["x1"] == pytest.approx(7 + 5 + 4 + 6 + 6 + 6)


def test_objects_in_streams_and_refusals():
    inner = b"20 0 21 29 << /Type /Catalog /Pages 2 0 R >> << /Odd true >>"
    head = len(b"20 0 21 29 ")
    packed = zlib.compress(inner)
    data = file(b"BT /F1 9 Tf (in) Tj ET").replace(b"1 0 obj << /Type /Catalog /Pages 2 0 R >> endobj", b"7 0 obj << /Type /ObjStm /N 2 /First %d /Length %d /Filter /FlateDecode >> stream\n%s\nendstream endobj" % (head, len(packed), packed))
    assert said(data) == [(1, ["in"])]
    for bad in (b"no pdf", b"%PDF-1.4 trailer << /Encrypt 9 0 R >>", b"%PDF-1.4 nothing"):
        with pytest.raises(ValueError):
            list(pdf.pages(bad))


def test_documents(spark, tmp_path):
    text = lambda y, size, t: b"BT /F1 %d Tf 50 %d Td (%s) Tj ET\n" % (size, y, t)
    body = text(760, 20, b"A report") + text(720, 10, b"The first line of a paragraph of some length") + text(708, 10, b"and its second line, which goes on a little.") + text(670, 14, b"Part") + text(650, 10, b"More text here, enough for a page of its own.")
    (tmp_path / "good.pdf").write_bytes(file(body, text(760, 10, b"The second page ends the report with words.")))
    (tmp_path / "scan.pdf").write_bytes(file(b"", b""))
    (tmp_path / "bad.pdf").write_bytes(b"nothing")
    (tmp_path / "note.txt").write_text("plain", encoding="utf-8")
    rows = {r.source: r for r in extract_files(spark, str(tmp_path)).collect()}
    assert len(rows) == 4 and rows["note.txt"].blocks[0].text == "plain"
    assert [(b.text, b.kind, b.level, b.path, b.page) for b in rows["good.pdf"].blocks] == [
        ("A report", "title", 1, [], 1),
        ("The first line of a paragraph of some length and its second line, which goes on a little.", "paragraph", None, ["A report"], 1),
        ("Part", "title", 2, ["A report"], 1),
        ("More text here, enough for a page of its own.", "paragraph", None, ["A report", "Part"], 1),
        ("The second page ends the report with words.", "paragraph", None, ["A report", "Part"], 2),
    ]
    assert rows["good.pdf"].errors == [] and rows["good.pdf"].meta == {"n_pages": "2"}
    assert rows["scan.pdf"].errors == ["2 pages without readable text, and no recogniser"] and rows["scan.pdf"].meta["needs_recognition"] == "true"
    assert rows["bad.pdf"].blocks == [] and rows["bad.pdf"].errors[0].startswith("ValueError")

    def recognise(pages):
        return pages.select("doc_id", "page", F.lit(0).alias("line"), F.concat(F.lit("seen on page "), F.col("page").cast("string")).alias("text"), F.lit(88.0).alias("conf"))

    again = {r.source: r for r in extract_files(spark, str(tmp_path), recognise).collect()}
    assert [(b.text, b.kind, b.page) for b in again["scan.pdf"].blocks] == [("seen on page 1", "ocr", 1), ("seen on page 2", "ocr", 2)] and again["scan.pdf"].errors == []


def test_queries_in_a_pdf(spark, tmp_path):
    body = b"BT /F1 10 Tf 14 TL 50 700 Td (q001. What is a) Tj T* (long question?) Tj T* (q002: And a short one?) Tj ET"
    (tmp_path / "q.pdf").write_bytes(file(body))
    assert [tuple(r) for r in read_queries(spark, f"{tmp_path}/q.pdf").orderBy("query_id").collect()] == [("q001", "What is a long question?"), ("q002", "And a short one?")]


def packed_lzw(data, early=1):
    """LZW codes by the standard's rule, written here for the tests."""
    table, out, bits, width, before = {bytes([k]): k for k in range(256)}, 0, 0, 9, b""
    codes = [(256, 9)]
    size = 258
    for k in range(len(data)):
        c = data[k : k + 1]
        if before + c in table:
            before += c
            continue
        codes.append((table[before], width))
        table[before + c], size, before = size, size + 1, c
        width = min(12, max(9, (size - 1 + early).bit_length()))
        if size == 4095:
            codes.append((256, width))
            table, size, width = {bytes([k]): k for k in range(256)}, 258, 9
    if before:
        codes.append((table[before], width))
        size += 1
        width = min(12, max(9, (size - 1 + early).bit_length()))
    codes.append((257, width))
    for code, w in codes:
        out, bits = out << w | code, bits + w
    return (out << (-bits % 8)).to_bytes((bits + 7) // 8, "big")


def filtered(body, names, parms=b""):
    data = file(b"X")
    head = b"<< /Length %d /Filter [%s]%s >>" % (len(body), names, parms)
    return data.replace(b"11 0 obj << /Length 1 >> stream\nX\n", b"11 0 obj " + head + b" stream\n" + body + b"\n")


TEXT = b"BT /F1 9 Tf (in) Tj 0 -20 Td (a stream) Tj ET " + b"% filler \n" * 400


@pytest.mark.parametrize("early", [0, 1])
def test_lzw(early):
    assert streams.lzw(packed_lzw(TEXT * 9, early), early) == TEXT * 9
    noise = bytes((k * k * 7 + k // 3) % 251 for k in range(20_000))
    assert streams.lzw(packed_lzw(noise, early), early) == noise
    assert said(filtered(packed_lzw(TEXT, early), b"/LZWDecode", b" /DecodeParms << /EarlyChange %d >>" % early)) == [(1, ["in", "a", "stream"])]
    assert streams.lzw(bytes.fromhex("800B6050220C0C8501")) == bytes([45, 45, 45, 45, 45, 65, 45, 45, 45, 66])
    with pytest.raises(ValueError):
        streams.lzw(b"\x80\x7f\xff\xff")


def test_text_filters_and_runs():
    assert streams.ascii85(base64.a85encode(b"Hello, world") + b" ~>junk") == b"Hello, world" and streams.ascii85(b"zzE,~>")[:8] == bytes(8)
    assert streams.ascii_hex(b"48 65 6c6C6F7>zz") == b"Hellop"
    assert streams.run_length(b"\x02abc\xfdx\x80zz") == b"abcxxxx"
    assert said(filtered(base64.a85encode(zlib.compress(TEXT)) + b"~>", b"/ASCII85Decode /FlateDecode")) == [(1, ["in", "a", "stream"])]
    assert said(filtered(TEXT.hex().encode() + b">", b"/AHx")) == [(1, ["in", "a", "stream"])]
    with pytest.raises(ValueError, match="DCTDecode"):
        list(pdf.pages(filtered(b"x", b"/DCTDecode")))


def predicted(rows, kind, step):
    out, above = b"", bytes(len(rows[0]))
    for row in rows:
        made = bytearray()
        for k, v in enumerate(row):
            left, up, corner = row[k - step] if k >= step else 0, above[k], above[k - step] if k >= step else 0
            p = left + up - corner
            paeth = left if abs(p - left) <= abs(p - up) and abs(p - left) <= abs(p - corner) else up if abs(p - up) <= abs(p - corner) else corner
            made.append((v - [0, left, up, (left + up) // 2, paeth][kind]) & 255)
        out, above = out + bytes([kind]) + bytes(made), row
    return out


@pytest.mark.parametrize("kind", range(5))
def test_predictors(kind):
    body = TEXT + b" " * (-len(TEXT) % 30)
    rows = [body[k : k + 30] for k in range(0, len(body), 30)]
    assert streams.unpredicted(predicted(rows, kind, 3), 12, colors=3, columns=10) == body
    parms = b" /DecodeParms << /Predictor 15 /Colors 3 /Columns 10 >>"
    assert said(filtered(zlib.compress(predicted(rows, kind, 3)), b"/FlateDecode", parms)) == [(1, ["in", "a", "stream"])]
    tiff = b"".join(bytes((row[k] - (row[k - 1] if k else 0)) & 255 for k in range(30)) for row in rows)
    assert streams.unpredicted(tiff, 2, columns=30) == body


def referred(parts, trailer, prev=None, base=b""):
    """Objects behind ``base`` with a table of where they stand; ``parts``: number -> body or None for a freed one."""
    out, places = bytearray(base or b"%PDF-1.4\n"), {}
    for number, body in parts.items():
        if body is not None:
            places[number] = len(out)
            out += b"%d 0 obj %s endobj\n" % (number, body)
    at = len(out)
    out += b"xref\n" + b"".join(b"%d 1\n%s" % (n, b"%010d 00000 n \n" % places[n] if n in places else b"0000000000 00001 f \n") for n in parts)
    return bytes(out + b"trailer << %s%s >>\nstartxref\n%d\n%%%%EOF\n" % (trailer, b" /Prev %d" % prev if prev else b"", at)), at


def stream(body, more=b""):
    return b"<< /Length %d%s >> stream\n%s\nendstream" % (len(body), more, body)


def one_page(text):
    return {
        1: b"<< /Type /Catalog /Pages 2 0 R >>", 2: b"<< /Type /Pages /Kids [5 0 R] /Count 1 /MediaBox [0 0 600 800] /Resources << /Font << /F1 3 0 R >> >> >>",
        3: b"<< /Type /Font /Subtype /Type1 >>", 5: b"<< /Type /Page /Parent 2 0 R /Contents 6 0 R >>", 6: stream(text),
    }


def test_the_chain_chooses_the_live_objects():
    old, at = referred(one_page(b"BT /F1 9 Tf (old) Tj ET"), b"/Root 1 0 R /Size 7")
    assert said(old) == [(1, ["old"])]
    new, _ = referred({6: stream(b"BT /F1 9 Tf (new) Tj ET")}, b"/Root 1 0 R /Size 7", at, old)
    # What stands last in the file is not live: no table names it.
    stray = (b"6 0 obj " + stream(b"BT /F1 9 Tf (stray) Tj ET") + b" endobj\nstartxref\n").join(new.rsplit(b"startxref\n", 1))
    assert said(new) == [(1, ["new"])] and said(stray) == [(1, ["new"])]
    gone, _ = referred({6: None}, b"/Root 1 0 R /Size 7", at, old)
    assert said(gone) == [(1, [])]
    damaged = new.replace(b"startxref\n%d" % at, b"startxref\n7").replace(b"(new)", b"(later)")
    assert said(damaged.replace(b"%010d 00000 n" % old.index(b"5 0 obj"), b"0000000003 00000 n"))[0][1] == ["later"]


def test_cross_reference_streams():
    parts = one_page(b"BT /F1 9 Tf (packed) Tj ET")
    inner = b"1 0 2 %d %s %s" % (len(parts[1]) + 1, parts[1], parts[2])
    out, places = bytearray(b"%PDF-1.5\n"), {}
    first = inner.index(parts[1])
    rest = {n: parts[n] for n in (3, 5, 6)} | {7: stream(inner, b" /Type /ObjStm /N 2 /First %d" % first)}
    for n, body in rest.items():
        places[n] = len(out)
        out += b"%d 0 obj %s endobj\n" % (n, body)
    at = len(out)
    rows = [(0, 0, 0), (2, 7, 0), (2, 7, 1), (1, places[3], 0), (0, 0, 0), (1, places[5], 0), (1, places[6], 0), (1, places[7], 0), (1, at, 0)]
    table = [bytes([k]) + p.to_bytes(2, "big") + bytes([g]) for k, p, g in rows]
    body = zlib.compress(predicted(table, 2, 1))
    out += b"8 0 obj " + stream(body, b" /Type /XRef /Size 9 /W [1 2 1] /Root 1 0 R /Filter /FlateDecode /DecodeParms << /Predictor 12 /Columns 4 >>") + b" endobj\nstartxref\n%d\n%%%%EOF" % at
    assert said(bytes(out)) == [(1, ["packed"])]
    assert pdf.File(bytes(out)).trailer["Root"] == 1


@pytest.mark.parametrize("revision", [2, 3])
def test_standard_encryption_under_the_empty_password(revision):
    import hashlib

    owner, ident, rights = bytes(range(32)), b"0123456789abcdef", -44
    size = 5 if revision == 2 else 16
    key = hashlib.md5(streams.PADDING + owner + (rights & 0xFFFFFFFF).to_bytes(4, "little") + ident).digest()
    for _ in range(50 if revision == 3 else 0):
        key = hashlib.md5(key[:size]).digest()
    key = key[:size]
    user = streams.rc4(key, streams.PADDING) if revision == 2 else hashlib.md5(streams.PADDING + ident).digest()
    for k in range(20 if revision == 3 else 0):
        user = streams.rc4(bytes(b ^ k for b in key), user)
    user += bytes(32 - len(user))
    body = b"BT /F1 9 Tf (secret) Tj ET"
    own = hashlib.md5(key + (6).to_bytes(3, "little") + bytes(2)).digest()[: min(16, size + 5)]
    parts = one_page(b"")
    parts[6] = stream(streams.rc4(own, body))
    parts[9] = b"<< /Filter /Standard /V %d /R %d /Length %d /P %d /O <%s> /U <%s> >>" % (revision - 1, revision, 8 * size, rights, owner.hex().encode(), user.hex().encode())
    data, _ = referred(parts, b"/Root 1 0 R /Size 10 /Encrypt 9 0 R /ID [<%s> <00>]" % ident.hex().encode())
    assert said(data) == [(1, ["secret"])]
    assert streams.rc4(b"Key", b"Plaintext").hex() == "bbf316e8d940af0ad3"
    with pytest.raises(ValueError, match="needs a password"):
        list(pdf.pages(data.replace(user.hex().encode(), b"00" * 32)))
    with pytest.raises(ValueError, match="a method"):
        list(pdf.pages(data.replace(b"/V %d" % (revision - 1), b"/V 5")))
