import unicodedata

import pytest
from pyspark.sql import functions as F

from quernstone.functions import sentences as S
from quernstone.functions import text as T
from quernstone.sources import extract as X


def each(spark, values, column, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(column).collect()]


def test_normalised(spark):
    odd = ["a  b\t\nc", "x​y", "  ", "", "﻿hola mundo", "\x07bell", "tab\x0bvt", None]
    once = each(spark, odd, T.normalised(F.col("v")))
    assert once == ["a b c", "xy", "", "", "hola mundo", "bell", "tab vt", None]
    assert each(spark, once, T.normalised(F.col("v"))) == once
    assert [X.clean(v) for v in odd[:-1]] == once[:-1]


def test_normalised_composes(spark):
    raw = ["e\u0301a  \u212b", "e\u200b\u0301", "c\u0327\u0301 a\u0302\u0301", "\ufeff  a\tb\u00a0", "o\u0328\u0301 \u2009x", "가 — ok", None, ""]
    extract = pytest.importorskip("quernstone.sources.extract")
    assert each(spark, raw, T.normalised(F.col("v"))) == [None if t is None else extract.clean(t) for t in raw]


def test_composed_and_ids(spark):
    assert each(spark, ["é", None], T.composed("v")) == [unicodedata.normalize("NFC", "é"), None]
    assert each(spark, ["a.pdf"], T.document_id("v")) == [__import__("hashlib").blake2b(b"a.pdf", digest_size=8).hexdigest()]


@pytest.mark.parametrize(
    ("line", "noise"),
    [("12", True), ("- 7 -", True), ("— 3 —", True), ("Página 3", True), ("PAG. 3 de 12", True), ("Page 4 of 20", True), ("3 / 12", True), ("", True), ("Capítulo 3", False), ("en 2024", False)],
)
def test_page_noise(spark, line, noise):
    assert each(spark, [line], T.is_page_noise(F.col("v"))) == [noise]
    assert (not X.clean(line) or bool(X._NOISE.search(X.clean(line)))) == noise


def test_natural_and_opaque(spark):
    values = ["Inminencia", "91689", "https://a.b/c", "x@y.es", "10.1000/abc", "a" * 16, "2024-01-02", "dir/f.pdf", "· · ·", "una frase con https://a.b dentro", None, ""]
    assert each(spark, values, T.is_natural(F.col("v"))) == [True, *[False] * 8, True, False, False]
    assert each(spark, values, T.is_opaque(F.col("v"))) == [False, False, True, True, False, True, False, True, False, False, True, True]
    assert [X.natural(v) for v in values] == [True, *[False] * 8, True, False, False]


def test_serialised(spark):
    row = T.serialised(("país", F.lit("Perú")), ("url", F.lit("http://x.y/z")), ("", F.lit("lost")), ("año", F.lit("2024")), ("vacío", F.lit("")))
    assert each(spark, ["x"], row) == ["país: Perú | año: 2024"]


def test_words_tokens_fragments(spark):
    assert each(spark, ["", "a", "a b c", None], T.word_count(F.col("v"))) == [0, 1, 3, 0]
    assert each(spark, [1, 5, 240], T.estimated_tokens(F.col("v")), "int") == [2, 8, 384]
    assert each(spark, ["F1-X-001"], T.fragment_id(F.col("v"), F.lit(7))) == ["F1-X-001-c0007"]
    assert each(spark, ["F1-X-001-c0007"], T.document_of_fragment(F.col("v"))) == ["F1-X-001"]
    with pytest.raises(Exception, match="not a fragment id"):
        each(spark, ["F1-X-001"], T.document_of_fragment(F.col("v")))


def test_language(spark):
    texts = ["el informe de la agencia sobre el espacio", "the report of the agency on space and law", "o relatório da agência não é muito longo", "corto", "zzzz yyyy xxxx wwww vvvv uuuu", None]
    assert each(spark, texts, T.function_word_language(F.col("v"))) == ["es", "en", "pt", "es", "es", "es"]


def test_names(spark):
    assert each(spark, ["  «La  Agencia Espacial».", "The", "el", "NASA,"], T.entity_name(F.col("v"))) == ["Agencia Espacial", "The", "el", "NASA"]
    assert each(spark, ["Ámérica Ñandú", "São"], T.entity_key(F.col("v"))) == ["america nandu", "sao"]
    assert each(spark, ["AArrttiiffiicciiaall", "Committee", "abc"], T.has_doubled_glyphs(F.col("v"))) == [True, False, False]
    assert each(spark, ["Index Index Report", "a b a", "La la"], T.has_repeated_words(F.col("v"))) == [True, False, True]


def test_tiles(spark):
    (b,) = each(spark, ["x"], T.tile_bounds(F.lit(0), F.lit(0), F.lit(0)))
    assert (b.west, b.east) == (-180.0, 180.0) and b.north == pytest.approx(85.051129) and b.south == pytest.approx(-85.051129)


SENTENCES = [
    ("es", "Llegó tarde. Nadie dijo nada.", ["Llegó tarde.", "Nadie dijo nada."]),
    ("es", "El Dr. Ruiz habló. Luego salió.", ["El Dr. Ruiz habló.", "Luego salió."]),
    ("es", "Véase el Art. 5 de la ley. Es claro.", ["Véase el Art. 5 de la ley.", "Es claro."]),
    ("en", "Mr. J. R. Smith of the U.S. agency left. He ran.", ["Mr. J. R. Smith of the U.S. agency left.", "He ran."]),
    ("en", "Acme Inc. builds it. Acme Inc. They left.", ["Acme Inc. builds it.", "Acme Inc.", "They left."]),
    ("en", 'He said "stop." Then he left!', ['He said "stop."', "Then he left!"]),
    ("pt", "Ver pág. 3 do texto. Fim?", ["Ver pág. 3 do texto.", "Fim?"]),
    ("es", "", []),
    ("es", "Sin punto final", ["Sin punto final"]),
]


@pytest.mark.parametrize(("language", "text", "parts"), SENTENCES)
def test_sentences(spark, language, text, parts):
    assert each(spark, [text], S.sentences(F.col("v"), language)) == [parts]


def test_sentences_lose_nothing(spark):
    texts = [t for _, t, _ in SENTENCES] + ["a.b. C. d? e!  f", "... !!! ??", "1. 2. 3."]
    clean = each(spark, texts, T.normalised(F.col("v")))
    assert [" ".join(s) for s in each(spark, clean, S.sentences(F.col("v")))] == clean


def test_sentences_by_kind(spark):
    """A case for each thing that is no end of a sentence, and for each that is."""
    cases = {
        "es": [
            ["El Art. 9 rige el uso del suelo.", "Se revisa en mayo."], ["La N.A.S.A. y la O.N.U. firmaron ayer."], ["Hay mapas, datos, etc.", "El resto falta."], ["Hay mapas, etc. y planos en el anexo."],
            ["Subió 2,5 puntos en 2021.", "Nadie lo vio."], ["Dijo: «Es tarde.»", "Luego se fue."], ["Quiso ir, pero... la puerta no abrió.", "Volvió."], ["Cayó (ver el cuadro C.) y se rompió."], ["¿Qué es esto?", "Un ensayo."], ["La obra de M. L. Ruiz sigue viva.", "Es de 1990."], ["Índice"],
        ],
        "en": [
            ["Mr. Hall spoke first.", "Dr. Wu came later."], ["The U.S. team left."], ["It went to Star Systems Inc.", "The award stood."], ["It went to Star Systems Inc. and two others."], ["“Stop!” she said.", "Then it was quiet."], ["He waited, and... nothing came.", "He left."],
            ["See [4].", "It is old."], ["The text ends here."],
        ],
        "pt": [["O Art. 2 vale desde ontem.", "A revisão é anual."], ["Foi em Pedras Ltda.", "A obra parou."], ["Os órgãos, p.ex. o INPE, vieram.", "O custo é alto."]],
    }
    for language, rows in cases.items():
        got = each(spark, [" ".join(r) for r in rows], S.sentences(T.normalised(F.col("v")), language))
        assert got == rows
    assert each(spark, ["", None], S.sentences(T.normalised(F.col("v")), "en")) == [[], None]


def test_case_folding(spark):
    odd = ["Straße", "STRASSE", "ſtark", "ΟΔΟΣ", "οδος", "ﬁnal", "ŉa", "ẞ", "plain Ñandú", "", None, "µ", "ΐ"]
    assert each(spark, odd, T.casefolded(F.col("v"))) == [None if t is None else t.casefold() for t in odd]
    assert each(spark, ["Maß", "MASS", "mass"], T.entity_key(F.col("v"))) == ["mass"] * 3


def test_classes_of_many_characters_keep_them(spark):
    every = spark.range(0x80, 0x3000).select(F.expr("decode(unhex(lpad(hex(id), 8, '0')), 'UTF-32')").alias("c"))
    for fast, plain in ((T._COMPOSABLE, rf"[\p{{M}}{T._SINGLE}]"), (T._FOLDABLE, "[" + "".join(T._FOLD_MORE) + "]")):
        assert fast != plain and every.where(F.col("c").rlike(fast) != F.col("c").rlike(plain)).count() == 0
    odd = spark.createDataFrame([("a  b   c",), (" a b ",), ("",), (None,), ("a",)], "t string")
    assert [r.n for r in odd.select(T.word_count(F.col("t")).alias("n")).collect()] == [3, 4, 0, 0, 1]
