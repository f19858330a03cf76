from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from quernstone.functions import language as N
from quernstone.functions import text as T
from quernstone.sources.extract import extract_files


def test_runs_do_not_cross_texts():
    gram, owner = N.runs(["abc", None, "ab", "bcde", ""])
    assert owner.tolist() == [0, 3, 3] and len(np.unique(gram)) == 3
    assert N.runs([])[0].tolist() == [] and N.runs(["ab", "c"])[0].tolist() == []


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("lang IS NOT NULL AND length(text) >= 100").select("doc_id", "lang", "text")
    held_out = F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0
    said = N.guess(docs.where(held_out), N.train(docs.where(~held_out)))
    n, right = said.agg(F.count("*"), F.count_if(F.col("language") == F.col("lang"))).first()
    assert n > 150 and right / n >= 0.95


def test_short_unknown_and_null_texts(spark):
    docs = spark.createDataFrame([("the quick brown fox jumps over the lazy dog again", "en"), ("el veloz zorro marrón salta sobre el perro perezoso", "es"), (None, "pt"), ("x", None)], "text string, lang string")
    model = N.train(docs)
    assert model.languages == ("en", "es")
    asked = spark.createDataFrame([(1, "the brown dog jumps over the fox"), (2, "hola"), (3, None), (4, ""), (5, "привет мир, как дела сегодня"), (6, "El Perro Salta Sobre El Zorro ")], "i int, text string")
    got = {r.i: (r.language, r.score is None) for r in N.guess(asked, model, default="zz").collect()}
    assert got == {1: ("en", False), 2: ("zz", True), 3: ("zz", True), 4: ("zz", True), 5: ("zz", True), 6: ("es", False)}
    empty = N.train(docs.limit(0))
    assert [r.language for r in N.guess(asked.where("i = 6"), empty).collect()] == ["es"]
    assert len(N.train(docs, most=5).grams) == 5


def test_files_take_a_model(spark, tmp_path):
    (tmp_path / "a.txt").write_text("zum beispiel steht hier ein satz auf deutsch, und noch einer", encoding="utf-8")
    model = N.train(spark.createDataFrame([("hier steht ein deutscher satz und noch ein beispiel", "de"), ("here is an english sentence and one more", "en")], "text string, lang string"))
    assert extract_files(spark, str(tmp_path), languages=model).first().language == "de"


def by_character(text):
    """The runs of one text, a character at a time."""
    low = [chr(N.folded()[ord(c)]) for c in text]
    s = f" {' '.join(''.join(low).split(' ')).strip()} "
    while "  " in s.strip():
        s = s.replace("  ", " ")
    return [s[i : i + 3] for i in range(len(s) - 2)]


def number(gram):
    return sum(ord(c) << N.BITS * (2 - k) for k, c in enumerate(gram))


def odd_texts(n=400):
    """Letters of more kinds than a table of common ones holds, marks, spaces, texts without letters at both ends."""
    chars = [*"aaabbcde    .,1\n", *map(chr, range(0x400, 0x600)), "Σ", "İ", "ß", "́", "漢", "𐐀"]
    rng = np.random.default_rng(4)
    return ["", "...", *("".join(rng.choice(chars[: rng.integers(3, len(chars))], rng.integers(0, 40))) for _ in range(n)), "x", " - ", ""]


def test_runs_of_letters_are_those_of_each_text():
    assert [chr(N.folded()[ord(c)]) for c in "AßΣİ9_́漢"] == ["a", "ß", "σ", "i", " ", " ", "́", "漢"]
    for texts in (odd_texts(), [""], ["", "1"], ["ab"], ["a", "", "b"]):
        gram, n = N.letter_runs(texts)
        assert dict(zip(gram.tolist(), n.tolist(), strict=True)) == Counter(number(g) for t in texts for g in by_character(t))


def test_sums_by_table_and_by_search():
    texts = odd_texts()
    grams = np.unique([number(g) for t in texts[::3] for g in by_character(t)])
    weights = np.random.default_rng(5).integers(-9000, 0, (len(grams), 3))
    model = N.LanguageModel(grams, weights, np.array([-9100, -9200, -9300]), ("a", "b", "c"))
    weigh = dict(zip(grams.tolist(), weights.tolist(), strict=True))
    places = N.Places(model)
    sums, hits = places.sums(texts)
    assert (np.bincount(places.few).nonzero()[0] == np.arange(1 << N.FEW)).all()  # some letters have no number of their own
    for k, text in enumerate(texts):
        own = [weigh.get(number(g)) for g in by_character(text)]
        assert hits[k] == sum(w is not None for w in own)
        assert sums[k].tolist() == [sum(w[j] if w else model.unknown[j] for w in own) for j in range(3)]


def test_only_texts_short_of_letters_are_normalised(spark, monkeypatch):
    words = "the quick brown fox jumps over the lazy dog again"
    docs = spark.createDataFrame([(1, words * 9, "en"), (2, "el veloz zorro marrón salta sobre el perro", "es"), (3, "- " * 500 + words, "en")], "i int, text string, lang string")
    model = N.train(docs)
    whole = T.normalised
    asked = [("1234567890 abcdefghi", False), ("1234567890 abcdefgh", True), ("á" * 19, True), ("á" * 20, False), ("\u0001​" * 30 + "ab", True), (" . " * 400 + "a", False), (". " * 5, True), ("", True), (None, True), ("-" * 20, False)]
    got = spark.createDataFrame(asked, "text string, short boolean").select("short", T.is_short(F.col("text"), 20)).collect()
    assert all(a == b for a, b in got)
    monkeypatch.setattr(T, "normalised", lambda text: F.when(text.startswith("- "), whole(text)).otherwise(F.raise_error(F.lit("normalised")).cast("string")))
    assert [r.language for r in N.guess(docs, model).orderBy("i").collect()] == ["en", "es", "en"]


def test_bytes_that_are_no_text(spark):
    docs = spark.sql("SELECT cast(concat(encode('the brown dog jumps over', 'utf-8'), unhex('FFC3'), encode(' the fox', 'utf-8')) AS string) AS text, 'en' AS lang UNION ALL SELECT 'el perro marrón salta sobre el zorro', 'es'")
    assert sorted(r.language for r in N.guess(docs, N.train(docs)).collect()) == ["en", "es"]
