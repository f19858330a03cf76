import pytest
from pyspark.sql import functions as F

from quernstone.functions import sentences as S
from quernstone.functions import table_functions as U
from quernstone.functions import text as T
from quernstone.operators import chunk as C
from quernstone.operators import graph as G

ODD = ["Dr. Smith went. He left... and came back! (Yes.) \"Really?\" Sure etc. And so on etc. more.", "A. B. Lee of the U.S.A. spoke. 3 items. fig. 2 shows.", "", "No end", " a.  b\tc. D", "…", "¿Qué? ¡Bien! «Sí.» Ok", "x Inc. Then y Ltd. and z."]


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    real = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(100_000 + k, t) for k, t in enumerate(ODD)] + [(200_000, None)], "doc_id long, text string")
    found = real.unionByName(odd)
    found.createOrReplaceTempView("udtf_docs")
    U.register(spark, G.Dictionary(sensitive={"The": ("the", "TEMA")}), C.ChunkConfig())
    return found


@pytest.mark.parametrize("language", ["es", "en", "pt"])
def test_sentences_by_sql(spark, docs, language):
    got = spark.sql(f"SELECT doc_id, pos, sentence FROM udtf_docs, LATERAL sentences(text, '{language}')")
    want = docs.select("doc_id", F.posexplode(S.sentences(T.normalised(F.col("text")), language)).alias("pos", "sentence"))
    assert got.count() == want.count() and got.exceptAll(want).count() == 0


def test_fragments_by_sql(spark, docs):
    block = F.struct(F.col("text"), F.lit("paragraph").alias("kind"), F.lit(None).cast("int").alias("level"), F.array().cast("array<string>").alias("path"), F.lit(None).cast("int").alias("page"), F.lit(False).alias("atomic"))
    rows = docs.select("doc_id", F.array(block).alias("blocks"), F.lit(None).cast("string").alias("observatory"), F.lit(None).cast("string").alias("title"))
    want = C.fragment_documents(rows, C.ChunkConfig(target_words=60)).select("doc_id", "chunk_id", "n_tokens", "text", "overlaps", "n_sentences")
    got = spark.sql("SELECT CAST(doc_id AS STRING) AS doc_id, chunk_id, n_tokens, f.text, overlaps, n_sentences FROM udtf_docs, LATERAL fragments(doc_id, text, 60) AS f")
    assert got.count() == want.count() > 100 and got.exceptAll(want).count() == 0


def test_entities_by_sql(spark, docs):
    want = G.recognise(docs, G.Dictionary(sensitive={"The": ("the", "TEMA")})).select("doc_id", "pos", "name", "kind", "start", "end", "origin")
    got = spark.sql("SELECT doc_id, e.* FROM udtf_docs, LATERAL entities(text) AS e")
    assert got.count() == want.count() > 0 and got.exceptAll(want).count() == 0


def test_wrong_arguments_fail_when_the_query_is_analysed(spark, docs):
    with pytest.raises(Exception, match="the text is int"):
        spark.sql("SELECT * FROM sentences(3)")
    with pytest.raises(Exception, match="no rules for xx"):
        spark.sql("SELECT * FROM sentences('a', 'xx')")
    with pytest.raises(Exception, match="the target is string"):
        spark.sql("SELECT * FROM fragments('d', 'a', 'b')")
