"""The corpus pipeline: toxicity, near-duplicates, decontamination, secrets, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes each
result as Parquet in the shared folder and reads it back for the next. What a stage
writes on its way is deleted when its result is written, and so is its input then.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quernstone.llm.bpe import encode_documents
from quernstone.llm.decontaminate import drop_leaks
from quernstone.llm.near_copies import keep_one
from quernstone.llm.queries import vocabulary_file
from quernstone.llm.secrets import redact_documents
from quernstone.llm.toxicity import drop_toxic, fit_on
from quernstone.session import Written, scratch, table


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that reach their language's threshold go; the others stay as they are.

    A null text is judged as an empty one, a null language by the common threshold.
    Repeated rows go or stay together. Extra columns stay, one named score too.
    Long texts are judged whole. An empty table gives no rows.
    """
    return drop_toxic(docs, fit_on(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share four fifths of their five-word shingles with one of a smaller doc_id go.

    A null doc_id counts as the largest; ties in doc_id go to the smaller hash of
    the text; rows alike in both stay once. Null, empty and blank texts are copies
    of each other. Extra columns stay. Long texts are compared whole. An empty
    table gives no rows.
    """
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go.

    Null and empty texts hold none; null and empty items are none. Repeated rows go
    or stay together. Extra columns stay. Long texts are searched whole. An empty
    table gives no rows, an empty benchmark drops none.
    """
    return drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in texts are replaced by a mark; every document stays, n_chars follows.

    Null texts stay null. Repeated rows are all cleaned. Extra columns stay. Long
    texts are scanned whole. An empty table gives no rows.
    """
    clean = redact_documents(docs)
    return clean.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else clean


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, token count and digests of every document, encoded whole and decoded again.

    A null text has no tokens. Repeated rows and null ids stay; extra columns are
    left out. An empty table gives no rows.
    """
    return encode_documents(docs, vocabulary_file(), digests_only=True)


STAGES = [
    ("toxicity", toxicity),
    ("simhash_near_dedup", near_duplicates),
    ("decontamination", decontamination),
    ("secret_scans", secret_scans),
    ("bpe", bpe),
]
#: A classifier, a decomposition and a tokenizer are no SQL; the tests judge every stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last one's input is the only table that stays."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        with scratch():
            done = Written(stage(spark, docs, sf_dir), f"stage-{name}", stays=True)
        if before:
            before.delete()
        docs, before = done.read(), done
    return STAGES[-1][1](spark, docs, sf_dir)
