"""Query files: marked text, a query a line, or JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quernstone.operators.relational import require_unique

_MARK = r"(?im)^[^\S\n]*(q\s?\d{1,4})[\s.:)\-]+"
#: Names that ids and texts go by, in order.
ID_KEYS = ("query_id", "id", "consulta_id", "id_consulta")
TEXT_KEYS = ("consulta", "texto", "pregunta", "query", "text")


def _tidy(c: F.Column) -> F.Column:
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def queries_of_text(texts: DataFrame) -> DataFrame:
    """(query_id, query) from whole texts (column value): cut at marks, else a query a line."""
    marks = F.regexp_extract_all("value", F.lit(_MARK), F.lit(1))
    bodies = F.slice(F.split("value", _MARK), 2, F.size(marks) + 1)
    marked = F.zip_with(marks, bodies, lambda m, b: F.struct(F.lower(F.replace(m, F.lit(" "), F.lit(""))).alias("query_id"), _tidy(b).alias("query")))
    lines = F.filter(F.split("value", r"\r?\n"), lambda x: F.trim(x) != "")
    plain = F.transform(lines, lambda x, i: F.struct(F.format_string("q%03d", i + 1).alias("query_id"), _tidy(x).alias("query")))
    return require_unique(texts.select(F.inline(F.when(F.size(marks) > 0, marked).otherwise(plain))), "query_id")


def read_queries(spark: SparkSession, path: str) -> DataFrame:
    """Queries of a ``.jsonl``, ``.pdf`` or text file; a repeated id or a missing text raises."""
    if path.lower().endswith(".pdf"):
        from quernstone.operators.layout import page_lines
        from quernstone.sources.extract import pdf_words

        file = spark.read.format("binaryFile").load(path).select(F.lit("queries").alias("doc_id"), "content")
        lines = page_lines(pdf_words(file).where("text IS NOT NULL"))
        listed = F.array_sort(F.collect_list(F.struct("page", "line", "text")))
        return queries_of_text(lines.groupBy().agg(F.array_join(F.transform(listed, lambda x: x["text"]), "\n").alias("value")))  # one file
    if not path.endswith(".jsonl"):
        return queries_of_text(spark.read.text(path, wholetext=True))
    rows = spark.read.json(path, schema=", ".join(f"{k} string" for k in (*ID_KEYS, *TEXT_KEYS)), mode="FAILFAST")
    text = F.coalesce(*TEXT_KEYS)
    checked = F.when(text.isNull(), F.raise_error(F.lit("a query without text"))).otherwise(_tidy(text))
    return require_unique(rows.select(F.coalesce(*ID_KEYS).alias("query_id"), checked.alias("query")), "query_id")
