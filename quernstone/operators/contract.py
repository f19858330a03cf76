"""Contracts of documents and fragments, and reports about a corpus.

Checks are arrays of messages that an expression filters, so a corpus is judged in
one pass; heading paths need one sort a document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quernstone.functions import text as T
from quernstone.operators import blocks as B
from quernstone.operators.chunk import ChunkConfig, fragment_documents
from quernstone.operators.relational import histogram, nearest_rank

#: What a document's and a block's fields may be, and the form of an inventory's ids.
KINDS = ("title", "paragraph", "list", "row", "ocr")
FORMATS = ("pdf", "json", "csv", "xlsx", "imagen", "pbf", "txt")
LANGUAGES, PHENOMENA = ("es", "en", "pt"), (1, 2, 3)
UNITS = ("prose", "atomic", "orphan_title")
INVENTORY_ID = r"^F[123]-[A-Z0-9]+-\d+$"


def _said(*checks: tuple[Column, str]) -> Column:
    """The messages whose conditions hold; an unknown condition counts as broken."""
    return F.filter(F.array(*(F.when(F.coalesce(wrong, F.lit(True)), F.lit(what)) for wrong, what in checks)), lambda m: m.isNotNull())


def _block_messages(b: Column, at: Column) -> Column:
    text, level, title = b["text"], b["level"], b["kind"] == "title"
    clean = T.normalised(text)
    messages = _said(
        (text.isNull(), "text is missing"),
        (text.isNotNull() & (clean == ""), "text is empty"),
        (text.isNotNull() & (clean != "") & (text != clean), "text is not normalised"),
        (~b["kind"].isin(*KINDS), "unknown kind"),
        (title & level.isNull(), "a title without a level"),
        (title & level.isNotNull() & ~level.between(1, B.LEVELS), "level out of range"),
        (~title & level.isNotNull(), "a level on a block that is no title"),
        (b["path"].isNull() | F.exists(b["path"], lambda p: p.isNull()), "path is no list of texts"),
        (b["page"].isNotNull() & (b["page"] < 1), "page under 1"),
        (b["atomic"].isNull(), "atomic is missing"),
    )
    return F.transform(messages, lambda m: F.concat(F.lit("block "), at.cast("string"), F.lit(": "), m))


def document_violations(docs: DataFrame) -> DataFrame:
    """(doc_id, source, violations) of documents that break the contract.

    A doc_id is an inventory's, or derived from the source or the relative path.
    Every block's stated path must be the headings live above it; a title whose
    level is out of range opens none.
    """
    relative = F.col("meta")["ruta_relativa"]
    traced = F.col("doc_id").rlike(INVENTORY_ID) | (F.col("doc_id") == T.document_id(F.col("source"))) | F.coalesce(F.col("doc_id") == T.document_id(relative), F.lit(False))
    named = F.coalesce(F.trim("source") != "", F.lit(False))
    identified = F.coalesce(F.trim("doc_id") != "", F.lit(False))
    own = _said(
        (~named, "source is empty"),
        (named & ~identified, "doc_id is empty"),
        (named & identified & ~traced, "doc_id is not traceable"),
        (~F.col("format").isin(*FORMATS), "unknown format"),
        (~F.col("phenomenon").isin(*PHENOMENA), "unknown phenomenon"),
        (~F.col("language").isin(*LANGUAGES), "unknown language"),
        (F.col("meta").isNull(), "meta is missing"),
        (F.col("errors").isNull() | F.exists("errors", lambda e: e.isNull()), "errors is no list of texts"),
        (F.col("blocks").isNull(), "blocks are missing"),
    )
    inner = F.flatten(F.transform(F.coalesce("blocks", F.array().cast(docs.schema["blocks"].dataType)), lambda b, k: _block_messages(b, k)))
    keyed = docs.withColumn("_row", F.monotonically_increasing_id())
    local = keyed.select("_row", "doc_id", "source", F.concat(own, inner).alias("violations"))
    rows = keyed.select("_row", F.posexplode("blocks").alias("pos", "b"))
    # A title without a level that counts neither opens nor closes one, and its own path is not judged.
    odd = (F.col("kind") == "title") & ~F.coalesce(F.col("level").between(1, B.LEVELS), F.lit(False))
    placed = rows.select("_row", "pos", F.col("b.text").alias("text"), F.col("b.kind").alias("kind"), F.when(F.col("b.kind") == "title", F.col("b.level")).alias("level"), F.col("b.path").alias("path")).where(~odd)
    bad = B.path_violations(placed, doc="_row")
    paths = bad.groupBy("_row").agg(F.array_sort(F.collect_list(F.struct("pos", F.concat(F.lit("block "), F.col("pos").cast("string"), F.lit(": path is not that of the headings above")).alias("m")))).alias("p"))
    joined = local.join(paths, "_row", "left")
    both = F.concat("violations", F.coalesce(F.transform("p", lambda x: x["m"]), F.array().cast("array<string>")))
    return joined.select("doc_id", "source", both.alias("violations")).where(F.size("violations") > 0)


def fragment_violations(fragments: DataFrame, config: ChunkConfig = ChunkConfig(), words: int | None = None) -> DataFrame:  # noqa: B008
    """(chunk_id, violations) of complete fragments that break an invariant; see ``sources.artefacts.complete_fragments``.

    Token counts are judged by the estimate; with a counter of its own they are not.
    """
    most = words or config.max_words
    text, n = F.col("text"), T.word_count(F.col("text"))
    blank = F.coalesce(F.trim(text) == "", F.lit(True))
    sound = lambda c: ~blank & c
    tokens = [(sound(F.col("n_tokens") != T.estimated_tokens(n)), "token count differs")] if config.count_tokens is None else []
    found = _said(
        (F.coalesce(F.trim("source") == "", F.lit(True)), "source is empty"),
        (F.coalesce(F.trim("doc_id") == "", F.lit(True)), "doc_id is empty"),
        (F.coalesce(F.col("position") < 0, F.lit(True)), "position under 0"),
        ((F.col("position") >= 0) & (F.col("chunk_id") != T.fragment_id(F.col("doc_id"), F.col("position"))), "chunk_id differs from doc_id and position"),
        (~F.col("format").isin(*FORMATS), "unknown format"),
        (~F.col("phenomenon").isin(*PHENOMENA), "unknown phenomenon"),
        (~F.col("language").isin(*LANGUAGES), "unknown language"),
        (~F.col("unit").isin(*UNITS), "unknown unit"),
        (blank, "text is empty"),
        (sound(text != T.normalised(text)), "text is not normalised"),
        (sound(~F.col("enriched").endswith(text)), "enriched text does not end in the text"),
        (sound(F.col("n_words") != n), "word count differs"),
        *tokens,
        (sound((n > most) & (F.col("n_sentences") <= 1)), "too long: one sentence that cannot be cut"),
        (sound((n > most) & (F.col("n_sentences") > 1)), "too long: packing let it pass"),
        (sound((F.col("n_tokens") > config.max_tokens) & (F.col("n_sentences") > 1)), "too many tokens"),
        (F.col("section").isNull() | F.exists("section", lambda s: s.isNull()), "section is no list of texts"),
        (F.col("page").isNotNull() & (F.col("page") < 1), "page under 1"),
        (F.col("overlaps").isNull(), "overlaps is missing"),
        (F.coalesce(F.col("n_sentences") < 1, F.lit(True)), "no sentences"),
    )
    return fragments.select("chunk_id", found.alias("violations")).where(F.size("violations") > 0)


def _map_of(counts: DataFrame, key: str, name: str) -> DataFrame:
    """One row with a map of a small grouped count, keys in order."""
    return counts.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(key, "n")))).alias(name))


def fragmentation_report(docs: DataFrame, fragments: DataFrame, config: ChunkConfig = ChunkConfig()) -> DataFrame:  # noqa: B008
    """One row about a fragmented corpus; ``fragments`` need columns format, n_words, n_sentences, unit.

    Documents without blocks are counted; their list is :func:`without_blocks`.
    """
    atomic = F.col("unit") == "atomic"
    facts = fragments.agg(
        F.count("*").alias("n_fragments"), nearest_rank("n_words", 50).alias("median_words"), nearest_rank("n_words", 95).alias("p95_words"), F.count_if(F.col("n_sentences") == 1).alias("n_one_sentence"),
        F.count_if(atomic).alias("n_atomic"), F.count_if((F.col("n_sentences") == 1) & (F.col("n_words") > config.max_words)).alias("n_indivisible"),
    )
    of_docs = docs.agg(F.count("*").alias("n_documents"), F.count_if(F.coalesce(F.size("blocks"), F.lit(0)) < 1).alias("n_without_blocks"))
    by_format = _map_of(fragments.groupBy("format").agg(F.count("*").alias("n")), "format", "by_format")
    bins = _map_of(histogram(fragments, "n_words"), "bin", "histogram")
    return of_docs.join(facts, F.lit(True)).join(by_format, F.lit(True)).join(bins, F.lit(True))  # frames of one row each


def without_blocks(docs: DataFrame) -> DataFrame:
    return docs.where(F.coalesce(F.size("blocks"), F.lit(0)) < 1).select("doc_id", "errors")


def fragment_corpus(docs: DataFrame, config: ChunkConfig = ChunkConfig()) -> DataFrame:  # noqa: B008
    """Complete fragments of typed documents (``sources.artefacts``), each in its own language's rules."""
    from quernstone.sources.artefacts import complete_fragments

    slim = docs.select("doc_id", "blocks", F.col("meta")["observatorio"].alias("observatory"), F.coalesce(F.col("meta")["titulo"], F.col("meta")["title"]).alias("title"), "language")
    parts = [fragment_documents(slim.where(F.col("language") == k), config, k) for k in LANGUAGES if k != "es"]
    out = fragment_documents(slim.where(~F.coalesce(F.col("language").isin("en", "pt"), F.lit(False))), config, "es")
    for p in parts:
        out = out.unionByName(p)
    return complete_fragments(out, docs)


def extraction_totals(docs: DataFrame) -> DataFrame:
    """(format, is_total, docs, blocks, chars) of extracted documents: a row a format, and one of all, from one pass."""
    chars = F.aggregate("blocks", F.lit(0).cast("long"), lambda a, b: a + F.length(b["text"]))
    sums = docs.rollup("format").agg(F.grouping_id().alias("g"), F.count("*").alias("docs"), F.sum(F.size("blocks")).cast("long").alias("blocks"), F.sum(chars).alias("chars"))
    return sums.select("format", (F.col("g") == 1).alias("is_total"), "docs", "blocks", "chars")


def extraction_summary(docs: DataFrame) -> DataFrame:
    """(format, docs, blocks, chars) of extracted documents."""
    return extraction_totals(docs).where(~F.col("is_total")).drop("is_total")


def failure_reasons(docs: DataFrame) -> DataFrame:
    """(reason, n): why documents have no blocks, the first error up to its colon."""
    failed = docs.where((F.size("blocks") < 1) & (F.size("errors") > 0))
    return failed.groupBy(F.substring_index(F.get("errors", F.lit(0)), ":", 1).alias("reason")).agg(F.count("*").alias("n"))


def acceptance(docs: DataFrame) -> DataFrame:
    """(check, found, expected, passed): no violations, blocks in every document, breadcrumbs of three levels somewhere."""
    n_bad = document_violations(docs).agg(F.count("*").alias("bad"))
    deep = F.exists("blocks", lambda b: F.size(b["path"]) >= 3)
    facts = docs.agg(F.count("*").alias("n"), F.count_if(F.size("blocks") > 0).alias("full"), F.coalesce(F.max(deep), F.lit(False)).alias("deep")).join(n_bad, F.lit(True))
    check = lambda name, found, expected: F.struct(F.lit(name).alias("check"), found.cast("string").alias("found"), expected.cast("string").alias("expected"), (found.cast("string") == expected.cast("string")).alias("passed"))
    rows = F.array(check("documents that break the contract", F.col("bad"), F.lit(0)), check("documents with blocks", F.col("full"), F.col("n")), check("paths of three levels", F.col("deep"), F.lit(True)))
    return facts.select(F.inline(rows))


def same_rows(a: DataFrame, b: DataFrame) -> bool:
    """Whether two runs gave the same rows, repeats counted."""
    rows = lambda df: df.select(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}).alias("row"))  # noqa: E731  maps take no part in set operations
    return rows(a).exceptAll(rows(b)).isEmpty() and rows(b).exceptAll(rows(a)).isEmpty()


def percentage(part: Column, total: Column) -> Column:
    """A share in percent with one decimal; 0 of nothing."""
    return F.when(total == 0, F.lit(0.0)).otherwise(F.round(100.0 * part / total, 1))
