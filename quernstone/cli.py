"""Command lines: extract a corpus, fragment it, build an index and answer, evaluate, make a graph, sweep.

    python -m quernstone.cli extract --input DIR --output DIR [--index XLSX] ...
"""

from __future__ import annotations

import argparse
import importlib
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quernstone.operators import assembly, chunk, contract, encode, graph
from quernstone.operators import retrieval as V
from quernstone.operators.relational import upsert
from quernstone.session import materialise
from quernstone.sources import artefacts as A
from quernstone.sources import inventory
from quernstone.sources.extract import extract_files
from quernstone.sources.lines import read_line_index, write_line_index
from quernstone.sources.queries import read_queries


def _say(text: str) -> None:
    print(text, file=sys.stderr)


def named(path: str) -> object:
    """What ``module:name`` names, for encoders and dictionaries that are parameters."""
    module, _, name = path.partition(":")
    return getattr(importlib.import_module(module), name)


# Extraction ---------------------------------------------------------------------


def extract_corpus(spark: SparkSession, root: str, output: str, index: str | None = None, default: int = 1, retry: bool = False, clean: bool = False) -> inventory.Coverage:
    """Documents (``output``/documents) and manifest (``output``/manifest) of a folder; what was left out.

    Spark retries lost tasks; a file that cannot be read is a document with its
    reason. ``retry`` extracts the documents again that have errors in the manifest
    of the run before and rewrites only the buckets that hold them; it cannot go with
    ``clean``.
    """
    if retry and clean:
        raise ValueError("retry keeps what clean would delete")
    if retry and not A.exists(spark, f"{output}/manifest"):
        raise ValueError(f"no manifest of a run before in {output}")
    coverage = inventory.survey(spark, root, index, default)
    identity = coverage.identity
    if notice := inventory.collision_notice(identity):
        _say(notice)
    before = materialise(A.read_manifest(spark, f"{output}/manifest"), "manifest-before") if retry else None
    if before is not None:
        failed = before.where("n_errors > 0").select("doc_id")
        gone = failed.join(identity, "doc_id", "left_anti").count()
        if gone:
            _say(f"{gone} documents to retry are not in the corpus any more")
        identity = identity.join(failed, "doc_id", "left_semi")
    names = identity.select("relative")
    fresh = inventory.with_identity(extract_files(spark, root).join(names, F.col("path") == F.col("relative"), "left_semi"), identity)
    docs = materialise(fresh.select("doc_id", "source", "format", "phenomenon", "language", "blocks", "meta", "errors"), "documents")
    lines = docs.select("doc_id", A.document_json(docs).alias("value"))
    table = A.document_table(spark, output)
    table.replace(lines) if before is None else table.upsert(lines)
    rows = A.manifest_rows(docs)
    A.write_manifest(rows if before is None else upsert(before.select(*rows.columns), rows, "doc_id"), f"{output}/manifest", ["source", "doc_id"])
    return coverage


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents of the table below ``folder``, or of one JSON file each in ``folder``."""
    table = A.document_table(spark, folder)
    if table.versions():
        return A.document_of_json(table.read().select("value"))
    return A.read_documents(spark, folder).drop("place")


# Fragments, index, answers ------------------------------------------------------


def fragment(spark: SparkSession, source: str, output: str, config: chunk.ChunkConfig) -> dict:
    """Fragments of the documents in ``source`` and a report; gives the report."""
    docs = materialise(_documents(spark, source), "documents")
    made = materialise(contract.fragment_corpus(docs, config), "fragments")
    A.write_fragments(made, f"{output}/{A.CHUNKS}")
    report = contract.fragmentation_report(docs, made, config).first().asDict(recursive=True)
    A.write_report(spark, report, f"{output}/{A.REPORT}")
    return report


def index(spark: SparkSession, chunks: str, output: str, config: encode.EncoderConfig, encoder: encode.Encoder, count) -> dict:
    """Vectors and metadata of fragments; gives the report."""
    rows = materialise(A.read_fragments(spark, chunks), "fragments")
    made = encode.build_index(rows, encoder, config, count)
    made.write.mode("overwrite").parquet(f"{output}/vectors")
    A.write_metadata(rows, f"{output}/{A.METADATA}")
    write_line_index(spark, f"{output}/{A.METADATA}", f"{output}/lines")
    report = encode.index_report(spark.read.parquet(f"{output}/vectors"), rows, config).first().asDict(recursive=True)
    A.write_report(spark, report, f"{output}/{A.REPORT}")
    return report


def answer(spark: SparkSession, folder: str, queries: str, results: str, config: encode.EncoderConfig, encoder: encode.Encoder, count, k: int = V.CANDIDATES, top: int = V.TOP_DOCUMENTS, fragments: int = V.TOP_FRAGMENTS, language: str | None = None) -> dict:
    """Answers of an index to a query file; gives counts of short answers and repeats."""
    asked = materialise(read_queries(spark, queries), "queries")
    vectors = materialise(encode.encode_queries(asked, encoder, config, count).select("query_id", "qvec"), "query-vectors")
    hits = V.top_k(spark.read.parquet(f"{folder}/vectors"), vectors, k)
    columns = ["doc_id", "chunk_id", "source", "relative", "phenomenon", "observatory", "page", "text", "language"]
    named_hits = A.metadata_of(materialise(hits, "hits"), read_line_index(spark, f"{folder}/lines"), columns)
    filtered = materialise(V.language_filter(named_hits, language, "language"), "hits")
    unique = materialise(V.distinct_texts(filtered, ["query_id", "doc_id"], "text", ["rank"]), "unique-hits")
    best = V.best_documents(unique, "doc_id", top).withColumnRenamed("n", "n_fragments")
    first = unique.groupBy("query_id", "doc_id").agg(F.min_by(F.struct("chunk_id", "source", "relative", "phenomenon", "observatory", "page", "text"), "rank").alias("m"))
    documents = best.join(first, ["query_id", "doc_id"]).select("query_id", "place", "doc_id", "score", "n_fragments", "m.*")
    parts = V.first_rows_by_rank(unique, fragments) if fragments > 0 else None
    rows = materialise(A.result_rows(asked, documents, parts), "answers")
    A.write_results(rows, results)
    short = rows.agg(F.count_if(F.size("documentos") < top).alias("without_all_documents"), F.count("*").alias("queries")).first().asDict()
    return short | {"repeats_left_out": filtered.count() - unique.count()}


def evaluate(spark: SparkSession, results: str, truth: str, k_documents: int = V.TOP_DOCUMENTS, k_fragments: int = V.TOP_FRAGMENTS) -> dict:
    """Macro averages over the questions of the ground truth: F1 and its ceiling, NDCG binary and graded.

    A question without an answer raises; answers to other queries are counted. The
    NDCG are None where the answers hold no fragments.
    """
    found, relevant = materialise(A.read_results(spark, results), "results"), materialise(A.read_truth(spark, truth), "truth")
    answered = spark.read.json(results, schema="query_id string").distinct()
    missing = [r[0] for r in relevant.select("query_id").distinct().join(answered, "query_id", "left_anti").limit(10).collect()]
    if missing:
        raise ValueError(f"questions of the ground truth without an answer: {missing}")
    docs = relevant.select("query_id", F.col("doc_id").alias("item")).distinct().withColumn("gain", F.lit(1.0))
    mean = lambda df, c: df.agg(F.avg(c)).first()[0] or 0.0
    ceiling = docs.groupBy("query_id").agg(V.f1_ceiling(F.count("*"), k_documents).alias("c"))
    out = {"queries": relevant.select("query_id").distinct().count(), "f1": mean(V.f1_at_k(found.where("kind = 'document'"), docs, k_documents), "f1"), "f1_ceiling": mean(ceiling, "c"), "ndcg_binary": None, "ndcg_graded": None}
    out["ignored"] = answered.join(relevant.select("query_id").distinct(), "query_id", "left_anti").count()
    hits = found.where("kind = 'fragment'")
    if not hits.isEmpty():
        for name, gain in (("ndcg_binary", F.lit(1.0)), ("ndcg_graded", (6 - F.col("rank")).cast("double"))):
            out[name] = mean(V.ndcg_at_k(hits, relevant.select("query_id", "item", gain.alias("gain")), k_fragments), "ndcg")
    return out


def coverage_of_index(spark: SparkSession, index_path: str, metadata: str) -> DataFrame:
    """(phenomenon, n): documents of the inventory without a vector."""
    return inventory.read_inventory(spark, index_path).join(A.documents_with_vectors(spark, metadata), "doc_id", "left_anti").groupBy("phenomenon").agg(F.count("*").alias("n"))


def build_graph(spark: SparkSession, metadata: str, output: str, dictionary: graph.Dictionary, first: int = 0, end: int | None = None, most: int | None = None, merge: list[str] | None = None, partial: bool = False, least_mentions: int = 2, least_weight: int = 1, isolated: bool = True) -> dict:
    """A graph of fragments, of a range of lines kept as partial tables, or of partial tables merged."""
    parts = assembly.merge(*(A.read_partial(spark, p) for p in merge)) if merge else assembly.accumulate(A.scan_fragments(spark, metadata, first, end, most), dictionary)
    if partial:
        A.write_partial(*parts, output)
        return {}
    nodes, edges, stats = assembly.assemble(*parts, least_mentions, least_weight, isolated)
    A.write_partial(nodes, edges, stats, output)
    report: dict = {}
    for r in stats.orderBy("what", F.desc("n"), "kind").collect():  # kinds and relations are few
        if r["kind"]:
            report.setdefault(r["what"], {})[r["kind"]] = r["n"]
        else:
            report[r["what"]] = r["n"]
    A.write_report(spark, report, f"{output}/{A.REPORT}")
    return report


def sweep(spark: SparkSession, source: str) -> str:
    """The parameter sweep over the documents in ``source`` as a Markdown table."""
    docs = _documents(spark, source).select("doc_id", "blocks", F.col("meta")["observatorio"].alias("observatory"), F.col("meta")["titulo"].alias("title"))
    return A.markdown(chunk.sweep(docs).orderBy("target", "overlap"))


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    jobs = top.add_subparsers(dest="job", required=True)

    def job(name: str, *needed: str) -> argparse.ArgumentParser:
        own = jobs.add_parser(name)
        for n in needed:
            own.add_argument(f"--{n}", required=True)
        return own

    p = job("extract", "input", "output")
    p.add_argument("--index")
    p.add_argument("--phenomenon", type=int, default=1, choices=(1, 2, 3))
    p.add_argument("--retry", action="store_true")
    p.add_argument("--clean", action="store_true")
    d = chunk.ChunkConfig()
    p = job("fragment", "input", "output")
    for name in ("target_words", "max_words", "max_tokens", "min_words", "overlap", "boundary_level"):
        p.add_argument("--" + name.replace("_", "-"), type=int, default=getattr(d, name))
    p.add_argument("--no-atomic", action="store_true")
    p.add_argument("--vocabulary", help="file of the tokenizers library; the estimate without it")
    e = encode.EncoderConfig()
    for name, needed in (("index", ("input", "output")), ("answer", ("index", "queries", "results"))):
        p = job(name, *needed, "encoder")
        p.add_argument("--vocabulary")
        p.add_argument("--model", default=e.model)
        p.add_argument("--dimension", type=int, default=e.dimension)
        p.add_argument("--batch", type=int, default=e.batch)
        p.add_argument("--attention", type=int, default=e.attention)
    p.add_argument("--k", type=int, default=V.CANDIDATES)
    p.add_argument("--top", type=int, default=V.TOP_DOCUMENTS)
    p.add_argument("--fragments", type=int, default=V.TOP_FRAGMENTS)
    p.add_argument("--language")
    p = job("evaluate", "results", "truth")
    p.add_argument("--k-documents", type=int, default=V.TOP_DOCUMENTS)
    p.add_argument("--k-fragments", type=int, default=V.TOP_FRAGMENTS)
    job("coverage", "index", "metadata")
    p = job("graph", "output")
    p.add_argument("--metadata")
    p.add_argument("--dictionary", help="module:name of a Dictionary")
    p.add_argument("--merge", nargs="*")
    p.add_argument("--partial", action="store_true")
    for name, default in (("first", 0), ("end", None), ("most", None), ("least-mentions", 2), ("least-weight", 1)):
        p.add_argument(f"--{name}", type=int, default=default)
    p.add_argument("--no-isolated", action="store_true")
    job("sweep", "input")
    p = job("deliver", "output")
    p.add_argument("parts", nargs="+", help="name=path")
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    """Runs a job; 1 where an index holds texts beyond the encoder's window or an acceptance fails."""
    a = parser().parse_args(argv)
    spark = spark or SparkSession.builder.getOrCreate()
    counter = lambda: encode.token_counter(a.vocabulary) if a.vocabulary else (lambda t: chunk.ChunkConfig().tokens(t))
    config = lambda: encode.EncoderConfig(model=a.model, dimension=a.dimension, batch=a.batch, attention=a.attention)
    if a.job == "extract":
        coverage = extract_corpus(spark, a.input, a.output, a.index, a.phenomenon, a.retry, a.clean)
        _say(A.markdown(coverage.report()))
    elif a.job == "fragment":
        c = chunk.ChunkConfig(a.target_words, a.max_words, a.max_tokens, a.min_words, a.overlap, a.boundary_level, not a.no_atomic, encode.token_counter(a.vocabulary) if a.vocabulary else None)
        print(f"{fragment(spark, a.input, a.output, c)['n_fragments']} fragments")
    elif a.job == "index":
        report = index(spark, a.input, a.output, config(), named(a.encoder), counter())
        print(f"{report['n_vectors']} vectors")
        if report["n_truncated"]:
            _say(f"{report['n_truncated']} fragments are longer than the encoder's window")
            return 1
    elif a.job == "answer":
        said = answer(spark, a.index, a.queries, a.results, config(), named(a.encoder), counter(), a.k, a.top, a.fragments, a.language)
        print(f"{said['queries']} queries answered")
        if said["without_all_documents"]:
            _say(f"{said['without_all_documents']} queries have fewer than {a.top} documents; raise --k")
    elif a.job == "evaluate":
        for k, v in evaluate(spark, a.results, a.truth, a.k_documents, a.k_fragments).items():
            print(f"{k}: {v if v is None or isinstance(v, int) else round(v, 3)}")
    elif a.job == "coverage":
        missing = coverage_of_index(spark, a.index, a.metadata)
        print(A.markdown(missing.orderBy("phenomenon")))
        return 0 if missing.isEmpty() else 1
    elif a.job == "graph":
        report = build_graph(spark, a.metadata, a.output, named(a.dictionary) if a.dictionary else graph.Dictionary(), a.first, a.end, a.most, a.merge, a.partial, a.least_mentions, a.least_weight, not a.no_isolated)
        print(report)
    elif a.job == "sweep":
        print(sweep(spark, a.input))
    elif a.job == "deliver":
        print(A.bundle(spark, dict(p.split("=", 1) for p in a.parts), a.output))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
