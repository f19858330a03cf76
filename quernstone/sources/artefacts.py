"""The files that the stages of the engine leave each other: readers and writers.

Names in the files are the fixed ones of their formats; in frames they are this
library's. Files of many rows are JSON lines or Parquet folders that Spark reads
and writes in parallel, GraphML is ordered parts; only small reports are one file.
"""

from __future__ import annotations

import json
from xml.sax.saxutils import quoteattr

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quernstone.functions import text as T
from quernstone.operators.relational import require_unique
from quernstone.sources.keyed import KeyedTable
from quernstone.sources.lines import line_index, line_range, lines_at, numbered_lines

#: Fields of a document file and of its blocks, with the frame's names; those a block may lack.
DOCUMENT_FIELDS = {"doc_id": "doc_id", "fuente": "source", "formato": "format", "fenomeno": "phenomenon", "idioma": "language", "bloques": "blocks", "meta": "meta", "errores": "errors"}
BLOCK_FIELDS = {"texto": "text", "tipo": "kind", "nivel": "level", "ruta": "path", "pagina": "page", "atomico": "atomic", "datos": "data"}
DEFAULTED = ("datos",)
#: Kinds of blocks, formats and units as the files name them.
KINDS = {"titulo": "title", "parrafo": "paragraph", "lista": "list", "fila": "row", "ocr": "ocr"}
FORMATS = {"texto": "txt"}
UNITS = {"prosa": "prose", "atomico": "atomic", "titulo_huerfano": "orphan_title"}
#: Fields of a fragment line.
FRAGMENT_FIELDS = {
    "doc_id": "doc_id", "chunk_id": "chunk_id", "fuente": "source", "formato": "format", "fenomeno": "phenomenon", "posicion": "position", "num_tokens": "n_tokens", "texto": "text",
    "texto_enriquecido": "enriched", "idioma": "language", "observatorio": "observatory", "ruta_relativa": "relative", "seccion": "section", "pagina": "page", "num_palabras": "n_words",
    "tipo_unidad": "unit", "tiene_solape": "overlaps", "n_oraciones": "n_sentences", "datos": "data",
}
FRAGMENT_TYPES = {"phenomenon": "int", "position": "int", "n_tokens": "int", "section": "array<string>", "page": "int", "n_words": "int", "overlaps": "boolean", "n_sentences": "int", "data": "array<map<string,string>>"}
#: Fields that the index's metadata leaves out, and file names.
ENCODED_ONLY = ("enriched",)
MANIFEST, CHUNKS, REPORT, METADATA, RESULTS = "manifiesto.jsonl", "chunks.jsonl", "reporte.json", "metadata.jsonl", "resultados.jsonl"
#: The list of the parts of one logical file.
PARTS = "parts.json"


def _named(column: Column, names: dict[str, str], back: bool = False) -> Column:
    """A value under its other name; unknown ones stay."""
    pairs = names.items() if not back else [(b, a) for a, b in names.items()]
    return F.coalesce(F.create_map(*(F.lit(x) for p in pairs for x in p))[column], column)


def _need(value: Column, json_text: Column, names: list[str], what: str) -> Column:
    """``value``; raises where the JSON object lacks a field."""
    missing = F.array_except(F.array(*map(F.lit, names)), F.json_object_keys(json_text))
    return F.when(F.size(missing) > 0, F.raise_error(F.concat(F.lit(f"{what} lacks fields: "), F.array_join(missing, ", ")))).otherwise(value)


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


# Documents --------------------------------------------------------------------


def document_of_json(rows: DataFrame, column: str = "value") -> DataFrame:
    """Typed documents of JSON texts; a missing field raises, a block may lack those with a default."""
    block = "texto string, tipo string, nivel int, ruta array<string>, pagina int, atomico boolean, datos map<string,string>"
    schema = f"doc_id string, fuente string, formato string, fenomeno int, idioma string, bloques array<struct<{block}>>, meta map<string,string>, errores array<string>"
    raw = F.from_json(column, "bloques array<string>")["bloques"]
    needed = [k for k in BLOCK_FIELDS if k not in DEFAULTED]
    checked = F.transform(raw, lambda b: _need(F.lit(True), b, needed, "a block"))
    body = _need(F.from_json(column, schema, {"mode": "FAILFAST"}), F.col(column), list(DOCUMENT_FIELDS), "a document")
    parsed = rows.select("*", body.alias("_d"), F.coalesce(F.forall(checked, lambda x: x), F.lit(True)).alias("_ok"))
    typed = lambda b: F.struct(
        b["texto"].alias("text"), _named(b["tipo"], KINDS).alias("kind"), b["nivel"].alias("level"), b["ruta"].alias("path"), b["pagina"].alias("page"), b["atomico"].alias("atomic"),
        F.coalesce(b["datos"], F.create_map().cast("map<string,string>")).alias("data"),
    )
    kept = [c for c in rows.columns if c != column]
    return parsed.where("_ok").select(
        *kept, "_d.doc_id", F.col("_d.fuente").alias("source"), _named(F.col("_d.formato"), FORMATS).alias("format"), F.col("_d.fenomeno").alias("phenomenon"), F.col("_d.idioma").alias("language"),
        F.transform("_d.bloques", typed).alias("blocks"), "_d.meta", F.col("_d.errores").alias("errors"),
    )


def document_json(docs: DataFrame, indent: bool = False) -> Column:
    """A document as JSON with its keys in order; null fields are written."""
    block = lambda b: F.struct(*(
        (_named(b[to], KINDS, True) if to == "kind" else b[to]).alias(name) for name, to in sorted(BLOCK_FIELDS.items())
    ))
    empty = {"errors": F.array().cast("array<string>"), "data": None}
    value = {"blocks": F.transform("blocks", block), "format": _named(F.col("format"), FORMATS, True)}
    columns = [(value.get(to, F.col(to)) if to in docs.columns else empty.get(to, F.lit(None).cast("string"))).alias(name) for name, to in sorted(DOCUMENT_FIELDS.items())]
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"} | ({"pretty": "true"} if indent else {}))


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents of a folder of JSON files with ``place``: the manifest's order, else that of the file names.

    Files that the manifest does not list are left out; a listed one that is
    missing raises. A missing folder raises.
    """
    if not exists(spark, folder):
        raise ValueError(f"no such folder: {folder}")
    files = spark.read.option("pathGlobFilter", "*.json").text(folder, wholetext=True).withColumn("_file", F.regexp_extract(F.input_file_name(), r"([^/]+)\.json$", 1))
    if exists(spark, f"{folder}/{MANIFEST}"):
        lines = numbered_lines(spark, f"{folder}/{MANIFEST}").where(F.trim("value") != "")
        order = lines.select(F.get_json_object("value", "$.doc_id").alias("_file"), F.col("line").alias("place"))
        joined = order.join(files, "_file", "left")
        files = joined.withColumn("value", F.when(F.col("value").isNull(), F.raise_error(F.concat(F.lit("the manifest lists a document without a file: "), F.col("_file")))).otherwise(F.col("value")))
    else:
        files = files.withColumn("place", F.col("_file"))
    return document_of_json(files.select("place", "value"))


def write_documents(docs: DataFrame, folder: str, place: str = "doc_id") -> None:
    """Documents as JSON lines, keys sorted, in ranges of ``place``; what was there is replaced.

    One file a document does not scale; :func:`write_document_files` does that.
    """
    docs.orderBy(place).select(document_json(docs).alias("value")).write.mode("overwrite").text(folder)


def document_table(spark: SparkSession, folder: str) -> KeyedTable:
    """The table of a folder's documents by id: lines of JSON, rewritten only where they change."""
    return KeyedTable(spark, f"{folder}/documents", "doc_id", text_key=F.get_json_object("value", "$.doc_id"))


def write_document_files(docs: DataFrame, folder: str) -> None:
    """A folder of its own for each document, keys sorted, indented; what was there is replaced."""
    docs.select("doc_id", document_json(docs, True).alias("value")).write.mode("overwrite").partitionBy("doc_id").text(folder)


def manifest_rows(docs: DataFrame) -> DataFrame:
    """A summary row for each document."""
    chars = F.aggregate("blocks", F.lit(0).cast("long"), lambda a, b: a + F.length(b["text"]))
    return docs.select(
        "doc_id", "source", "format", "phenomenon", "language", F.size("blocks").alias("n_blocks"), chars.alias("n_chars"), F.size("errors").alias("n_errors"),
        F.col("meta")["observatorio"].alias("observatory"), F.coalesce(F.col("meta")["fuente_ambigua"] == "true", F.lit(False)).alias("ambiguous_name"),
    )


_MANIFEST_FIELDS = {"doc_id": "doc_id", "fuente": "source", "formato": "format", "fenomeno": "phenomenon", "idioma": "language", "n_bloques": "n_blocks", "n_chars": "n_chars", "n_errores": "n_errors", "observatorio": "observatory", "fuente_ambigua": "ambiguous_name"}


def write_manifest(rows: DataFrame, path: str, order: list[str]) -> None:
    """Manifest rows as JSON lines in a total order; what was there is replaced."""
    fields = F.struct(*(F.col(c).alias(n) for n, c in sorted(_MANIFEST_FIELDS.items())))
    rows.orderBy(*order).select(F.to_json(fields, {"ignoreNullFields": "false"}).alias("value")).write.mode("overwrite").text(path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Manifest rows; bad lines raise, blank ones are passed over."""
    types = {"n_blocks": "int", "n_chars": "long", "n_errors": "int", "phenomenon": "int", "ambiguous_name": "boolean"}
    schema = ", ".join(f"{n} {types.get(c, 'string')}" for n, c in _MANIFEST_FIELDS.items())
    return spark.read.json(path, schema=schema, mode="FAILFAST").withColumnsRenamed(_MANIFEST_FIELDS)


# Fragments --------------------------------------------------------------------


def fragment_schema() -> str:
    return ", ".join(f"{n} {FRAGMENT_TYPES.get(c, 'string')}" for n, c in FRAGMENT_FIELDS.items())


def complete_fragments(fragments: DataFrame, docs: DataFrame) -> DataFrame:
    """Fragments with what their documents say: source, format, phenomenon, language, observatory, relative path."""
    relative = F.coalesce(F.nullif(F.trim(F.col("meta")["ruta_relativa"]), F.lit("")), F.col("source"))
    known = docs.select("doc_id", "source", "format", "phenomenon", "language", F.col("meta")["observatorio"].alias("observatory"), relative.alias("relative"))
    made = fragments.join(known, "doc_id")
    return made if "data" in made.columns else made.withColumn("data", F.array().cast(FRAGMENT_TYPES["data"]))


def _fragment_json(fragments: DataFrame, without: tuple[str, ...] = ()) -> Column:
    value = {"unit": _named(F.col("unit"), UNITS, True), "format": _named(F.col("format"), FORMATS, True)}
    fields = [value.get(c, F.col(c)).alias(n) for n, c in sorted(FRAGMENT_FIELDS.items()) if c in fragments.columns and c not in without]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def write_fragments(fragments: DataFrame, path: str, order: tuple[str, ...] = ("doc_id", "position")) -> None:
    """Fragments as JSON lines, keys sorted, in order; what was there is replaced."""
    fragments.orderBy(*order).select(_fragment_json(fragments).alias("value")).write.mode("overwrite").text(path)


def _typed_fragments(lines: DataFrame) -> DataFrame:
    """Fragments of JSON texts (row_id, value); bad ones raise, absent fields are null."""
    parsed = F.from_json("value", fragment_schema(), {"mode": "FAILFAST"})
    rows = lines.select("row_id", parsed.alias("f")).select("row_id", "f.*").withColumnsRenamed(FRAGMENT_FIELDS)
    return rows.withColumns({"unit": _named(F.col("unit"), UNITS), "format": _named(F.col("format"), FORMATS)})


def read_fragments(spark: SparkSession, path: str) -> DataFrame:
    """Fragments of JSON lines with ``row_id``, their place among the lines that are not blank.

    The lines of a folder are those of its parts in the order of their names. Bad
    lines, a missing enriched text and an empty file raise.
    """
    lines = numbered_lines(spark, path, blank=False).withColumnRenamed("line", "row_id")
    if lines.isEmpty():
        raise ValueError(f"{path} holds no fragments")
    bad = F.coalesce(F.col("enriched"), F.lit("")) == ""
    return _typed_fragments(lines).withColumn("enriched", F.when(bad, F.raise_error(F.concat(F.lit("a fragment without the text to encode, row "), F.col("row_id").cast("string")))).otherwise(F.col("enriched")))


def scan_fragments(spark: SparkSession, path: str, first: int = 0, end: int | None = None, most: int | None = None, index: DataFrame | None = None) -> DataFrame:
    """Fragments for graphs (doc_id, chunk_id, source, phenomenon, text, language, line) of lines ``first`` to ``end``.

    A range is read by byte offsets, from ``index`` (see ``lines.line_index``) or one
    made for it; all lines by one scan. Lines that are no JSON and empty texts are
    passed over, absent fields are empty or 0. ``most`` keeps the first rows, which
    is the feature.
    """
    whole = first == 0 and end is None
    lines = numbered_lines(spark, path) if whole else line_range(line_index(spark, path) if index is None else index, first, end)
    f = F.from_json("value", "doc_id string, chunk_id string, fuente string, fenomeno int, texto string, idioma string")
    rows = lines.select("line", f.alias("f")).where(F.coalesce("f.texto", F.lit("")) != "")
    said = lambda c: F.coalesce(f"f.{c}", F.lit(""))
    out = rows.select(said("doc_id").alias("doc_id"), said("chunk_id").alias("chunk_id"), said("fuente").alias("source"), F.coalesce("f.fenomeno", F.lit(0)).alias("phenomenon"), F.col("f.texto").alias("text"), said("idioma").alias("language"), "line")
    return out if most is None else out.orderBy("line").limit(most)


def write_metadata(fragments: DataFrame, path: str, order: str = "row_id") -> None:
    """A line for each vector in the index's order, without what only the encoder reads."""
    fragments.orderBy(order).select(_fragment_json(fragments, ENCODED_ONLY).alias("value")).write.mode("overwrite").text(path)


def documents_with_vectors(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id): the documents that the index's metadata names."""
    return spark.read.json(path, schema="doc_id string").where(F.length("doc_id") > 0).distinct()


def metadata_of(hits: DataFrame, index: DataFrame, columns: list[str]) -> DataFrame:
    """``hits`` with columns of the metadata lines that their ``row_id`` numbers, looked up after the cut.

    ``index`` is the metadata's (``lines.line_index``): only the runs of lines that
    hold a hit are read, each once.
    """
    found = lines_at(index, hits, "row_id").withColumnRenamed("line", "row_id")
    return hits.join(_typed_fragments(found).select("row_id", *columns), "row_id", "left")


# Answers ----------------------------------------------------------------------


def result_rows(queries: DataFrame, documents: DataFrame, fragments: DataFrame | None = None) -> DataFrame:
    """A nested answer for each query: ``documents`` by place, and ``fragments`` where given.

    ``documents`` has (query_id, place, doc_id, score, n_fragments, ...) and
    ``fragments`` (query_id, place, chunk_id, doc_id, score, ...), with the metadata
    columns that exist; scores have 6 places. Queries without hits have empty lists.
    """
    wanted = {"puesto": "place", "doc_id": "doc_id", "fuente": "source", "ruta_relativa": "relative", "fenomeno": "phenomenon", "observatorio": "observatory", "score": "score", "n_fragmentos": "n_fragments", "chunk_id": "chunk_id", "pagina": "page", "texto": "text"}
    short = {k: wanted[k] for k in ("puesto", "chunk_id", "doc_id", "fuente", "score", "pagina", "texto")}

    def listed(df: DataFrame, fields: dict[str, str], name: str) -> DataFrame:
        value = lambda c: F.round("score", 6) if c == "score" else F.col(c) if c in df.columns else F.lit(None).cast("string")
        return df.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct(*(value(c).alias(n) for n, c in fields.items())))).alias(name))

    rows = queries.select("query_id", F.col("query").alias("consulta")).join(listed(documents, wanted, "documentos"), "query_id", "left")
    if fragments is not None:
        rows = rows.join(listed(fragments, short, "fragmentos"), "query_id", "left")
    lists = [c for c in ("documentos", "fragmentos") if c in rows.columns]
    return rows.withColumns({c: F.coalesce(c, F.array().cast(rows.schema[c].dataType)) for c in lists})


def write_results(rows: DataFrame, path: str) -> None:
    """Answers as JSON lines by query; an empty list of fragments is not written."""
    columns = [F.when(F.size(c) > 0, F.col(c)).alias(c) if c == "fragmentos" else F.col(c) for c in rows.columns]
    rows.orderBy("query_id").select(F.to_json(F.struct(*columns)).alias("value")).write.mode("overwrite").text(path)


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """(query_id, kind, rank, item, doc_id): delivered documents and fragments; bad lines and repeated queries raise."""
    if not exists(spark, path):
        raise ValueError(f"no results: {path}")
    item = "array<struct<puesto: int, doc_id: string, chunk_id: string>>"
    rows = require_unique(spark.read.json(path, schema=f"query_id string, documentos {item}, fragmentos {item}", mode="FAILFAST"), "query_id")
    out = lambda c, kind, of: rows.select("query_id", F.inline(c)).select("query_id", F.lit(kind).alias("kind"), F.col("puesto").alias("rank"), F.col(of).alias("item"), "doc_id")
    return out("documentos", "document", "doc_id").unionByName(out("fragmentos", "fragment", "chunk_id"))


def read_truth(spark: SparkSession, path: str) -> DataFrame:
    """(query_id, item, rank, doc_id): the relevant fragments of each question; an unexpected fragment id raises."""
    if not exists(spark, path):
        raise ValueError(f"no ground truth: {path}")
    schema = "question_id string, relevant_chunks array<struct<rank: int, chunk_id: string>>"
    rows = spark.read.json(path, schema=schema, multiLine=True, mode="FAILFAST").select(F.col("question_id").alias("query_id"), F.inline("relevant_chunks"))
    last = rows.groupBy("query_id", F.col("chunk_id").alias("item")).agg(F.max("rank").alias("rank"))
    return last.select("query_id", "item", "rank", T.document_of_fragment(F.col("item")).alias("doc_id"))


# Graphs and reports -----------------------------------------------------------


def write_partial(nodes: DataFrame, edges: DataFrame, facts: DataFrame, folder: str) -> None:
    """A partial graph as three tables; see ``operators.graph``."""
    for name, df in (("nodes", nodes), ("edges", edges), ("facts", facts)):
        df.write.mode("overwrite").parquet(f"{folder}/{name}")


def read_partial(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return tuple(spark.read.parquet(f"{folder}/{name}") for name in ("nodes", "edges", "facts"))


def _escaped(value: Column) -> Column:
    out = value
    for c, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        out = F.replace(out, F.lit(c), F.lit(entity))
    return out


def graphml_lines(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(section, k1, k2, k3, value): the lines of the graph in GraphML, in the order of the first four.

    Nodes are in the order of their keys, edges in that of their ends; an end that is
    no node goes by its key. Lists are joined by commas, nulls are left out.
    """
    spark = nodes.sparkSession
    kinds = {"bigint": "long", "int": "int", "double": "double"}
    columns = [("node", c, kinds.get(t, "string")) for c, t in nodes.dtypes if c not in ("node", "name")] + [("edge", c, kinds.get(t, "string")) for c, t in edges.dtypes if c not in ("a", "b")]
    key = {(of, c): f"d{k}" for k, (of, c, _) in enumerate(columns)}
    head = ['<?xml version="1.0" encoding="utf-8"?>', '<graphml xmlns="http://graphml.graphdrawing.org/xmlns">']
    head += [f'<key id="{key[of, c]}" for="{of}" attr.name={quoteattr(c)} attr.type="{t}"/>' for of, c, t in columns] + ['<graph edgedefault="directed">']

    def data(of: str, df: DataFrame) -> Column:
        text = lambda c: F.array_join(F.col(c).cast("array<string>"), ",") if dict(df.dtypes)[c].startswith("array") else F.col(c).cast("string")
        return F.concat(F.lit(""), *(F.coalesce(F.concat(F.lit(f'<data key="{key[of, c]}">'), _escaped(text(c)), F.lit("</data>")), F.lit("")) for o, c, _ in columns if o == of))

    line = lambda k, *parts: F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts)).alias("value")
    node = nodes.select(F.lit(1).alias("section"), F.col("node").alias("k1"), F.lit("").alias("k2"), F.lit("").alias("k3"), line(1, '<node id="', _escaped(F.col("name")), '">', data("node", nodes), "</node>"))
    ends = edges
    for end in ("a", "b"):
        names = nodes.select(F.col("node").alias(end), F.col("name").alias(f"_{end}"))
        ends = ends.join(names, end, "left")
    said = lambda end: _escaped(F.coalesce(f"_{end}", end))
    edge = ends.select(F.lit(2).alias("section"), F.col("a").alias("k1"), F.col("relation").alias("k2"), F.col("b").alias("k3"), line(2, '<edge source="', said("a"), '" target="', said("b"), '">', data("edge", ends), "</edge>"))
    rim = [(0, f"{k:06d}", "", "", v) for k, v in enumerate(head)] + [(3, f"{k}", "", "", v) for k, v in enumerate(("</graph>", "</graphml>"))]
    return node.unionByName(edge).unionByName(spark.createDataFrame(rim, "section int, k1 string, k2 string, k3 string, value string"))


def write_graphml(nodes: DataFrame, edges: DataFrame, folder: str) -> dict:
    """The graph as one logical file in ordered parts below ``folder``; gives the manifest, which is written last.

    A range sort places the lines, so any size is written by all tasks and parts in the
    order of their names are the file. A folder without its manifest is unfinished.
    """
    spark = nodes.sparkSession
    root = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    system.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{PARTS}"), False)
    graphml_lines(nodes, edges).orderBy("section", "k1", "k2", "k3").select("value").write.mode("overwrite").text(f"{folder}/parts")
    files = system.listStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/parts"))
    parts = sorted((f.getPath().getName(), f.getLen()) for f in files if f.getPath().getName().startswith("part-") and f.getLen())
    manifest = {"parts": [{"name": n, "bytes": size} for n, size in parts], "bytes": sum(size for _, size in parts)}
    write_small(spark, json.dumps(manifest), f"{folder}/{PARTS}")
    return manifest


def join_parts(spark: SparkSession, folder: str, target: str) -> int:
    """The parts below ``folder`` as one file, copied from stream to stream in the manifest's order; its bytes.

    A missing manifest or a part of another size raises.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path
    conf = spark._jsc.hadoopConfiguration()
    source = path(f"{folder}/{PARTS}")
    system = source.getFileSystem(conf)
    if not system.exists(source):
        raise ValueError(f"no finished file in {folder}")
    stream = system.open(source)
    manifest = json.loads(bytes(stream.readAllBytes()).decode())
    stream.close()
    out = path(target).getFileSystem(conf).create(path(target), True)
    for part in manifest["parts"]:
        own = path(f"{folder}/parts/{part['name']}")
        if system.getFileStatus(own).getLen() != part["bytes"]:
            raise ValueError(f"part {part['name']} is not as it was written")
        stream = system.open(own)
        spark._jvm.org.apache.hadoop.io.IOUtils.copyBytes(stream, out, 1 << 16, False)
        stream.close()
    out.close()
    return manifest["bytes"]


def write_small(spark: SparkSession, text: str, path: str) -> None:
    """One small text as one file in whatever store the path is; what was there is replaced."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark._jsc.hadoopConfiguration()).create(p, True)
    out.write(bytearray(text.encode()))
    out.close()


def write_report(spark: SparkSession, report: dict, path: str) -> None:
    write_small(spark, json.dumps(report, ensure_ascii=False, sort_keys=True, indent=2, default=str) + "\n", path)


def markdown(rows: DataFrame, most: int = 1000) -> str:
    """A small table as Markdown; more than ``most`` rows raise."""
    found = rows.limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"more than {most} rows are no table to read")
    line = lambda cells: "| " + " | ".join("" if c is None else str(c).replace("|", "\\|") for c in cells) + " |"
    return "\n".join([line(rows.columns), line("---" for _ in rows.columns), *map(line, found)])


def bundle(spark: SparkSession, parts: dict[str, str], target: str) -> dict[str, int]:
    """Copies the lines of text tables (name -> path) under ``target``; lines of each. A missing part raises."""
    missing = [k for k, v in parts.items() if not exists(spark, v)]
    if missing:
        raise ValueError(f"the delivery lacks {missing}")
    for name, path in parts.items():
        table = KeyedTable(spark, path, "key", text_key=F.lit(None))
        (table.read().select("value") if table.versions() else spark.read.text(path)).write.mode("overwrite").text(f"{target}/{name}")
    return {name: spark.read.text(f"{target}/{name}").count() for name in parts}
