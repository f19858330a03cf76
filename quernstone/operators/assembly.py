"""The aggregated graph of a corpus of fragments: partial sums, their merge, the pruned graph.

A partial graph is two tables that add up: mentions by (node, document,
phenomenon) and triples by (a, relation, b, document, phenomenon). A fragment lies
in one document, so batches of fragments, of any ranges, merge by summing; the
graph of all at once is the same thing with one part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quernstone.functions import text as T
from quernstone.operators import graph as G
from quernstone.session import materialise

#: Sample fragments of a node or edge, relations listed in the statistics, kinds that must earn their place.
TRACES, LISTED = 20, 40
HEURISTIC = ("SIGLA", "NOMBRE")


def analyse(fragments: DataFrame, dictionary: G.Dictionary) -> tuple[DataFrame, DataFrame]:
    """Entities and triples of fragments (line, text, ...), with doc_id, chunk_id and phenomenon beside each."""
    keep = ("doc_id", "chunk_id", "phenomenon")
    found = materialise(G.recognise(fragments, dictionary, "line", "text", keep), "entities")
    beside = found.groupBy("line").agg(*(F.first(c).alias(c) for c in keep))
    return found, G.triples(found, "line").join(beside, "line")


def _first(rows: Column | str) -> Column:
    """The first TRACES fragments of a group, in the corpus's order."""
    return F.slice(F.array_sort(F.collect_set(rows)), 1, TRACES)


def partial_nodes(found: DataFrame) -> DataFrame:
    """(node, doc_id, phenomenon, mentions, n_chunks, best, chunks): what a document says of a node.

    ``best`` orders mentions by trust and place, and names the node.
    """
    best = F.struct((F.col("origin") != "dictionary").alias("guess"), "line", "pos", "name", "kind")
    return found.groupBy(T.entity_key(F.col("name")).alias("node"), "doc_id", "phenomenon").agg(
        F.count("*").alias("mentions"), F.count_distinct("line").alias("n_chunks"), F.min(best).alias("best"), _first(F.struct("line", "chunk_id")).alias("chunks")
    )


def partial_edges(triples: DataFrame) -> DataFrame:
    """(a, relation, b, doc_id, phenomenon, weight, chunks)."""
    key = lambda c: T.entity_key(F.col(c)).alias(c)
    rows = triples.select("line", "doc_id", "chunk_id", "phenomenon", key("a"), "relation", key("b")).where("a <> b")
    return rows.groupBy("a", "relation", "b", "doc_id", "phenomenon").agg(F.count("*").alias("weight"), _first(F.struct("line", "chunk_id")).alias("chunks"))


def partial_facts(fragments: DataFrame, found: DataFrame, triples: DataFrame) -> DataFrame:
    """(what, kind, n): counts of a run; all add up over batches."""
    node = T.entity_key(F.col("name"))
    total = lambda df, what: df.agg(F.lit(what).alias("what"), F.lit("").alias("kind"), F.count("*").alias("n"))
    by = lambda df, key, what: df.groupBy(F.col(key).alias("kind")).agg(F.count("*").alias("n")).select(F.lit(what).alias("what"), "kind", "n")
    first = found.groupBy("line", node.alias("node")).agg(F.min_by("origin", "pos").alias("origin"))
    lines = found.select("line").distinct()
    linked = triples.where(T.entity_key(F.col("a")) != T.entity_key(F.col("b")))
    parts = [total(fragments, "fragments"), total(fragments.join(lines, "line", "left_anti"), "without entities"), total(linked, "triples"), by(first, "origin", "mentions by origin"), by(linked, "relation", "triples by relation")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def accumulate(fragments: DataFrame, dictionary: G.Dictionary) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Partial nodes, edges and facts of fragments (line, doc_id, chunk_id, phenomenon, text).

    Ranges of fragments may be taken one by one and merged; see ``sources.artefacts``
    for reading them by lines and keeping partial tables.
    """
    found, triples = analyse(fragments, dictionary)
    return partial_nodes(found), partial_edges(triples), partial_facts(fragments, found, triples)


def merge(*parts: tuple[DataFrame, DataFrame, DataFrame]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """One partial graph of several over disjoint fragments."""
    every = []
    for frames in zip(*parts, strict=True):
        out = frames[0]
        for df in frames[1:]:
            out = out.unionByName(df)
        every.append(out)
    nodes, edges, facts = every
    joined = F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("chunks")))), 1, TRACES).alias("chunks")  # a list a part
    nodes = nodes.groupBy("node", "doc_id", "phenomenon").agg(F.sum("mentions").alias("mentions"), F.sum("n_chunks").alias("n_chunks"), F.min("best").alias("best"), joined)
    edges = edges.groupBy("a", "relation", "b", "doc_id", "phenomenon").agg(F.sum("weight").alias("weight"), joined)
    return nodes, edges, facts.groupBy("what", "kind").agg(F.sum("n").alias("n"))


def _phenomena(rows: DataFrame, keys: list[str], count: str) -> DataFrame:
    """(keys, phenomena): those met, most frequent first; 0 stands for none."""
    sums = rows.where("phenomenon > 0").groupBy(*keys, "phenomenon").agg(F.sum(count).alias("n"))
    listed = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), "phenomenon")))
    return sums.groupBy(*keys).agg(F.transform(listed, lambda x: x["phenomenon"]).alias("phenomena"))


def _samples(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, chunk_ids): the first fragments; the cut is made before rows of a key meet."""
    w = Window.partitionBy(*keys).orderBy("line", "chunk_id")
    each = rows.select(*keys, F.inline("chunks")).withColumn("r", F.row_number().over(w)).where(F.col("r") <= TRACES)
    return each.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("r", "chunk_id"))), lambda x: x["chunk_id"]).alias("chunk_ids"))


def node_table(partial: DataFrame) -> DataFrame:
    """(node, name, kind, mentions, n_chunks, n_docs, phenomena, chunk_ids) of partial nodes."""
    sums = partial.groupBy("node").agg(F.min("best").alias("best"), F.sum("mentions").alias("mentions"), F.sum("n_chunks").alias("n_chunks"), F.count_distinct("doc_id").alias("n_docs"))
    rows = sums.select("node", "best.name", "best.kind", "mentions", "n_chunks", "n_docs")
    none = F.array().cast("array<int>")
    return rows.join(_phenomena(partial, ["node"], "mentions"), "node", "left").join(_samples(partial, ["node"]), "node", "left").withColumn("phenomena", F.coalesce(F.col("phenomena").cast("array<int>"), none))


def edge_table(partial: DataFrame) -> DataFrame:
    """(a, relation, b, weight, n_docs, phenomena, chunk_ids) of partial edges."""
    keys = ["a", "relation", "b"]
    sums = partial.groupBy(*keys).agg(F.sum("weight").alias("weight"), F.count_distinct("doc_id").alias("n_docs"))
    none = F.array().cast("array<int>")
    return sums.join(_phenomena(partial, keys, "weight"), keys, "left").join(_samples(partial, keys), keys, "left").withColumn("phenomena", F.coalesce(F.col("phenomena").cast("array<int>"), none))


def assemble(nodes: DataFrame, edges: DataFrame, facts: DataFrame, least_mentions: int = 2, least_weight: int = 1, isolated: bool = True) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The pruned graph of partial tables and its statistics (what, kind, n).

    Nodes that only heuristics found need ``least_mentions``, edges ``least_weight``
    and both ends; without ``isolated`` nodes on no edge go.
    """
    every_node, every_edge = materialise(node_table(nodes), "nodes"), materialise(edge_table(edges), "edges")
    kept, lines = G.pruned(every_node, every_edge, least_mentions, least_weight, isolated)
    lines = every_edge.join(lines.select("a", "relation", "b"), ["a", "relation", "b"], "left_semi")
    total = lambda df, what: df.agg(F.lit(what).alias("what"), F.lit("").alias("kind"), F.count("*").alias("n"))
    cut = every_edge.join(lines.select("a", "relation", "b"), ["a", "relation", "b"], "left_anti")
    kinds = kept.groupBy("kind").agg(F.count("*").alias("n")).select(F.lit("nodes by kind").alias("what"), "kind", "n")
    common = facts.where(F.col("what") == "triples by relation").orderBy(F.desc("n"), "kind").limit(LISTED)
    rest = facts.where(F.col("what") != "triples by relation")
    statistics = rest.unionByName(common).unionByName(kinds)
    for df, what in ((kept, "nodes"), (lines, "edges"), (cut, "edges pruned"), (G.isolated(kept, lines), "isolated nodes")):
        statistics = statistics.unionByName(total(df, what))
    return kept, lines, statistics


def dictionary_forms(spark: SparkSession, dictionary: G.Dictionary) -> DataFrame:
    """(form, name, kind): a dictionary as a table, a row a surface form; a form by case goes before the same one without."""
    forms = {**dictionary.insensitive, **dictionary.sensitive}
    return spark.createDataFrame([(f, *entry) for f, entry in forms.items()], "form string, name string, kind string")


def dictionary_totals(forms: DataFrame) -> DataFrame:
    """(kind, is_total, n_entities, n_forms) of a dictionary table: a row a kind, and one of all, from one pass."""
    sums = forms.rollup("kind").agg(F.grouping_id().alias("g"), F.count_distinct(F.struct("name", "kind")).alias("n_entities"), F.count("*").alias("n_forms"))
    return sums.select("kind", (F.col("g") == 1).alias("is_total"), "n_entities", "n_forms")


def dictionary_summary(forms: DataFrame) -> dict[str, int]:
    """Entities of a dictionary table by kind, and totals of entities and of surface forms."""
    rows = dictionary_totals(forms).orderBy("is_total", "kind").collect()  # a row a kind
    out = {r["kind"]: r["n_entities"] for r in rows if not r["is_total"]}
    total = next((r for r in rows if r["is_total"]), None)
    return out | {"_total_entidades": total["n_entities"] if total else 0, "_total_variantes": total["n_forms"] if total else 0}
