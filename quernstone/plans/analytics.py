"""Queries over the larger operators: dictionaries, language, quantiles, tables; registered with the catalogue's."""

from __future__ import annotations

from pyspark.sql import functions as F

from quernstone.functions import language as N
from quernstone.functions import table_functions
from quernstone.operators import assembly as M
from quernstone.operators import contract as K
from quernstone.operators.automaton import match_forms
from quernstone.operators.quantiles import half_even_place, nearest_place, selected
from quernstone.plans.catalogue import ORACLES, query
from quernstone.session import table

#: Runs of three letters by language, their weights, and the sums of each document.
_RUNS = r"""t AS (SELECT doc_id, lang, text, ' ' || trim(regexp_replace(lower(coalesce(text, '')), '[^\p{L}\p{M}]+', ' ', 'g')) || ' ' AS s FROM documents),
dg AS (SELECT doc_id, lang, gram, count(*) AS n FROM (SELECT doc_id, lang, unnest(list_transform(range(1, length(s) - 1), lambda i: substr(s, i, 3))) AS gram FROM t) GROUP BY ALL),
lg AS (SELECT lang, gram, sum(n) AS n FROM dg GROUP BY ALL), total AS (SELECT lang, sum(n) AS total FROM lg GROUP BY lang), d AS (SELECT count(DISTINCT gram) AS d FROM lg),
w AS (SELECT g.gram, total.lang AS of, floor(1000 * ln((coalesce(lg.n, 0) + 1)::DOUBLE / (total + d + 1)))::BIGINT AS w FROM (SELECT DISTINCT gram FROM lg) g CROSS JOIN total CROSS JOIN d LEFT JOIN lg ON lg.gram = g.gram AND lg.lang = total.lang)"""


@query(
    f"""WITH {_RUNS}, s AS (SELECT doc_id, of, sum(n * w)::BIGINT AS score FROM dg JOIN w USING (gram) GROUP BY ALL),
    r AS (SELECT doc_id, of, score, score - lead(score) OVER o AS margin, row_number() OVER o AS r FROM s WINDOW o AS (PARTITION BY doc_id ORDER BY score DESC, of))
    SELECT t.doc_id, CASE WHEN short THEN 'es' ELSE of END AS language, CASE WHEN short THEN 0 ELSE score END AS score, CASE WHEN short THEN 0 ELSE margin END AS margin
    FROM (SELECT *, length(trim(regexp_replace(coalesce(text, ''), '\\s+', ' ', 'g'))) < 20 AS short FROM t) t LEFT JOIN r ON r.doc_id = t.doc_id AND r.r = 1"""
)
def language_model(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return N.guess(docs.select("doc_id", "text"), N.train(docs)).drop("text").na.fill(0)


def _forms(items: list[str]) -> dict[str, tuple[str, str]]:
    """The first word of each text, its first two and its first three, where single spaces part them."""
    heads = [t.split(" ")[:n] for t in items for n in (1, 2, 3)]
    return {" ".join(h): (" ".join(h).lower(), "TEMA") for h in heads if all(w.replace("_", "a").isalnum() for w in h)}


_FORMS = r"""forms AS (SELECT DISTINCT array_to_string(string_split(text, ' ')[1:n], ' ') AS form FROM benchmark, (VALUES (1), (2), (3)) v(n) WHERE len(list_filter(string_split(text, ' ')[1:n], lambda w: NOT regexp_full_match(w, '[\p{L}\p{N}_]+'))) = 0)"""


@query(
    rf"""WITH {_FORMS}, t AS (SELECT doc_id, text, regexp_extract_all(text, '[\p{{L}}\p{{N}}_]+') AS w, string_split_regex(text, '[\p{{L}}\p{{N}}_]+') AS g FROM documents),
    p AS (SELECT doc_id, text, i, length(w[i]) AS size, sum(length(g[i]) + length(w[i])) OVER (PARTITION BY doc_id ORDER BY i) - length(w[i]) AS a FROM (SELECT doc_id, text, w, g, unnest(range(1, len(w) + 1)) AS i FROM t)),
    e AS (SELECT doc_id, text, a, a + size AS z1, lead(a + size, 1) OVER o AS z2, lead(a + size, 2) OVER o AS z3 FROM p WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
    m AS (SELECT doc_id, a, max(z) AS z FROM (SELECT doc_id, a, substr(text, a::BIGINT + 1, (z - a)::BIGINT) AS s, z FROM (SELECT doc_id, text, a, unnest([z1, z2, z3]) AS z FROM e) WHERE z IS NOT NULL) WHERE s IN (SELECT form FROM forms) GROUP BY ALL),
    l AS (SELECT doc_id, list_reduce(list_prepend({{a: 0::BIGINT, z: 0::BIGINT, n: 0::BIGINT, starts: 0::BIGINT, sizes: 0::BIGINT}}, list({{a: a::BIGINT, z: z::BIGINT, n: 1::BIGINT, starts: a::BIGINT, sizes: (z - a)::BIGINT}} ORDER BY a)),
      lambda x, y: CASE WHEN y.a >= x.z THEN {{a: y.a, z: y.z, n: x.n + 1, starts: x.starts + y.a, sizes: x.sizes + y.sizes}} ELSE x END) AS r FROM m GROUP BY doc_id)
    SELECT doc_id, r.n AS n_spans, r.starts AS start_sum, r.sizes AS length_sum FROM l"""
)
def dictionary_spans(spark, sf_dir):
    """Forms from the benchmark's first words, found in every document: leftmost, then longest."""
    items = [r[0] for r in table(spark, sf_dir, "benchmark").where("text IS NOT NULL").select("text").distinct().collect()]  # the dictionary is a parameter
    found = match_forms(table(spark, sf_dir, "documents"), _forms(items), "doc_id")
    size = F.col("end") - F.col("start")
    return found.groupBy("doc_id").agg(F.count("*").alias("n_spans"), F.sum("start").alias("start_sum"), F.sum(size).alias("length_sum"))


@query(
    """SELECT l_returnflag, l_linestatus, quantile_disc(l_extendedprice, 0.5)::DOUBLE AS p50, quantile_disc(l_extendedprice, 0.95)::DOUBLE AS p95,
    list_sort(list(l_extendedprice))[greatest(1, least(count(*), round_even(99.0::DOUBLE * count(*) / 100.0 + 0.5, 0)::BIGINT))]::DOUBLE AS p99 FROM lineitem GROUP BY ALL"""
)
def price_quantiles(spark, sf_dir):
    """Exact order statistics of a column with nearly as many values as rows."""
    n = F.col("n")
    places = {"p50": nearest_place(n, 50), "p95": nearest_place(n, 95), "p99": half_even_place(n, 99)}
    return selected(table(spark, sf_dir, "lineitem").withColumn("l_extendedprice", F.col("l_extendedprice").cast("double")), ["l_returnflag", "l_linestatus"], "l_extendedprice", places)


@query(
    """WITH f AS (SELECT DISTINCT array_to_string(string_split(text, ' ')[1:n], ' ') AS form, n FROM documents, (VALUES (1), (2), (3)) v(n) WHERE text <> ''),
    d AS (SELECT form, any_value(lower(form)) AS name, max(n)::VARCHAR AS kind FROM f GROUP BY form)
    SELECT coalesce(kind, '') AS kind, grouping(kind) = 1 AS is_total, count(DISTINCT (name, kind)) AS n_entities, count(*) AS n_forms FROM d GROUP BY ROLLUP (kind)"""
)
def dictionary_totals(spark, sf_dir):
    """The heads of all documents as a dictionary: one to three words, by case; entities without it."""
    words = F.split("text", " ")
    heads = table(spark, sf_dir, "documents").where("text <> ''").select(F.explode(F.array(*(F.struct(F.array_join(F.slice(words, 1, n), " ").alias("form"), F.lit(n).alias("n")) for n in (1, 2, 3)))).alias("h"))
    forms = heads.groupBy("h.form").agg(F.max("h.n").cast("string").alias("kind")).withColumn("name", F.lower("form"))
    return M.dictionary_totals(forms).na.fill("", ["kind"])


@query(
    """SELECT coalesce(source, '') AS format, grouping(source) = 1 AS is_total, count(*) AS docs, sum(len(string_split(text, chr(10))))::BIGINT AS blocks, sum(length(replace(text, chr(10), '')))::BIGINT AS chars
    FROM documents WHERE text IS NOT NULL GROUP BY ROLLUP (source)"""
)
def extraction_totals(spark, sf_dir):
    """Documents as extracted ones, a line a block, their source as the format; totals from the same pass."""
    docs = table(spark, sf_dir, "documents").where("text IS NOT NULL")
    blocks = F.transform(F.split("text", "\n"), lambda t: F.struct(t.alias("text")))
    return K.extraction_totals(docs.select(F.col("source").alias("format"), blocks.alias("blocks"))).na.fill("", ["format"])


@query(f"SELECT doc_id, n, digest FROM ({ORACLES['sentences']})")
def sentences_by_sql(spark, sf_dir):
    """Sentences by the table function, called from SQL text."""
    table_functions.register(spark)
    table(spark, sf_dir, "documents").createOrReplaceTempView("sentences_by_sql_documents")
    return spark.sql(
        """SELECT doc_id, count(sentence) AS n, md5(array_join(transform(array_sort(collect_list(named_struct('pos', pos, 's', sentence))), x -> x.s), '|')) AS digest
        FROM sentences_by_sql_documents LEFT JOIN LATERAL sentences(text, 'en') GROUP BY doc_id"""
    )
