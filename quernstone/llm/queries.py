"""The registered query of each operator, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quernstone.session import table


def vocabulary_file(name: str = "byte_bpe_50k.json") -> str:
    """Where the public tokenizer package keeps a file."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quernstone.llm.warc import archive_pages

    return archive_pages(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quernstone.llm.decontaminate import find_leaks

    leaks = find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return leaks.select("doc_id", "contaminated", "item_id", "share", "item_ids")


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quernstone.llm.secrets import scan_documents

    return scan_documents(table(spark, sf_dir, "documents")).drop("text_hash", "findings")


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quernstone.llm.bpe import encode_documents

    return encode_documents(table(spark, sf_dir, "documents"), vocabulary_file(), digests_only=True)


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quernstone.llm.sharding import shard_documents

    return shard_documents(table(spark, sf_dir, "documents"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quernstone.llm.simhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quernstone.llm.repeats import deduplicate

    return deduplicate(table(spark, sf_dir, "documents"), keep_text=False)


def op8_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quernstone.llm.lm_score import score_documents

    return score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quernstone.llm.toxicity import classify_documents

    return classify_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from quernstone.llm.ann import nearest

    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op11_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quernstone.llm.lexical import search_documents

    return search_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quernstone.llm.jaccard import jaccard_join

    return jaccard_join(table(spark, sf_dir, "documents"))


def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quernstone.llm.importance import resample

    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("n_words")


QUERIES = {"op1_warc": op1_warc, "op2_decontamination": op2_decontamination, "op3_secrets": op3_secrets, "op4_bpe": op4_bpe, "op5_sharding": op5_sharding, "op6_simhash": op6_simhash, "op7_repeats": op7_repeats, "op8_lm_score": op8_lm_score, "op9_toxicity": op9_toxicity, "op10_ann": op10_ann, "op11_lexical": op11_lexical, "op12_jaccard": op12_jaccard, "op13_importance": op13_importance}


def _secrets_sql() -> str:
    """DuckDB SQL for op3_secrets: the same patterns, positions and linking by running extremes."""
    from quernstone.llm import secrets as rules

    patterns = dict(zip(rules.KINDS, (rules.ASSIGN, rules.ACCESS, rules.HEX, rules.IDENT, rules.MIXED, rules.ENDPOINT), strict=True))
    quoted = {k: "'" + p.replace("'", "''") + "'" for k, p in patterns.items()}
    keep = {
        "assign": f"length(regexp_extract(m, {quoted['assign']}, 2)) >= 6",
        "ident": f"length(regexp_extract(m, {quoted['ident']}, 2)) >= 4",
        "secret": "regexp_matches(m, '[0-9]') AND regexp_matches(m, '[a-z]') AND regexp_matches(m, '[A-Z]')",
    }
    found = " UNION ALL ".join(
        f"SELECT rid, {k} AS kind, i, ms[i] AS m, length(gs[i]) AS skip, {keep.get(n, 'true').replace('(m,', '(ms[i],')} AS keep FROM "
        f"(SELECT rid, ms, gs, unnest(range(1, len(ms) + 1)) AS i FROM (SELECT rid, regexp_extract_all(text, {p}) AS ms, string_split_regex(text, {p}) AS gs FROM t))"
        for k, (n, p) in enumerate(quoted.items())
    )
    near = lambda kinds: rules.near(kinds, rules.SCOPE).replace("`end`", "stop")
    names = "[" + ", ".join(f"'{k}'" for k in rules.KINDS) + "]"
    listed = f"string_agg({names}[kind + 1] || ':' || start || ':' || stop, ',' ORDER BY start, kind)"
    return f"""WITH t AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents), found AS ({found}),
    placed AS (SELECT rid, kind, keep, length(m) AS size, (sum(skip + length(m)) OVER (PARTITION BY rid, kind ORDER BY i))::BIGINT - length(m) AS start FROM found),
    kept AS (SELECT rid, kind, start, start + size AS stop FROM placed WHERE keep),
    marked AS (SELECT *, kind = 4 AND coalesce(max(CASE WHEN kind <= 2 THEN stop END) OVER (PARTITION BY rid ORDER BY start, kind ROWS UNBOUNDED PRECEDING) > start, false) AS covered FROM kept),
    linked AS (SELECT *, {near(rules.IDS)} AS by_id, {near(rules.SECRETS)} AS by_secret FROM marked WHERE NOT covered),
    spans AS (SELECT * FROM linked WHERE kind <= 2 OR (kind = 3 AND by_secret) OR (kind = 4 AND by_id) OR (kind = 5 AND by_id AND by_secret))
    SELECT doc_id, count(*) FILTER (WHERE kind = 0) AS n_assign, count(*) FILTER (WHERE kind = 1) AS n_access, count(*) FILTER (WHERE kind = 2) AS n_hex,
    sha256(coalesce({listed} FILTER (WHERE kind <= 2), '')) AS base_sha256, coalesce({listed}, '') AS spans
    FROM t LEFT JOIN spans USING (rid) GROUP BY rid, doc_id"""


#: Windows of 50 bytes with the smallest document of each; what they cover is cut out.
_REPEATS_SQL = """WITH t AS (SELECT row_number() OVER () AS rid, coalesce(doc_id, 9223372036854775807) AS doc, doc_id, encode(coalesce(text, '')) AS b FROM documents),
w AS (SELECT rid, doc, p, array_slice(b, p + 1, p + 50) AS s FROM (SELECT rid, doc, b, unnest(range(0, greatest(octet_length(b) - 49, 0))) AS p FROM t)),
least AS (SELECT s, min(doc) AS first FROM w GROUP BY s HAVING min(doc) < max(doc)),
hit AS (SELECT rid, p FROM w JOIN least USING (s) WHERE doc > first),
run AS (SELECT rid, p, sum(fresh) OVER (PARTITION BY rid ORDER BY p) AS k FROM (SELECT rid, p, (p > coalesce(lag(p) OVER (PARTITION BY rid ORDER BY p) + 50, -1))::INT AS fresh FROM hit)),
span AS (SELECT rid, min(p) AS a, max(p) + 50 AS z FROM run GROUP BY rid, k),
kept AS (SELECT rid, a, z, coalesce(lag(z) OVER (PARTITION BY rid ORDER BY a), 0) AS before FROM span),
cut AS (SELECT t.rid, sum(z - a)::BIGINT AS n_removed, count(*) AS n_spans, string_agg(hex(array_slice(b, before + 1, a)), '' ORDER BY a) || hex(array_slice(any_value(b), max(z) + 1, any_value(octet_length(b)))) AS h FROM kept JOIN t USING (rid) GROUP BY t.rid)
SELECT doc_id, octet_length(b)::BIGINT AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(coalesce(from_hex(h), b)) AS kept_sha256 FROM t LEFT JOIN cut USING (rid)"""
#: The response of equal payloads is their largest page.
_WARC_SQL = """WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS d FROM pages), g AS (SELECT d, max(page_id) AS top FROM p WHERE n >= 1000 GROUP BY d)
SELECT page_id, n::BIGINT AS payload_bytes, d AS payload_digest, CASE WHEN n >= 1000 AND page_id < top THEN 'revisit' ELSE 'response' END AS record_type,
CASE WHEN n >= 1000 AND page_id < top THEN top END AS refers_to FROM p LEFT JOIN g USING (d)"""
#: Maximal runs of ASCII letters, digits and other characters beyond ASCII, A-Z lower-cased.
_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_LEXICAL_SQL = f"""WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS w FROM documents), g AS (SELECT row_number() OVER () AS gid, item_id, unnest({_WORDS}) AS f FROM benchmark),
size AS (SELECT count(*) FILTER (WHERE len(w) > 0) AS n, sum(len(w))::BIGINT AS l FROM d),
tf AS (SELECT rid, f, count(*) AS tf FROM (SELECT rid, unnest(w) AS f FROM d) GROUP BY ALL),
wt AS (SELECT f, floor(1000 * ln((2 * n + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tf, size GROUP BY f, n),
share AS (SELECT rid, f, wt.w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + ((75 * len(d.w) * n) // l)))) AS c FROM tf JOIN wt USING (f) JOIN d USING (rid), size WHERE f IN (SELECT f FROM g)),
scored AS (SELECT gid, item_id, rid, sum(c)::BIGINT AS score FROM g JOIN share USING (f) GROUP BY ALL)
SELECT item_id, rank, doc_id, score FROM (SELECT item_id, doc_id, score, (row_number() OVER (PARTITION BY gid ORDER BY score DESC, doc_id NULLS LAST))::INT AS rank FROM scored JOIN d USING (rid) WHERE score > 0) WHERE rank <= 10"""
#: All pairs that share a shingle, then what a chain of links reaches.
_JACCARD_SQL = r"""WITH RECURSIVE d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT rid, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')] ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s FROM d),
f AS (SELECT rid, len(s) AS n, unnest(s) AS f FROM s),
link AS (SELECT a.rid AS u, b.rid AS v FROM f a JOIN f b ON a.f = b.f AND a.rid <> b.rid GROUP BY a.rid, b.rid, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
reach AS (SELECT rid, rid AS v FROM s UNION SELECT r.rid, l.v FROM reach r JOIN link l ON r.v = l.u)
SELECT a.doc_id, len(a.s)::BIGINT AS n_shingles, min(b.doc_id) AS component_id FROM s a JOIN reach USING (rid) JOIN s b ON b.rid = reach.v GROUP BY a.rid, a.doc_id, len(a.s)"""
#: CRC-32 byte by byte from a table made by its rule, once for each distinct feature.
_IMPORTANCE_SQL = f"""WITH RECURSIVE step AS (SELECT range AS b, range AS c, 0 AS k FROM range(256) UNION ALL SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM step WHERE k < 8),
crc AS (SELECT list(c ORDER BY b) AS t FROM step WHERE k = 8),
d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS w FROM documents),
g AS (SELECT {_WORDS} AS w FROM benchmark),
df AS (SELECT rid, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM d),
gf AS (SELECT unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM g),
dn AS (SELECT rid, f, count(*) AS n FROM df GROUP BY ALL), gn AS (SELECT f, count(*) AS n FROM gf GROUP BY f),
code AS (SELECT f, xor(list_reduce(list_transform(range(1, octet_length(encode(f)) + 1), lambda i: ('0x' || substr(hex(encode(f)), 2 * i - 1, 2))::BIGINT), lambda a, x: xor(t[xor(a & 255, x) + 1], a >> 8), 4294967295), 4294967295) % 10000 AS bucket FROM (SELECT f FROM dn UNION SELECT f FROM gn), crc),
s AS (SELECT bucket, sum(n)::DOUBLE AS s FROM dn JOIN code USING (f) GROUP BY bucket), t AS (SELECT bucket, sum(n)::DOUBLE AS t FROM gn JOIN code USING (f) GROUP BY bucket),
gain AS (SELECT range AS bucket, floor(1000 * ln((coalesce(t, 0) + 1) * (coalesce((SELECT sum(s) FROM s), 0) + 10000) / ((coalesce(s, 0) + 1) * (coalesce((SELECT sum(t) FROM t), 0) + 10000))))::BIGINT AS gain FROM range(10000) LEFT JOIN s ON s.bucket = range LEFT JOIN t ON t.bucket = range),
mean AS (SELECT rid, sum(n)::BIGINT AS n_features, sum(gain * n)::BIGINT AS total FROM dn JOIN code USING (f) JOIN gain USING (bucket) GROUP BY rid),
scored AS (SELECT rid, doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce((total - ((total % n_features) + n_features) % n_features) // n_features, 0)::BIGINT AS weight,
floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS noise FROM d LEFT JOIN mean USING (rid)),
placed AS (SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY weight + noise DESC, doc_id NULLS LAST, weight, n_features) AS place, count(*) FILTER (WHERE n_words >= 20) OVER () AS eligible FROM scored)
SELECT doc_id, n_features, weight, weight + noise AS score, CASE WHEN n_words >= 20 AND place <= 25 * eligible // 100 THEN place END AS rank FROM placed"""
def _sharding_sql(n_shards: int = 8, seed: int = 20) -> str:
    """DuckDB SQL for op5_sharding over unique ids: one round of the network a step, until the image falls inside."""
    import numpy as np

    from quernstone.llm.sharding import ROUNDS, _mix

    keys = _mix(np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))
    wide = lambda x: f"({x})::UHUGEINT"
    word = wide(1 << 64)
    times = lambda x, shift, by: f"xor({x}, {x} >> {shift}) * {wide(by)} % {word}"
    return f"""WITH RECURSIVE step AS (SELECT range AS b, range AS c, 0 AS k FROM range(256) UNION ALL SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM step WHERE k < 8),
    crc AS (SELECT list(c ORDER BY b) AS t FROM step WHERE k = 8),
    d AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id NULLS FIRST) - 1 AS rid, count(*) OVER () AS n, hex(encode(coalesce(text, ''))) AS h FROM documents),
    sums AS (SELECT rid, list_reduce(list_transform(range(1, len(h) // 2 + 1), lambda i: ('0x' || substr(h, 2 * i - 1, 2))::BIGINT), lambda a, x: xor(t[xor(a & 255, x) + 1], a >> 8), 4294967295) AS c FROM d, crc),
    size AS (SELECT {wide("any_value(n)")} AS n, greatest(1, (len(bin(greatest(any_value(n) - 1, 1))) + 1) // 2)::UHUGEINT AS half FROM d),
    walk AS (SELECT rid, {wide("rid")} AS x, 0 AS k FROM d UNION ALL
    SELECT rid, ("right" << half) + xor("left", xor(m2, m2 >> 31) & ((1::UHUGEINT << half) - 1)), k + 1 FROM (SELECT *, {times("m1", 27, 0x94D049BB133111EB)} AS m2
    FROM (SELECT *, {times("m0", 30, 0xBF58476D1CE4E5B9)} AS m1 FROM (SELECT *, ("right" + {[int(k) for k in keys]}[k % {ROUNDS} + 1]::UHUGEINT) % {word} AS m0
    FROM (SELECT rid, k, half, x >> half AS "left", x & ((1::UHUGEINT << half) - 1) AS "right" FROM walk, size WHERE k % {ROUNDS} > 0 OR k = 0 OR x >= n))))),
    image AS (SELECT rid, x::BIGINT AS p FROM walk, size WHERE k > 0 AND k % {ROUNDS} = 0 AND x < n)
    SELECT doc_id, (len(h) // 2 + 1)::BIGINT AS size, xor(coalesce(c, 4294967295), 4294967295)::BIGINT AS text_crc32, 'rows' AS law, (p % {n_shards})::INT AS shard, p // {n_shards} AS slot, NULL::INT AS grown_shard, rid AS global_row
    FROM d JOIN sums USING (rid) JOIN image USING (rid)"""


#: SQL has no tokenizer, no such hash, no iteration to a model: the others are tested by
#: brute force, exact round trips or held-out accuracy.
ORACLES: dict[str, str] = {"op1_warc": _WARC_SQL, "op3_secrets": _secrets_sql(), "op5_sharding": _sharding_sql(), "op7_repeats": _REPEATS_SQL, "op11_lexical": _LEXICAL_SQL, "op12_jaccard": _JACCARD_SQL, "op13_importance": _IMPORTANCE_SQL}
