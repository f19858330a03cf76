"""Secret scans with multipart credential linking, in DataFrame operations only.

A credential has up to three parts: an identifier, a secret and an endpoint.
Strong patterns are reported wherever they match. Weak patterns (account names,
long mixed tokens, addresses) are common in clean text, so they are reported
only where complementary parts stand within one scope, that is, where at most
``scope`` characters lie between the spans: a weak identifier beside a secret, a
weak secret beside an identifier, an endpoint beside both. This interval
semi-join asks for the furthest end among the parts before a span and the first
start among those after it, two running extremes over each text's spans in order
of position, so no pairs are made. Positions are code points, ends are exclusive.

Only spans are shuffled, never texts. Matches come from ``regexp_extract_all``,
the stretches between them from ``split``; their lengths give positions by a
running sum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernstone.llm.columns import spare

SCOPE = 300
#: Kinds in order: three strong ones, then those that linking may add.
KINDS = ("assign", "access", "hex", "ident", "secret", "endpoint")
#: Kinds that identify, and kinds that are secret.
IDS, SECRETS = "(1, 3)", "(0, 2, 4)"
#: The strong patterns. Those of access and hex hold the least
#: length; that of assign must not (a short value is dropped with its match).
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
#: Weak patterns.
IDENT = r"""((?i:client_?id|user_?name|account|login))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.@-]+)"""
MIXED = r"[A-Za-z0-9+/_=-]{20,}"
ENDPOINT = r"""[a-z]{2,12}://[^\x00-\x20"'<>]+"""


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _matches(kind: str, pattern: str, guard: str, keep: str = "true") -> str:
    """SQL for an array of (kind, nth, skip, size, keep): a text's matches in order.

    ``guard`` is a cheap test that spares texts without any; ``keep`` is over m,
    the match.
    """
    p = _quoted(pattern)
    pairs = f"zip_with(split(text, {p}, -1), regexp_extract_all(text, {p}, 0), (g, m) -> struct(length(g) AS skip, length(m) AS size, {keep} AS keep))"
    numbered = f"transform(filter({pairs}, x -> x.size IS NOT NULL), (x, i) -> struct({KINDS.index(kind)} AS kind, i AS nth, x.skip AS skip, x.size AS size, x.keep AS keep))"
    return f"CASE WHEN {guard} THEN {numbered} ELSE array() END"


def near(kinds: str, scope: int) -> str:
    """SQL for whether a part of ``kinds`` lies within ``scope`` of a span."""
    over = "OVER (PARTITION BY rid ORDER BY start {} RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    before = f"max(CASE WHEN kind IN {kinds} THEN `end` END) {over.format('ASC')}"
    after = f"min(CASE WHEN kind IN {kinds} THEN start END) {over.format('DESC')}"
    return f"coalesce({before} >= start - {scope}, false) OR coalesce({after} <= `end` + {scope}, false)"


def find_spans(docs: DataFrame, text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """(rid, doc_id, text_hash, kind, start, end): every reported span of every row.

    ``rid`` numbers the rows of ``docs`` within this plan; a row without spans
    gives one row with null kind, start and end. ``kind`` is a place in KINDS. A
    null text counts as empty. Rows may repeat and ids may be null: rows are told
    apart by ``rid``.
    """
    texts = docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", F.coalesce(text_col, F.lit("")).alias("text"))
    flagged = texts.selectExpr(
        "*",
        "xxhash64(text) AS text_hash",
        "contains(text, 'AKIA') AS may_access",
        f"text RLIKE {_quoted(IDENT)} AS may_ident",
    )
    linkable = "(may_access OR may_ident)"
    mixed = "(m RLIKE '[0-9]' AND m RLIKE '[a-z]' AND m RLIKE '[A-Z]')"
    found = flagged.selectExpr(
        "rid",
        "doc_id",
        "text_hash",
        "concat("
        + ", ".join(
            [
                _matches("assign", ASSIGN, "text RLIKE '(?i)passw|secret|token|api_?key'", f"length(regexp_extract(m, {_quoted(ASSIGN)}, 2)) >= 6"),
                _matches("access", ACCESS, "may_access"),
                _matches("hex", HEX, f"text RLIKE {_quoted(HEX)}"),
                _matches("ident", IDENT, "may_ident", f"length(regexp_extract(m, {_quoted(IDENT)}, 2)) >= 4"),
                _matches("secret", MIXED, linkable, mixed),
                _matches("endpoint", ENDPOINT, f"{linkable} AND contains(text, '://')"),
            ]
        )
        + ") AS found",
    )
    rows = found.select("rid", "doc_id", "text_hash", F.explode_outer("found").alias("f")).select("rid", "doc_id", "text_hash", "f.*")
    placed = rows.repartition("rid").selectExpr(
        "rid", "doc_id", "text_hash", "kind", "size", "keep",
        "sum(skip + size) OVER (PARTITION BY rid, kind ORDER BY nth) - size AS start",
    )
    placed = placed.selectExpr("rid", "doc_id", "text_hash", "IF(keep, kind, NULL) AS kind", "start", "start + size AS end")
    # A weak secret inside a strong span is that span, not a second part.
    covered = "max(IF(kind <= 2, end, NULL)) OVER (PARTITION BY rid ORDER BY start, kind ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    parts = placed.selectExpr("*", f"kind = 4 AND coalesce({covered} > start, false) AS inner")
    parts = parts.selectExpr("rid", "doc_id", "text_hash", "IF(inner, NULL, kind) AS kind", "start", "end")
    linked = parts.selectExpr("*", *(f"{near(kinds, scope)} AS {name}" for name, kinds in (("by_id", IDS), ("by_secret", SECRETS))))
    reported = "kind <= 2 OR (kind = 3 AND by_secret) OR (kind = 4 AND by_id) OR (kind = 5 AND by_id AND by_secret)"
    return linked.selectExpr(
        "rid", "doc_id", "text_hash", *(f"IF({reported}, {c}, NULL) AS {c}" for c in ("kind", "start", "end"))
    )


def _named(column: str) -> str:
    names = ", ".join(f"'{k}'" for k in KINDS)
    return f"concat_ws(',', transform({column}, s -> concat_ws(':', element_at(array({names}), s.kind + 1), s.start, s.end)))"


def scan_documents(docs: DataFrame, text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """Per row of ``docs``: doc_id, text_hash, findings, counts and digests of its spans.

    ``findings`` is an array of (start, kind, end) by start, then kind. n_assign,
    n_access, n_hex and base_sha256 are over the strong spans, ``spans`` lists
    all. Rows without spans, null and empty texts too, have empty lists. Repeated rows
    and null ids stay, each a row. Long texts are scanned whole. Only doc_id and the
    text are read, so other columns cannot clash. An empty table gives no rows.
    """
    spans = find_spans(docs, text_col, scope)
    listed = spans.groupBy("rid").agg(
        F.first("doc_id").alias("doc_id"),
        F.first("text_hash").alias("text_hash"),
        F.array_sort(F.collect_list(F.when(F.col("kind").isNotNull(), F.struct("start", "kind", "end")))).alias("findings"),
    )
    count = lambda k: F.size(F.filter("findings", lambda s: s["kind"] == k)).cast("long")
    listed = listed.withColumn("base", F.filter("findings", lambda s: s["kind"] <= 2))
    return listed.select(
        "doc_id",
        "text_hash",
        "findings",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(F.expr(_named("base")).cast("binary"), 256).alias("base_sha256"),
        F.expr(_named("findings")).alias("spans"),
    )


def redact_documents(docs: DataFrame, mark: str = "[SECRET]", scope: int = SCOPE) -> DataFrame:
    """``docs`` with every reported span of ``text`` replaced by ``mark``.

    Overlapping and touching spans become one mark. Rows and columns stay as
    they are otherwise, whatever their names, null and empty texts included;
    findings are joined back by id and hash of the text, so repeated rows all get
    theirs. Texts are scanned whole. An empty table gives no rows.
    """
    hits = scan_documents(docs, scope=scope).where(F.size("findings") > 0).dropDuplicates(["doc_id", "text_hash"])
    # Stretches to keep: what lies between the furthest end so far and the next start.
    folded = """aggregate(findings, struct(CAST(0 AS BIGINT) AS upto, CAST(array() AS ARRAY<STRUCT<a: BIGINT, n: BIGINT>>) AS kept),
        (acc, s) -> struct(greatest(acc.upto, CAST(s.end AS BIGINT)) AS upto,
                           IF(size(acc.kept) = 0 OR s.start > acc.upto, concat(acc.kept, array(struct(acc.upto AS a, s.start - acc.upto AS n))), acc.kept) AS kept))"""
    ident, digest, cut = (spare(c, docs) for c in ("_id", "_hash", "_cut"))
    cuts = hits.select(F.col("doc_id").alias(ident), F.col("text_hash").alias(digest), F.expr(folded).alias(cut))
    joined = docs.join(cuts, docs["doc_id"].eqNullSafe(F.col(ident)) & (F.xxhash64(docs["text"]) == F.col(digest)), "left")
    pieces = F.transform(F.col(cut)["kept"], lambda k: F.substring(docs["text"], (k["a"] + 1).cast("int"), k["n"].cast("int")))
    tail = F.substring(docs["text"], (F.col(cut)["upto"] + 1).cast("int"), F.length(docs["text"]))
    clean = F.when(F.col(cut).isNull(), docs["text"]).otherwise(F.array_join(F.concat(pieces, F.array(tail)), mark))
    return joined.select(*(clean.alias("text") if c.lower() == "text" else docs[c] for c in docs.columns))
