"""Exact top-k by inner product, document aggregation, and retrieval metrics."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Bytes of queries and of rows that a cell of the grid holds, vectors a block, pairs multiplied at once.
QUERY_BYTES, ROW_BYTES, BLOCK, PAIRS = 32 << 20, 128 << 20, 1 << 10, 1 << 12
#: Documents and fragments delivered, candidates asked for.
TOP_DOCUMENTS, TOP_FRAGMENTS, CANDIDATES = 3, 10, 50


def norm(vector: Column) -> Column:
    v = vector.cast("array<double>")
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x))


def unit(vector: Column) -> Column:
    """The vector over its length; raises on length 0."""
    v, n = vector.cast("array<double>"), norm(vector)
    return F.when(n > 0, F.transform(v, lambda x: x / n)).otherwise(F.raise_error(F.lit("a vector of length 0")))


def truncated(vector: Column, dimension: int) -> Column:
    """The first components, at unit length again; raises where there are too few."""
    return F.when(F.size(vector) < dimension, F.raise_error(F.lit("too few components"))).when(F.size(vector) == dimension, vector.cast("array<double>")).otherwise(unit(F.slice(vector, 1, dimension)))


def _packed(df: DataFrame, ident: str, vector: str, dim: int, most: int) -> DataFrame:
    """(block, ids, matrix, top): runs of at most ``most`` vectors, the longest first, as one binary each; ``top`` is the greatest length."""
    kind = dict(df.dtypes)[ident]
    length = F.when(F.size(vector) == dim, F.col(vector).cast("array<double>")).otherwise(F.raise_error(F.lit(f"a vector is not of length {dim}")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            if not batch.num_rows:
                continue
            matrix = batch.column("vec").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
            size = np.sqrt(np.einsum("ij,ij->i", matrix, matrix))
            order = np.argsort(-size, kind="stable")
            for a in range(0, len(order), most):
                own = order[a : a + most]
                ids = batch.column("id").take(pa.array(own))
                ends = pa.array([0, len(own)], pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.ListArray.from_arrays(ends, ids), pa.array([matrix[own].tobytes()], pa.binary()), pa.array([size[own[0]]])], names=["block", "ids", "matrix", "top"])
                block += 1

    return df.select(F.col(ident).alias("id"), length.alias("vec")).mapInArrow(run, f"block long, ids array<{kind}>, matrix binary, top double")


class Nearest:
    """The ``k`` best rows so far of each query of a block, by double-precision products."""

    def __init__(self, queries: np.ndarray, k: int):
        self.q, self.k = queries, k
        self.cut = queries.shape[1] // 2
        self.length = np.sqrt(np.einsum("ij,ij->i", queries, queries))
        self.rest = np.sqrt(np.einsum("ij,ij->i", queries[:, self.cut :], queries[:, self.cut :]))
        self.score = np.full((len(queries), 0), -np.inf)
        self.row = np.zeros((len(queries), 0), np.int64)
        self.skipped = self.halved = 0

    def floor(self) -> np.ndarray:
        """What a row must reach, ties included."""
        return self.score[:, -1] if self.score.shape[1] == self.k else np.full(len(self.q), -np.inf)

    def add(self, x: np.ndarray, rows: np.ndarray, top: float) -> None:
        """Rows ``x``, numbered ``rows``, none longer than ``top``.

        A block goes where no query times ``top`` reaches its floor. The first half
        of the components and the lengths of the second (Cauchy-Schwarz) leave few
        of the others; only these are multiplied whole.
        """
        slack = 1e-9 * (1 + self.length * top)
        floor = self.floor() - slack
        if (self.length * top < floor).all():
            self.skipped += 1
            return
        c = self.cut
        first = self.q[:, :c] @ x[:, :c].T
        far = np.sqrt(np.einsum("ij,ij->i", x[:, c:], x[:, c:]))
        near = (first + self.rest[:, None] * far[None] >= floor[:, None]).any(axis=0)
        if not near.all():
            self.halved += int((~near).sum())
            if not near.any():
                return
            first, x, rows = first[:, near], x[near], rows[near]
        rough = first + self.q[:, c:] @ x[:, c:].T
        if rough.shape[1] > self.k:
            floor = np.maximum(floor, -np.partition(-rough, self.k - 1, axis=1)[:, self.k - 1] - slack)
        # Scores of pairs are sums in one order, so equal vectors have equal scores wherever they lie.
        q_at, x_at = np.nonzero(rough >= floor[:, None])
        width = np.bincount(q_at, minlength=len(self.q))
        score = np.full((len(self.q), int(width.max(initial=0))), -np.inf)
        row = np.full(score.shape, np.iinfo(np.int64).max)
        place = np.arange(len(q_at)) - (np.cumsum(width) - width)[q_at]
        for a in range(0, len(q_at), PAIRS):
            cut = slice(a, a + PAIRS)
            score[q_at[cut], place[cut]] = np.einsum("ij,ij->i", self.q[q_at[cut]], x[x_at[cut]])
        row[q_at, place] = rows[x_at]
        score, row = np.hstack([self.score, score]), np.hstack([self.row, row])
        order = np.lexsort((row, -score), axis=1)[:, : self.k]
        self.score, self.row = np.take_along_axis(score, order, 1), np.take_along_axis(row, order, 1)


def grid(n_rows: int, n_queries: int, dim: int, tasks: int) -> tuple[int, int]:
    """Parts of the rows and of the queries: within ROW_BYTES and QUERY_BYTES, the rows' at least as many as keep ``tasks`` busy."""
    columns = max(1, -(-n_queries * dim * 8 // QUERY_BYTES))
    least = min(-(-tasks // columns), -(-n_rows // BLOCK))
    return max(1, least, -(-n_rows * dim * 8 // ROW_BYTES)), columns


def top_k(index: DataFrame, queries: DataFrame, k: int = CANDIDATES) -> DataFrame:
    """(query_id, rank, row_id, score): the ``k`` rows of largest inner product of each query.

    ``index`` has (row_id, vec), ``queries`` (query_id, qvec), all of one length (else
    an error); ties go to the smaller row_id. Rows and queries are packed into blocks
    and dealt to the cells of a grid, by cogroup: a cell holds at most about ROW_BYTES
    of rows and QUERY_BYTES of queries, and each block of queries meets each of rows
    once. A cell gives k rows a query. Nothing but counts passes through the driver.
    """
    spark = index.sparkSession
    n_queries, dim = queries.agg(F.count("*"), F.max(F.size("qvec"))).first()
    kind = dict(queries.dtypes)["query_id"]
    if not n_queries:
        return spark.createDataFrame([], f"query_id {kind}, rank int, row_id long, score double")
    n_rows = index.count()
    down, across = grid(n_rows, n_queries, dim, int(spark.conf.get("spark.sql.shuffle.partitions")))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    part = lambda n: F.pmod(F.xxhash64("block"), F.lit(n)).cast("int")
    rows = _packed(index.select(F.col("row_id").cast("long").alias("row_id"), "vec"), "row_id", "vec", dim, BLOCK)
    asked = _packed(queries, "query_id", "qvec", dim, BLOCK)
    dealt = rows.select("*", part(down).alias("r"), every(across).alias("c"))
    asked = asked.select("*", part(across).alias("c"), every(down).alias("r"))

    def cell(rows: pa.Table, asked: pa.Table) -> pa.Table:
        found: list[list] = [[], [], []]
        numbers = [x.values.to_numpy() for x in rows.column("ids")]
        blocks = [np.frombuffer(m.as_buffer(), np.float64).reshape(-1, dim) for m in rows.column("matrix")]
        tops = rows.column("top").to_numpy()
        for at in range(asked.num_rows):
            nearest = Nearest(np.frombuffer(asked.column("matrix")[at].as_buffer(), np.float64).reshape(-1, dim), k)
            for b in np.argsort(-tops, kind="stable").tolist():
                nearest.add(blocks[b], numbers[b], tops[b])
            held = np.isfinite(nearest.score) | (nearest.row < np.iinfo(np.int64).max)
            q_at, place = np.nonzero(held)
            found[0].append(asked.column("ids")[at].values.take(pa.array(q_at)))
            found[1].append(nearest.row[q_at, place])
            found[2].append(nearest.score[q_at, place])
        ids = pa.concat_arrays(found[0]) if found[0] else pa.array([], asked.schema.field("ids").type.value_type)
        return pa.table({"query_id": ids, "row_id": np.concatenate([np.zeros(0, np.int64), *found[1]]), "score": np.concatenate([np.zeros(0), *found[2]])})

    found = dealt.groupBy("r", "c").cogroup(asked.groupBy("r", "c")).applyInArrow(cell, f"query_id {kind}, row_id long, score double")
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "row_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "row_id", "score")


def best_documents(candidates: DataFrame, doc: str, top: int = TOP_DOCUMENTS) -> DataFrame:
    """(query_id, place, doc, score, n): documents by their best fragment, ties by document."""
    grouped = candidates.groupBy("query_id", doc).agg(F.max("score").alias("score"), F.count("*").alias("n"))
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), doc)
    return grouped.withColumn("place", F.row_number().over(w)).where(F.col("place") <= top)


def distinct_texts(candidates: DataFrame, keys: list[str], text: str, order: list[str]) -> DataFrame:
    """The first of rows whose texts are alike but for case and white space."""
    alike = F.lower(F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)\s+", " ")))
    w = Window.partitionBy(*keys, alike).orderBy(*order)
    return candidates.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def first_rows_by_rank(candidates: DataFrame, top: int = TOP_FRAGMENTS) -> DataFrame:
    """The ``top`` best candidates of each query with their ``place``; reranking would come before this cut."""
    w = Window.partitionBy("query_id").orderBy("rank")
    return candidates.withColumn("place", F.row_number().over(w)).where(F.col("place") <= top)


def language_filter(candidates: DataFrame, language: str | None, column: str = "lang") -> DataFrame:
    """After the top-k cut, on purpose: the list shrinks and is not filled up again."""
    return candidates if language is None else candidates.where(F.col(column) == language)


def f1_at_k(hits: DataFrame, relevant: DataFrame, k: int) -> DataFrame:
    """(query_id, f1): ``hits`` (query_id, rank, item), ``relevant`` (query_id, item, gain).

    Precision is over the hits delivered, at most k. Queries without a hit or
    without a relevant item get 0.
    """
    first = hits.where(F.col("rank") <= k)
    delivered = first.groupBy("query_id").agg(F.count("*").alias("d"))
    met = first.select("query_id", "item").distinct().join(relevant.select("query_id", "item").distinct(), ["query_id", "item"]).groupBy("query_id").agg(F.count("*").alias("h"))
    known = relevant.select("query_id", "item").distinct().groupBy("query_id").agg(F.count("*").alias("r"))
    return _f1(known, delivered, met)


def f1_by_class(hits: DataFrame, asked: DataFrame, items: DataFrame, k: int) -> DataFrame:
    """:func:`f1_at_k` where the relevant items of a query are those of its class.

    ``asked`` has (query_id, class), ``items`` (item, class). Classes are counted, never
    paired with queries item by item, which would grow with the square of the table.
    """
    first = hits.where(F.col("rank") <= k)
    delivered = first.groupBy("query_id").agg(F.count("*").alias("d"))
    known = asked.join(items.distinct().groupBy("class").agg(F.count("*").alias("r")), "class").select("query_id", "r")
    met = first.select("query_id", "item").distinct().join(asked, "query_id").join(items.distinct(), ["item", "class"]).groupBy("query_id").agg(F.count("*").alias("h"))
    return _f1(known, delivered, met)


def _f1(known: DataFrame, delivered: DataFrame, met: DataFrame) -> DataFrame:
    """(query_id, f1) from the relevant (r), delivered (d) and met (h) items of each query."""
    joined = known.join(delivered, "query_id", "left").join(met, "query_id", "left")
    p, r = F.col("h") / F.col("d"), F.col("h") / F.col("r")
    return joined.select("query_id", F.coalesce(F.when(F.col("h") > 0, 2 * p * r / (p + r)), F.lit(0.0)).alias("f1"))


def ndcg_at_k(hits: DataFrame, relevant: DataFrame, k: int) -> DataFrame:
    """(query_id, ndcg): gains over log2(rank + 1), against the best order of the gains."""
    gained = hits.where(F.col("rank") <= k).join(relevant, ["query_id", "item"]).groupBy("query_id").agg(F.sum(F.col("gain") / F.log2(F.col("rank") + 1.0)).alias("dcg"))
    w = Window.partitionBy("query_id").orderBy(F.desc("gain"), "item")
    ideal = relevant.withColumn("r", F.row_number().over(w)).where(F.col("r") <= k).groupBy("query_id").agg(F.sum(F.col("gain") / F.log2(F.col("r") + 1.0)).alias("ideal"))
    return ideal.join(gained, "query_id", "left").select("query_id", F.coalesce(F.when(F.col("ideal") > 0, F.col("dcg") / F.col("ideal")), F.lit(0.0)).alias("ndcg"))


def ndcg_by_class(hits: DataFrame, asked: DataFrame, items: DataFrame, k: int) -> DataFrame:
    """:func:`ndcg_at_k` where the relevant items of a query are those of its class: ``items`` has (item, class, gain), see :func:`f1_by_class`.

    The best order is found once a class; its first ``k`` items are cut within tasks.
    """
    met = hits.where(F.col("rank") <= k).join(asked, "query_id").join(items, ["item", "class"])
    gained = met.groupBy("query_id").agg(F.sum(F.col("gain") / F.log2(F.col("rank") + 1.0)).alias("dcg"))
    w = Window.partitionBy("class").orderBy(F.desc("gain"), "item")
    best = items.withColumn("r", F.row_number().over(w)).where(F.col("r") <= k).groupBy("class").agg(F.sum(F.col("gain") / F.log2(F.col("r") + 1.0)).alias("ideal"))
    ideal = asked.join(best, "class")
    return ideal.join(gained, "query_id", "left").select("query_id", F.coalesce(F.when(F.col("ideal") > 0, F.col("dcg") / F.col("ideal")), F.lit(0.0)).alias("ndcg"))


def f1_ceiling(n_relevant: Column, k: int) -> Column:
    """The best F1 at k that ``n_relevant`` relevant items allow."""
    best = F.least(n_relevant, F.lit(k)).cast("double")
    p, r = best / F.least(n_relevant, F.lit(k)), best / n_relevant
    return F.when(n_relevant > 0, 2 * p * r / (p + r)).otherwise(0.0)
