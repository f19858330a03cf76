"""Approximate nearest neighbours by learned partitions.

On a bounded sample of distinct vectors a neighbour graph is built and cut into
parts of equal size by recursive bisection (a relaxed eigenvector gives the
halves, swaps across the cut mend them). A small network then learns to say, for
a vector, in which parts its neighbours lie. Every vector is filed under its most
probable part; a query is sent to several parts, as many as reach the stated
recall for sample vectors held out of the fit, and all their vectors are scored
exactly. Parts that turn out large are dealt in blocks, queries likewise, so no
task holds more than a block of each. A table too large for ``max_parts`` parts of
the wanted size gets a second level: each part has a router of its own, fitted on
a bounded sample of the part in a task of its own. Hits are merged in steps, at
most ``fan`` lists at a time.

Equal vectors score equally and ties go to the smaller id, so of each distinct
vector only the ``k + 1`` smallest ids can be among anyone's ``k`` nearest: they
are kept by a ranked cut before any search. Equal queries are searched once.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quernstone.session import materialise


@dataclass(frozen=True)
class Config:
    """``sample`` bounds the vectors that a router is fitted on; a part should hold ``part_rows`` rows.

    There are at least ``least_parts`` parts, fewer only where there are not four
    distinct vectors for each, and at most ``max_parts`` a level. ``held`` vectors
    of the sample choose the number of parts to search, so that ``recall`` of their
    neighbours is met.
    """

    k: int = 20
    sample: int = 6000
    part_rows: int = 2048
    least_parts: int = 8
    max_parts: int = 256
    fan: int = 64
    recall: float = 0.95
    held: int = 600
    neighbours: int = 15
    hidden: int = 128
    epochs: int = 20
    block: int = 4096
    seed: int = 10


@dataclass
class Router:
    """Two layers that give each part's log-probability (up to a constant)."""

    mean: np.ndarray
    scale: float
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray

    def logits(self, x: np.ndarray) -> np.ndarray:
        hidden = np.maximum((x - self.mean) * self.scale @ self.w1 + self.b1, 0)
        return hidden @ self.w2 + self.b2

    def parts(self, x: np.ndarray, n: int) -> np.ndarray:
        """The ``n`` most probable parts of each row, most probable first."""
        return np.argsort(-self.logits(x), axis=1, kind="stable")[:, :n]


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """For each row, the ``k`` other rows of largest inner product."""
    out = np.empty((len(x), k), dtype=np.int64)
    for a in range(0, len(x), 1024):
        s = x[a : a + 1024] @ x.T
        s[np.arange(len(s)), np.arange(a, a + len(s))] = -np.inf
        out[a : a + len(s)] = np.argpartition(-s, k - 1, axis=1)[:, :k]
    return out


def balanced_parts(graph: np.ndarray, n_parts: int, seed: int = 0) -> np.ndarray:
    """Part of each node: ``n_parts`` (a power of two) parts, sizes equal but for rounding."""
    rng = np.random.default_rng(seed)
    part = np.zeros(len(graph), dtype=np.int64)
    for level in range(n_parts.bit_length() - 1):
        halves = np.zeros(len(graph), dtype=np.int64)
        for p in range(1 << level):
            nodes = np.flatnonzero(part == p)
            local = np.full(len(graph), -1)
            local[nodes] = np.arange(len(nodes))
            src, dst = np.repeat(np.arange(len(nodes)), graph.shape[1]), local[graph[nodes]].ravel()
            src, dst = src[dst >= 0], dst[dst >= 0]
            a, b = np.r_[src, dst], np.r_[dst, src]
            degree = np.bincount(a, minlength=len(nodes)) + 1.0
            v = rng.normal(size=len(nodes))
            for _ in range(60):
                v = (v + np.bincount(a, v[b], minlength=len(nodes))) / degree
                v -= (v * degree).sum() / degree.sum()
                v /= np.abs(v).max() + 1e-30
            side = np.zeros(len(nodes), dtype=np.int64)
            side[np.argsort(v, kind="stable")[len(nodes) // 2 :]] = 1
            for _ in range(8):
                cross = np.bincount(a, side[a] != side[b], minlength=len(nodes))
                gain = 2 * cross - (degree - 1)
                pairs = [np.flatnonzero((side == s) & (gain > 0)) for s in (0, 1)]
                n = min(map(len, pairs)) // 2
                if not n:
                    break
                for s, own in enumerate(pairs):
                    side[own[np.argsort(-gain[own], kind="stable")[:n]]] = 1 - s
            halves[nodes] = 2 * p + side
        part = halves
    return part


def fit_router(x: np.ndarray, n_parts: int, config: Config) -> Router:
    """The router of a sample of distinct vectors."""
    x = np.unique(x, axis=0).astype(np.float64)
    while n_parts > 1 and len(x) < 4 * n_parts:
        n_parts //= 2
    mean = x.mean(axis=0)
    scale = 1 / max(float(x.std()), 1e-12)
    rng = np.random.default_rng(config.seed)
    dims = (x.shape[1], config.hidden, n_parts)
    params = [rng.normal(0, np.sqrt(2 / dims[0]), dims[:2]), np.zeros(dims[1]), rng.normal(0, np.sqrt(1 / dims[1]), dims[1:]), np.zeros(dims[2])]
    router = Router(mean, scale, *params)
    k = min(config.neighbours, len(x) - 1)
    if n_parts == 1 or k < 1:
        return Router(mean, scale, *(np.zeros_like(p) for p in params))
    graph = neighbour_graph(x, k)
    part = balanced_parts(graph, n_parts, config.seed)
    target = np.zeros((len(x), n_parts))
    for column in (np.arange(len(x))[:, None], graph):
        np.add.at(target, (np.arange(len(x))[:, None], part[column]), 1 / column.shape[1])
    target /= target.sum(axis=1, keepdims=True)
    inputs = (x - mean) * scale
    first, second, t = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for _ in range(config.epochs):
        order = rng.permutation(len(x))
        for a in range(0, len(x), 256):
            rows = order[a : a + 256]
            pre = inputs[rows] @ params[0] + params[1]
            hidden = np.maximum(pre, 0)
            logits = hidden @ params[2] + params[3]
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            error = (p / p.sum(axis=1, keepdims=True) - target[rows]) / len(rows)
            back = (error @ params[2].T) * (pre > 0)
            t += 1
            for i, g in enumerate((inputs[rows].T @ back, back.sum(axis=0), hidden.T @ error, error.sum(axis=0))):
                first[i] = 0.9 * first[i] + 0.1 * g
                second[i] = 0.99 * second[i] + 0.01 * g * g
                params[i] -= 0.005 * (first[i] / (1 - 0.9**t)) / (np.sqrt(second[i] / (1 - 0.99**t)) + 1e-8)
    return router


def probes_for(router: Router, fitted: np.ndarray, held: np.ndarray, k: int, recall: float) -> int:
    """How many parts a query must see for ``recall`` of its ``k`` nearest fitted rows."""
    n_parts = len(router.b2)
    if not len(held) or n_parts == 1:
        return n_parts
    k = max(1, min(k, len(fitted)))
    home = router.parts(fitted, 1)[:, 0]
    near = np.argpartition(-(held @ fitted.T), k - 1, axis=1)[:, :k]
    place = np.argsort(router.parts(held, n_parts), axis=1)  # of each part in a row's order
    ranks = np.sort(np.take_along_axis(place, home[near], axis=1).ravel())
    return int(ranks[min(len(ranks) - 1, int(np.ceil(recall * len(ranks))))]) + 1


def usable(vector: Column, dim: int | None = None) -> Column:
    """Whether a vector takes part: not null, not all zero, all components finite."""
    finite = F.forall(vector, lambda v: v.isNotNull() & (F.abs(v) < float("inf")) & ~F.isnan(v))
    own = vector.isNotNull() & finite & F.exists(vector, lambda v: v != 0)
    return F.coalesce(own & (F.size(vector) == dim) if dim is not None else own, F.lit(False))


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(flat.flatten().to_numpy(zero_copy_only=False), dtype=np.float64).reshape(-1, dim)


def inner_products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Row by row inner products in double precision, alike for alike rows."""
    return np.einsum("ij,ij->i", x, y)


def nearest_in_block(queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, id, score) of each query's ``n`` nearest, ties to smaller ids."""
    order = np.argsort(ids, kind="stable")
    ids, vectors = ids[order], vectors[order]
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for a in range(0, len(queries), 256):
        own = queries[a : a + 256]
        rough = own @ vectors.T
        if len(ids) > n:
            least = np.partition(rough, len(ids) - n, axis=1)[:, len(ids) - n]
            slack = 1e-9 * (1 + np.abs(rough).max(axis=1))
            rows, columns = np.nonzero(rough >= (least - slack)[:, None])
        else:
            rows, columns = np.nonzero(np.ones_like(rough, dtype=bool))
        score = inner_products(own[rows], vectors[columns])
        rank = np.lexsort((ids[columns], -score, rows))
        rows, columns, score = rows[rank], columns[rank], score[rank]
        first = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
        place = np.arange(len(rows)) - np.repeat(first, np.diff(np.r_[first, len(rows)]))
        keep = place < n
        found.append((rows[keep] + a, ids[columns[keep]], score[keep]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def fitted(sample: np.ndarray, total: int, config: Config, recall: float) -> tuple[Router, int]:
    """A router of distinct vectors of a table of ``total`` rows, and the parts to search for ``recall``."""
    sample = np.unique(sample, axis=0)
    sample = sample[np.random.default_rng(config.seed).permutation(len(sample))]
    n_held = min(config.held, len(sample) // 10)
    wanted = 1 << max(0, round(np.log2(max(1, total / config.part_rows))))
    router = fit_router(sample[n_held:], min(config.max_parts, max(config.least_parts, wanted)), config)
    # The k nearest of all rows are about this many of the sample's.
    k_sample = max(1, round(config.k * len(sample) / max(1, total)))
    return router, probes_for(router, sample[n_held:], sample[:n_held], k_sample, recall)


def second_level(filed: DataFrame, dim: int, sizes: dict[int, int], config: Config) -> dict[int, tuple[Router, int]]:
    """A router and a number of parts to search for each part of (part, id, vector), fitted in a task each.

    A part sends at most ``config.sample`` vectors, those of the smallest hash.
    """
    first = Window.partitionBy("part").orderBy(F.xxhash64("id"), "id")
    sample = filed.withColumn("r", F.row_number().over(first)).where(F.col("r") <= config.sample).select("part", "vector")

    def fit(rows: pa.Table) -> pa.Table:
        part = rows.column("part")[0].as_py()
        made = fitted(_matrix(rows.column("vector"), dim), sizes[part], config, config.recall**0.5)
        return pa.table({"part": pa.array([part], pa.int32()), "made": pa.array([pickle.dumps(made)], pa.binary())})

    rows = sample.groupBy("part").applyInArrow(fit, "part int, made binary").collect()  # at most max_parts routers of fixed size
    return {r["part"]: pickle.loads(r["made"]) for r in rows}


def _routed_again(df: DataFrame, routers: dict[int, tuple[Router, int]], several: bool, dim: int, key: str, width: int) -> DataFrame:
    """(part, key, vector) under parts of the second level: the most probable, or as many as the router searches."""
    held = df.sparkSession.sparkContext.broadcast(routers)  # at most max_parts routers of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part, x = batch.column("part").to_numpy(), _matrix(batch.column("vector"), dim)
            for p in np.unique(part).tolist():
                own = np.flatnonzero(part == p)
                router, probes = held.value[p]
                found = router.parts(x[own], probes if several else 1)
                taken = batch.take(pa.array(np.repeat(own, found.shape[1])))
                yield pa.RecordBatch.from_arrays([pa.array((p * width + found).ravel().astype(np.int32)), taken.column(key), taken.column("vector")], names=["part", key, "vector"])

    return df.mapInArrow(run, f"part int, {key} long, vector array<double>")


def _routed(df: DataFrame, router: Router, n: int, dim: int, key: str) -> DataFrame:
    """(part, key, vector): each row under its ``n`` most probable parts."""
    held = df.sparkSession.sparkContext.broadcast(router)  # of fixed size: hidden x (dim + parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = held.value.parts(_matrix(batch.column("vector"), dim), n)
            rows = np.repeat(np.arange(batch.num_rows), parts.shape[1])
            taken = batch.take(pa.array(rows))
            yield pa.RecordBatch.from_arrays([pa.array(parts.ravel().astype(np.int32)), taken.column(key), taken.column("vector")], names=["part", key, "vector"])

    return df.select(key, "vector").mapInArrow(run, f"part int, {key} long, vector array<double>")


def nearest(vectors: DataFrame, queries: Column, id_col: str = "vec_id", vector_col: str = "embedding", config: Config = Config()) -> DataFrame:  # noqa: B008
    """(query_id, rank, vec_id, score): the nearest found of every row where ``queries`` holds.

    Nearness is the inner product in double precision; a query's own id is no
    candidate. Vectors that are null, all zero, or hold a null or non-finite
    component take no part, nor do those of another length than most, nor null
    ids. Repeated rows are candidates once; of one id with several vectors each
    is searched for by itself and its results are ranked together. Fewer
    candidates than ``config.k`` give fewer rows; an empty table gives none. Only the
    id, the vector and what ``queries`` names are read, so other columns cannot clash.
    """
    spark, k = vectors.sparkSession, config.k
    raw = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vector"), F.coalesce(queries, F.lit(False)).alias("asks")).where("id IS NOT NULL").where(usable(F.col("vector")))
    raw = materialise(raw.withColumn("id", F.col("id").cast("long")), "vectors")
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    lengths = raw.groupBy(F.size("vector").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    if lengths is None:
        return empty
    dim, total = lengths["dim"], lengths["count"]
    own = raw.where(F.size("vector") == dim)
    every = max(1, total // config.sample)
    sample = _matrix(pa.table(own.where(F.pmod(F.xxhash64("id"), F.lit(every)) == 0).select("vector").limit(2 * config.sample).toArrow()).column("vector"), dim)
    # Two levels where even the most parts of one would be four times too large.
    deep = total > 4 * config.part_rows * config.max_parts
    router, probes = fitted(sample if len(sample) else np.vstack([np.zeros(dim), np.ones(dim)]), total, config, config.recall**0.5 if deep else config.recall)

    rank = F.row_number().over(Window.partitionBy("vector").orderBy("id"))
    base = own.select("id", "vector").distinct().withColumn("r", rank).where(F.col("r") <= k + 1).drop("r")
    asked = own.where("asks").select("id", "vector").distinct()
    once = asked.groupBy("vector").agg(F.min("id").alias("qkey"))
    base = materialise(_routed(base, router, 1, dim, "id"), "filed")
    once = _routed(once, router, probes, dim, "qkey")
    if deep:
        routers = second_level(base, dim, {r["part"]: r["count"] for r in base.groupBy("part").count().collect()}, config)
        base = materialise(_routed_again(base, routers, False, dim, "id", config.max_parts), "filed-again")
        once = _routed_again(once.where(F.col("part").isin(*routers)), routers, True, dim, "qkey", config.max_parts)
    once = materialise(once, "asked")

    # Blocks: as many as the part's rows need; queries and rows meet in each.
    sizes = base.groupBy("part").count().collect()
    asks = once.groupBy("part").count().collect()
    blocks = {r["part"]: -(-r["count"] // config.block) for r in sizes}
    ask_blocks = {r["part"]: -(-r["count"] // config.block) for r in asks}
    counts = spark.createDataFrame([(p, blocks.get(p, 1), ask_blocks.get(p, 1)) for p in sorted({*blocks, *ask_blocks})] or [(0, 1, 1)], "part int, rows_in int, asks_in int")
    counts = F.broadcast(counts)  # at most max_parts squared rows
    every_of = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    one_of = lambda key, c: F.pmod(F.xxhash64(key), F.col(c).cast("long")).cast("int")
    left = once.join(counts, "part").withColumn("b", every_of("rows_in")).withColumn("a", one_of("qkey", "asks_in")).select("part", "a", "b", "qkey", "vector")
    right = base.join(counts, "part").withColumn("a", every_of("asks_in")).withColumn("b", one_of("id", "rows_in")).select("part", "a", "b", "id", "vector")

    hits = pa.list_(pa.struct([("loss", pa.float64()), ("vec_id", pa.int64())]))

    def search(ask: pa.Table, file: pa.Table) -> pa.Table:
        if not ask.num_rows or not file.num_rows:
            return pa.table({"qkey": pa.array([], pa.int64()), "part": pa.array([], pa.int32()), "b": pa.array([], pa.int32()), "hits": pa.array([], hits)})
        rows, ids, score = nearest_in_block(_matrix(ask.column("vector"), dim), file.column("id").to_numpy(), _matrix(file.column("vector"), dim), k + 1)
        first = np.r_[np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]]), len(rows)]
        flat = pa.StructArray.from_arrays([pa.array(-score), pa.array(ids)], names=["loss", "vec_id"])
        lists = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), flat)
        here = {c: pa.array(np.full(len(lists), ask.column(c)[0].as_py()), pa.int32()) for c in ("part", "b")}
        return pa.table({"qkey": pa.array(ask.column("qkey").to_numpy()[rows[first[:-1]]]), **here, "hits": lists})

    def merged(df: DataFrame, *by: str) -> DataFrame:
        return df.groupBy(*by).agg(F.slice(F.array_sort(F.flatten(F.collect_list("hits"))), 1, k + 1).alias("hits"))

    # A block gives one row per query, its nearest in a list; lists are merged in steps.
    keys = ["part", "a", "b"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(search, "qkey long, part int, b int, hits array<struct<loss: double, vec_id: long>>")
    lists = max(blocks.values(), default=1)
    while lists > config.fan:
        found = merged(found.withColumn("b", F.expr(f"b div {config.fan}").cast("int")), "qkey", "part", "b")
        lists = -(-lists // config.fan)
    if lists > 1:
        found = merged(found, "qkey", "part")
    if deep:
        found = merged(found.withColumn("part", F.expr(f"part div {config.max_parts}").cast("int")), "qkey", "part")
    found = merged(found, "qkey").select("qkey", F.inline("hits")).select("qkey", "vec_id", (-F.col("loss")).alias("score"))
    keyed = asked.join(asked.groupBy("vector").agg(F.min("id").alias("qkey")), "vector").select(F.col("id").alias("query_id"), "qkey")
    spread = keyed.join(found, "qkey").where("vec_id <> query_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    final = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = spread.withColumn("rank", F.row_number().over(final)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
