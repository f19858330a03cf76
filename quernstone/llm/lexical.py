"""Ranked lexical search by branch and bound over hierarchical max trees.

Documents lie in ranges. For every term of the items a tree over a range's
documents holds, in each node, the largest share that the term reaches below it;
the leaves are runs of a few documents. An item's bound at a node is the sum of
its terms' shares there by their weights, and no document below can score more.
The search opens nodes in the order of their bounds and reads documents only in
the leaves it opens. It ends when the best bound is under the k-th score so far;
a node that equals it is still opened, as a document there may win the tie.

The corpus is read once: the terms of its documents that occur in any item are
written as postings, with the lengths. Counts over all documents come from them.
A first pass over the postings follows each item's best path in each range; the
k-th best score of what it finds there is a floor under the k-th score of all.
The second pass searches every range from that floor, so most end at the root.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quernstone.llm.tokens import byte_blocks
from quernstone.session import materialise

#: Word bytes as they are, all others a space.
_WORD = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256))


@dataclass(frozen=True)
class Config:
    """Results an item, documents and bytes of text a range, documents a leaf, children a node.

    Items of so many ``terms`` in sum are searched at a time, one at least: a tree's
    leaves hold a number for each. ``item_bytes`` bounds all items' texts, whose terms
    every task holds.
    """

    top: int = 10
    documents: int = 8192
    text_bytes: int = 32 << 20
    leaf: int = 8
    fan: int = 8
    terms: int = 1 << 14
    item_bytes: int = 64 << 20


def terms(text: bytes) -> list[bytes]:
    """Runs of ASCII letters, digits and bytes from 0x80 on, A-Z lower-cased."""
    return text.lower().translate(_WORD).split()


@dataclass
class Items:
    """The items: id, and each distinct term's number with its count; the terms' numbers."""

    ids: list
    terms: list[np.ndarray]
    counts: list[np.ndarray]
    vocabulary: dict[bytes, int]

    @classmethod
    def of(cls, rows: list[tuple]) -> Items:
        out = cls([], [], [], {})
        for ident, text in rows:
            numbers = [out.vocabulary.setdefault(w, len(out.vocabulary)) for w in terms((text or "").encode())]
            if numbers:
                number, n = np.unique(np.array(numbers), return_counts=True)
                out.ids.append(ident)
                out.terms.append(number)
                out.counts.append(n)
        return out


def postings(docs: DataFrame, vocabulary: dict[bytes, int], config: Config) -> DataFrame:
    """(ids, lengths, term, doc, tf): the items' terms in a range of documents, by term and document.

    ``lengths`` counts all terms of each document, ``doc`` is a place in ``ids``.
    """
    held = docs.sparkSession.sparkContext.broadcast(vocabulary)
    slim = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    kind = dict(slim.dtypes)["doc_id"]

    def row(ids: list[pa.Array], lengths: list[int], numbers: list[np.ndarray]) -> pa.RecordBatch:
        doc = np.repeat(np.arange(len(numbers)), [len(n) for n in numbers])
        key, tf = np.unique(np.concatenate(numbers) * np.int64(len(numbers)) + doc, return_counts=True)
        lists = [pa.concat_arrays(ids), pa.array(lengths, pa.int64()), pa.array((key // len(numbers)).astype(np.int32)), pa.array((key % len(numbers)).astype(np.int32)), pa.array(tf.astype(np.int32))]
        return pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in lists], names=["ids", "lengths", "term", "doc", "tf"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = held.value.get
        ids, lengths, numbers, size = [], [], [], 0
        for batch in batches:
            for at, data, offsets in byte_blocks(batch.column("text")):
                for k in range(len(offsets) - 1):
                    text = data[offsets[k] : offsets[k + 1]].tobytes()
                    if ids and (len(ids) >= config.documents or size + len(text) > config.text_bytes):
                        yield row(ids, lengths, numbers)
                        ids, lengths, numbers, size = [], [], [], 0
                    words = terms(text)
                    ids.append(batch.column("doc_id").slice(at + k, 1))
                    lengths.append(len(words))
                    numbers.append(np.array([x for x in map(number, words) if x is not None], np.int64))
                    size += len(text)
        if ids:
            yield row(ids, lengths, numbers)

    return slim.mapInArrow(run, f"ids array<{kind}>, lengths array<long>, term array<int>, doc array<int>, tf array<int>")


def weights(index: DataFrame, n_terms: int) -> tuple[np.ndarray, int, int]:
    """Each term's weight, the documents that hold any term, and the terms of all documents."""
    sums = F.aggregate("lengths", F.lit(0).cast("long"), lambda a, n: a + n)
    n, total = index.agg(F.sum(F.size(F.filter("lengths", lambda x: x > 0))), F.sum(sums)).first()
    n, total = int(n or 0), int(total or 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(n_terms, np.int64)
        for batch in batches:
            df += np.bincount(batch.column("term").flatten(), minlength=n_terms)
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(df[some])], names=["term", "df"])

    df = index.select("term").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    weight = F.floor(1000 * F.log((F.lit(2 * n + 2).cast("double")) / (2 * F.col("df") + 1).cast("double"))).cast("long")
    rows = df.select("term", weight.alias("w")).toPandas()  # one row a term of the items
    out = np.zeros(n_terms, np.int64)
    out[rows["term"].to_numpy()] = rows["w"].to_numpy()
    return out, n, total


class Range:
    """The trees of a range: ``levels[0]`` has a row a leaf, the last one row; a column a term that occurs."""

    def __init__(self, batch: pa.RecordBatch, at: int, n: int, total: int, config: Config, wanted: np.ndarray):
        """``wanted`` are the terms to read, in order."""
        self.ids, lengths, term, doc, tf = (batch.column(c)[at].values for c in ("ids", "lengths", "term", "doc", "tf"))
        lengths, term = lengths.to_numpy(), term.to_numpy()
        own = np.isin(term, wanted)
        term, tf = term[own], tf.to_numpy()[own].astype(np.int64)
        self.doc, self.config = doc.to_numpy()[own], config
        m = 25 + 75 * lengths[self.doc] * n // max(total, 1)
        self.share = 1_000_000_000 * tf // (1000 * tf + 8 * m)
        self.present, self.first = np.unique(term, return_index=True)
        self.first = np.append(self.first, len(term))
        column = np.repeat(np.arange(len(self.present)), np.diff(self.first))
        level = np.zeros((-(-len(lengths) // config.leaf), len(self.present)), np.int32)
        np.maximum.at(level, (self.doc // config.leaf, column), self.share.astype(np.int32))
        self.levels = [level]
        while len(level) > 1:
            starts = np.arange(0, len(level), config.fan)
            level = np.maximum.reduceat(level, starts, axis=0)
            self.levels.append(level)

    def of(self, numbers: np.ndarray, factors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The columns and factors of those of an item's terms that occur here."""
        if not len(self.present):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        column = np.searchsorted(self.present, numbers)
        column[column == len(self.present)] = 0
        own = (self.present[column] == numbers) & (factors != 0)
        return column[own], factors[own]

    def bounds(self, level: int, nodes: slice, columns: np.ndarray, factors: np.ndarray) -> np.ndarray:
        return self.levels[level][nodes][:, columns].astype(np.int64) @ np.maximum(factors, 0)

    def scores(self, leaf: int, columns: np.ndarray, factors: np.ndarray) -> np.ndarray:
        """The exact scores of a leaf's documents."""
        low = leaf * self.config.leaf
        out = np.zeros(min(self.config.leaf, len(self.ids) - low), np.int64)
        for c, factor in zip(columns.tolist(), factors.tolist(), strict=True):
            if self.levels[0][leaf, c]:
                a, z = self.first[c], self.first[c + 1]
                a, z = a + np.searchsorted(self.doc[a:z], [low, low + len(out)])
                out[self.doc[a:z] - low] += factor * self.share[a:z]
        return out

    def search(self, columns: np.ndarray, factors: np.ndarray, floor: int, once: bool = False) -> list[tuple[int, int]]:
        """(score, place) of the documents that can be among the best, scores above 0 and at least ``floor``.

        ``once`` ends after the first leaf that is opened.
        """
        top, best, found = self.config.top, [], []
        floor = max(floor, 1)
        root = len(self.levels) - 1
        heap = [(-int(b), root, k) for k, b in enumerate(self.bounds(root, slice(None), columns, factors)) if b >= floor]
        while heap and -heap[0][0] >= floor:
            _, level, node = heapq.heappop(heap)
            if level:
                a = node * self.config.fan
                for k, b in enumerate(self.bounds(level - 1, slice(a, a + self.config.fan), columns, factors).tolist()):
                    if b >= floor:
                        heapq.heappush(heap, (-b, level - 1, a + k))
                continue
            for k, s in enumerate(self.scores(node, columns, factors).tolist()):
                if s >= floor:
                    found.append((s, node * self.config.leaf + k))
                    heapq.heappush(best, s)
                    if len(best) > top:
                        heapq.heappop(best)
            if len(best) == top:
                floor = max(floor, best[0])
            if once:
                break
        return [(s, d) for s, d in found if s >= floor]


def _hits(index: DataFrame, items: Items, weight: np.ndarray, sizes: tuple[int, int], floors: np.ndarray, config: Config, once: bool) -> DataFrame:
    """(item, doc_id, score): what each range has of the best documents of each item."""
    factors = [weight[t] * c for t, c in zip(items.terms, items.counts, strict=True)]
    wanted = np.unique(np.concatenate(items.terms)) if items.terms else np.zeros(0, np.int64)
    held = index.sparkSession.sparkContext.broadcast((items.terms, factors, floors, wanted))
    kind = dict(index.dtypes)["ids"][len("array<") : -1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, factors, floors, wanted = held.value
        for batch in batches:
            for at in range(batch.num_rows):
                part = Range(batch, at, *sizes, config, wanted)
                found = [(k, d, s) for k in range(len(numbers)) for s, d in part.search(*part.of(numbers[k], factors[k]), int(floors[k]), once)]
                if found:
                    item, doc, score = zip(*found, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), part.ids.take(pa.array(doc)), pa.array(score, pa.int64())], names=["item", "doc_id", "score"])

    return index.mapInArrow(run, f"item int, doc_id {kind}, score long")


def _best(hits: DataFrame, top: int) -> DataFrame:
    """The ``top`` rows of each item, ranked; each task cuts its own before they are dealt by item."""
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def search_documents(docs: DataFrame, items: DataFrame, config: Config = Config()) -> DataFrame:  # noqa: B008
    """(item_id, rank, doc_id, score): the highest-scoring documents of every item, from rank 1.

    Scores are exact 64-bit integers and above 0; equal ones go to the smaller
    doc_id, a null doc_id last, and repeated rows are ranked each. An item with
    fewer such documents has fewer rows; one without terms (null, empty) has none.
    Items that repeat an id are ranked each by itself. Null and empty documents
    count in nothing. Long texts are read whole. Only doc_id, item_id and text are
    read, so other columns cannot clash. An empty table gives no rows.
    """
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if size > config.item_bytes:
        raise ValueError(f"items of {size} bytes are more than the {config.item_bytes} that a task may hold; search them in parts")
    spark, kind = docs.sparkSession, dict(items.dtypes)["item_id"]
    rows = items.select("item_id", "text").orderBy("item_id", "text").collect()  # bounded just above
    known = Items.of([(r.item_id, r.text) for r in rows])
    index = materialise(postings(docs, known.vocabulary, config), "postings")
    weight, *sizes = weights(index, len(known.vocabulary))
    names = spark.createDataFrame(list(enumerate(known.ids)), f"item int, item_id {kind}")
    out = None
    run = np.cumsum([len(t) for t in known.terms]) // config.terms
    starts = [0, *np.flatnonzero(run[1:] != run[:-1]) + 1, len(run)]
    for a, z in zip(starts[:-1], starts[1:], strict=True):
        part = Items(known.ids[a:z], known.terms[a:z], known.counts[a:z], known.vocabulary)
        floors = np.zeros(len(part.ids), np.int64)
        first = _best(_hits(index, part, weight, tuple(sizes), floors, config, True), config.top).where(F.col("rank") == config.top)
        for r in first.select("item", "score").collect():  # one row an item
            floors[r["item"]] = r["score"]
        best = _best(_hits(index, part, weight, tuple(sizes), floors, config, False), config.top).withColumn("item", F.col("item") + int(a))
        out = best if out is None else out.unionByName(best)
    return out.join(names, "item").select("item_id", "rank", "doc_id", "score")
