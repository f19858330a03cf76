"""Jaccard join of word shingle sets by PartEnum signatures.

Two sets of Jaccard similarity 0.9 differ in at most a nineteenth of the sum of
their sizes. Sizes are cut into bands such that linked sets lie in one band or in
neighbours; a set signs for its own band, and for the next one if a linked set may
lie there. A band bounds the number k of differing elements. The domain of
shingles is cut by hash into ceil((k+1)/2) parts, each into three: in some part
at most one element differs, so two of its three subparts agree exactly. The three
ways of choosing two subparts, each with the digest of what the set has there, are
the part's signatures, and linked sets share one. Nothing is missed, and every
candidate is compared on its whole set.

Equal sets meet first, one of them goes on. Those that share a signature meet in
two rounds with one another's representatives, on whole sets, and components
follow. Where a signature still holds several components, all pairs across them
are compared in blocks by size and by parities: each of m classes of shingles
leaves its count's parity, and two sets differ in at least as many elements as
parities. Pairs that pass are compared on whole sets.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernstone.llm.components import connected_components
from quernstone.llm.hot import join_back
from quernstone.llm.tokens import mix
from quernstone.session import Written, let_go, materialise

#: Words a shingle, least similarity in hundredths, sets a block, sets compared with one representative in a task.
SHINGLE, PERCENT, BLOCK, HEADED = 3, 90, 512, 512
_WORD = np.uint64(0xD6E8FEB86659FD93)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def word_codes(text: bytes, size: int = 1 << 20) -> np.ndarray:
    """A hash of each word, A-Z lower-cased; words are cut at space and \\t\\n\\v\\f\\r."""
    found, at = [], 0
    while at < len(text):
        end = at + size
        while end < len(text) and text[end] not in b" \t\n\v\f\r":
            end += 1
        words = text[at:end].lower().split()
        found.append(np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words)))
        at = end
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def shingle_set(text: bytes) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles; of fewer words the whole sequence is one, of none there is none."""
    codes = word_codes(text)
    width = min(SHINGLE, len(codes))
    made = np.zeros(len(codes) - width + 1 if width else 0, np.uint64)
    for k in range(width):
        made = mix(made * _WORD + codes[k : k + len(made)])
    return np.unique(made)


def differing(size: int) -> int:
    """The most elements in which linked sets of ``size`` in mean can differ."""
    return 2 * size * (100 - PERCENT) // (100 + PERCENT)


@lru_cache
def band_starts(size: int) -> tuple[int, ...]:
    """The smallest sizes of the bands, past ``size`` and one more; a band spans two steps of the similarity."""
    starts = [1]
    while starts[-1] <= size or len(starts) < 2 or starts[-2] <= size:
        starts.append(max(starts[-1] + 1, -(-starts[-1] * 10_000 // (PERCENT * PERCENT))))
    return tuple(starts)


def signatures(members: np.ndarray) -> np.ndarray:
    """The PartEnum signatures of a set in all its bands; none in bands where only equal sets are linked."""
    size = len(members)
    if not size:
        return np.zeros(0, np.uint64)
    starts = band_starts(1 << (100 * size // PERCENT).bit_length())
    own = int(np.searchsorted(starts, size, side="right")) - 1
    out = [np.zeros(0, np.uint64)]
    for band in (own, own + 1) if 100 * size // PERCENT >= starts[own + 1] else (own,):
        k = differing(starts[band + 1] - 1)
        if not k:
            continue
        parts = k // 2 + 1
        place = (mix(members ^ _ODD) >> np.uint64(32)) * np.uint64(3 * parts) >> np.uint64(32)
        digest = np.zeros(3 * parts, np.uint64)
        np.add.at(digest, place.astype(np.int64), mix(members * _ODD))
        digest = digest.reshape(parts, 3)
        for left_out in range(3):
            a, b = digest[:, (left_out + 1) % 3], digest[:, (left_out + 2) % 3]
            which = np.uint64(band << 34 | left_out << 32) + np.arange(parts, dtype=np.uint64)
            out.append(mix(mix(mix(which) ^ a) * _WORD ^ mix(b)))
    return np.concatenate(out)


def parities(members: np.ndarray) -> bytes:
    """One bit a class of hashes: whether the set has an odd number there. Over two classes for each element that may differ."""
    m = 1 << max(8, (4 * differing(len(members))).bit_length())
    odd = np.bincount((members & np.uint64(m - 1)).astype(np.int64), minlength=m) & 1
    return np.packbits(odd.astype(bool)).tobytes()


def alike(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sorted sets are linked."""
    if 100 * min(len(a), len(b)) < PERCENT * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= PERCENT * (len(a) + len(b) - both)


def possible(sketches: list[bytes], sizes: np.ndarray, side: np.ndarray, root: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (a, b) of rows of other roots that sizes and parities leave possible; of two sides only pairs across.

    A sketch twice as long as another is folded: a parity is that of the two classes it joins.
    """
    bits = [np.unpackbits(np.frombuffer(s, np.uint8)) for s in sketches]
    m = min(map(len, bits))
    folded = np.packbits([b.reshape(-1, m).sum(axis=0) & 1 for b in bits], axis=1).view(np.uint64)
    across = len(np.unique(side)) > 1
    for at in range(0, len(bits), 32):
        cut = slice(at, at + 32)
        sums, least = sizes[cut, None] + sizes[None], np.minimum(sizes[cut, None], sizes[None])
        near = (100 * least >= PERCENT * (sums - least)) & (root[cut, None] != root[None])
        if across:
            near &= side[cut, None] != side[None]
        a, b = np.nonzero(near)
        up = a + at < b
        a, b = a[up] + at, b[up]
        apart = np.bitwise_count(folded[a] ^ folded[b]).sum(axis=1, dtype=np.int64)
        ok = apart * (100 + PERCENT) <= (sizes[a] + sizes[b]) * (100 - PERCENT)
        yield a[ok], b[ok]


def _signed(rows: DataFrame) -> DataFrame:
    """(doc_id, text_hash, row, k1, k2, size, signatures, parities): one row a document; (k1, k2, size) stands for the set."""
    slim = rows.select("doc_id", F.xxhash64("text").alias("text_hash"), F.col("text").cast("binary").alias("text"))
    longs = lambda x: pa.array(np.asarray(x, np.uint64).view(np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            sets = [shingle_set(t.as_py() or b"") for t in batch.column("text")]
            made = [signatures(s) for s in sets]
            ends = pa.array(np.cumsum([0, *map(len, made)]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("text_hash"), pa.array(np.arange(row, row + len(sets))),
                    longs([mix(s).sum(dtype=np.uint64) for s in sets]), longs([mix(s ^ _WORD).sum(dtype=np.uint64) for s in sets]), pa.array(np.array([len(s) for s in sets], np.int64)),
                    pa.ListArray.from_arrays(ends, longs(np.concatenate([np.zeros(0, np.uint64), *made]))), pa.array([parities(s) for s in sets], pa.binary()),
                ],
                names=["doc_id", "text_hash", "row", "k1", "k2", "size", "signatures", "parities"],
            )
            row += len(sets)

    schema = f"doc_id {dict(slim.dtypes)['doc_id']}, text_hash long, row long, k1 long, k2 long, size long, signatures array<long>, parities binary"
    return slim.mapInArrow(run, schema)


def _meetings(nodes: DataFrame) -> DataFrame:
    """(signature, head, node), head < node: sets that share a signature, each with a smaller one that has it.

    Equal signatures meet within a batch first, so a common one travels once a batch.
    """

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("signatures")
            node = np.repeat(batch.column("node").to_numpy(), lists.value_lengths().fill_null(0).to_numpy())
            sign = lists.flatten().to_numpy()
            order = np.lexsort((node, sign))
            node, sign = node[order], sign[order]
            first = np.flatnonzero(np.concatenate(([True], sign[1:] != sign[:-1]))) if len(sign) else np.zeros(0, np.int64)
            head = np.repeat(node[first], np.diff(np.append(first, len(sign))))
            again = np.ones(len(sign), bool)
            again[first] = False
            key = np.where(again, mix(node.view(np.uint64)).view(np.int64), sign)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(sign), pa.array(head, mask=~again), pa.array(node)], names=["key", "signature", "head", "node"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, least = None, None
        for batch in batches:
            met = batch.filter(batch.column("head").is_valid())
            if met.num_rows:
                yield met.select(["signature", "head", "node"])
            batch = batch.filter(batch.column("head").is_null())
            if not batch.num_rows:
                continue
            sign, node = batch.column("signature").to_numpy(), batch.column("node").to_numpy()
            first = np.concatenate(([True], sign[1:] != sign[:-1]))
            head = np.repeat(node[first], np.diff(np.append(np.flatnonzero(first), len(sign))))
            if last == sign[0]:  # a run that began in the batch before
                head[: np.argmin(sign == last) or len(sign)] = least
            last, least = sign[-1], head[-1]
            more = head != node
            yield pa.RecordBatch.from_arrays([pa.array(x[more]) for x in (sign, head, node)], names=["signature", "head", "node"])

    dealt = nodes.select("node", "signatures").mapInArrow(send, "key long, signature long, head long, node long")
    return dealt.repartition("key").sortWithinPartitions("signature", "node").mapInArrow(meet, "signature long, head long, node long")


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, members): the sets of ``wanted`` (node, doc_id, text_hash), made again from their texts."""
    texts = docs.select(F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_hash"), F.col("text").cast("binary").alias("text"))
    held = texts.join(wanted, F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_hash") == F.col("text_hash"))).select("node", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            nodes = batch.column("node").to_pylist()
            own = [k for k, n in enumerate(nodes) if n != (nodes[k - 1] if k else last)]  # repeated rows stand together
            last = nodes[-1] if nodes else last
            yield pa.RecordBatch.from_arrays([pa.array([nodes[k] for k in own], pa.int64()), pa.array([shingle_set(batch.column("text")[k].as_py() or b"").tobytes() for k in own], pa.binary())], names=["node", "members"])

    return held.mapInArrow(run, "node long, members binary")


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The runs of rows that are equal in ``keys``, of batches in that order."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        values = np.stack([batch.column(c).to_numpy() for c in keys])
        cuts = np.flatnonzero((values[:, 1:] != values[:, :-1]).any(axis=0)) + 1
        if held and any(held[-1].column(c)[-1] != batch.column(c)[0] for c in keys):
            yield pa.Table.from_batches(held)
            held = []
        for a, z in zip(np.r_[0, cuts], np.r_[cuts, batch.num_rows], strict=True):
            held.append(batch.slice(a, z - a))
            if z < batch.num_rows:
                yield pa.Table.from_batches(held)
                held = []
    if held:
        yield pa.Table.from_batches(held)


def _in_groups(rows: DataFrame, keys: list[str], order: list[str], f: Callable[[pa.Table], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, keys):
            yield from f(group)

    return rows.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(run, schema)


def _linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (head, node) whose sets are linked; a head's pairs are dealt to several tasks where they are many."""
    tasks = pairs.groupBy("head").agg(F.ceil(F.count("*") / HEADED).alias("tasks"))
    dealt = pairs.join(tasks, "head").select("head", "node", F.pmod(F.xxhash64("node"), F.col("tasks")).alias("task"))
    heads = tasks.select("head", F.col("head").alias("node"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("tasks") - 1)).alias("task"))

    def compare(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        nodes, members = rows.column("node").to_pylist(), rows.column("members")
        head = rows.column("head")[0].as_py()
        at = nodes.index(head)
        own = np.frombuffer(members[at].as_py(), np.uint64)
        found = [n for k, n in enumerate(nodes) if n != head and alike(own, np.frombuffer(members[k].as_py(), np.uint64))]
        yield pa.RecordBatch.from_arrays([pa.array([head] * len(found), pa.int64()), pa.array(found, pa.int64())], names=["head", "node"])

    return _in_groups(dealt.unionByName(heads).join(sets, "node"), ["head", "task"], ["node"], compare, "head long, node long")


def _across(met: DataFrame, roots: DataFrame, known: DataFrame) -> DataFrame:
    """(head, node): possible pairs of other roots among the sets of a signature (``met``: signature, node), met in blocks."""
    rows = met.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    sizes = rows.groupBy("signature").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"), F.count("*").alias("n")).where("n > 2")
    dealt = rows.join(sizes.select("signature", "blocks"), "signature").withColumn("side", F.pmod(F.xxhash64("node"), F.col("blocks")))
    dealt = dealt.select("signature", "side", "node", "root", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other"))
    dealt = dealt.select("signature", F.least("side", "other").alias("low"), F.greatest("side", "other").alias("high"), "side", "node", "root").join(known.select("node", "size", "parities"), "node")

    def compare(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        node, size, side, root = (rows.column(c).to_numpy() for c in ("node", "size", "side", "root"))
        for a, b in possible(rows.column("parities").to_pylist(), size, side, root):
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(node[a], node[b])), pa.array(np.maximum(node[a], node[b]))], names=["head", "node"])

    return _in_groups(dealt, ["signature", "low", "high"], ["node"], compare, "head long, node long").distinct()


def _roots(links: DataFrame) -> DataFrame:
    """(node, root) of the nodes that have links."""
    return connected_components(links.select(F.col("head").alias("u"), F.col("node").alias("v")), "jaccard-links").withColumnRenamed("component", "root")


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs (head, node) that no chain of links joins so far."""
    root = roots.select(F.col("node").alias("of"), "root")
    out = pairs
    for end in ("head", "node"):
        out = out.join(root.withColumnRenamed("root", f"{end}_root"), F.col(end) == F.col("of"), "left").drop("of")
    return out.where(F.coalesce("head_root", "head") != F.coalesce("node_root", "node")).select(*pairs.columns)


def jaccard_join(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs``; chains of links make a component.

    Two rows are linked if their sets of three-word shingles have a similarity of 0.9
    or more. A text of fewer words is one shingle, one without words (null, empty,
    blank) has none and is linked with nothing. The component's name is its smallest
    doc_id; a null doc_id keeps its row and is never a name (alone: null). Repeated
    rows are linked with each other. Long texts are read whole. Only doc_id and text
    are read, so other columns cannot clash; an empty table gives no rows.
    """
    spark = docs.sparkSession
    base = materialise(_signed(docs), "signed-sets")
    key = ["k1", "k2", "size"]
    filled = base.where("size > 0")
    classes = materialise(filled.groupBy(*key).agg(F.min("row").alias("node"), F.min("doc_id").alias("first_id"), F.count("*").alias("n")), "distinct-sets")
    chosen = filled.where("size(signatures) > 0").groupBy(*key).agg(F.min(F.struct("row", "doc_id", "text_hash", "signatures", "parities")).alias("o"))
    known = materialise(chosen.select(F.col("o.row").alias("node"), "size", "o.doc_id", "o.text_hash", "o.signatures", "o.parities"), "signed-classes")
    met = Written(_meetings(known), "shared-signatures", n=F.count("*"))
    let_go(spark)
    links = spark.createDataFrame([], "head long, node long")
    roots = spark.createDataFrame([], "node long, root long")
    if met.taken["n"]:
        shared = met.read()
        star = materialise(shared.groupBy("head", "node").agg(F.count("*").alias("shared")), "star")
        ends = star.select("node").unionByName(star.select(F.col("head").alias("node"))).distinct()
        sets = materialise(_sets(docs, known.join(ends, "node").select("node", "doc_id", "text_hash")), "shingle-sets")
        let_go(spark)
        # Each with the head it shares most signatures with, then with its other heads that are still apart.
        first = star.groupBy("node").agg(F.max(F.struct("shared", (-F.col("head")).alias("down"))).alias("m")).select((-F.col("m.down")).alias("head"), "node")
        links = materialise(_linked(first, sets), "links")
        roots = _roots(links)
        rest = materialise(_apart(star.select("head", "node"), roots).join(first, ["head", "node"], "left_anti"), "second-heads")
        links = links.unionByName(materialise(_linked(rest, sets), "links"))
        roots = _roots(links)
        # Signatures whose sets are not yet one component: all pairs across.
        mixed = _apart(shared, roots).select("signature").distinct()
        held = shared.join(mixed, "signature").select("signature", F.explode(F.array("head", "node")).alias("node")).distinct()
        tried = star.select("head", "node")
        pairs = materialise(_across(held, roots, known).join(tried, ["head", "node"], "left_anti"), "pairs-across")
        links = links.unionByName(materialise(_linked(pairs, sets), "links"))
        roots = _roots(links)
    named = classes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    names = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_key = named.join(names, "root").select(*key, "component_id", "n")
    whole = join_back(filled.select("doc_id", *key), materialise(of_key, "named-sets"), key, "n")
    none = base.where("size = 0").select("doc_id", F.col("size").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return whole.select("doc_id", F.col("size").alias("n_shingles"), "component_id").unionByName(none)
