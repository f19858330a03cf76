"""Near-copies by SimHash and by similarity of word shingles; exact sets decide.

A document is the set of its runs of five words. Its SimHash fingerprint over
these runs goes through the segment-popcount search of ``simhash``, which
proposes the pairs within 3 of 64 bits. Sets of similarity 0.8 differ in about 10
bits, out of reach of any grid on 64 bits, so bands of minima over the set
propose the rest: they put documents of that similarity into a common bucket with
a chance of 0.9996 at least. Every proposed pair is compared on the whole sets.

In two rounds the others of a bucket are compared with its smallest document
only, and what resembles it goes, so a large group of copies is never paired with
itself. Documents that share a bucket and resemble nobody are left, such as those
around one common passage. Their signatures, all minima, are compared in blocks,
and pairs that agree in 60 of 100 go to the exact test; at a similarity of 0.8
fewer agree with a chance of 10**-6.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernstone.llm.simhash import bit_majority, groups_for, linked_fingerprints, only
from quernstone.llm.tokens import mix
from quernstone.session import Written, let_go, materialise

#: Words a shingle, least Jaccard similarity, bands and minima a band.
SHINGLE, SIMILARITY, BANDS, ROWS = 5, 0.8, 20, 5
#: Rounds of comparing with a bucket's smallest, signatures a block, minima that agree.
ROUNDS, BLOCK, AGREE = 2, 512, 60
_SEEDS = mix(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_WORD = np.uint64(0xD6E8FEB86659FD93)


def shingles(text: bytes) -> tuple[int, int, np.ndarray]:
    """A hash of the word sequence, the fingerprint, the distinct shingles' hashes; words as in ``simhash.fingerprint``.

    A text of fewer words is one shingle, one without words none (fingerprint 0).
    """
    words = text.lower().split()
    key = xxhash.xxh64_intdigest(b" ".join(words), 0)
    if len(words) < SHINGLE:
        return key, key if words else 0, np.array([key] if words else [], dtype=np.uint64)
    codes = np.array([xxhash.xxh64_intdigest(w, 0) for w in words], dtype=np.uint64)
    n, made = len(words) - SHINGLE + 1, np.zeros(len(words) - SHINGLE + 1, dtype=np.uint64)
    for k in range(SHINGLE):
        made = mix(made * _WORD + codes[k : k + n])
    return key, bit_majority(made), np.unique(made)


def minima(made: np.ndarray) -> np.ndarray:
    """The least value of each hash function over a set that is not empty."""
    least = np.full(len(_SEEDS), np.iinfo(np.uint64).max, dtype=np.uint64)
    for a in range(0, len(made), 2048):
        part = made[a : a + 2048, None] * _SEEDS
        np.minimum(least, (part ^ (part >> np.uint64(31))).min(axis=0), out=least)
    return least


def bands(least: np.ndarray) -> np.ndarray:
    """One bucket a band."""
    out = np.arange(BANDS, dtype=np.uint64)
    for column in least.reshape(BANDS, ROWS).T:
        out = mix(out * _WORD + column)
    return out


def agreeing(signatures: np.ndarray, side: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (a, b), a < b, of rows that agree in AGREE minima; of two sides only pairs across."""
    several = len(np.unique(side)) > 1
    for at in range(0, len(signatures), 64):
        same = (signatures[at : at + 64, None] == signatures[None]).sum(axis=2) >= AGREE
        if several:
            same &= side[at : at + 64, None] != side[None]
        a, b = np.nonzero(same)
        up = a + at < b
        yield a[up] + at, b[up]


def similar(a: bytes, b: bytes) -> bool:
    """Whether two packed sets reach the similarity."""
    x, y = np.frombuffer(a, np.uint32), np.frombuffer(b, np.uint32)
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 5 * both >= 4 * (len(x) + len(y) - both) and both > 0


def _sets(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, key, fp, buckets, signature, members).

    signature holds 16 bits of each minimum, members the sorted 32-bit hashes of the shingles.
    """
    slim = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.col("text").cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signed = lambda x: pa.array(np.array(x, np.uint64).view(np.int64))
        for batch in batches:
            keys, prints, buckets, signatures, members = [], [], [], [], []
            for t in batch.column("text"):
                key, fp, made = shingles(t.as_py() or b"")
                keys.append(key)
                prints.append(fp)
                least = minima(made)
                buckets.append(bands(least).view(np.int64) if len(made) else [])
                signatures.append(mix(least).astype(np.uint16).tobytes())
                members.append(np.unique((made >> np.uint64(32)).astype(np.uint32)).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), signed(keys), signed(prints), pa.array(buckets, pa.list_(pa.int64())), pa.array(signatures, pa.binary()), pa.array(members, pa.binary())],
                names=["doc_id", "text_hash", "key", "fp", "buckets", "signature", "members"],
            )

    return slim.mapInArrow(run, f"doc_id {dict(slim.dtypes)['doc_id']}, text_hash long, key long, fp long, buckets array<long>, signature binary, members binary")


def _buckets(owners: DataFrame, n: int) -> DataFrame:
    """(node, bucket): fingerprints alike or within 3 bits, and bands of minima, of ``n`` rows."""
    prints = owners.select("fp", "node").where("size(buckets) > 0")
    pairs = linked_fingerprints(prints.select("fp").distinct(), groups_for(n))
    ends = pairs.select(F.xxhash64("u", "v").alias("bucket"), F.explode(F.array("u", "v")).alias("fp"))
    near = prints.join(ends, "fp").select("node", "bucket")
    alike = prints.select("node", F.xxhash64("fp").alias("bucket"))
    return near.unionByName(alike).unionByName(owners.select("node", F.explode("buckets").alias("bucket")))


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The documents (node) of (head, node) whose sets reach the similarity."""
    both = pairs.join(sets.select(F.col("node").alias("head"), F.col("members").alias("a")), "head").join(sets.select("node", F.col("members").alias("b")), "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [similar(x.as_py(), y.as_py()) for x, y in zip(batch.column("a"), batch.column("b"), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("node").filter(pa.array(keep, pa.bool_()))], names=["node"])

    return both.select("node", "a", "b").mapInArrow(run, f"node {dict(pairs.dtypes)['node']}").distinct()


def _alike(member: DataFrame, signatures: DataFrame) -> DataFrame:
    """(head, node), head < node: pairs of a bucket whose signatures agree, met in blocks."""
    sizes = member.groupBy("bucket").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"), F.count("*").alias("n")).where("n > 1")
    dealt = member.join(sizes.select("bucket", "blocks"), "bucket").join(signatures, "node")
    dealt = dealt.withColumn("side", F.pmod(F.xxhash64("node"), F.col("blocks")))
    dealt = dealt.select("bucket", "side", "node", "signature", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other"))
    dealt = dealt.select("bucket", F.least("side", "other").alias("low"), F.greatest("side", "other").alias("high"), "side", "node", "signature")

    def met(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        matrix = np.frombuffer(b"".join(rows.column("signature").to_pylist()), np.uint16).reshape(rows.num_rows, -1)
        nodes = rows.column("node").combine_chunks()
        for a, b in agreeing(matrix, rows.column("side").to_numpy()):
            if len(a):
                yield pa.RecordBatch.from_arrays([nodes.take(pa.array(a)), nodes.take(pa.array(b))], names=["head", "node"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_rows: list[pa.RecordBatch] = []  # of the group that is not known to be whole
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in ("bucket", "low", "high")])
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            if open_rows and batch.num_rows and any(open_rows[-1].column(c)[-1] != batch.column(c)[0] for c in ("bucket", "low", "high")):
                yield from met(pa.Table.from_batches(open_rows))
                open_rows = []
            for a, z in zip(np.r_[0, cuts], np.r_[cuts, batch.num_rows], strict=True):
                open_rows.append(batch.slice(a, z - a))
                if z < batch.num_rows:
                    yield from met(pa.Table.from_batches(open_rows))
                    open_rows = []
        if open_rows:
            yield from met(pa.Table.from_batches(open_rows))

    kind = dict(member.dtypes)["node"]
    keys = ["bucket", "low", "high"]
    return dealt.repartition(*keys).sortWithinPartitions(*keys, "node").mapInArrow(run, f"head {kind}, node {kind}").distinct()


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` without the near-copies of documents with a smaller doc_id.

    No two rows that stay have a similarity of 0.8 or more, save for pairs that
    share no bucket; each row that goes has it with a smaller one. Ties go to the
    smaller hash of the text, rows alike in both stay once, a null doc_id is the
    largest. Texts without words are copies of each other. Columns stay, whatever
    their names. An empty table gives no rows.
    """
    spark = docs.sparkSession
    base = materialise(_sets(docs), "shingles")
    node = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    # Equal word sequences meet first; one of them goes on.
    distinct = Written(base.groupBy("key").agg(F.min(node).alias("node"), F.min("fp").alias("fp"), F.min("buckets").alias("buckets")), "distinct-texts", n=F.count("*"))
    owners = distinct.read()
    member = materialise(_buckets(owners, distinct.taken["n"]), "buckets")
    shared = member.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket")
    open_ones = Written(member.join(shared, "bucket"), "shared-buckets", n=F.count("*"))
    member = open_ones.read()
    wanted = member.select("node").distinct().select("node", F.col("node.doc_id").alias("id"), F.col("node.text_hash").alias("digest"))
    held = base.join(wanted, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_hash") == F.col("digest")))
    sets = materialise(held.groupBy("node").agg(F.min("members").alias("members")), "shingle-sets")
    gone = None
    for k in range(ROUNDS + 1):
        if not open_ones.taken["n"]:
            break
        if k < ROUNDS:
            heads = member.groupBy("bucket").agg(F.min("node").alias("head"), F.count("*").alias("n")).where("n > 1").select("bucket", "head")
            rest = materialise(member.join(heads, "bucket").where("node <> head"), "compared")
            pairs = rest.select("head", "node").distinct()
        else:
            signatures = base.join(wanted, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_hash") == F.col("digest"))).groupBy("node").agg(F.min("signature").alias("signature"))
            pairs = materialise(_alike(member, signatures), "alike")
        found = materialise(_verified(pairs, sets), "near-copies")
        gone = found if gone is None else gone.union(found)
        if k < ROUNDS:
            open_ones = Written(rest.select("bucket", "node").join(found, "node", "left_anti"), "open-buckets", n=F.count("*"))
            member = open_ones.read()
        let_go(spark)
    kept = owners.select("node") if gone is None else owners.select("node").join(gone, "node", "left_anti")
    return only(docs, kept.select("node.doc_id", "node.text_hash"))
