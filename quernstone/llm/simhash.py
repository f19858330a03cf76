"""SimHash near-duplicates by a segment-popcount embedding.

A fingerprint of 64 bits is cut into segments of two bits; the vector of their
popcounts embeds it so that the Manhattan distance of two vectors never exceeds
the Hamming distance of the fingerprints. To find all pairs within 3 bits, the
vector is split into two halves of 16 coordinates: one half then lies within
distance 1. Each half is a point of an integer grid, and a range join at radius
1 is an equality join of each point with itself and with its neighbours one step
up (a pair one step apart is met from its lower end). Candidates pass the bound
over the whole vector, then the exact Hamming distance.

A half has some 24 bits of entropy, so in a large corpus too many strangers share a
cell. The other half lies within distance 3: cut into g groups of coordinates, all but
three agree, so each choice of g - 3 groups, taken exactly, refines the cell. With g = 3
nothing is taken; g grows with the number of fingerprints and changes no result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quernstone.llm.columns import spare
from quernstone.llm.components import connected_components
from quernstone.llm.hot import join_back
from quernstone.session import Written, materialise

#: The seed of the shingle hash and the distance that links.
SEED, MAX_DISTANCE = 42, 3
_EVEN = 0x55555555


def bit_majority(hashes: np.ndarray) -> int:
    """The 64-bit number whose bits are those set in over half of ``hashes``."""
    count = np.zeros(64, dtype=np.int64)
    for k in range(0, len(hashes), 1 << 16):
        part = hashes[k : k + (1 << 16)]
        count += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * count > len(hashes), bitorder="little")
    return int.from_bytes(bits.tobytes(), "little")


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """SimHash of a UTF-8 text over shingles of ``shingle`` words, repeats included.

    A-Z are lower-cased; words are cut at space and \\t\\n\\v\\f\\r. A text of fewer
    words has one shingle, the whole sequence; one without words gives 0.
    """
    words = text.lower().split()  # of bytes: ASCII only, in both respects
    if not words:
        return 0
    digest, joined = xxhash.xxh64_intdigest, b" ".join(words)
    if len(words) <= shingle:
        return digest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    spans = zip(starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1 :].tolist(), strict=True)
    return bit_majority(np.array([digest(joined[a:b], SEED) for a, b in spans], dtype=np.uint64))


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, text_hash, fp), the fingerprint as a signed long; a null text counts as empty."""
    slim = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.col("text").cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = np.array([fingerprint(t.as_py() or b"", shingle) for t in batch.column("text")], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(made.view(np.int64))], names=["doc_id", "text_hash", "fp"]
            )

    kind = dict(slim.dtypes)["doc_id"]
    return slim.mapInArrow(run, f"doc_id {kind}, text_hash long, fp long")


def _popcounts(half: Column) -> Column:
    """The 16 two-bit popcounts of a 32-bit half, packed two bits each."""
    return half.bitwiseAND(_EVEN) + F.shiftright(half, 1).bitwiseAND(_EVEN)


def _manhattan(a: Column, b: Column) -> Column:
    """Manhattan distance of two packed vectors of 16 counts of 0 to 2."""
    # Written in unary (0, 01, 11), counts differ in as many bits as in value.
    unary = lambda c: c.bitwiseOR(F.shiftright(c, 1).bitwiseAND(_EVEN))
    return F.bit_count(unary(a).bitwiseXOR(unary(b)))


def refinements(groups: int) -> list[int]:
    """Masks of 16 packed coordinates that keep all but three of ``groups`` groups of them, one for each choice."""
    cuts = [16 * g // groups for g in range(groups + 1)]
    parts = [sum(3 << 2 * c for c in range(a, z)) for a, z in zip(cuts, cuts[1:], strict=False)]
    return [sum(chosen) for chosen in combinations(parts, groups - MAX_DISTANCE)]


def groups_for(n: int) -> int:
    """The fewest groups, up to 8, with which a cell of ``n`` even fingerprints holds at most 8 strangers.

    Two counts of two bits agree with a chance of 0.375.
    """
    for groups in range(MAX_DISTANCE, 8):
        kept = min(m.bit_count() // 2 for m in refinements(groups))
        if n * 0.375 ** (16 + kept) <= 8:
            return groups
    return 8


def linked_fingerprints(distinct: DataFrame, groups: int = MAX_DISTANCE) -> DataFrame:
    """Pairs (u, v), u < v, of distinct fingerprints (column fp) within 3 bits, whatever ``groups`` is."""
    low, high = F.col("fp").bitwiseAND(0xFFFFFFFF), F.shiftrightunsigned("fp", 32)
    embedded = distinct.select("fp", _popcounts(low).alias("c0"), _popcounts(high).alias("c1"))
    masks = refinements(groups)
    # A way is a half and a choice of groups of the other; these stand above the cell's 32 bits.
    ways = [
        F.struct(F.lit(len(masks) * s + k).cast("byte").alias("way"), F.col(f"c{s}").alias("cell"), F.shiftleft(F.col(f"c{1 - s}").bitwiseAND(mask), 32).alias("rest"))
        for s in (0, 1)
        for k, mask in enumerate(masks)
    ]
    ways = embedded.select("*", F.inline(F.array(*ways)))
    points = ways.select("fp", "c0", "c1", "way", (F.col("cell") + F.col("rest")).alias("cell"))
    steps = F.filter(
        F.transform(F.sequence(F.lit(0), F.lit(30), F.lit(2)), lambda i: F.when(F.call_function("shiftright", F.col("cell"), i).bitwiseAND(3) < 2, F.call_function("shiftleft", F.lit(1).cast("long"), i))),
        lambda x: x.isNotNull(),
    )
    probes = points.select("fp", "c0", "c1", "way", "cell", F.explode(F.concat(F.array(F.lit(0).cast("long")), steps)).alias("step"))
    probes = probes.select("way", (F.col("cell") + F.col("step")).alias("cell"), "step", F.col("fp").alias("p"), F.col("c0").alias("p0"), F.col("c1").alias("p1"))
    bound = _manhattan(F.col("c0"), F.col("p0")) + _manhattan(F.col("c1"), F.col("p1"))
    near = F.bit_count(F.col("fp").bitwiseXOR(F.col("p")))
    # Merged by hint, here and below: small files of fingerprints become tables that a driver cannot build for a broadcast.
    met = points.alias("a").hint("merge").join(
        probes.alias("b"),
        (F.col("a.way") == F.col("b.way"))
        & (F.col("a.cell") == F.col("b.cell"))
        & ((F.col("step") > 0) | (F.col("fp") < F.col("p")))
        & (bound <= MAX_DISTANCE)
        & (near <= MAX_DISTANCE),
    )
    return met.select(F.least("fp", "p").alias("u"), F.greatest("fp", "p").alias("v")).distinct()


def near_duplicates(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, text_hash, root, fingerprint, component_id) for every row of ``docs``.

    ``root`` is a fingerprint that stands for the component.

    Documents whose fingerprints are linked by a chain of distances of at most 3
    share a component, named by its smallest doc_id. Equal fingerprints meet in
    a grouped minimum and take part in the search once, however many they are.
    A null doc_id keeps its row and is never a name unless it stands alone (then
    component_id is null). Repeated rows stay; an empty table gives no rows. Only
    doc_id and text are read, so other columns cannot clash. Long texts are read
    whole.
    """
    base = materialise(fingerprints(docs, shingle), "fingerprints")
    owners = base.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n"))
    written = Written(owners, "distinct-fingerprints", n=F.count("*"))
    owners = written.read()
    reached = connected_components(linked_fingerprints(owners.select("fp"), groups_for(written.taken["n"])), "simhash-links")
    names = reached.join(owners.hint("merge"), F.col("node") == F.col("fp")).groupBy("component").agg(F.min("first_id").alias("component_id"))
    moved = reached.join(names.hint("merge"), "component").select(F.col("node").alias("fp"), "component", "component_id")
    of_fp = owners.join(moved.hint("merge"), "fp", "left").select(
        "fp", "n", F.coalesce("component", "fp").alias("root"), F.when(F.col("component").isNotNull(), F.col("component_id")).otherwise(F.col("first_id")).alias("component_id")
    )
    text = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return join_back(base, materialise(of_fp, "named-fingerprints"), ["fp"], "n").select("doc_id", "text_hash", "root", text.alias("fingerprint"), "component_id")


def row_key(ident: Column, digest: Column) -> Column:
    """One string of an id and a text's hash; null ids have their own."""
    return F.concat_ws(":", F.coalesce(ident.cast("string"), F.lit("")), digest.cast("string"))


def only(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """``docs`` without the rows whose (doc_id, text_hash) is not in ``kept``; rows alike in both stay once."""
    name = spare("_key", docs)
    keys = kept.select(row_key(F.col("doc_id"), F.col("text_hash")).alias(name)).distinct()
    keyed = docs.withColumn(name, row_key(F.col("doc_id"), F.xxhash64("text")))
    return keyed.join(keys, name, "left_semi").dropDuplicates([name]).select(*docs.columns)


def keep_one(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """``docs`` with one row of each near-duplicate component: that of the smallest doc_id.

    Ties go to the smaller hash of the text, rows alike in both stay once, a null
    doc_id is chosen last. Columns stay as they are, whatever their names. Null
    and empty texts have the fingerprint 0 and are near each other; long texts are
    read whole. An empty table gives no rows.
    """
    known = near_duplicates(docs, shingle)
    first = known.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("m"))
    return only(docs, first.select("m.doc_id", "m.text_hash"))
