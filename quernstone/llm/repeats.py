"""Removal of repeated passages by maximal repeats of an enhanced suffix array.

A byte of a document goes where it is covered by a string of ``LENGTH`` bytes
that also starts in a document of smaller id. Sorting every suffix of a corpus
would move each byte many times over, so places that can match are found first:

1. Contexts. Every window of LENGTH bytes picks the k-mer of least hash in it (the
   leftmost on ties), its anchor; the windows that pick one anchor form a context.
   Equal windows pick equal anchors. One shuffle of (anchor, digest of the
   context, document, place), some 25 bytes each, brings equal anchors together.
   Occurrences of one context are an interval of the suffix tree whose common
   prefix is the whole context; those above its smallest document go.
2. Repeats. Where an anchor has several contexts, parts of them may be equal. A
   string that two of them share holds the anchor at one place, so they also agree
   in one of three stretches about it (``stretches``); contexts whose hashes of them
   meet no other document's go no further. The bytes of one occurrence of each
   of the others are cut out, and an anchor's contexts form a
   suffix array of the suffixes long enough, with common-prefix lengths. A stack
   scan walks its interval tree; an interval whose suffixes are preceded by
   different bytes is a maximal repeat, with all its occurrences. Those above the
   smallest document of the group go.
3. Removal. All spans meet their documents.

What a task has read is merged before it is shuffled: of equal contexts the
smallest document is sent, the others are repeats for certain; places that
overlap are one run, so a periodic text is a few rows. An anchor with more than
``WIDE`` contexts is never gathered: its windows themselves are the keys of a
grouped minimum, a level of the tree deep enough for the question. Anchors that a
sample shows to be so common are spread by context from the start.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quernstone.llm.columns import spare
from quernstone.llm.hot import join_back
from quernstone.llm.tokens import byte_blocks, mix, power
from quernstone.session import Written, let_go, materialise

#: Fixed value: the length of a string that counts as repeated.
LENGTH = 50
#: k-mer length, bytes scanned at once, bytes of a piece of a long text, bytes of contexts sorted at once.
KMER, BLOCK, PIECE, CHUNK = 16, 1 << 20, 1 << 21, 1 << 19
#: Contexts merged before they are sent, and contexts a bucket should have.
FLUSH, BUCKET = 1 << 19, 1 << 18
#: Contexts of one anchor that one task takes; the sample that looks for common anchors.
WIDE, SAMPLE_BYTES, SAMPLE_EVERY = 1 << 13, 256 << 20, 32
#: Where null ids stand: above all others.
LAST = (1 << 63) - 1
#: Low bits of a hash that give way to a place; the same in every block.
_PLACE = np.uint64((1 << 26) - 1)
#: Bits of a stretch's hash.
_SIDE = 21


class Contexts(NamedTuple):
    """Contexts of some texts: anchor, digest, hashes of the stretches, number of the text, place in it, size."""

    hash: np.ndarray
    digest: np.ndarray
    sides: np.ndarray
    text: np.ndarray
    at: np.ndarray
    size: np.ndarray


def stretches(length: int = LENGTH) -> list[tuple[int, int]]:
    """Bytes before and after the anchor of three stretches, one of which lies in any string of ``length`` bytes that picks it.

    A string with o bytes before its anchor has ``length - KMER - o`` behind it; each
    stretch stands for a third of the values of o.
    """
    places = length - KMER + 1
    cuts = [-(-k * places // 3) for k in range(4)]
    return [(a, places - z) for a, z in zip(cuts, cuts[1:], strict=False)]


def contexts_of(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH) -> Contexts:
    """The contexts of the texts whose bytes stand in ``data`` between ``offsets``.

    Windows lie inside texts. A digest is a polynomial of the context's hashed
    k-mers, so equal contexts have equal ones wherever they stand; its 48 bits stand
    beside the 64 of the anchor. The hashes of the three stretches have 21 bits each, 0
    where the context is too short for one.
    """
    n, none = len(data), np.zeros(0, np.int64)
    if n >= 2 * PIECE:  # long texts: overlapping pieces, so that no window is lost
        parts = []
        for t in range(len(offsets) - 1):
            for a in range(offsets[t], max(offsets[t + 1] - length + 1, offsets[t] + 1), PIECE):
                z = min(a + PIECE + length - 1, offsets[t + 1])
                c = contexts_of(data[a:z], np.array([0, z - a]), length)
                parts.append(c._replace(text=np.full(len(c.hash), t), at=c.at + (a - offsets[t])))
        return Contexts(*(np.concatenate(x) for x in zip(*parts, strict=True)))
    if n < length:
        return Contexts(*[none.astype(np.uint64)] * 3, none, none, none)
    raw = np.ascontiguousarray(data)
    eight = np.empty(n - 7, dtype=np.uint64)
    for o in range(8):
        eight[o::8] = raw[o : o + (n - o) // 8 * 8].view("<u8")
    hashes = mix(eight[: n - KMER + 1] * np.uint64(0x9E3779B97F4A7C15) + eight[KMER - 8 :] * np.uint64(0xC2B2AE3D27D4EB4F))
    least = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)
    span, want = 1, length - KMER + 1
    while 2 * span <= want:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if want > span:
        least = np.minimum(least[: len(least) - (want - span)], least[want - span :])
    starts = np.arange(len(least))
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[: len(least)]
    valid = starts + length <= offsets[text + 1]
    starts, text = starts[valid], text[valid]
    if not len(starts):
        return Contexts(*[none.astype(np.uint64)] * 3, none, none, none)
    place = (least[valid] & _PLACE).astype(np.int64)
    first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    a, z = starts[first], starts[np.r_[first[1:], len(place)] - 1] + length
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * power("up", len(hashes)), out=sums[1:], dtype=np.uint64)
    down = power("down", len(hashes))
    digest = mix((sums[z - KMER + 1] - sums[a]) * down[a] + (z - a).astype(np.uint64)) >> np.uint64(16)
    sides, anchor = np.zeros(len(a), np.uint64), place[first]
    for k, (left, right) in enumerate(stretches(length)):
        own = np.flatnonzero((anchor - left >= a) & (anchor + KMER + right <= z))
        at = anchor[own]
        value = mix((sums[at + right + 1] - sums[at - left]) * down[at - left]) >> np.uint64(64 - _SIDE)
        sides[own] |= np.maximum(value, np.uint64(1)) << np.uint64(_SIDE * k)
    return Contexts(hashes[anchor], digest, sides, text[first], a - offsets[text[first]], z - a)


def anchors(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, text, start and end in ``data`` of each context."""
    c = contexts_of(data, offsets, length)
    return c.hash, c.text, offsets[c.text] + c.at, offsets[c.text] + c.at + c.size


def suffix_array(contexts: list[bytes], length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Context, place and size of each suffix of at least ``length`` bytes, sorted; common prefixes.

    The last array has at i the common prefix of suffixes i-1 and i (0 at 0).
    """
    size = np.array([len(c) for c in contexts])
    each = size - length + 1
    owner = np.repeat(np.arange(len(contexts)), each)
    place = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
    wide = -(-int(size.max()) // 8) * 8
    data = np.frombuffer(b"".join(contexts) + bytes(wide), dtype=np.uint8)
    left = size[owner] - place
    rows = sliding_window_view(data, wide)[(np.cumsum(size) - size)[owner] + place]
    rows[np.arange(wide) >= left[:, None]] = 0
    # Eight bytes are one number that orders as they do; a suffix that ends first comes first.
    words = rows.view(">u8").astype(np.uint64)
    order = np.lexsort((left, *words.T[::-1]))
    owner, place, left, words = owner[order], place[order], left[order], words[order]
    differ = words[1:] ^ words[:-1]
    at = np.where((differ != 0).any(axis=1), (differ != 0).argmax(axis=1), wide // 8 - 1)
    first = np.take_along_axis(differ, at[:, None], axis=1)[:, 0]
    common = 8 * at + sum(first < np.uint64(1 << 8 * k) for k in range(8))
    lcp = np.r_[0, np.minimum(common, np.minimum(left[1:], left[:-1]))]
    return owner, place, left, lcp


def maximal_repeats(lcp: np.ndarray, before: np.ndarray, length: int = LENGTH) -> Iterator[tuple[int, int, int]]:
    """(common length, first, end) of each maximal repeat of at least ``length`` bytes.

    ``before`` is the byte before each suffix, negative and distinct where there
    is none. A stack holds the open intervals of the common-prefix tree; an
    interval is diverse once two of its suffixes have different bytes before.
    """
    deep = np.flatnonzero(lcp >= length)
    if not len(deep):
        return
    runs = np.split(deep, np.flatnonzero(np.diff(deep) > 1) + 1)
    many = 1 << 30  # stands for several different bytes
    for run in runs:
        start, end = int(run[0]) - 1, int(run[-1]) + 1
        stack: list[list[int]] = []  # common length, first suffix, byte before
        values, bytes_before = lcp[start + 1 : end].tolist(), before[start:end].tolist()
        for i in range(start + 1, end + 1):
            value = values[i - start - 1] if i < end else 0
            first, byte = i - 1, bytes_before[i - 1 - start]
            while stack and stack[-1][0] > value:
                depth, first, own = stack.pop()
                byte = own if own == byte else many
                if byte == many:
                    yield depth, first, i
            if value >= length:
                if stack and stack[-1][0] == value:
                    if stack[-1][2] != byte:
                        stack[-1][2] = many
                else:
                    stack.append([value, first, byte])


def bytes_before(contexts: list[bytes], owner: np.ndarray, place: np.ndarray) -> np.ndarray:
    """The byte before each suffix; negative and distinct where a context begins."""
    base = np.cumsum([0] + [len(c) for c in contexts[:-1]])
    data = np.frombuffer(b"".join(contexts), dtype=np.uint8)
    return np.where(place > 0, data[np.maximum(base[owner] + place - 1, 0)].astype(np.int64), -1 - np.arange(len(place)))


def repeated_parts(contexts: list[bytes], least: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context, start, end) of the stretches that contexts share with one of smaller ``least``, merged.

    A suffix counts with the deepest interval that has a smaller document; deeper
    intervals come first.
    """
    owner, place, _, lcp = suffix_array(contexts, length)
    before = bytes_before(contexts, owner, place)
    docs, depth = least[owner], np.zeros(len(owner), np.int64)
    for common, first, end in maximal_repeats(lcp, before, length):
        own, known = docs[first:end], depth[first:end]
        known[(own > own.min()) & (known == 0)] = common
    found = np.flatnonzero(depth)
    found = found[np.lexsort((place[found], owner[found]))]
    who, at = owner[found], place[found]
    span = np.int64(1 << 32)
    upto = np.maximum.accumulate(who * span + at + depth[found]) if len(found) else at
    run, ends = merged_runs(who, at=who * span + at, upto=upto)
    return who[run], at[run], ends - who[run] * span


def merged_runs(*keys: np.ndarray, at: np.ndarray, upto: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first row, end) of each union of touching stretches; rows sorted by keys and ``at``, ends ascending."""
    new = np.ones(len(at), bool)
    if len(at):
        new[1:] = at[1:] > upto[:-1]
        for k in keys:
            new[1:] |= k[1:] != k[:-1]
    first = np.flatnonzero(new)
    return first, upto[np.r_[first[1:], len(at)] - 1] if len(at) else upto


def packed(*columns: np.ndarray) -> bytes:
    """64-bit columns, byte plane by byte plane, compressed; the first, if ascending, as differences."""
    n = len(columns[0])
    columns = (np.diff(columns[0], prepend=columns[0].dtype.type(0)), *columns[1:])
    planes = b"".join(np.ascontiguousarray(c).view(np.uint8).reshape(n, 8).T.tobytes() for c in columns)
    return n.to_bytes(4, "little") + zstandard.compress(planes, 1)


def unpacked(blob: bytes) -> list[np.ndarray]:
    n = int.from_bytes(blob[:4], "little")
    planes = np.frombuffer(zstandard.decompress(blob[4:]), np.uint8).reshape(-1, 8, n)
    first, *rest = (np.ascontiguousarray(p.T).view(np.int64).ravel() for p in planes)
    return [np.cumsum(first), *rest]


#: Repeated ids of which a table is sent to every task; with more, all rows carry a hash.
REPEATED_IDS = 1 << 20
#: Hashes tried to tell texts of one id apart.
SEEDS = 8


def _tie(seed: int) -> Column:
    """A hash of the text that is not negative."""
    return F.xxhash64(F.lit(seed), "text").bitwiseAND(F.lit((1 << 63) - 1))


def _known(docs: DataFrame) -> DataFrame:
    """(doc, tie, data): the id, and a hash of the text that tells rows of one id apart.

    Most ids are unique, and their rows need no hash: tie is 0 there. Where two texts
    of one id have equal ties, by a second hash of 64 bits, another seed is taken.
    """
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc")
    data = F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("data")
    twice = Written(docs.select(doc).groupBy("doc").agg(F.count("*").alias("n")).where("n > 1").select(F.col("doc").alias("twice")), "repeated-ids", n=F.count("*"))
    if not twice.taken["n"]:  # no literal, which the optimiser would take out of join keys and so undo their partitioning
        return docs.select(doc, data).withColumn("tie", F.col("doc").bitwiseAND(0)).select("doc", "tie", "data")
    few = twice.taken["n"] <= REPEATED_IDS
    repeated = F.broadcast(twice.read()) if few else twice.read()
    for seed in range(SEEDS):
        other = F.xxhash64(F.lit(-1 - seed), "text").alias("other")
        held = docs.select(doc, _tie(seed).alias("tie"), other).join(repeated, F.col("doc") == F.col("twice"), "left_semi")
        if not held.groupBy("doc", "tie").agg((F.min("other") != F.max("other")).alias("met")).where("met").limit(1).count():
            break
    else:
        raise RuntimeError("texts of one id cannot be told apart")
    known = docs.select(doc, _tie(seed).alias("tie"), data)
    if not few:
        return known
    marked = known.join(repeated, F.col("doc") == F.col("twice"), "left")
    return marked.select("doc", F.when(F.col("twice").isNull(), F.lit(0).cast("long")).otherwise(F.col("tie")).alias("tie"), "data")


def _batch(columns: list, schema: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_()}
    names, types = zip(*(c.split() for c in schema.split(", ")), strict=True)
    return pa.RecordBatch.from_arrays([pa.array(x, kinds[t]) for x, t in zip(columns, types, strict=True)], names=list(names))


def common_anchors(known: DataFrame, every: int, length: int = LENGTH, wide: int = WIDE) -> np.ndarray:
    """Anchors that by one document in ``every`` have far more than ``wide`` contexts: where rows go, not what comes out."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, data, offsets in byte_blocks(batch.column("data"), BLOCK):
                c = contexts_of(data, offsets, length)
                once = np.unique(np.stack([c.hash, c.digest]), axis=1)[0]
                found, n = np.unique(once, return_counts=True)
                yield _batch([found.view(np.int64), n], "hash long, n long")

    sample = known.where(F.pmod(F.xxhash64("doc", "tie"), F.lit(every)) == 0)
    sums = sample.mapInArrow(count, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n"))
    most = F.greatest(F.lit(16), F.lit(16 * wide // every))
    rows = sums.where(F.col("n") >= most).orderBy(F.desc("n"), "hash").limit(1 << 16).collect()  # bounded
    return np.array(sorted(r["hash"] for r in rows), np.int64).view(np.uint64)


SPAN, ASK, ASK_WIDE, HELD = range(4)
FOUND = "kind int, hash long, digest long, doc long, tie long, at int, last int, size int, more boolean"


def sharing(anchor: np.ndarray, sides: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Which contexts agree in one of the stretches with one of their anchor and of another document."""
    shared = np.zeros(len(anchor), bool)
    for k in range(3):
        value = (sides.view(np.uint64) >> np.uint64(_SIDE * k)) & np.uint64((1 << _SIDE) - 1)
        own = np.flatnonzero(value)
        key = (anchor[own].astype(np.uint64) << np.uint64(_SIDE)) | value[own]
        order = np.argsort(key, kind="stable")
        own, key = own[order], key[order]
        if len(own):
            first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            several = np.minimum.reduceat(least[own], first) < np.maximum.reduceat(least[own], first)
            shared[own[np.repeat(several, np.diff(np.r_[first, len(own)]))]] = True
    return shared


def context_rows(known: DataFrame, buckets: int, hot: np.ndarray, length: int = LENGTH) -> DataFrame:
    """(bucket, kind, blob): merged contexts of a task by bucket; spans that are certain."""
    held_hot = known.sparkSession.sparkContext.broadcast(hot)

    def sent(parts: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
        value, digest, sides, doc, tie, at, size = (np.concatenate(x) for x in zip(*parts, strict=True))
        common = np.isin(value, held_hot.value) if len(held_hot.value) else np.zeros(len(value), bool)
        order = np.lexsort((at, tie, doc, digest, value))
        value, digest, sides, doc, tie, at, size, common = (x[order] for x in (value, digest, sides, doc, tie, at, size, common))
        new = np.ones(len(value), bool)
        new[1:] = (value[1:] != value[:-1]) | (digest[1:] != digest[:-1])
        first = np.flatnonzero(new)
        least = np.repeat(doc[first], np.diff(np.r_[first, len(doc)]))
        sure = np.flatnonzero(doc > least)
        if len(sure):
            sure = sure[np.lexsort((at[sure], tie[sure], doc[sure]))]
            d, t, a = doc[sure], tie[sure], at[sure]
            run, upto = merged_runs(d, t, at=a, upto=a + size[sure])
            yield _batch([[int(value[0] % np.uint64(buckets))], [SPAN], [packed(d[run], t[run], a[run], upto)]], "bucket long, kind int, blob binary")
        rest = np.flatnonzero(doc == least)
        value, digest, sides, doc, tie, at, size, common = (x[rest] for x in (value, digest, sides, doc, tie, at, size, common))
        # Places of one context in one text that overlap are a run.
        run, last = merged_runs(value, digest, tie, at=at, upto=at + length)
        value, digest, sides, doc, tie, at, size, common = (x[run] for x in (value, digest, sides, doc, tie, at, size, common))
        for wide in (False, True):
            own = np.flatnonzero(common == wide)
            if not len(own):
                continue
            bucket = ((mix(value[own] ^ mix(digest[own])) if wide else value[own]) % np.uint64(buckets)).astype(np.int64)
            own = own[np.argsort(bucket, kind="stable")]
            bucket = np.sort(bucket)
            cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
            columns = [value.view(np.int64), digest.view(np.int64), sides.view(np.int64), doc, tie, at, last - length, size]
            blobs = [packed(*(c[own[a:z]] for c in columns)) for a, z in zip(cuts, np.r_[cuts[1:], len(bucket)], strict=True)]
            yield _batch([bucket[cuts], [ASK_WIDE if wide else ASK] * len(blobs), blobs], "bucket long, kind int, blob binary")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, n = [], 0
        for batch in batches:
            ids, ties = batch.column("doc").to_numpy(), batch.column("tie").to_numpy()
            for row, data, offsets in byte_blocks(batch.column("data"), BLOCK):
                c = contexts_of(data, offsets, length)
                parts.append((c.hash, c.digest, c.sides, ids[row + c.text], ties[row + c.text], c.at, c.size))
                n += len(c.hash)
                if n >= FLUSH:
                    yield from sent(parts)
                    parts, n = [], 0
        if n:
            yield from sent(parts)

    return known.mapInArrow(scan, "bucket long, kind int, blob binary")


def met_contexts(rows: DataFrame, most: int = WIDE, parts: int | None = None) -> DataFrame:
    """FOUND rows of all buckets, dealt to ``parts`` tasks (by default as many as Spark chooses).

    Spans that are certain (SPAN, from at to last); the first occurrences of each
    context that agrees in a stretch with another of its anchor (ASK, with over
    ``most`` of them at an anchor ASK_WIDE: they begin from at to last), and whether
    there are more; those (HELD), in the smallest document of the context.
    """

    def settle(blobs: list[bytes], wide: bool) -> Iterator[pa.RecordBatch]:
        columns = [np.concatenate(x) for x in zip(*map(unpacked, blobs), strict=True)]
        if not wide:  # anchors that occur once meet nobody
            order = np.argsort(columns[0], kind="stable")
            value = columns[0][order]
            same = value[1:] == value[:-1]
            order = order[np.r_[False, same] | np.r_[same, False]]
            columns = [c[order] for c in columns]
        value, digest, sides, doc, tie, at, last, size = columns
        if not len(value):
            return
        order = np.lexsort((at, tie, doc, digest, value))
        value, digest, sides, doc, tie, at, last, size = (x[order] for x in (value, digest, sides, doc, tie, at, last, size))
        new_value = np.r_[True, value[1:] != value[:-1]]
        new = new_value | np.r_[True, digest[1:] != digest[:-1]]
        anchor, context = np.cumsum(new_value) - 1, np.cumsum(new) - 1
        least = doc[new]
        lowest = np.minimum.reduceat(doc, np.flatnonzero(new_value))

        def out(kind: int, rows: np.ndarray, *columns: np.ndarray | pa.Array) -> pa.RecordBatch:
            none = pa.nulls(len(rows), pa.int64())
            return _batch([np.full(len(rows), kind), *((none, none) if kind == SPAN else (value[rows], digest[rows])), doc[rows], tie[rows], at[rows], *columns], FOUND)

        sure = np.flatnonzero(doc > least[context])
        empty = lambda rows, kind: pa.nulls(len(rows), kind)
        yield out(SPAN, sure, (last + size)[sure], empty(sure, pa.int32()), empty(sure, pa.bool_()))
        taken = many = np.ones(len(value), bool)
        if not wide:
            shared = sharing(anchor[new], sides[new], least)
            taken, many = shared[context], (np.bincount(anchor[new], weights=shared) > most)[anchor]
        # What the smallest document of all shares is no repeat.
        other = taken & ~new & (doc == least[context]) & (wide | (doc > lowest[anchor]))
        more = np.bincount(context[other], minlength=len(least)) > 0
        for kind, own in ((ASK, np.flatnonzero(new & taken & ~many)), (ASK_WIDE, np.flatnonzero(new & taken & many)), (HELD, np.flatnonzero(other))):
            if len(own):
                yield out(kind, own, last[own], size[own], more[context[own]] if kind != HELD else empty(own, pa.bool_()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[bytes]] = {ASK: [], ASK_WIDE: []}
        now = None
        for batch in batches:
            for bucket, kind, blob in zip(batch.column("bucket").to_pylist(), batch.column("kind").to_pylist(), batch.column("blob"), strict=True):
                if bucket != now:
                    for k, blobs in held.items():
                        if blobs:
                            yield from settle(blobs, k == ASK_WIDE)
                    held, now = {ASK: [], ASK_WIDE: []}, bucket
                if kind == SPAN:
                    doc, tie, at, upto = unpacked(blob.as_py())
                    n = len(doc)
                    yield _batch([np.full(n, SPAN), *[pa.nulls(n, pa.int64())] * 2, doc, tie, at, upto, pa.nulls(n, pa.int32()), pa.nulls(n, pa.bool_())], FOUND)
                else:
                    held[kind].append(blob.as_py())
        for k, blobs in held.items():
            if blobs:
                yield from settle(blobs, k == ASK_WIDE)

    dealt = rows.repartition(parts, "bucket") if parts else rows.repartition("bucket")
    return dealt.sortWithinPartitions("bucket").mapInArrow(run, FOUND)


CONTEXT = "key long, low long, doc long, tie long, at int, last int, hash long, digest long, a int, more boolean, context binary"
REPEAT = "kind int, hash long, digest long, doc long, tie long, at int, upto int"


def _partitions(df: DataFrame) -> int:
    """Partitions of a shuffle by document; texts and what joins them take the same, so neither moves twice."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _asked(known: DataFrame, found: DataFrame) -> DataFrame:
    """(doc, tie, data, asks): documents with the contexts to cut from them."""
    n = _partitions(known)
    wide = (F.col("kind") == ASK_WIDE).alias("wide")
    asks = found.where(F.col("kind").isin(ASK, ASK_WIDE)).select("doc", "tie", F.struct("hash", "digest", "at", "last", "size", "more", wide).alias("ask"))
    asks = asks.repartition(n, "doc", "tie").groupBy("doc", "tie").agg(F.collect_list("ask").alias("asks"))
    return known.repartition(n, "doc", "tie").join(asks, ["doc", "tie"]).select("doc", "tie", "data", "asks")


def context_bytes(asked: DataFrame, length: int = LENGTH) -> DataFrame:
    """CONTEXT rows: contexts with their bytes, by anchor; of very common anchors their windows, by content."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, tie, data, asks in zip(batch.column("doc").to_pylist(), batch.column("tie").to_pylist(), batch.column("data"), batch.column("asks"), strict=True):
                whole, asks = data.as_buffer(), asks.values
                value, digest, at, last, size, wide = (asks.field(c).to_numpy(zero_copy_only=False) for c in ("hash", "digest", "at", "last", "size", "wide"))
                more = asks.field("more").to_numpy(zero_copy_only=False)
                own = np.flatnonzero(~wide)
                if len(own):
                    texts = [whole[a:z].to_pybytes() for a, z in zip(at[own].tolist(), (at + size)[own].tolist(), strict=True)]
                    n, zero = len(own), np.zeros(len(own), np.int64)
                    yield _batch([value[own], zero, np.full(n, doc), np.full(n, tie), at[own], last[own], value[own], digest[own], zero, more[own], texts], CONTEXT)
                for k in np.flatnonzero(wide).tolist():
                    n, a = int(size[k]) - length + 1, int(at[k])
                    keys = np.frombuffer(b"".join(xxhash.xxh3_128_digest(whole[a + i : a + i + length]) for i in range(n)), np.int64).reshape(n, 2)
                    shift = np.arange(n)
                    yield _batch([keys[:, 0], keys[:, 1], np.full(n, doc), np.full(n, tie), a + shift, int(last[k]) + shift, np.full(n, value[k]), np.full(n, digest[k]), shift, np.full(n, more[k]), pa.nulls(n, pa.binary())], CONTEXT)

    return asked.mapInArrow(cut, CONTEXT)


def repeated_in_contexts(contexts: DataFrame, length: int = LENGTH) -> DataFrame:
    """REPEAT rows: spans (SPAN: doc, tie, at, upto) that a smaller document shares.

    Of contexts with more occurrences also the stretch itself (HELD: hash, digest,
    from at to upto).
    """

    def told(rows: dict[str, np.ndarray], who: np.ndarray, a: np.ndarray, z: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Stretches a to z of the contexts in rows ``who``."""
        if not len(who):
            return
        n, more = pa.nulls(len(who), pa.int64()), np.flatnonzero(rows["more"][who])
        yield _batch([np.full(len(who), SPAN), n, n, rows["doc"][who], rows["tie"][who], rows["at"][who] + a, rows["last"][who] + z], REPEAT)
        if len(more):
            n, own = pa.nulls(len(more), pa.int64()), who[more]
            yield _batch([np.full(len(more), HELD), rows["hash"][own], rows["digest"][own], n, n, a[more], z[more]], REPEAT)

    names = ("key", "low", "doc", "tie", "at", "last", "hash", "digest", "a", "more")

    def settle(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(parts)
        rows = {c: table.column(c).to_numpy() for c in names}
        once = np.unique(np.stack([rows["hash"], rows["digest"]]), axis=1, return_index=True)[1]  # a document may be there twice
        who, a, z = repeated_parts(table.column("context").take(pa.array(once)).to_pylist(), rows["doc"][once], length)
        yield from told(rows, once[who], a, z)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[pa.RecordBatch] = []
        size, last = 0, None
        window: tuple[int, int] | None = None  # the open group of windows, and its smallest document
        smallest = 0
        for batch in batches:
            windows = batch.column("context").is_null()
            wide = batch.filter(windows)
            if wide.num_rows:
                rows = {c: wide.column(c).to_numpy(zero_copy_only=False) for c in names}
                key, low, doc = rows["key"], rows["low"], rows["doc"]
                new = np.ones(len(key), bool)
                new[1:] = (key[1:] != key[:-1]) | (low[1:] != low[:-1])
                new[0] = (key[0], low[0]) != window
                first = np.flatnonzero(new)
                least = np.r_[smallest, doc[first]][np.cumsum(new)]
                who = np.flatnonzero(doc > least)
                yield from of_windows(rows, who)
                window, smallest = (key[-1], low[-1]), int(least[-1])
            rest = batch.filter(pc.invert(windows))
            if not rest.num_rows:
                continue
            key = rest.column("key").to_numpy()
            cuts = np.flatnonzero(key[1:] != key[:-1]) + 1
            if key[0] != last and size >= CHUNK:
                yield from settle(parts)
                parts, size = [], 0
            for a, z in zip(np.r_[0, cuts].tolist(), np.r_[cuts, len(key)].tolist(), strict=True):
                if a and size >= CHUNK:
                    yield from settle(parts)
                    parts, size = [], 0
                parts.append(rest.slice(a, z - a))
                size += 80 * (z - a)
            last = key[-1]
        if parts:
            yield from settle(parts)

    def of_windows(rows: dict[str, np.ndarray], who: np.ndarray) -> Iterator[pa.RecordBatch]:
        """As ``told`` for windows, whose stretch starts at their shift in the context."""
        n, more = pa.nulls(len(who), pa.int64()), who[rows["more"][who]]
        yield _batch([np.full(len(who), SPAN), n, n, rows["doc"][who], rows["tie"][who], rows["at"][who], rows["last"][who] + length], REPEAT)
        n = pa.nulls(len(more), pa.int64())
        yield _batch([np.full(len(more), HELD), rows["hash"][more], rows["digest"][more], n, n, rows["a"][more], rows["a"][more] + length], REPEAT)

    return contexts.repartition("key", "low").sortWithinPartitions("key", "low", "doc", "digest").mapInArrow(run, REPEAT)


def merged_spans(spans: DataFrame) -> DataFrame:
    """(doc, tie, spans) of (doc, tie, at, upto): touching stretches are one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("spans")
            row = np.repeat(np.arange(batch.num_rows), np.diff(np.asarray(lists.offsets)))
            flat = lists.flatten()
            at, upto = (flat.field(c).to_numpy().astype(np.int64) for c in ("at", "upto"))
            order = np.lexsort((at, row))
            row, at = row[order], at[order]
            span = np.int64(1 << 32)
            first, ends = merged_runs(row, at=row * span + at, upto=np.maximum.accumulate(row * span + upto[order]))
            cut = np.searchsorted(row[first], np.arange(batch.num_rows + 1))
            made = pa.StructArray.from_arrays([pa.array(at[first], pa.int32()), pa.array(ends - row[first] * span, pa.int32())], names=["at", "upto"])
            yield pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("tie"), pa.ListArray.from_arrays(pa.array(cut, pa.int32()), made)], names=["doc", "tie", "spans"])

    grouped = spans.groupBy("doc", "tie").agg(F.collect_set(F.struct("at", "upto")).alias("spans"))
    return grouped.mapInArrow(run, "doc long, tie long, spans array<struct<at: int, upto: int>>")


def removed_spans(known: DataFrame, length: int = LENGTH, wide: int = WIDE) -> DataFrame:
    """(doc, tie, spans): of each document (doc, tie, data) that loses bytes, its stretches to remove."""
    spark = known.sparkSession
    total = known.agg(F.sum(F.octet_length("data"))).first()[0] or 0
    expected = 2 * total // (length - KMER + 2)
    buckets = max(2 * _partitions(known), expected // BUCKET)
    parts = buckets // 2 if buckets > 2 * _partitions(known) else None  # a task takes two buckets, however large the corpus
    hot = common_anchors(known, max(SAMPLE_EVERY, total // SAMPLE_BYTES), length, wide)
    count = lambda *kinds: F.count_if(F.col("kind").isin(*kinds))
    met = Written(met_contexts(context_rows(known, buckets, hot, length), wide, parts), "contexts-met", asks=count(ASK, ASK_WIDE), held=count(HELD))
    let_go(spark)
    found, repeats = met.read(), None
    spans = found.where(F.col("kind") == SPAN).select("doc", "tie", "at", F.col("last").alias("upto"))
    if met.taken["asks"]:
        repeats = Written(repeated_in_contexts(context_bytes(_asked(known, found), length), length), "repeats", parts=count(HELD))
        let_go(spark)
        told = repeats.read()
        spans = spans.union(told.where(F.col("kind") == SPAN).select("doc", "tie", "at", "upto"))
        if met.taken["held"] and repeats.taken["parts"]:
            parts = told.where(F.col("kind") == HELD).select("hash", "digest", F.col("at").alias("a"), F.col("upto").alias("z"))
            held = found.where(F.col("kind") == HELD).select("hash", "digest", "doc", "tie", "at", "last").join(parts, ["hash", "digest"])
            spans = spans.union(held.select("doc", "tie", F.col("at") + F.col("a"), F.col("last") + F.col("z")))
    spans = materialise(merged_spans(spans), "repeated-spans")
    for table in (met, repeats):
        if table:
            table.delete()
    let_go(spark)
    return spans


def deduplicate(docs: DataFrame, length: int = LENGTH, keep_text: bool = True, wide: int = WIDE) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if asked, kept (binary).

    Strings are judged on the input, whatever else goes. A null text is empty. A
    null id stands above all others, and equal ids are not smaller than each
    other, so rows that share one lose nothing to each other; repeated rows lose
    the same. Texts of any length are taken whole, in pieces that overlap. Cuts may
    fall inside a character: ``kept`` is bytes. Only doc_id and text are read, so
    other columns cannot clash. An empty table gives no rows.
    """
    kind = dict(docs.dtypes)["doc_id"]
    known = _known(docs)
    ident = spare("doc_id", known)
    known = known.withColumn(ident, F.when(F.col("doc") < LAST, F.col("doc")).cast(kind))
    n = _partitions(known)
    spans = removed_spans(known.drop(ident), length, wide).repartition(n, "doc", "tie")
    joined = known.repartition(n, "doc", "tie").join(spans, ["doc", "tie"], "left").select(ident, "data", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for data, spans in zip(batch.column("data"), batch.column("spans"), strict=True):
                data, kept, at, runs, gone = data.as_py(), [], 0, 0, 0
                edge = -1
                for s in spans.as_py() or ():
                    a, z = s["at"], s["upto"]
                    if a > edge:
                        runs += 1
                    if a > at:
                        kept.append(data[at:a])
                    gone += max(0, z - max(a, at))
                    at, edge = max(at, z), max(edge, z)
                rest = b"".join(kept) + data[at:]
                for c, v in zip(out, (len(data), gone, runs, hashlib.sha256(rest).hexdigest(), rest), strict=True):
                    c.append(v)
            columns = [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in out[:3]), pa.array(out[3], pa.string())]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(out[4], pa.binary())] * keep_text, names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * keep_text)

    schema = f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * keep_text
    return joined.mapInArrow(run, schema)


PLACE = "hash long, digest long, doc long, tie long, at int, size int"
PART = "hash long, digest long, a int, depth int, key long, low long"
PREFIX = PART + ", before int, after int, times int"


def context_places(known: DataFrame, length: int = LENGTH) -> DataFrame:
    """PLACE rows: every context of every document, where it begins."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, ties = batch.column("doc").to_numpy(), batch.column("tie").to_numpy()
            for row, data, offsets in byte_blocks(batch.column("data"), BLOCK):
                c = contexts_of(data, offsets, length)
                yield _batch([c.hash.view(np.int64), c.digest.view(np.int64), ids[row + c.text], ties[row + c.text], c.at, c.size], PLACE)

    return known.mapInArrow(scan, PLACE)


def _named(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of each string, as two columns."""
    keys = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, texts)), np.int64).reshape(-1, 2)
    return keys[:, 0], keys[:, 1]


def _scanned_parts(cut: DataFrame, length: int) -> DataFrame:
    """PART rows of contexts (hash, digest, times, context), an anchor's in one task, by the stack scan."""

    def settle(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        value, digest, times = (rows.column(c).to_numpy() for c in ("hash", "digest", "times"))
        once = np.unique(np.stack([value, digest]), axis=1, return_index=True)[1]  # rows alike are cut twice
        texts = rows.column("context").take(pa.array(once)).to_pylist()
        # What occurs more than once stands there twice, so it is an interval like any other.
        twice = np.repeat(np.arange(len(once)), times[once])
        contexts = [texts[i] for i in twice]
        owner, place, _, lcp = suffix_array(contexts, length)
        before = bytes_before(contexts, owner, place)
        who, at, depth = [], [], []
        for common, first, end in maximal_repeats(lcp, before, length):
            met = np.unique(np.stack([twice[owner[first:end]], place[first:end]]), axis=1)
            who.append(met[0])
            at.append(met[1])
            depth.append(np.full(met.shape[1], common))
        if who:
            who, at, depth = np.concatenate(who), np.concatenate(at), np.concatenate(depth)
            key, low = _named([texts[w][a : a + d] for w, a, d in zip(who.tolist(), at.tolist(), depth.tolist(), strict=True)])
            yield _batch([value[once[who]], digest[once[who]], at, depth, key, low], PART)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[pa.RecordBatch] = []
        size, last = 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            value = batch.column("hash").to_numpy()
            cuts = np.flatnonzero(value[1:] != value[:-1]) + 1
            for a, z in zip(np.r_[0, cuts].tolist(), np.r_[cuts, len(value)].tolist(), strict=True):
                if size >= CHUNK and value[a] != last:
                    yield from settle(pa.Table.from_batches(parts))
                    parts, size = [], 0
                parts.append(batch.slice(a, z - a))
                size += 80 * (z - a)
                last = value[a]
        if parts:
            yield from settle(pa.Table.from_batches(parts))

    return cut.repartition("hash").sortWithinPartitions("hash").mapInArrow(run, PART)


def _counted_parts(cut: DataFrame, length: int) -> DataFrame:
    """PART rows as ``_scanned_parts``, of anchors too common for a task: every level of the tree is a grouped count."""

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for value, digest, times, context in zip(*(batch.column(c).to_pylist() for c in ("hash", "digest", "times", "context")), strict=True):
                n = len(context)
                a, z = (np.concatenate(x) for x in zip(*((np.full(n - length + 1 - p, p), np.arange(p + length, n + 1)) for p in range(n - length + 1)), strict=True))
                key, low = _named([context[p:q] for p, q in zip(a.tolist(), z.tolist(), strict=True)])
                byte = np.frombuffer(b"\0" + context + b"\0", np.uint8).astype(np.int32)
                before, after = np.where(a > 0, byte[a], -1), np.where(z < n, byte[z + 1], -1)
                yield _batch([np.full(len(a), value), np.full(len(a), digest), a, z - a, key, low, before, after, np.full(len(a), times)], PREFIX)

    every = materialise(cut.dropDuplicates(["hash", "digest"]).mapInArrow(prefixes, PREFIX), "prefixes")
    group = every.groupBy("key", "low").agg(F.sum("times").alias("n"), *(f(c).alias(f"{f.__name__}_{c}") for c in ("before", "after") for f in (F.min, F.max)))
    # An end of a context differs from every other.
    diverse = lambda c: (F.col(f"min_{c}") < 0) | (F.col(f"min_{c}") < F.col(f"max_{c}"))
    found = materialise(group.where((F.col("n") > 1) & diverse("before") & diverse("after")).select("key", "low", "n"), "repeats-counted")
    return join_back(every, found, ["key", "low"], "n").select("hash", "digest", "a", "depth", "key", "low")


def repeat_groups(docs: DataFrame, length: int = LENGTH, wide: int = WIDE) -> DataFrame:
    """(repeat, size, doc_id, at): the maximal repeats of the corpus's contexts, each with every occurrence.

    ``repeat`` names the string (32 hex digits of a hash), ``size`` is its length of at
    least ``length`` bytes, ``at`` the byte where it begins. A repeat is maximal
    within contexts, whose ends count as different from everything: two occurrences
    at least, which cannot all be extended by one byte on a side without leaving
    theirs. So a long passage is a chain of repeats of up to ``2 * length - KMER``
    bytes that overlap, and every window of ``length`` bytes that the corpus holds
    twice, in one document or several, lies in one of them.

    An anchor's contexts are scanned in one task where they are up to ``wide``, each
    text once and those that occur again twice; of commoner anchors every prefix of
    every suffix is counted by itself, whatever task it is in. Null texts are empty, null
    ids stay null. Repeated rows are occurrences each. Texts are read whole; only doc_id
    and text are read, so other columns cannot clash. An empty table gives no rows.
    """
    kind, known = dict(docs.dtypes)["doc_id"], _known(docs)
    places = materialise(context_places(known, length), "context-places")
    distinct = places.groupBy("hash", "digest").agg(F.count("*").alias("n"), F.min(F.struct("doc", "tie", "at", "size")).alias("one"))
    distinct = materialise(distinct, "distinct-contexts")
    anchor = distinct.groupBy("hash").agg(F.count("*").alias("n_contexts"), F.sum("n").alias("places"))
    anchor = materialise(anchor.where("places > 1").select("hash", "n_contexts", (F.col("n_contexts") > wide).alias("common")), "met-anchors")
    met = join_back(distinct, anchor, ["hash"], "n_contexts")
    # A context is asked for as ``deduplicate`` does; ``last`` carries whether it occurs once or more.
    asks = met.select(F.lit(ASK).alias("kind"), "hash", "digest", "one.*", F.least("n", F.lit(2)).cast("int").alias("last"), F.col("common").alias("more"))
    cut = context_bytes(_asked(known, asks), length).select("hash", "digest", F.col("last").alias("times"), F.col("more").alias("common"), "context")
    cut = materialise(cut, "context-bytes")
    parts = _scanned_parts(cut.where("NOT common"), length).unionByName(_counted_parts(cut.where("common"), length))
    of_context = parts.groupBy("hash", "digest").agg(F.collect_list(F.struct("a", "depth", "key", "low")).alias("parts"))  # a context has few substrings
    of_context = materialise(of_context.join(distinct.select("hash", "digest", "n"), ["hash", "digest"]), "repeated-parts")
    found = join_back(places, of_context, ["hash", "digest"], "n").select("doc", "at", F.inline("parts"))
    return found.select(
        F.lower(F.concat(F.lpad(F.hex("key"), 16, "0"), F.lpad(F.hex("low"), 16, "0"))).alias("repeat"),
        F.col("depth").alias("size"),
        F.when(F.col("doc") < LAST, F.col("doc")).cast(kind).alias("doc_id"),
        (F.col("at") + F.col("a")).alias("at"),
    )
