"""Cross-entropy difference scoring with matched target and background models.

Two bigram models of one shape share one vocabulary: the background over all
documents, the target over those labelled good. Both interpolate bigram and
unigram estimates alike, so per-token losses can be compared; a document's score
is the mean over its tokens of target loss minus background loss (lower: more
like the target). A document's own counts are taken out of both models before it
is scored, so documents that were counted are not favoured.

Every word and every (context, word) of the corpus has its own count, under a key
of 63 bits; nothing is dropped or shared, and the tables grow with the corpus.
Documents are held in blocks of bounded size. Each block sends its distinct keys,
counted, to buckets of the key space; a bucket adds them up and answers each block
with the sums of its keys, in the block's own order. A common pair is one entry a
block, so no bucket is hot, and no table is held whole anywhere.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernstone.llm.tokens import mix, word_blocks
from quernstone.session import materialise

_ODD = np.uint64(0xD6E8FEB86659FD93)
#: The key of a start; keys of words are odd, those of pairs even.
_START = np.uint64(0)


@dataclass(frozen=True)
class Config:
    """Interpolation weight, smoothing, tokens a block, keys a bucket, and least buckets (as a power of two).

    ``words`` and ``pairs`` fold the vocabulary and the pairs to so many places; 0
    keeps all apart, and the vocabulary is then as large as the corpus makes it.
    """

    words: int = 0
    pairs: int = 0
    weight: float = 0.6
    alpha: float = 0.1
    block: int = 1 << 20
    bucket: int = 1 << 21
    least_bits: int = 8


def pair_places(words: np.ndarray, first: np.ndarray, config: Config) -> tuple[np.ndarray, np.ndarray]:
    """Each token's context (``config.words`` at a start) and the number of its pair."""
    context = np.empty_like(words)
    if len(words):
        context[1:] = words[:-1]
        context[first[first < len(words)]] = config.words
    if config.pairs:
        pair = mix(context.astype(np.uint64) * np.uint64(config.words) + words.astype(np.uint64)) % np.uint64(config.pairs)
        return context, pair.astype(np.int64)
    return context, mix(context.astype(np.uint64) * _ODD + words.astype(np.uint64))


def _keys(words: np.ndarray, first: np.ndarray, config: Config) -> tuple[np.ndarray, np.ndarray]:
    """Keys of each token's word and of its pair."""
    _, pair = pair_places(words, first, config)
    even = ~np.uint64(1)
    return mix(words.astype(np.uint64)) | np.uint64(1), np.maximum(mix(pair.astype(np.uint64)) & even, np.uint64(2))


def _pack(numbers: np.ndarray) -> bytes:
    """Integers as compressed planes of bytes."""
    planes = np.ascontiguousarray(np.ascontiguousarray(numbers).view(np.uint8).reshape(len(numbers), numbers.itemsize).T)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _unpack(packed: bytes, n: int, dtype: type) -> np.ndarray:
    item = np.dtype(dtype).itemsize
    raw = pa.decompress(packed, n * item, codec="zstd", asbytes=True) if n else b""
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(item, n).T).reshape(-1).view(dtype)


@dataclass
class Block:
    """Words of a run of documents: ``sizes`` tokens each, and ``target``."""

    words: np.ndarray
    sizes: np.ndarray
    target: np.ndarray

    def __post_init__(self) -> None:
        self.row = np.repeat(np.arange(len(self.sizes)), self.sizes)
        self.first = (np.cumsum(self.sizes) - self.sizes)[self.sizes > 0]

    def places(self, config: Config) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The distinct keys in order, and each token's place among them, of its word and of its pair."""
        word, pair = _keys(self.words, self.first, config)
        keys, at = np.unique(np.concatenate(([_START], word, pair)), return_inverse=True)
        n = len(word)
        return keys, at[1 : n + 1], at[n + 1 :]

    def counts(self, config: Config) -> tuple[np.ndarray, np.ndarray]:
        """The distinct keys and their counts: row 0 background, row 1 target."""
        keys, word, pair = self.places(config)
        good = self.target[self.row]
        out = np.zeros((2, len(keys)), dtype=np.int64)
        for m, own in ((0, slice(None)), (1, good)):
            out[m] = np.bincount(word[own], minlength=len(keys)) + np.bincount(pair[own], minlength=len(keys))
        out[:, 0] = len(self.first), int(self.target[self.row[self.first]].sum())
        return keys, out

    def losses(self, table: np.ndarray, totals: tuple[float, float, float], config: Config) -> np.ndarray:
        """Mean loss of each document (nats) under both models, its own counts left out.

        ``table`` has both models' counts of the distinct keys; ``totals`` the size
        of the vocabulary and the tokens of each model.
        """
        c, n_docs = config, len(self.sizes)
        keys, word_at, pair_at = self.places(config)
        before_at = np.zeros_like(word_at)
        if len(word_at):
            before_at[1:] = word_at[:-1]
            before_at[self.first] = 0
        own = []
        for at in (word_at, pair_at):
            _, same, n = np.unique(self.row * np.int64(len(keys)) + at, return_inverse=True, return_counts=True)
            own.append(n[same])
        # A context counts as often as its word does, a start once.
        before_own = np.where(before_at == 0, 1, np.roll(own[0], 1)) if len(word_at) else own[0]
        out = np.zeros((2, n_docs))
        for m in (0, 1):
            inside = np.ones(len(word_at)) if m == 0 else self.target[self.row].astype(float)
            total = totals[1 + m] - inside * self.sizes[self.row]
            word = table[m][word_at] - inside * own[0]
            before = table[m][before_at] - inside * before_own
            both = table[m][pair_at] - inside * own[1]
            unigram = (word + c.alpha) / (total + c.alpha * totals[0])
            share = np.where(before > 0, both / np.maximum(before, 1), 0)
            if c.pairs:  # places that several pairs share
                share = np.minimum(share, 1)
            weight = np.where(before > 0, c.weight, 0)
            out[m] = np.bincount(self.row, -np.log(weight * share + (1 - weight) * unigram), minlength=n_docs)
        return out / np.maximum(self.sizes, 1)


def word_table(docs: DataFrame, config: Config) -> DataFrame:
    """(block, docs, sizes, vocabulary, codes): the words of whole texts, in runs of documents.

    A text longer than a block makes a run of its own.
    """
    kind = dict(docs.dtypes)["doc_id"]

    def row(block: int, ids: list[pa.Array], sizes: list[np.ndarray], words: list[np.ndarray]) -> pa.RecordBatch:
        vocabulary, codes, n = np.unique(np.concatenate(words), return_inverse=True, return_counts=True)
        order = np.argsort(-n, kind="stable")  # frequent words get small codes
        rank = np.empty(len(order), np.uint32)
        rank[order] = np.arange(len(order), dtype=np.uint32)
        size = np.concatenate(sizes).astype(np.int32)
        held = pa.concat_arrays(ids)
        return pa.RecordBatch.from_arrays(
            [pa.array([block], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(held)], pa.int32()), held), pa.ListArray.from_arrays(pa.array([0, len(size)], pa.int32()), pa.array(size)),
             pa.array([vocabulary[order].tobytes()], pa.binary()), pa.array([_pack(rank[codes])], pa.binary())],
            names=["block", "docs", "sizes", "vocabulary", "codes"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        ids, sizes, words, n = [], [], [], 0
        for batch in batches:
            for at, w in word_blocks(batch.column("text")):
                hashes = w.hashes % np.uint64(config.words) if config.words else w.hashes
                size = np.bincount(w.text, minlength=w.n_texts)
                if n and n + len(hashes) > config.block:
                    yield row(block, ids, sizes, words)
                    ids, sizes, words, n, block = [], [], [], 0, block + 1
                ids.append(batch.column("doc_id").slice(at, w.n_texts))
                sizes.append(size)
                words.append(hashes)
                n += len(hashes)
        if ids:
            yield row(block, ids, sizes, words)

    return docs.select("doc_id", "text").mapInArrow(run, f"block long, docs array<{kind}>, sizes array<int>, vocabulary binary, codes binary")


def _block(rows: pa.Table, marks: pa.Table) -> Block:
    """The block of one row of a word table, with the target documents that ``marks`` names."""
    sizes = rows.column("sizes").chunk(0).flatten().to_numpy().astype(np.int64)
    vocabulary = np.frombuffer(rows.column("vocabulary")[0].as_py(), np.uint64)
    words = vocabulary[_unpack(rows.column("codes")[0].as_py(), int(sizes.sum()), np.uint32)]
    target = np.zeros(len(sizes), dtype=bool)
    for mark in marks.column("good"):
        if mark.is_valid:
            target[mark.as_py()] = True
    return Block(words, sizes, target)


def count_keys(words: DataFrame, marks: DataFrame, bits: int, config: Config) -> DataFrame:
    """(block, bucket, counts, vocabulary, tokens, good_tokens): the sums of each block's keys, over all blocks.

    A bucket is the keys that share their first ``bits`` bits. Its rows without a
    block hold how many distinct words it has and how often they occur.
    """

    def send(rows: pa.Table, marks: pa.Table) -> pa.Table:
        keys, counts = _block(rows, marks).counts(config)
        bucket = (keys >> np.uint64(64 - bits)).astype(np.int32)
        cut = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1], [True])))
        spans = list(zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True))
        return pa.table(
            {
                "bucket": pa.array(bucket[cut[:-1]]), "block": pa.array([rows.column("block")[0].as_py()] * len(spans), pa.int64()), "n": pa.array([z - a for a, z in spans], pa.int32()),
                "keys": pa.array([keys[a:z].tobytes() for a, z in spans], pa.binary()), "counts": pa.array([_pack(counts[:, a:z].reshape(-1)) for a, z in spans], pa.binary()),
            }
        )

    def add(rows: pa.Table) -> pa.Table:
        sizes = rows.column("n").to_numpy()
        keys = np.concatenate([np.frombuffer(k.as_py(), np.uint64) for k in rows.column("keys")])
        parts = [_unpack(c.as_py(), 2 * n, np.int64).reshape(2, n) for c, n in zip(rows.column("counts"), sizes.tolist(), strict=True)]
        distinct, at = np.unique(keys, return_inverse=True)
        del keys
        sums = np.stack([np.bincount(at, np.concatenate([p[m] for p in parts]), minlength=len(distinct)) for m in (0, 1)]).astype(np.int64)
        word = (distinct & np.uint64(1)).astype(bool)
        back, a = [], 0
        for n in sizes.tolist():
            back.append(_pack(sums[:, at[a : a + n]].reshape(-1)))
            a += n
        no = pa.nulls(len(sizes), pa.int64())
        join = lambda column, more: pa.concat_arrays([column, pa.array([more], column.type)])
        return pa.table(
            {
                "block": join(rows.column("block").combine_chunks(), None), "bucket": join(rows.column("bucket").combine_chunks(), int(rows.column("bucket")[0].as_py())), "counts": pa.array([*back, None], pa.binary()),
                "vocabulary": join(no, int(word.sum())), "tokens": join(no, int(sums[0, word].sum())), "good_tokens": join(no, int(sums[1, word].sum())),
            }
        )

    sent = words.groupBy("block").cogroup(marks.groupBy("block")).applyInArrow(send, "bucket int, block long, n int, keys binary, counts binary")
    return sent.groupBy("bucket").applyInArrow(add, "block long, bucket int, counts binary, vocabulary long, tokens long, good_tokens long")


def score_documents(docs: DataFrame, labels: DataFrame, config: Config = Config()) -> DataFrame:  # noqa: B008
    """Per row of ``docs``: doc_id, n_tokens, target_loss, background_loss, score.

    Losses are means per token in nats. A text without words (null, empty) has no
    tokens, losses null and score 0. The target is every document whose quality
    is 1 in ``labels`` (of several labels the largest counts; null ones do not).
    Without target documents the target model is uniform. Repeated rows are
    counted and scored each; an empty table gives no rows. Only doc_id and text are read,
    and doc_id and quality of ``labels``, so other columns cannot clash. Texts are
    taken whole; one longer than a block is a block of its own, which a task holds.
    """
    kind = dict(docs.dtypes)["doc_id"]
    words = materialise(word_table(docs, config), "words")
    good = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("quality").alias("quality")).where("quality = 1").select("doc_id")
    # Merged at every size, so that the plan does not change with the labels.
    found = words.select("block", F.posexplode("docs").alias("at", "doc_id")).join(good.hint("merge"), "doc_id")
    marks = materialise(found.groupBy("block").agg(F.collect_list("at").alias("good")), "target-documents")
    n_tokens = words.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, n: a + n))).first()[0] or 0
    bits = max(config.least_bits, int(np.ceil(np.log2(2 * n_tokens / config.bucket + 1))))
    counts = materialise(count_keys(words, marks, bits, config), "key-counts")
    vocabulary, *tokens = counts.agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in ("vocabulary", "tokens", "good_tokens"))).first()
    totals = (config.words or max(vocabulary, 1), *tokens)
    answers = counts.where("block IS NOT NULL").select("block", "bucket", "counts", F.lit(None).cast("array<int>").alias("good"))
    answers = answers.unionByName(marks.select("block", F.lit(-1).alias("bucket"), F.lit(None).cast("binary").alias("counts"), "good"))

    def run(rows: pa.Table, answers: pa.Table) -> pa.Table:
        block = _block(rows, answers)
        got = sorted((b, c) for b, c in zip(answers.column("bucket").to_pylist(), answers.column("counts").to_pylist(), strict=True) if c is not None)
        keys = block.places(config)[0]
        n = np.bincount((keys >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
        table = np.concatenate([_unpack(c, 2 * int(n[b]), np.int64).reshape(2, -1) for b, c in got], axis=1)
        mean = block.losses(table, totals, config)
        empty = block.sizes == 0
        return pa.table(
            {
                "doc_id": rows.column("docs").chunk(0).flatten(), "n_tokens": pa.array(block.sizes), "target_loss": pa.array(mean[1], mask=empty), "background_loss": pa.array(mean[0], mask=empty),
                "score": pa.array(np.where(empty, 0.0, mean[1] - mean[0])),
            }
        )

    return words.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, f"doc_id {kind}, n_tokens long, target_loss double, background_loss double, score double")
