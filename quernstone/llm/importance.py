"""Target-distribution importance resampling by an external sort-count.

Texts become streams of hashed features: every word and every pair of neighbours,
by the CRC-32 of its bytes modulo the number of buckets. The streams of a run of
documents are written as one packed row of 16-bit numbers with the documents'
sizes. Counts come from the written streams, each sorted and run-length encoded,
summed within a task and then over tasks. A bucket's gain is the logarithm of its
share in the target over its share in the corpus. A second pass over the streams,
not over the texts, gathers the gains and sums them by document. With Gumbel
noise from a hash of the id, the highest scores are a draw without replacement
in proportion to the weights.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernstone.llm.sharding import number_rows
from quernstone.llm.tokens import byte_blocks
from quernstone.session import materialise

#: Word bytes lower-cased, all others a space.
_FOLD = bytes(ord(chr(b).lower()) if b < 0x80 and chr(b).isalnum() else b if b >= 0x80 else 0x20 for b in range(256))


@dataclass(frozen=True)
class Config:
    """Buckets (65,536 at most), features a row of streams, share drawn, least words, the seed of the noise."""

    buckets: int = 10_000
    block: int = 1 << 22
    percent: int = 25
    least_words: int = 20
    seed: int = 7

    def __post_init__(self) -> None:
        if not 0 < self.buckets <= 1 << 16:
            raise ValueError("buckets are numbered by 16 bits")


def pieces(text: bytes, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words of a text, in runs of about ``size`` bytes that end between words."""
    at = 0
    while at < len(text):
        end = at + size
        while end < len(text) and _FOLD[text[end]] != 0x20:
            end += 1
        yield text[at:end].translate(_FOLD).split()
        at = end


def stream(text: bytes, buckets: int) -> tuple[int, np.ndarray]:
    """The number of words, and the bucket of each word and pair of neighbours."""
    n, before, found = 0, None, []
    for words in pieces(text):
        if not words:
            continue
        single = list(map(zlib.crc32, words))
        firsts = single[:-1] if before is None else [before, *single[:-1]]
        pair = map(zlib.crc32, [b" " + w for w in (words[1:] if before is None else words)], firsts)
        found += [np.fromiter(single, np.uint32, len(single)), np.fromiter(pair, np.uint32, len(firsts))]
        n, before = n + len(words), single[-1]
    return n, (np.concatenate(found) % np.uint32(buckets)).astype(np.uint16) if found else np.zeros(0, np.uint16)


def feature_streams(docs: DataFrame, config: Config) -> DataFrame:
    """(block, ids, words, sizes, stream): packed bucket numbers of a run of documents.

    ``docs`` has the columns id and text. ``sizes`` are features a document, in the
    order of the stream; a text with more features than a block is a row of its own.
    """
    kind = dict(docs.dtypes)["id"]

    def row(block: int, ids: list[pa.Array], words: list[int], streams: list[np.ndarray]) -> pa.RecordBatch:
        held = pa.concat_arrays(ids)
        ends = pa.array([0, len(held)], pa.int32())
        sizes = pa.array([len(s) for s in streams], pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array([block], pa.int64()), pa.ListArray.from_arrays(ends, held), pa.ListArray.from_arrays(ends, pa.array(words, pa.int64())), pa.ListArray.from_arrays(ends, sizes), pa.array([np.concatenate(streams).astype("<u2").tobytes()], pa.binary())],
            names=["block", "ids", "words", "sizes", "stream"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        ids, words, streams, held = [], [], [], 0
        for batch in batches:
            for at, data, offsets in byte_blocks(batch.column("text")):
                for k in range(len(offsets) - 1):
                    n, made = stream(data[offsets[k] : offsets[k + 1]].tobytes(), config.buckets)
                    if held and held + len(made) > config.block:
                        yield row(block, ids, words, streams)
                        ids, words, streams, held, block = [], [], [], 0, block + 1
                    ids.append(batch.column("id").slice(at + k, 1))
                    words.append(n)
                    streams.append(made)
                    held += len(made)
        if ids:
            yield row(block, ids, words, streams)

    return docs.select("id", "text").mapInArrow(run, f"block long, ids array<{kind}>, words array<long>, sizes array<long>, stream binary")


def sort_count(packed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct numbers of a stream and how often each occurs: sorted, then run-length encoded."""
    ordered = np.sort(packed)
    starts = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1]))) if len(ordered) else np.zeros(0, np.int64)
    return ordered[starts], np.diff(np.append(starts, len(ordered)))


def bucket_counts(streams: DataFrame, config: Config) -> DataFrame:
    """(bucket, n): how many features of all streams fall into each bucket that has any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(config.buckets, np.int64)
        for batch in batches:
            for packed in batch.column("stream"):
                bucket, n = sort_count(np.frombuffer(packed.as_py(), "<u2"))
                total[bucket] += n
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["bucket", "n"])

    return streams.select("stream").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(corpus: DataFrame, target: DataFrame, config: Config) -> np.ndarray:
    """The gain of every bucket, in thousandths of a nat, from counts with one added to each."""
    spark = corpus.sparkSession
    both = spark.range(config.buckets).select(F.col("id").cast("int").alias("bucket"))
    both = both.join(corpus.withColumnRenamed("n", "s"), "bucket", "left").join(target.withColumnRenamed("n", "t"), "bucket", "left").na.fill(0)
    both = materialise(both, "bucket-counts")
    s_all, t_all = (float(x or 0) for x in both.agg(F.sum("s"), F.sum("t")).first())
    s, t = F.col("s").cast("double"), F.col("t").cast("double")
    gain = F.floor(1000 * F.log((t + 1) * (s_all + config.buckets) / ((s + 1) * (t_all + config.buckets))))
    # As many rows as there are buckets, whatever the corpus.
    rows = both.select("bucket", gain.cast("long").alias("gain")).toPandas()
    out = np.zeros(config.buckets, np.int64)
    out[rows["bucket"].to_numpy()] = rows["gain"].to_numpy()
    return out


def document_weights(streams: DataFrame, gains: np.ndarray) -> DataFrame:
    """(doc_id, n_words, n_features, weight, block, at): the floored mean gain of each document's features."""
    kind = dict(streams.dtypes)["ids"][len("array<") : -1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                held, words, sizes = (batch.column(c)[k].values for c in ("ids", "words", "sizes"))
                sizes = sizes.to_numpy()
                gathered = gains[np.frombuffer(batch.column("stream")[k].as_py(), "<u2")]
                weight, some = np.zeros(len(sizes), np.int64), np.flatnonzero(sizes)
                if len(some):
                    weight[some] = np.add.reduceat(gathered, (np.cumsum(sizes) - sizes)[some]) // sizes[some]
                block = np.full(len(sizes), batch.column("block")[k].as_py(), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [held, words, pa.array(sizes), pa.array(weight), pa.array(block), pa.array(np.arange(len(sizes)))],
                    names=["doc_id", "n_words", "n_features", "weight", "block", "at"],
                )

    return streams.mapInArrow(run, f"doc_id {kind}, n_words long, n_features long, weight long, block long, at long")


def resample(docs: DataFrame, target: DataFrame, config: Config = Config()) -> DataFrame:  # noqa: B008
    """Per row of ``docs``: doc_id, n_words, n_features, weight, score, rank, all long.

    ``docs`` has doc_id and text, ``target`` text; other columns are not read, so
    none can clash. Drawn are the highest ``percent`` of a hundred (floored) of the
    rows with ``least_words`` words, ranked from 1; others have rank null. Equal
    scores go to the smaller doc_id; a null doc_id comes last and has the noise of
    an empty one, rows of one id are ordered by weight, features and place. Repeated
    rows are counted and drawn each. A null or empty text has no features and weight
    0. Long texts are read whole, in pieces. An empty target gives the corpus's
    own rare buckets the higher gains; an empty table gives no rows.
    """
    streams = materialise(feature_streams(docs.select(F.col("doc_id").alias("id"), "text"), config), "feature-streams")
    wanted = materialise(feature_streams(target.select(F.lit(None).cast("long").alias("id"), "text"), config), "target-streams")
    gains = bucket_gains(bucket_counts(streams, config), bucket_counts(wanted, config), config)
    name = F.concat(F.lit(f"{config.seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296)))
    scored = document_weights(streams, gains).withColumn("score", F.col("weight") + noise.cast("long"))
    scored = materialise(scored.withColumn("down", -F.col("score")).withColumn("none", F.col("doc_id").isNull()), "importance")
    numbered, n = number_rows(scored.where(F.col("n_words") >= config.least_words), ["down", "none", "doc_id", "weight", "n_features", "block", "at"])
    drawn = F.when(F.col("global_row") < config.percent * n // 100, F.col("global_row") + 1)
    columns = ["doc_id", "n_words", "n_features", "weight", "score"]
    rest = scored.where(F.col("n_words") < config.least_words).select(*columns, F.lit(None).cast("long").alias("rank"))
    return numbered.select(*columns, drawn.alias("rank")).unionByName(rest)
