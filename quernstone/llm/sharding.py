"""Reproducible shuffling and sharding by a Feistel permutation.

Every row gets a global row number in a total order of stated columns. A keyed
Feistel network over the smallest even number of bits that holds the row count,
with cycle walking back into the range, permutes these numbers. Shard and slot
follow from the permuted number ``p`` alone: ``shard = p mod n``,
``slot = p div n``. So shard sizes differ by one row at most, slots have no gap,
and anyone who knows the row count and the seed can compute where a row lies.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType

from quernstone.session import materialise

ROUNDS = 8


def _mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of SplitMix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _once(x: np.ndarray, half: int, keys: np.ndarray, backwards: bool) -> np.ndarray:
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)
    left, right = x >> shift, x & mask
    for key in keys[::-1] if backwards else keys:
        if backwards:
            left, right = right ^ (_mix(left + key) & mask), left
        else:
            left, right = right, left ^ (_mix(right + key) & mask)
    return (left << shift) | right


def permute(rows: np.ndarray, n: int, seed: int = 0, backwards: bool = False) -> np.ndarray:
    """The image of each row number in [0, n) under the keyed permutation of [0, n).

    ``backwards`` gives the inverse. Cycle walking: an image outside [0, n) is
    permuted again until it falls inside; the domain has under 4n values, so
    that takes under four steps on average.
    """
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    keys = _mix(np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))
    out = _once(np.asarray(rows, dtype=np.uint64), half, keys, backwards)
    while (far := out >= n).any():
        out[far] = _once(out[far], half, keys, backwards)
    return out.astype(np.int64)


def number_rows(df: DataFrame, order: list[str], into: str = "global_row") -> tuple[DataFrame, int]:
    """``df`` with gapless global row numbers in the order of ``order``; the row count.

    A range sort, written once so that both readers see the same partitions,
    then one count per partition on the driver; the numbers depend on the order
    only, not on where the range bounds fall. Rows equal in all order columns
    are interchangeable. Nulls come first. An empty table gives no rows and 0.
    """
    parted = (
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(into, F.monotonically_increasing_id())
    )
    parted = materialise(parted, "numbered")
    part = F.shiftright(into, 33)
    counts = {r[0]: r[1] for r in parted.groupBy(part.alias("p")).count().collect()}
    starts, total = {}, 0
    for p in sorted(counts):
        starts[p] = total
        total += counts[p]

    @F.pandas_udf(LongType())
    def start_of(p: pd.Series) -> pd.Series:
        return p.map(starts).astype("int64")

    return parted.withColumn(into, start_of(part) + F.col(into).bitwiseAND((1 << 33) - 1)), total


def shard_rows(df: DataFrame, order: list[str], n_shards: int, seed: int = 0) -> DataFrame:
    """``df`` with ``global_row``, ``shuffled_row``, ``shard`` and ``slot``.

    Give ``df`` only the columns that identify a row: it is written once in the
    shared folder. Columns of these four names are replaced. Any values, nulls
    included, may stand in the order columns.
    """
    if n_shards < 1:
        raise ValueError("n_shards must be at least 1")
    made = ("global_row", "shuffled_row", "shard", "slot")
    numbered, total = number_rows(df.drop(*(c for c in made if c not in order)), order)

    @F.pandas_udf(LongType())
    def shuffled(rows: pd.Series) -> pd.Series:
        return pd.Series(permute(rows.to_numpy(), total, seed))

    out = numbered.withColumn("shuffled_row", shuffled("global_row"))
    return out.withColumn("shard", (F.col("shuffled_row") % n_shards).cast(IntegerType())).withColumn(
        "slot", F.expr(f"shuffled_row div {n_shards}")
    )


def shard_documents(docs: DataFrame, n_shards: int = 8, seed: int = 20) -> DataFrame:
    """Shard and slot of every document under the law of equal row counts.

    Returns doc_id, size (UTF-8 bytes of the text plus 1; a null text has none),
    text_crc32 (of the UTF-8 bytes, unsigned; 0 for an empty or null text), law
    (always ``rows``), shard, slot, grown_shard (null under this law) and
    global_row. Equal texts are rows like any other under this law. Repeated and
    null ids are ordered by size, then by two hashes of the text. Texts are measured and
    hashed whole where they are, however long. Only doc_id and text are read, so
    other columns cannot clash. An empty table gives no rows.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    slim = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("text_hash"),
    )
    out = shard_rows(slim, ["doc_id", "size", "text_crc32", "text_hash"], n_shards, seed)
    return out.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "global_row",
    )
