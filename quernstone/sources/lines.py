"""Line files of any number of parts: line numbers, and an index of byte offsets.

The lines of a folder are those of its parts in the order of their paths, whatever
the sizes of the parts and however Spark packs them into tasks. The index has an
entry for about every megabyte: file, byte offset, first line and number of lines.
With it a few lines are read by seeking to the entries that hold them. Lines end at
\\n (a \\r before it goes); files are not compressed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Bytes of lines an entry of the index spans, and lines of a bucket by which entries and wanted lines meet.
STRIDE, BUCKET = 1 << 20, 1 << 10
ENTRY = "file string, offset long, bytes long, first long, lines long"


def _read(spark: SparkSession, path: str) -> DataFrame:
    """(value, file, block): lines as they are, with the split of a file that each comes from."""
    raw = spark.read.option("lineSep", "\n").text(path)
    return raw.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def _before(*columns: str) -> list[Column]:
    """Sums over the splits that come before; there is one row a split, some bytes for each 128 MB read."""
    w = Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)
    return [F.coalesce(F.sum(c).over(w), F.lit(0)).alias(f"{c}_before") for c in columns]


def numbered_lines(spark: SparkSession, path: str, blank: bool = True) -> DataFrame:
    """(line, value): the lines of a file or folder with their numbers from 0; without ``blank`` ones only others count.

    Spark's running number is in order within a split; the splits before are counted.
    """
    raw = _read(spark, path)
    raw = (raw if blank else raw.where(F.trim(F.regexp_replace("value", r"\s", " ")) != "")).withColumn("id", F.monotonically_increasing_id())
    splits = raw.groupBy("file", "block").agg(F.count("*").alias("n"), F.min("id").alias("least"))
    starts = splits.select("file", "block", "least", *_before("n"))
    # What is sent to every task is a row a split.
    line = F.col("n_before") + F.col("id") - F.col("least")
    return raw.join(F.broadcast(starts), ["file", "block"]).select(line.alias("line"), F.rtrim("value", F.lit("\r")).alias("value"))


def line_index(spark: SparkSession, path: str, stride: int = STRIDE) -> DataFrame:
    """ENTRY rows of a file or folder: where runs of about ``stride`` bytes begin. An empty file has none."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: tuple[str, int] | None = None
        entry = np.zeros(4, np.int64)  # place and lines of the open entry, counted from the split's start: offset, bytes, first, lines

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"file": [at[0]], "block": [at[1]], **{c: [int(x)] for c, x in zip(("offset", "bytes", "first", "lines"), entry, strict=True)}})

        for batch in batches:
            for file, block, size in zip(*(batch.column(c).to_pylist() for c in ("file", "block", "size")), strict=True):
                if (file, block) != at:
                    if entry[3]:
                        yield done()
                    at, entry = (file, block), np.zeros(4, np.int64)
                elif entry[1] >= stride:
                    yield done()
                    entry = np.array([entry[0] + entry[1], 0, entry[2] + entry[3], 0])
                entry[1] += size
                entry[3] += 1
        if entry[3]:
            yield done()

    sizes = _read(spark, path).select("file", "block", (F.octet_length("value") + 1).cast("long").alias("size"))
    entries = sizes.mapInArrow(cut, "file string, block long, offset long, bytes long, first long, lines long")
    splits = entries.groupBy("file", "block").agg(F.sum("bytes").alias("b"), F.sum("lines").alias("n"))
    # Offsets count within a file, lines over all files.
    own = F.coalesce(F.sum("b").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = splits.select("file", "block", own.alias("b_before"), *_before("n"))
    placed = entries.join(F.broadcast(starts), ["file", "block"])
    return placed.select("file", (F.col("offset") + F.col("b_before")).alias("offset"), "bytes", (F.col("first") + F.col("n_before")).alias("first"), "lines")


def _open(uri: str) -> tuple[pafs.FileSystem, str]:
    """The store of a file and the file's path there."""
    return pafs.FileSystem.from_uri(f"file://{uri.removeprefix('file:')}" if uri.startswith("file:/") and not uri.startswith("file://") else uri)


def _lines_of(entries: DataFrame) -> DataFrame:
    """(line, value) of ENTRY rows with ``wanted``, lines to give (null: all); reads the bytes of these entries only."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                system, name = _open(row["file"])
                with system.open_input_file(name) as file:
                    file.seek(row["offset"])
                    lines = file.read(row["bytes"]).split(b"\n")[: row["lines"]]
                numbers = range(row["first"], row["first"] + len(lines)) if row["wanted"] is None else sorted(set(row["wanted"]))
                values = [lines[n - row["first"]].rstrip(b"\r").decode("utf-8", "replace") for n in numbers]
                yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), pa.array(values, pa.string())], names=["line", "value"])

    return entries.repartition("file", "first").mapInArrow(read, "line long, value string")


def line_range(index: DataFrame, first: int, end: int | None = None) -> DataFrame:
    """(line, value) of the lines from ``first`` to before ``end``."""
    held = index.where(F.col("first") + F.col("lines") > first)
    inside = F.col("line") >= first
    if end is not None:
        held, inside = held.where(F.col("first") < end), inside & (F.col("line") < end)
    return _lines_of(held.withColumn("wanted", F.lit(None).cast("array<long>"))).where(inside)


def lines_at(index: DataFrame, wanted: DataFrame, column: str = "line") -> DataFrame:
    """(line, value) of the lines that ``wanted`` numbers in ``column``, each once.

    Numbers outside the file and nulls give no row. Entries and numbers meet by
    buckets of lines, so an entry is read once, whatever asks for it.
    """
    numbers = wanted.select(F.col(column).cast("long").alias("n")).where("n >= 0").distinct()
    buckets = F.sequence(F.expr(f"first div {BUCKET}"), F.expr(f"(first + lines - 1) div {BUCKET}"))
    spread = index.withColumn("bucket", F.explode(buckets))
    met = numbers.withColumn("bucket", F.expr(f"n div {BUCKET}")).join(spread, "bucket").where("n >= first AND n < first + lines")
    return _lines_of(met.groupBy("file", "offset", "bytes", "first", "lines").agg(F.collect_list("n").alias("wanted")))


def write_line_index(spark: SparkSession, path: str, out: str, stride: int = STRIDE) -> None:
    line_index(spark, path, stride).write.mode("overwrite").parquet(out)


def read_line_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ENTRY).parquet(path)
