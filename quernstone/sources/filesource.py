"""Files as a data source: ``spark.read.format("quernstone").load(folder)`` gives documents.

The plan knows names and sizes only. Files are dealt to partitions by their bytes, in
the order of their paths; options choose files by format, path and bytes before
anything is opened; each task opens the files of its partition and extracts
them. So no content is listed, shuffled or read twice. Stores are those of Arrow's
file systems; ``sources.extract.extract_files`` does the same through Spark's own
reader, for stores that only Spark knows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from quernstone.sources.extract import EXTRACTED, extracted, format_of

#: Bytes of a partition, what opening a file counts as, bytes and files of an Arrow batch.
PARTITION_BYTES, OPEN_BYTES, BATCH_BYTES, BATCH_FILES = 128 << 20, 1 << 20, 32 << 20, 256
COLUMNS = f"path string, source string, format string, length long, {EXTRACTED}, content binary"


@dataclass(frozen=True)
class File:
    """A file: its path below the root, name, format (None: no extractor) and bytes."""

    path: str
    source: str
    format: str | None
    length: int


def listed(root: str) -> list[File]:
    """The files below ``root`` by path, without system files. A missing folder raises."""
    system, base = pafs.FileSystem.from_uri(root if "://" in root else f"file://{root.removeprefix('file:')}")
    if system.get_file_info(base).type != pafs.FileType.Directory:
        raise ValueError(f"no such folder: {root}")
    found = []
    for info in system.get_file_info(pafs.FileSelector(base, recursive=True)):
        if info.type == pafs.FileType.File and (known := format_of(info.base_name)) is not False:
            found.append(File(info.path[len(base) :].lstrip("/"), info.base_name, known, info.size))
    return sorted(found, key=lambda f: f.path)


@dataclass(frozen=True)
class Choice:
    """Which files to open: of these formats (empty: all), below a path, with bytes up to a limit."""

    formats: frozenset[str] = frozenset()
    prefix: str = ""
    most: int | None = None

    def holds(self, file: File) -> bool:
        return file.format is not None and (not self.formats or file.format in self.formats) and file.path.startswith(self.prefix) and (self.most is None or file.length <= self.most)


@dataclass
class Files(InputPartition):
    """The files of one task."""

    files: list[File]


def dealt(files: Iterable[File], most: int) -> list[Files]:
    """Runs of files of about ``most`` bytes; a larger file is a partition of its own."""
    out, held, size = [], [], 0
    for f in files:
        cost = f.length + OPEN_BYTES
        if held and size + cost > most:
            out.append(Files(held))
            held, size = [], 0
        held.append(f)
        size += cost
    return [*out, Files(held)] if held else out


class CorpusReader(DataSourceReader):
    def __init__(self, root: str, choice: Choice, most: int):
        self.root, self.choice, self.most = root, choice, most

    def partitions(self) -> list[InputPartition]:
        return dealt(filter(self.choice.holds, listed(self.root)), self.most) or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        system, base = pafs.FileSystem.from_uri(self.root if "://" in self.root else f"file://{self.root.removeprefix('file:')}")
        held: list[tuple[File, bytes]] = []

        def batch() -> pa.RecordBatch:
            files = [f for f, _ in held]
            columns = extracted([(data, f.source, f.format, f.path) for f, data in held if f.format != "pdf"])
            done = np.cumsum([f.format != "pdf" for f in files]) - 1
            take = pa.array([int(n) if f.format != "pdf" else None for n, f in zip(done, files, strict=True)], pa.int64())  # null for a PDF
            return pa.RecordBatch.from_arrays(
                [pa.array([getattr(f, c) for f in files], t) for c, t in (("path", pa.string()), ("source", pa.string()), ("format", pa.string()), ("length", pa.int64()))]
                + [c.take(take) for c in columns]
                + [pa.array([data if f.format == "pdf" else None for f, data in held], pa.binary())],
                names=["path", "source", "format", "length", "blocks", "meta", "errors", "content"],
            )

        size = 0
        for f in partition.files:
            with system.open_input_file(f"{base.rstrip('/')}/{f.path}") as stream:
                held.append((f, stream.read()))
            size += f.length
            if size >= BATCH_BYTES or len(held) >= BATCH_FILES:
                yield batch()
                held, size = [], 0
        if held:
            yield batch()


class Corpus(DataSource):
    """Options: path (the folder), formats (names with commas between), prefix, max_length, partition_bytes.

    Files are chosen by options: filters pushed into a Python source stay with a
    frame, in Spark 4.1, when it is filtered again in another way.
    """

    @classmethod
    def name(cls) -> str:
        return "quernstone"

    def schema(self) -> str:
        return COLUMNS

    def reader(self, schema: StructType) -> CorpusReader:
        o = self.options
        choice = Choice(frozenset(f.strip() for f in o.get("formats", "").split(",") if f.strip()), o.get("prefix", ""), int(o["max_length"]) if "max_length" in o else None)
        return CorpusReader(o["path"], choice, int(o.get("partition_bytes", PARTITION_BYTES)))


def register(spark: SparkSession) -> None:
    """Make the format known to a session.

    Of PDF files it gives the content, whose words need more than one row
    (``extract.pdf_documents``); of the others blocks, meta and errors.
    """
    spark.dataSource.register(Corpus)
