"""A deterministic sharded WARC writer, and a reader of its archives.

Rows are range-partitioned into shards by record id, with bounds from a sample
fixed by a hash of the id, and sorted inside each shard. A shard's records go
to files that roll once their compressed size reaches a limit. Every record is
a gzip member of its own; headers, identifiers and digests are made anew from
the payload, so equal input gives equal bytes. Tasks write under temporary names
that no other attempt shares and list their files in a manifest, which Spark
commits exactly once; only files in the manifest get their final names, and
readers follow the manifest alone.
"""

from __future__ import annotations

import base64
import hashlib
import posixpath
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from quernstone.session import fresh_dir, materialise

#: Line end, the profile of revisits, the date of records that have none.
CRLF = b"\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2000-01-01T00:00:00Z"
#: Payloads of fewer bytes are always written out.
LEAST_SHARED = 1000
#: About what a record takes besides its payload.
RECORD_BYTES = 800
_SPACE = uuid.UUID("6f1bca0e-0a0b-5c3e-9d54-6f1f6d0c7a11")


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:/") else (pafs.LocalFileSystem(), path)


def _safe_uri(url: str | None, record_id: object) -> str:
    """The url with control characters and spaces escaped; a name of our own where null."""
    if not url:
        return f"urn:record:{record_id}"
    return "".join(c if 0x20 < ord(c) != 0x7F else "".join(f"%{b:02X}" for b in c.encode()) for c in url)


def record_name(record_id: object, digest: str, url: str | None) -> str:
    """The record's identifier, from its id, payload digest and url."""
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'{record_id}/{digest}/{url}')}>"


def build_record(record_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str = DATE) -> bytes:
    """One uncompressed record: a response, or a revisit where ``refers_to`` is given."""
    sha1 = hashlib.sha1(payload)
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: " + str(len(payload)).encode() + CRLF + CRLF
    block = http if refers_to is not None else http + payload
    b32 = lambda d: "sha1:" + base64.b32encode(d).decode()
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", record_name(record_id, sha1.hexdigest(), url)),
        ("WARC-Date", date),
        ("WARC-Target-URI", _safe_uri(url, record_id)),
        ("WARC-Payload-Digest", b32(sha1.digest())),
        ("WARC-Block-Digest", b32(hashlib.sha1(block).digest())),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
        ("X-Payload-Length", str(len(payload))),
    ]
    if record_id is not None:
        fields.append(("X-Record-Number", str(record_id)))
    if refers_to is not None:
        fields += [("WARC-Profile", PROFILE), ("X-Refers-To-Number", str(refers_to))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + CRLF + CRLF


def _gzip(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)  # header without name or time
    return packer.compress(data) + packer.flush()


class _Roller:
    """Files of one shard, each closed once it holds ``limit`` compressed bytes."""

    def __init__(self, root: str, shard: int, limit: int):
        self.fs, self.root = _open(root)
        self.shard, self.limit, self.attempt = shard, limit, uuid.uuid4().hex
        self.sink, self.rows, self.files = None, [0, 0], 0

    def add(self, data: bytes) -> Iterator[dict]:
        if self.sink is None:
            self.name = f"shard-{self.shard:05d}-{self.files:05d}.warc.gz"
            self.temporary = posixpath.join("temporary", f"{self.attempt}-{self.name}")
            self.sink, self.sha = self.fs.open_output_stream(posixpath.join(self.root, self.temporary), compression=None), hashlib.sha256()
            self.rows = [0, 0]
        self.sink.write(data)
        self.sha.update(data)
        self.rows = [self.rows[0] + 1, self.rows[1] + len(data)]
        if self.rows[1] >= self.limit:
            yield from self.close()

    def close(self) -> Iterator[dict]:
        if self.sink is not None:
            self.sink.close()
            self.sink, self.files = None, self.files + 1
            yield {"shard": self.shard, "file": self.name, "temporary": self.temporary, "records": self.rows[0], "bytes": self.rows[1], "sha256": self.sha.hexdigest()}


MANIFEST = "shard int, file string, temporary string, records long, bytes long, sha256 string"


def _shards(slim: DataFrame, shard_bytes: int, most: int, sample: int) -> tuple[list[int], int]:
    """Least ids of all shards but the first, and the number of shards.

    A shard gets about ``shard_bytes`` of payloads, more where that would make over
    ``most`` shards. Bounds come from some ``sample`` ids a shard, picked by hash.
    """
    total, size = slim.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    n = min(most, total, -(-(size + RECORD_BYTES * total) // shard_bytes))
    if n <= 1:
        return [], 1
    every = max(1, total // (sample * n))
    ids = sorted(r[0] for r in slim.where("id IS NOT NULL").where(F.pmod(F.xxhash64("id"), F.lit(every)) == 0).select("id").collect())
    return sorted({ids[len(ids) * k // n] for k in range(1, n)}) if ids else [], n


def write_archives(
    pages: DataFrame,
    out: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    least_shared: int = LEAST_SHARED,
    shard_bytes: int = 16 << 20,
    file_bytes: int = 64 << 20,
    most_shards: int = 1 << 16,
    sample: int = 20,
) -> DataFrame:
    """Write one record per row of ``pages`` under ``out``; the manifest of files.

    Of records with equal payloads of at least ``least_shared`` bytes the one of
    the largest id is a response and the others are revisits to it; of repeated
    rows of that id the first written is the response. A null payload is empty,
    a null url gets a name of our own, a null id is kept: such a row is a revisit
    where a row with an id has its payload, else a response. Rows without an id are
    dealt to shards by their payload. Ids must be integers. Payloads of any length
    are written whole, one at a time. Other columns are not read. Payloads are
    shuffled once, to their shards; the choice of responses travels as (id, digest)
    rows. The driver holds a bound a shard and ``sample`` ids each. An empty table
    writes no file.
    """
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    slim = materialise(rows.select("id", F.unhex(F.sha1("payload")).alias("digest"), F.length("payload").alias("size")), "warc-digests")
    shared = slim.where(F.col("size") >= least_shared)
    groups = shared.groupBy("digest").agg(F.max("id").alias("to"), F.count("*").alias("n")).where("n > 1 AND to IS NOT NULL")
    choices = shared.join(groups, "digest").select("id", "to", "digest").distinct()

    bounds, n_shards = _shards(slim, shard_bytes, most_shards, sample)
    least = np.array(bounds, dtype=np.int64)

    @F.pandas_udf(IntegerType())
    def shard_of(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(least, ids.to_numpy(np.int64), side="right").astype(np.int32))

    # One shuffle: a shard's choices and rows meet sorted, choices of an id first.
    none = lambda kind, name: F.lit(None).cast(kind).alias(name)
    both = choices.select("id", "to", "digest", none("string", "url"), none("binary", "payload")).unionByName(
        rows.select("id", none("long", "to"), none("binary", "digest"), "url", "payload")
    )
    by_payload = F.pmod(F.xxhash64(F.coalesce("digest", F.unhex(F.sha1("payload")))), F.lit(n_shards)).cast("int")
    # Without nulls, which would make pandas round large ids.
    shard = F.when(F.col("id").isNull(), by_payload).otherwise(shard_of(F.coalesce("id", F.lit(0))))
    dealt = both.withColumn("shard", shard).repartitionById(n_shards, "shard").sortWithinPartitions("shard", "id", F.col("digest").isNull(), "digest", "url", "payload")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roller, at, chosen, written = None, None, {}, set()

        def listed(entries: Iterator[dict]) -> Iterator[pa.RecordBatch]:
            if found := list(entries):
                yield pa.RecordBatch.from_pylist(found, schema=pa.schema([("shard", pa.int32()), ("file", pa.string()), ("temporary", pa.string()), ("records", pa.int64()), ("bytes", pa.int64()), ("sha256", pa.string())]))

        for batch in batches:
            columns = [batch.column(c) for c in ("shard", "id", "to", "digest", "url", "payload")]
            for row in range(batch.num_rows):
                shard, ident, to, digest, url, data = (c[row].as_py() for c in columns)
                if roller is None or roller.shard != shard:
                    if roller is not None:
                        yield from listed(roller.close())
                    roller, at = _Roller(out, shard, file_bytes), (None,)
                if at != (shard, ident):
                    at, chosen, written = (shard, ident), {}, set()
                if digest is not None:
                    chosen[digest] = to
                    continue
                refers_to = chosen.get(hashlib.sha1(data).digest()) if chosen else None
                if refers_to is not None and refers_to == ident:
                    own = hashlib.sha1(data).digest()
                    if own not in written:
                        written.add(own)
                        refers_to = None
                yield from listed(roller.add(_gzip(build_record(ident, url, data, refers_to))))
        if roller is not None:
            yield from listed(roller.close())

    system, root = _open(out)
    system.create_dir(posixpath.join(root, "temporary"), recursive=True)
    manifest = f"{out}/manifest"
    dealt.mapInArrow(write, MANIFEST).write.parquet(manifest)
    listed = pages.sparkSession.read.schema(MANIFEST).parquet(manifest)

    def publish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _open(out)
        for batch in batches:
            for old, new in zip(batch.column("temporary").to_pylist(), batch.column("file").to_pylist(), strict=True):
                target = posixpath.join(root, new)
                try:
                    system.move(posixpath.join(root, old), target)
                except FileNotFoundError:
                    if system.get_file_info(target).type == pafs.FileType.NotFound:
                        raise
            yield batch.select(["file"])

    listed.mapInArrow(publish, "file string").agg(F.count("*")).collect()
    system.delete_dir(posixpath.join(root, "temporary"))
    return listed


def _members(stream: pa.NativeFile) -> Iterator[bytes]:
    """Each gzip member of a stream, decompressed."""
    packer, parts, left = zlib.decompressobj(31), [], b""
    while chunk := left or stream.read(1 << 20):
        parts.append(packer.decompress(chunk))
        left = packer.unused_data
        if packer.eof:
            yield b"".join(parts)
            packer, parts = zlib.decompressobj(31), []
    if any(parts):
        raise ValueError("an archive ends inside a record")


def parse_record(data: bytes) -> dict:
    """Headers (lower-case names) and block of a record; lengths and digests are checked."""
    head, _, rest = data.partition(CRLF + CRLF)
    version, *lines = head.decode().split("\r\n")
    if version != "WARC/1.1":
        raise ValueError("not a WARC record")
    fields = {k.lower(): v for k, v in (line.split(": ", 1) for line in lines)}
    block = rest[: int(fields["content-length"])]
    digest = lambda b: "sha1:" + base64.b32encode(hashlib.sha1(b).digest()).decode()
    if len(block) != int(fields["content-length"]) or rest[len(block) :] != CRLF + CRLF or digest(block) != fields["warc-block-digest"]:
        raise ValueError(f"a broken record: {fields.get('warc-record-id')}")
    payload = block.partition(CRLF + CRLF)[2] if fields["warc-type"] == "response" else None
    if payload is not None and (digest(payload) != fields["warc-payload-digest"] or len(payload) != int(fields["x-payload-length"])):
        raise ValueError(f"payload and digest differ: {fields.get('warc-record-id')}")
    return {"fields": fields, "payload": payload}


RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, record_id string, file string"


def read_archives(manifest: DataFrame, out: str, payloads: bool = False) -> DataFrame:
    """One row per record of the files in ``manifest``, each record checked.

    payload_bytes and payload_digest (hex SHA-1) are of the full payload, for
    revisits too. ``payloads`` adds the payload (null for revisits). Files are
    streamed: a record at a time is held. An empty manifest gives no rows; columns
    other than ``file`` are not read.
    """
    schema = RECORD + (", payload binary" if payloads else "")
    n_files = max(1, manifest.count())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _open(out)
        for batch in batches:
            for name in batch.column("file").to_pylist():
                rows, held = [], 0
                with system.open_input_stream(posixpath.join(root, name), compression=None) as stream:
                    for data in _members(stream):
                        record = parse_record(data)
                        f = record["fields"]
                        number = lambda k, f=f: int(f[k]) if k in f else None
                        digest = base64.b32decode(f["warc-payload-digest"].removeprefix("sha1:")).hex()
                        row = [number("x-record-number"), number("x-payload-length"), digest, f["warc-type"], number("x-refers-to-number"), f["warc-target-uri"], f["warc-record-id"], name]
                        rows.append(row + ([record["payload"]] if payloads else []))
                        held += len(record["payload"] or b"") * payloads
                        if len(rows) >= 4000 or held > 1 << 24:
                            yield _batch(rows, payloads)
                            rows, held = [], 0
                if rows:
                    yield _batch(rows, payloads)

    return manifest.select("file").repartition(min(n_files, 4096), "file").mapInArrow(read, schema)


def _batch(rows: list[list], payloads: bool) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()] + [pa.binary()] * payloads
    names = [c.split()[0] for c in RECORD.split(", ")] + ["payload"] * payloads
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def archive_pages(pages: DataFrame, out: str | None = None, **options: int) -> DataFrame:
    """Write ``pages`` as archives in the shared folder (or ``out``) and read them back.

    One row per row of ``pages``, under the choices of :func:`write_archives`: null
    payloads are empty, null ids and repeated rows are kept, ties of the largest id
    go to the first written, long payloads are whole, only page_id, url and html are
    read (others may have any name), an empty table gives no rows.
    """
    out = out or fresh_dir(pages.sparkSession, "warc")
    return read_archives(write_archives(pages, out, **options), out)
