import gzip
import hashlib
from collections import defaultdict
from pathlib import Path

import pytest

from quernstone.llm.queries import op1_warc
from quernstone.llm.warc import archive_pages, build_record, parse_record, read_archives, write_archives


def expected(rows):
    """(page_id, bytes, digest, type, refers_to) for distinct, non-null page ids."""
    groups = defaultdict(list)
    for i, html in rows:
        groups[(html or "").encode()].append(i)
    return sorted(
        (i, len(p), hashlib.sha1(p).hexdigest(), *(("revisit", max(ids)) if len(p) >= 1000 and i != max(ids) else ("response", None)))
        for p, ids in groups.items()
        for i in ids
    )


def test_query(spark, sf_dir):
    rows = [(r.page_id, r.html) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()]
    assert sorted(map(tuple, op1_warc(spark, sf_dir).collect())) == expected(rows)


def test_copies_rolling_and_bytes(spark, tmp_path):
    html = ["a" * 999, "b" * 1000, "é" * 500, "", None, "x" * 5000]
    rows = [(i, f"http://h/{i}", html[i % 6] if i % 7 else f"{i} " * 600, 1) for i in range(-20, 180)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, file int")
    one, two = f"file://{tmp_path}/one", f"file://{tmp_path}/two"
    manifest = write_archives(df, one, shard_bytes=60_000, file_bytes=2000)
    got = read_archives(manifest, one).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted(map(tuple, got.collect())) == expected([(r[0], r[2]) for r in rows])
    listed = manifest.collect()
    assert len({r.shard for r in listed}) >= 4 and len(listed) > len({r.shard for r in listed})
    assert all(r.bytes < 2000 + 6000 for r in listed) and sum(r.records for r in listed) == 200
    again = write_archives(df.repartition(7), two, shard_bytes=60_000, file_bytes=2000).collect()
    plain = lambda m: sorted((r.file, r.records, r.bytes, r.sha256) for r in m)
    assert plain(listed) == plain(again)
    for r in listed:
        data = (Path(tmp_path) / "one" / r.file).read_bytes()
        assert hashlib.sha256(data).hexdigest() == r.sha256
        assert gzip.decompress(data).count(b"WARC/1.1\r\n") == r.records
    assert not (Path(tmp_path) / "one" / "temporary").exists()
    texts = {r.page_id: r.payload for r in read_archives(manifest, one, payloads=True).collect() if r.record_type == "response"}
    assert all((dict((r[0], r[2]) for r in rows)[i] or "").encode() == p for i, p in texts.items())


def test_odd_rows(spark):
    big = "z" * 2000
    rows = [(None, None, None), (None, "u", big), (5, "a\r\nb c\x7f", big), (5, "u", big), (3, "u", big), (None, "v", "y" * 1500), (None, "v", "y" * 1500)]
    got = archive_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert len(got) == 7
    z = sorted(((r.page_id or -1), r.record_type, r.refers_to) for r in got if r.payload_bytes == 2000)
    assert z == [(-1, "revisit", 5), (3, "revisit", 5), (5, "response", None), (5, "revisit", 5)]
    assert all(r.record_type == "response" for r in got if r.payload_bytes != 2000)
    assert archive_pages(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_broken_record_is_noticed():
    data = build_record(1, "http://h", b"payload", None)
    assert parse_record(data)["payload"] == b"payload"
    with pytest.raises(ValueError):
        parse_record(data.replace(b"payload\r\n\r\n", b"pAyload\r\n\r\n"))


def test_large_ids_beside_null_ids_in_many_shards(spark):
    big = 1 << 60
    rows = [(big + k, f"http://h/{k}", f"{k % 300:05d} " * 300) for k in range(1500)]
    rows += [(None, "http://none", f"{k % 400:05d} " * 300) for k in range(0, 400, 7)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    got = archive_pages(df, shard_bytes=20_000).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted(tuple(r) for r in got if r.page_id is not None) == expected([(r[0], r[2]) for r in rows if r[0] is not None])
    last = {hashlib.sha1(r[2].encode()).hexdigest(): r[0] for r in rows if r[0] is not None}
    for r in got:
        if r.page_id is None:
            assert (r.record_type, r.refers_to) == (("revisit", last[r.payload_digest]) if r.payload_digest in last else ("response", None))
