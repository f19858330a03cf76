import zlib
from collections import Counter

import numpy as np
import pytest

from quernstone.llm.queries import op5_sharding
from quernstone.llm.sharding import permute, shard_documents, shard_rows


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 17, 100, 1000, 4097])
def test_permutation(n):
    for seed in (0, 7):
        image = permute(np.arange(n), n, seed)
        assert sorted(image) == list(range(n))
        assert (permute(image, n, seed, backwards=True) == np.arange(n)).all()


def test_query(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = op5_sharding(spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        data = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(data) + 1, zlib.crc32(data), "rows", None)
    sizes = Counter(r.shard for r in rows)
    assert set(sizes) == set(range(8)) and max(sizes.values()) - min(sizes.values()) <= 1
    for s, n in sizes.items():
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(n))
    # place follows from the global row number
    by_row = sorted(rows, key=lambda r: r.global_row)
    assert [r.doc_id for r in by_row] == sorted(texts)
    image = permute(np.arange(len(rows)), len(rows), 20)
    assert [(r.shard, r.slot) for r in by_row] == [(p % 8, p // 8) for p in image]
    assert {tuple(r) for r in op5_sharding(spark, sf_dir).collect()} == {tuple(r) for r in rows}


def test_partitions_do_not_matter(spark):
    df = spark.range(1000).selectExpr("id as doc_id", "repeat('a', cast(id % 7 as int)) as text")
    first = {tuple(r) for r in shard_documents(df, 3).collect()}
    assert first == {tuple(r) for r in shard_documents(df.repartition(13), 3).collect()}


def test_nulls_ties_and_empty(spark):
    df = spark.createDataFrame([(None, None, 1), (5, "a", 2), (5, "a", 3), (5, None, 4)], "doc_id long, text string, shard int")
    rows = shard_documents(df, 2).collect()
    assert sorted((r.shard, r.slot) for r in rows) == [(0, 0), (0, 1), (1, 0), (1, 1)]
    assert sorted(r.size for r in rows) == [1, 1, 2, 2]
    assert shard_documents(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        shard_rows(df, ["doc_id"], 0)
