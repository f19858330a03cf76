import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from quernstone.sources.keyed import KeyedTable, WriteConflict

SCHEMA = "k string, v long"


def rows(table, version=None):
    return {r.k: r.v for r in table.read(version).collect()}


def test_only_touched_buckets_are_rewritten(spark, tmp_path):
    table = KeyedTable(spark, f"{tmp_path}/t", "k", 16)
    assert table.upsert(spark.createDataFrame([(f"k{i}", i) for i in range(200)], SCHEMA)) == 1
    before = table.manifest()["folders"]
    assert len(before) == 16
    assert table.upsert(spark.createDataFrame([("k7", -7), ("new", 1)], SCHEMA)) == 2
    after = table.manifest()["folders"]
    assert 1 <= sum(before[b] != after[b] for b in before) <= 2
    assert rows(table) == {f"k{i}": i for i in range(200)} | {"k7": -7, "new": 1} and rows(table, 1)["k7"] == 7
    assert table.upsert(spark.createDataFrame([], SCHEMA)) == 2
    with pytest.raises(ValueError, match="without an order"):
        table.upsert(spark.createDataFrame([("a", 1), ("a", 2)], SCHEMA))


def test_replay_and_order(spark, tmp_path):
    table = KeyedTable(spark, f"{tmp_path}/t", "k", 4)
    with pytest.raises(ValueError, match="no table"):
        table.read()
    batch = spark.createDataFrame([("a", 1), ("a", 3), ("b", 2)], SCHEMA)
    assert table.upsert(batch, batch=5, order="v") == 1 and rows(table) == {"a": 3, "b": 2}
    assert table.upsert(batch.withColumn("v", F.col("v") * 10), batch=5, order="v") == 1 and rows(table) == {"a": 3, "b": 2}
    assert table.upsert(batch.withColumn("v", F.col("v") * 10), batch=6, order="v") == 2 and rows(table) == {"a": 30, "b": 20}
    assert table.replace(batch.where("k = 'b'")) == 3 and rows(table) == {"b": 2}


def test_a_writer_that_comes_late_fails_and_changes_nothing(spark, tmp_path, monkeypatch):
    table, late = (KeyedTable(spark, f"{tmp_path}/t", "k", 4) for _ in range(2))
    table.upsert(spark.createDataFrame([("a", 1)], SCHEMA))
    seen = late.manifest()
    monkeypatch.setattr(late, "manifest", lambda version=None: seen)
    table.upsert(spark.createDataFrame([("a", 2)], SCHEMA))
    with pytest.raises(WriteConflict):
        late.upsert(spark.createDataFrame([("a", 3), ("b", 3)], SCHEMA))
    assert rows(table) == {"a": 2} and table.versions() == [1, 2]
    assert [p.name for p in Path(tmp_path, "t", "versions").iterdir() if not p.name.endswith(".crc")].__len__() == 2


def test_a_lost_write_is_nobodys_and_is_vacuumed(spark, tmp_path):
    table = KeyedTable(spark, f"{tmp_path}/t", "k", 4)
    for n in range(5):
        table.upsert(spark.createDataFrame([(f"k{i}", n) for i in range(9)], SCHEMA))
    table._write(table._changes(spark.createDataFrame([("k0", 99)], SCHEMA), 4, None), 1)  # died before its commit
    assert rows(table) == {f"k{i}": 4 for i in range(9)}
    assert table.vacuum(keep=2) == 13
    assert table.versions() == [4, 5] and rows(table) == {f"k{i}": 4 for i in range(9)} and rows(table, 4)["k1"] == 3


def test_lines_of_text(spark, tmp_path):
    table = KeyedTable(spark, f"{tmp_path}/t", "id", 4, F.get_json_object("value", "$.id"))
    line = lambda k, v: (k, json.dumps({"id": k, "v": v}))
    table.replace(spark.createDataFrame([line("a", 1), line("b", 1)], "id string, value string"))
    table.upsert(spark.createDataFrame([line("b", 2)], "id string, value string"))
    assert sorted(json.loads(r.value)["v"] for r in table.read().collect()) == [1, 2]
    assert {r.id for r in table.read().collect()} == {"a", "b"}
