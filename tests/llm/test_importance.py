import hashlib
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quernstone.llm.importance import Config, pieces, resample, sort_count, stream
from quernstone.llm.queries import op13_importance


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def features_of(words):
    return [zlib.crc32(f.encode()) for f in words + [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]]


def brute(rows, target, c):
    docs = [(i, words_of(t)) for i, t in rows]
    fs = [[x % c.buckets for x in features_of(w)] for _, w in docs]
    s, t = np.zeros(c.buckets), np.zeros(c.buckets)
    for f in fs:
        np.add.at(s, f, 1)
    for text in target:
        np.add.at(t, [x % c.buckets for x in features_of(words_of(text))], 1)
    gain = [math.floor(1000 * math.log((b + 1) * (s.sum() + c.buckets) / ((a + 1) * (t.sum() + c.buckets)))) for a, b in zip(s, t, strict=True)]
    out = []
    for (i, w), f in zip(docs, fs, strict=True):
        h = int(hashlib.sha256(f"{c.seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[x] for x in f) // len(f) if f else 0
        out.append([i, len(w), len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    order = sorted((o for o in out if o[1] >= c.least_words), key=lambda o: (-o[4], o[0] is None, o[0] or 0, o[3], o[2]))
    for k, o in enumerate(order[: c.percent * len(order) // 100]):
        o[5] = k + 1
    return out


def in_order(rows):
    return sorted(map(tuple, rows), key=lambda r: [(v is None, v or 0) for v in r])


@pytest.mark.parametrize("text", ["", " .,", "One", "A b\x00c É1é B", "x " * 40 + "y" * 100, "wort" * 30])
def test_stream(text):
    for size in (1, 7, 1 << 20):
        assert [w.decode() for run in pieces(text.encode(), size) for w in run] == words_of(text)
    n, made = stream(text.encode(), 10_000)
    assert n == len(words_of(text))
    assert sorted(made.tolist()) == sorted(x % 10_000 for x in features_of(words_of(text)))


def test_pairs_across_pieces(monkeypatch):
    from quernstone.llm import importance

    text = " ".join(f"w{k}" for k in range(500)).encode()
    whole = np.sort(stream(text, 1 << 16)[1])
    monkeypatch.setattr(importance, "pieces", lambda t: pieces(t, 64))
    assert (np.sort(stream(text, 1 << 16)[1]) == whole).all()


def test_sort_count():
    numbers, n = sort_count(np.array([5, 1, 5, 5, 2], np.uint16))
    assert numbers.tolist() == [1, 2, 5] and n.tolist() == [1, 1, 3]
    assert len(sort_count(np.zeros(0, np.uint16))[0]) == 0


def test_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    target = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    want = brute([(r.doc_id, r.text) for r in docs], target, Config())
    rows = op13_importance(spark, sf_dir).select("doc_id", "n_features", "weight", "score", "rank").collect()
    assert in_order(rows) == in_order([[o[0], *o[2:]] for o in want])


def test_nulls_ties_and_clashing_columns(spark):
    long = " ".join(f"w{k % 50}" for k in range(3000))
    rows = [(1, "a b c"), (1, "a b c"), (1, "c b a d"), (None, "a b"), (None, None), (2, ""), (3, " ?! "), (4, "d e f g"), (5, long), (6, "a b c d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("rank", F.lit("x")).withColumn("id", F.lit(1))
    target = spark.createDataFrame([(1, "a b", 1), (2, None, 1)], "item_id long, text string, score int")
    small = Config(buckets=97, block=8, percent=60, least_words=2)
    got = resample(docs, target, small)
    assert in_order(got.collect()) == in_order(brute(rows, ["a b", None], small))
    assert resample(docs.limit(0), target, small).count() == 0
    assert in_order(resample(docs, target.limit(0), small).collect()) == in_order(brute(rows, [], small))
    with pytest.raises(ValueError):
        Config(buckets=1 << 17)


def test_repeated_rows_share_a_place_in_order(spark):
    rows = [(7, "same words here")] * 300 + [(k, f"other words {k}") for k in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    small = Config(buckets=64, least_words=1, percent=50)
    ranks = sorted(r.rank for r in resample(docs, docs, small).collect() if r.rank)
    assert ranks == list(range(1, 251))
