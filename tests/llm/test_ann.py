import numpy as np
import pytest
from pyspark.sql import functions as F

from quernstone.llm.ann import Config, balanced_parts, fitted, inner_products, nearest, neighbour_graph
from quernstone.llm.queries import op10_ann

SMALL = Config(k=5, sample=800, part_rows=64, block=50, epochs=15)


def brute(ids, x, queries, k):
    out = {}
    for q in queries:
        i = int(np.flatnonzero(ids == q)[0])
        s = inner_products(np.repeat(x[i : i + 1], len(x), axis=0), x)
        out[q] = [(int(ids[j]), s[j]) for j in np.lexsort((ids, -s)) if ids[j] != q][:k]
    return out


def frame(spark, ids, x):
    return spark.createDataFrame([(int(i), [float(v) for v in r]) for i, r in zip(ids, x, strict=True)], "vec_id long, embedding array<float>")


def test_balanced_cut():
    rng = np.random.default_rng(0)
    x = np.vstack([rng.normal(c, 0.1, (50, 4)) for c in np.eye(4) * 3])
    part = balanced_parts(neighbour_graph(x, 6), 4)
    assert sorted(np.bincount(part)) == [50] * 4
    assert all(len(set(part[i * 50 : i * 50 + 50])) == 1 for i in range(4))


DEEP = Config(k=5, sample=800, part_rows=8, max_parts=8, block=20, epochs=15, fan=2)


def test_parts_at_every_size():
    """At least eight parts where there are four vectors for each; clusters need few of them."""
    rng = np.random.default_rng(3)
    clustered = (rng.normal(size=(40, 32)) * 3)[rng.integers(0, 40, 2000)] + rng.normal(size=(2000, 32))
    for n, parts in ((10, 2), (36, 8), (500, 8), (2000, 8)):
        router, _ = fitted(clustered[:n], n, Config(), 0.95)
        assert len(router.b2) >= parts
    router, probes = fitted(clustered, 2000, Config(), 0.95)
    assert len(router.b2) == 8 and 2 * probes <= 8
    router, probes = fitted(clustered, 60_000, Config(), 0.95)
    assert len(router.b2) == 32 and 2 * probes <= 32


@pytest.mark.parametrize(("clusters", "config"), [(1, SMALL), (30, SMALL), (30, DEEP), (1, DEEP)])
def test_recall_and_exact_scores(spark, clusters, config):
    rng = np.random.default_rng(1)
    x = (rng.normal(size=(clusters, 16)) * 2 * (clusters > 1))[rng.integers(0, clusters, 1500)] + rng.normal(size=(1500, 16))
    x = x.astype(np.float32).astype(np.float64)
    ids = rng.permutation(5000)[:1500]
    truth = brute(ids, x, [int(i) for i in ids if i % 20 == 0], 5)
    rows = nearest(frame(spark, ids, x), F.col("vec_id") % 20 == 0, config=config).collect()
    assert {(r.query_id, r.rank) for r in rows} == {(q, k) for q in truth for k in range(1, 6)}
    met = sum(r.vec_id in {v for v, _ in truth[r.query_id]} for r in rows) / len(rows)
    assert met >= 0.9
    at = {int(i): v for i, v in zip(ids, x, strict=True)}
    for r in rows:
        assert r.score == pytest.approx(float(at[r.query_id] @ at[r.vec_id]), abs=1e-12)


def test_hot_vector_ties_and_odd_rows(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 8)).astype(np.float32).astype(np.float64)
    x[:300] = x[0]
    good = frame(spark, np.arange(400), x).withColumn("rank", F.lit(1))
    odd = [(None, [1.0] * 8), (1000, None), (1020, [0.0] * 8), (1040, [float("nan")] + [1.0] * 7), (1060, [None] * 8), (1080, [1.0] * 3), (1100, [float("inf")] * 8)]
    more = spark.createDataFrame(odd, "vec_id long, embedding array<float>").withColumn("rank", F.lit(1))
    rows = nearest(good.union(more).union(good.where("vec_id = 3")), F.col("vec_id") % 20 == 0, config=SMALL).collect()
    assert {r.query_id for r in rows} == set(range(0, 400, 20)) and len(rows) == 100
    own = float(x[0] @ x[0])
    for q in range(0, 300, 20):
        got = sorted((r.rank, r.vec_id) for r in rows if r.query_id == q)
        if all(float(x[0] @ v) < own for v in x[300:]):
            assert [v for _, v in got] == [i for i in range(6) if i != q][:5]
    assert nearest(good.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    assert nearest(good.where("vec_id < 2"), F.col("vec_id") == 0, config=SMALL).count() == 1


def test_query_recall(spark, sf_dir):
    t = spark.read.parquet(f"{sf_dir}/embeddings.parquet").toPandas()
    x = np.array(t.embedding.tolist(), dtype=np.float64)
    ids = t.vec_id.to_numpy()
    truth = brute(ids, x, [int(i) for i in ids if i % 20 == 0], 20)
    rows = op10_ann(spark, sf_dir).collect()
    assert len(rows) == 20 * len(truth)
    assert sum(r.vec_id in {v for v, _ in truth[r.query_id]} for r in rows) >= 0.9 * len(rows)
