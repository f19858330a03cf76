import math
import random

import pytest
from pyspark.sql import functions as F

from quernstone.operators.quantiles import half_even_place, nearest_place, selected


def places():
    return {"p50": nearest_place(F.col("n"), 50), "p95": nearest_place(F.col("n"), 95), "h95": half_even_place(F.col("n"), 95)}


def brute(values):
    v = sorted(values)
    at = lambda k: v[max(1, min(len(v), k)) - 1]
    return at(math.ceil(0.5 * len(v))), at(math.ceil(95 * len(v) / 100)), at(round(95 * len(v) / 100 + 0.5))


@pytest.mark.parametrize("kind", ["int", "bigint", "double"])
def test_equals_sorting(spark, kind):
    rng = random.Random(kind)
    draw = {
        "int": lambda: rng.choice((rng.randrange(5), rng.randrange(-(2**31), 2**31))),
        "bigint": lambda: rng.choice((2**62 + rng.randrange(50), -(2**63), 2**63 - 1, rng.randrange(9))),
        "double": lambda: rng.choice((rng.random(), 1e308 * (rng.random() - 0.5), -1.5e-300, 0.0, 1e308, -1e308)),
    }[kind]
    groups = {"a": [draw() for _ in range(501)], None: [draw() for _ in range(20)], "c": [draw()], "d": [7 if kind != "double" else 7.0] * 100}
    rows = [(k, v) for k, vs in groups.items() for v in vs] + [("a", None), ("empty", None)]
    df = spark.createDataFrame(rows, f"n string, v {kind}").repartition(3)
    got = {r["n"]: (r.p50, r.p95, r.h95) for r in selected(df, ["n"], "v", places(), bins=8 if kind != "double" else 1024).collect()}
    assert got == {k: brute(vs) for k, vs in groups.items()}


def test_without_keys_and_empty(spark):
    df = spark.range(1000).select((F.col("id") * 3).alias("v"))
    assert tuple(selected(df, [], "v", places()).first()) == brute([3 * k for k in range(1000)])
    assert selected(df.limit(0), [], "v", places()).count() == 0


def test_a_pass_makes_bins_not_values(spark, monkeypatch):
    from quernstone.operators import quantiles

    written = []
    plain = quantiles.Written
    monkeypatch.setattr(quantiles, "Written", lambda df, *a, **k: written.append(df.count()) or plain(df, *a, **k))
    df = spark.range(50_000).select(F.rand(1).alias("v"))
    assert selected(df, [], "v", {"p": nearest_place(F.col("n"), 50)}).count() == 1
    assert all(n == 1 for n in written) and len(written) <= 4


def test_values_are_worked_out_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def dear(v):
        seen.add(1)
        return v

    rows = spark.range(5000).select((F.col("id") % 2).alias("g"), dear((F.col("id") * 7919) % 100_003).alias("v"))
    assert selected(rows, ["g"], "v", {"p50": nearest_place(F.col("n"), 50)}, bins=4).count() == 2
    assert seen.value == 5000
