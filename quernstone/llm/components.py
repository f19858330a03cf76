"""Connected components of large edge lists, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernstone.session import Written

MAX_ROUNDS = 200


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) for every node of ``edges`` (u, v); component: smallest node reachable.

    Alternates the large-star and small-star steps: each replaces a node's
    edges by edges to its smallest neighbour. The smallest neighbours come from
    a grouped minimum (combined before the shuffle), so no neighbourhood is ever
    gathered; the join that follows can be split where a node is hot, and nothing is
    broadcast through the driver. Every
    step is written in the shared folder and the one before it deleted; count and
    checksum are taken while it is written, so a round is two jobs. Loops (u = v)
    and nulls are ignored, repeated and reversed edges count once; no edges give
    no rows.
    """
    state = {"n": F.count("*"), "sum": F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))}
    now = Written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), name, **state)
    for _ in range(MAX_ROUNDS):
        if not now.taken["n"]:
            break
        pairs = now.read()
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least.hint("merge"), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        step = Written(large.where("u <> v").distinct(), name)
        large = step.read()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least.hint("merge"), "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
        done = Written(small.select("e.u", "e.v").where("u <> v").distinct(), name, **state)
        settled = done.taken == now.taken
        step.delete()
        now.delete()
        now = done
        if settled:
            break
    else:
        raise RuntimeError("connected components did not settle")
    pairs = now.read()
    roots = pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
