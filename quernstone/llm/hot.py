"""Joins back on keys of which a few may hold a large part of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernstone.llm.columns import spare

#: A key is hot that has over one in so many rows; so there are fewer hot keys than this.
SHARE = 1000


def join_back(rows: DataFrame, groups: DataFrame, key: list[str], count: str) -> DataFrame:
    """``rows`` with the columns of ``groups``, which has each key once and its rows in ``count``.

    The hot keys, under ``SHARE`` rows whatever the table's size, are broadcast, so
    their rows stay where they are; the others are dealt by key,
    never broadcast, for a small file of them may be a large table in the driver. Keys hold no nulls;
    rows of a key that ``groups`` lacks go. ``count`` goes too.
    """
    total = groups.agg(F.sum(count)).first()[0] or 0
    mark = spare("_hot", rows, groups)
    hot = groups.where(F.col(count) * SHARE > total).drop(count).withColumn(mark, F.lit(True))
    cold = groups.where(F.col(count) * SHARE <= total).drop(count)
    marked = rows.join(F.broadcast(hot), key, "left")
    met = marked.where(F.col(mark)).drop(mark)
    return met.unionByName(marked.where(F.col(mark).isNull()).select(*rows.columns).join(cold.hint("merge"), key))
