"""Exact order statistics by refining histograms.

Each pass cuts the interval that holds a group's wanted rank into BINS parts and
counts them, combined within tasks; the part that holds the rank is the next
interval, shrunk to its own least and largest value. It ends where they are equal.
Neither rows nor distinct values of a group are ever gathered: what a group costs is
BINS rows a pass, whatever it holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quernstone.session import Written

BINS = 1024


def nearest_place(n: Column, percent: int) -> Column:
    """The place from 1 of the nearest-rank percentile among ``n`` values."""
    return F.greatest(F.lit(1), F.ceil(F.lit(percent) * n / F.lit(100)).cast("long"))


def half_even_place(n: Column, percent: int) -> Column:
    """The place at round-half-even(p·n/100 + 0.5), within 1 to ``n``."""
    return F.greatest(F.lit(1), F.least(n, F.bround(F.lit(float(percent)) * n / 100.0 + 0.5).cast("long")))


def selected(df: DataFrame, keys: list[str], value: str, places: dict[str, Column], bins: int = BINS) -> DataFrame:
    """(keys, a column for each of ``places``): of each group the values at places in ascending order.

    ``places`` maps a column's name to a place from 1, an expression over the group's
    count ``n``; see the functions above. Null values do not count; a null key is a
    group of its own, and without keys there is one group. A group without values
    gives no row. Values are numbers but no NaN. Passes over the data: one for every
    power of ``bins`` in the spread of the values, two as a rule. They read keys and
    values that are written once, so ``df`` is worked out once however dear its columns.
    """
    kind = dict(df.dtypes)[value]
    named = {f"k{i}": F.col(k) for i, k in enumerate(keys)} or {"k0": F.lit(0)}  # names of our own, so that none can clash
    own = list(named)
    exact = "decimal(20,0)" if kind == "bigint" else "double"
    # The filter comes after the write: before it, it would work ``value`` out a second time.
    rows = Written(df.select(*(c.alias(o) for o, c in named.items()), F.col(value).alias("v")), "values").read().where(F.col("v").isNotNull())
    wanted = F.array(*(F.struct(F.lit(k).alias("which"), p.cast("long").alias("place")) for k, p in places.items()))
    first = rows.groupBy(*own).agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).select(*own, "lo", "hi", F.inline(wanted))
    held = Written(first.withColumn("before", F.lit(0).cast("long")), "intervals", open=F.count_if(F.col("lo") < F.col("hi")))
    done = held.read().where("lo = hi")
    while held.taken["open"]:
        now = held.read().where("lo < hi").withColumnsRenamed({o: f"of_{o}" for o in own})
        met = rows.join(now, [*(F.col(o).eqNullSafe(F.col(f"of_{o}")) for o in own), F.col("v").between(F.col("lo"), F.col("hi"))]).drop(*(f"of_{o}" for o in own))
        v, lo, hi = (F.col(c).cast(exact) for c in ("v", "lo", "hi"))
        # Halves, as the difference of two doubles may be beyond a double.
        share = (v / 2 - lo / 2) / (hi / 2 - lo / 2) * bins if exact == "double" else (v - lo) * bins / (hi - lo + 1)
        part = F.least(F.lit(bins - 1), F.floor(share).cast("int"))
        counted = met.groupBy(*own, "which", "place", "before", part.alias("bin")).agg(F.count("*").alias("c"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        w = Window.partitionBy(*own, "which").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
        upto = counted.withColumn("b", F.col("before") + F.coalesce(F.sum("c").over(w), F.lit(0)))
        hit = upto.where("b < place AND place <= b + c").select(*own, "lo", "hi", "which", "place", F.col("b").alias("before"))
        held = Written(hit, "intervals", open=F.count_if(F.col("lo") < F.col("hi")))
        done = done.unionByName(held.read().where("lo = hi"))
    found = done.groupBy(*own).agg(*(F.max(F.when(F.col("which") == k, F.col("lo"))).cast(kind).alias(f"p{i}") for i, k in enumerate(places)))
    return found.select(*(F.col(o).alias(k) for k, o in zip(keys, own, strict=False)), *(F.col(f"p{i}").alias(k) for i, k in enumerate(places)))
