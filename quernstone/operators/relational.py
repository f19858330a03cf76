"""Joins and aggregates around the document inventory."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quernstone.operators.quantiles import half_even_place, selected


#: Paths listed of a name that several share.
SHOWN = 20


def split_by_index(files: DataFrame, index: DataFrame | None, key: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Listed files, files outside the index, index rows without a file. No index lists all."""
    if index is None:
        return files, files.limit(0), files.limit(0)
    keys = index.select(key).distinct()
    return files.join(keys, key, "left_semi"), files.join(keys, key, "left_anti"), index.join(files.select(key), key, "left_anti")


def upsert(previous: DataFrame, changed: DataFrame, key: str) -> DataFrame:
    """``previous`` with the rows of ``changed`` in place of those that share a key."""
    return previous.join(changed.select(key).distinct(), key, "left_anti").unionByName(changed)


def require_unique(df: DataFrame, key: str) -> DataFrame:
    """``df``; raises where a key occurs twice. Counts are combined before the shuffle."""
    twice = df.groupBy(key).count().where("count > 1").select(key).head(1)
    if twice:
        raise ValueError(f"{key} is not unique: {twice[0][0]}")
    return df


def ambiguous(df: DataFrame, name: Column, path: str) -> DataFrame:
    """(name, n_paths, paths) of names that several paths share; of a name's paths the first SHOWN."""
    pairs = df.select(name.alias("name"), path).distinct()
    counted = pairs.groupBy("name").agg(F.count("*").alias("n_paths")).where("n_paths > 1")
    w = Window.partitionBy("name").orderBy(path)
    first = pairs.join(counted.select("name"), "name", "left_semi").withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= SHOWN)
    return counted.join(first.groupBy("name").agg(F.array_sort(F.collect_list(path)).alias("paths")), "name")


def repeated_lines(lines: DataFrame, group: str, unit: str, line: str, share: float = 0.6, least_units: int = 3) -> DataFrame:
    """(group, line, n_units): lines in at least ``share`` of a group's units."""
    units = lines.groupBy(group).agg(F.count_distinct(unit).alias("units"))
    seen = lines.select(group, unit, line).distinct().groupBy(group, line).agg(F.count("*").alias("n_units"))
    return seen.join(units, group).where((F.col("units") >= least_units) & (F.col("n_units") >= share * F.col("units"))).select(group, line, "n_units")


def counts(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("n"))


def histogram(df: DataFrame, value: str, width: int = 25) -> DataFrame:
    """(bin, n) with labels of the form 0000-0024."""
    low = F.floor(F.col(value) / width) * width
    return df.groupBy(F.format_string(f"%04d-%04d", low, low + (width - 1)).alias("bin")).agg(F.count("*").alias("n"))


def nearest_rank(value: str, percent: int) -> Column:
    """Nearest-rank percentile as an aggregate; 0 for no rows.

    It holds a group's distinct values: for counts of words and the like. Where they
    may be many, ``quantiles.selected`` finds the same in bounded memory.
    """
    return F.coalesce(F.expr(f"percentile_disc({percent / 100}) WITHIN GROUP (ORDER BY {value})").cast("long"), F.lit(0))


def half_even_rank(df: DataFrame, keys: list[str], value: str, percent: int, into: str) -> DataFrame:
    """(keys, into): the percentile at place round-half-even(p·n/100 + 0.5)."""
    return selected(df, keys, value, {into: half_even_place(F.col("n"), percent)})


def capped(df: DataFrame, keys: list[str], order: list[str], cap: int) -> DataFrame:
    """(keys, kept, over): rows within the cap and beyond it (the cap is the feature)."""
    return df.groupBy(*keys).agg(F.least(F.count("*"), F.lit(cap)).alias("kept"), F.greatest(F.count("*") - cap, F.lit(0)).alias("over"))


def first_rows(df: DataFrame, keys: list[str], order: list[Column | str], n: int = 1) -> DataFrame:
    """The first ``n`` rows of each group in a total order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n).drop("_r")
