"""Ordered blocks: heading paths, layout lines and paragraphs, spans of a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quernstone.functions import text as T

LEVELS = 6


def heading_paths(blocks: DataFrame, doc: str = "doc_id", pos: str = "pos", level: str = "level", text: str = "text") -> DataFrame:
    """``blocks`` with ``path``: the live headings above each block, outermost first.

    ``level`` is null for a body block. A heading of level n ends all headings of
    level n and deeper; levels are clamped to 1..6. One sort per document: for each
    level the last heading before the block is kept, and it is live while no
    shallower heading came later.
    """
    before = Window.partitionBy(doc).orderBy(pos).rowsBetween(Window.unboundedPreceding, -1)
    clamped = F.when(F.col(level).isNotNull(), F.least(F.greatest(F.col(level), F.lit(1)), F.lit(LEVELS)))
    marked = blocks.withColumn("_level", clamped)
    lasts = {n: f"_h{n}" for n in range(1, LEVELS + 1)}
    marked = marked.select("*", *(F.last(F.when(F.col("_level") == n, F.struct(F.col(pos).alias("p"), F.col(text).alias("t"))), ignorenulls=True).over(before).alias(h) for n, h in lasts.items()))
    live = []
    for n, h in lasts.items():
        shallower = [F.coalesce(F.col(f"{lasts[m]}.p"), F.lit(-(1 << 62))) for m in range(1, n)]
        newest = F.greatest(*shallower) if len(shallower) > 1 else shallower[0] if shallower else F.lit(-(1 << 62))
        own = (F.col(f"{h}.p") > newest) & (F.col("_level").isNull() | (F.col("_level") > n))
        live.append(F.when(own, F.col(f"{h}.t")))
    path = F.filter(F.array(*live), lambda t: t.isNotNull())
    return marked.withColumn("path", path).drop("_level", *lasts.values())


def path_violations(blocks: DataFrame, path: str = "path", **columns: str) -> DataFrame:
    """Blocks whose stated path is not the one their headings give."""
    stated = blocks.withColumnRenamed(path, "_stated")
    return heading_paths(stated, **columns).where(~F.col("path").eqNullSafe(F.col("_stated")))


def paragraph_numbers(lines: DataFrame, group: str, top: str, size: str | None, leading: Column, order: list[str]) -> DataFrame:
    """``lines`` with ``paragraph``: a new one on a size change, a wide gap or a step back.

    Wide is over 1.5 times the larger of the leading and the previous size.
    """
    w = Window.partitionBy(group).orderBy(*order)
    gap = F.col(top) - F.lag(top).over(w)
    reach = F.greatest(leading, F.lag(size).over(w)) if size else leading
    cut = (gap < 0) | (gap > 1.5 * reach)
    if size:
        cut = cut | (F.col(size) != F.lag(size).over(w))
    return lines.withColumn("_cut", F.coalesce(cut, F.lit(False)).cast("long")).withColumn("paragraph", F.sum("_cut").over(w)).drop("_cut")


def modal(df: DataFrame, keys: list[str], value: str, into: str) -> DataFrame:
    """The most frequent value of each group; ties to the smallest. Counts are combined early."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n"))
    return counts.groupBy(*keys).agg(F.min_by(value, F.struct(-F.col("_n"), F.col(value))).alias(into))


def title_levels(sizes: DataFrame, body: float, size: str = "size") -> DataFrame:
    """(size, level): sizes over 1.15 times the body's, largest first, levels 1 to 6.

    Only the LEVELS - 1 largest are ranked; all others have the last level.
    """
    large = sizes.where(F.col(size) > 1.15 * body).select(size).distinct()
    first = large.orderBy(F.desc(size)).limit(LEVELS - 1)
    ranked = first.withColumn("level", F.row_number().over(Window.orderBy(F.desc(size))))  # a few rows
    return large.join(F.broadcast(ranked), size, "left").withColumn("level", F.coalesce("level", F.lit(LEVELS)))


def widest_gap(occupied: DataFrame, keys: list[str], band: str, into: str = "gap") -> DataFrame:
    """(keys, start, width): each group's widest run of empty bands between occupied ones."""
    w = Window.partitionBy(*keys).orderBy(band)
    steps = occupied.select(*keys, band).distinct().withColumn("_next", F.lead(band).over(w))
    gaps = steps.where(F.col("_next") > F.col(band) + 1).select(*keys, (F.col(band) + 1).alias("start"), (F.col("_next") - F.col(band) - 1).alias("width"))
    return gaps.groupBy(*keys).agg(F.max_by("start", F.struct("width", -F.col("start"))).alias("start"), F.max("width").alias("width"))


def recognised_lines(words: DataFrame, keys: list[str], least: float = 60.0) -> DataFrame:
    """Lines of recognised words (text, conf, pos): mean confidence of at least ``least``."""
    sure = words.where("conf >= 0").groupBy(*keys).agg(
        F.avg("conf").alias("conf"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "text"))), lambda s: s["text"]), " ").alias("text")
    )
    return sure.where(F.col("conf") >= least)


def recognised_line(words: Column, least: float = 60.0) -> Column:
    """(conf, text) of one line's words, an array of (text, conf) in order; null below ``least``. No row leaves its place."""
    sure = F.filter(words, lambda w: w["conf"] >= 0)
    mean = lambda s: F.aggregate(s, F.lit(0.0), lambda a, w: a + w["conf"]) / F.size(s)
    whole = lambda s: F.struct(mean(s).alias("conf"), F.array_join(F.transform(s, lambda w: w["text"]), " ").alias("text"))
    return T.once(T.once(sure, lambda s: F.when(F.size(s) > 0, whole(s))), lambda x: F.when(x["conf"] >= least, x))
