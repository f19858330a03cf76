"""Incremental ingest: new and changed documents replace their earlier rows.

An extra beside the batch operators: a stream of document rows goes through
``foreachBatch`` into a keyed table. A batch rewrites the buckets of its keys only,
and a replayed batch changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quernstone.sources.keyed import KeyedTable


def ingest(stream: DataFrame, table: KeyedTable, checkpoint: str, order: str) -> StreamingQuery:
    """Merge all that the stream has now, of each key the newest row; the caller awaits the query."""
    return (
        stream.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(lambda batch, n: table.upsert(batch, batch=n, order=order))
        .start()
    )


def windowed_counts(stream: DataFrame, ts: str, key: str, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """(window, key, n) over event time; rows later than ``late`` are not waited for."""
    return stream.withWatermark(ts, late).groupBy(F.window(ts, width), key).agg(F.count("*").alias("n"))
