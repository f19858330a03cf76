"""Session and shared storage helpers."""

from __future__ import annotations

import gc
import tempfile
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, Observation, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the test tables, read through Spark whatever store it is in."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A session for tests and the benchmark on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where a local session names none (tests on one machine) a temporary folder is
    made and set as the checkpoint folder; a cluster must name one.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
        named = held.get() if held.isDefined() else None
    if not named:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="quernstone-")
        spark.sparkContext.setCheckpointDir(f"file://{named}")
        named = f"file://{named}"
    return named


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A folder of its own below the shared one."""
    return f"{shared_dir(spark).rstrip('/')}/quernstone/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    This cuts the lineage: a lost executor costs a re-read, not a re-run. The files
    stay until the ``scratch`` around the call ends, if there is one.
    """
    return Written(df, name).read()


#: The tables written in the open ``scratch``.
_held: ContextVar[list[Written] | None] = ContextVar("held", default=None)


@contextmanager
def scratch() -> Iterator[None]:
    """Delete at the end, errors included, every table that was written inside.

    Frames that come out of it read those tables and must not be used afterwards:
    write what is to stay, to a path or by ``Written(..., stays=True)``, before it ends. An inner scratch
    deletes its own tables only.
    """
    held: list[Written] = []
    token = _held.set(held)
    try:
        yield
    finally:
        _held.reset(token)
        for written in held:
            written.delete()


class Written:
    """A table written in the shared folder, with aggregates taken while it was written.

    One that ``stays`` outlives the ``scratch`` it is made in.
    """

    def __init__(self, df: DataFrame, name: str, stays: bool = False, **taken: Column):
        self.spark, self.schema, self.path = df.sparkSession, df.schema, fresh_dir(df.sparkSession, name)
        if not stays and (held := _held.get()) is not None:
            held.append(self)
        seen = Observation() if taken else None
        (df.observe(seen, *(c.alias(k) for k, c in taken.items())) if seen else df).write.parquet(self.path)
        self.taken = seen.get if seen else {}

    def read(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path)

    def delete(self) -> None:
        """Drop the files; frames that read them must not be used any more."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def let_go(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of plans that nothing refers to any more.

    Python's references are given up first, then those of the JVM, each a moment
    after it was asked.
    """
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.5)
