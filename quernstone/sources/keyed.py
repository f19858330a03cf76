"""A keyed table in files: copy on write by buckets, one manifest a version.

Rows lie in buckets by the hash of their key; a version's manifest names one folder
for each bucket that has rows. A change reads and rewrites the buckets of its keys
alone; the others stay in the folders where they are. A version becomes visible by
one rename of its manifest, which fails where another writer was first. Tasks that
are lost or run twice change nothing: Spark commits each folder as a whole, and a
folder that no manifest names is nobody's.
"""

from __future__ import annotations

import json
import uuid
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quernstone.session import materialise


class WriteConflict(RuntimeError):
    """Another writer made the version first; read it and try again."""


class KeyedTable:
    """The table at ``root``, one row a ``key``.

    Files are Parquet; with ``text_key`` they are lines of text (column value), whose
    key is that expression. ``buckets`` is fixed by the first version. Keys must not
    be null.
    """

    def __init__(self, spark: SparkSession, root: str, key: str, buckets: int = 64, text_key: Column | None = None):
        self.spark, self.root, self.key, self.buckets, self.text_key = spark, root.rstrip("/"), key, buckets, text_key

    def _path(self, name: str) -> tuple[Any, Any]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _listed(self, name: str) -> list[str]:
        path, system = self._path(name)
        return sorted(s.getPath().getName() for s in system.listStatus(path)) if system.exists(path) else []

    def versions(self) -> list[int]:
        return [int(n.removesuffix(".json")) for n in self._listed("versions") if n.endswith(".json")]

    def manifest(self, version: int | None = None) -> dict:
        """{version, batch, buckets, schema, folders: bucket -> folder}; of an unwritten table version 0 without folders."""
        known = self.versions()
        if version is None and not known:
            return {"version": 0, "batch": None, "buckets": self.buckets, "schema": None, "folders": {}}
        path, system = self._path(f"versions/{(known[-1] if version is None else version):010d}.json")
        stream = system.open(path)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _frame(self, schema: str | None, folders: list[str]) -> DataFrame | None:
        if not folders:
            return self.spark.createDataFrame([], schema) if schema else None
        paths = [f"{self.root}/{f}" for f in folders]
        if self.text_key is None:
            return self.spark.read.schema(schema).parquet(*paths)
        return self.spark.read.text(paths).withColumn(self.key, self.text_key)

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, the newest by default; a table that was never written raises."""
        m = self.manifest(version)
        frame = self._frame(m["schema"], list(m["folders"].values()))
        if frame is None:
            raise ValueError(f"no table at {self.root}")
        return frame

    def _write(self, rows: DataFrame, n: int) -> str:
        """Rows with ``_bucket`` in a folder of their own; one task and one folder a bucket."""
        folder = f"data/{uuid.uuid4().hex}"
        tasks = max(1, min(n, int(self.spark.conf.get("spark.sql.shuffle.partitions"))))
        dealt = rows.repartition(tasks, "_bucket")
        out = (dealt if self.text_key is None else dealt.select("value", "_bucket")).write.partitionBy("_bucket")
        (out.parquet if self.text_key is None else out.text)(f"{self.root}/{folder}")
        return folder

    def _commit(self, before: dict, batch: int | None, schema: str, folders: dict[str, str]) -> int:
        version = before["version"] + 1
        made = {"version": version, "batch": before["batch"] if batch is None else batch, "buckets": before["buckets"], "schema": schema, "folders": folders}
        draft, system = self._path(f"versions/.{uuid.uuid4().hex}")
        out = system.create(draft, False)
        out.write(bytearray(json.dumps(made, sort_keys=True).encode()))
        out.close()
        target, _ = self._path(f"versions/{version:010d}.json")
        jvm = self.spark._jvm
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri() if target.toUri().getScheme() else system.getUri(), self.spark._jsc.hadoopConfiguration())
        none = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            files.rename(system.makeQualified(draft), system.makeQualified(target), none)
        except Exception as e:
            system.delete(draft, False)
            if not system.exists(target):
                raise
            raise WriteConflict(f"version {version} of {self.root} is another writer's") from e
        return version

    def _changes(self, rows: DataFrame, buckets: int, order: str | None) -> DataFrame:
        if order is not None:
            newest = F.row_number().over(Window.partitionBy(self.key).orderBy(F.desc(order)))
            rows = rows.withColumn("_r", newest).where("_r = 1").drop("_r")
        return rows.withColumn("_bucket", F.pmod(F.xxhash64(self.key), F.lit(buckets)).cast("int"))

    def replace(self, rows: DataFrame, batch: int | None = None, order: str | None = None) -> int:
        """``rows`` as the whole table; the new version's number. Other rows go."""
        m = self.manifest()
        folder = self._write(self._changes(rows, m["buckets"], order), m["buckets"])
        made = {n.removeprefix("_bucket="): f"{folder}/{n}" for n in self._listed(folder) if n.startswith("_bucket=")}
        return self._commit(m, batch, _ddl(rows), made)

    def upsert(self, rows: DataFrame, batch: int | None = None, order: str | None = None) -> int:
        """``rows`` in place of those of their keys; the new version's number.

        A ``batch`` number that is not above the last one changes nothing, so a
        replay is safe. ``order`` picks the newest of rows that share a key; without
        it keys of ``rows`` must be unique. Columns are the table's. No rows change
        nothing.
        """
        m = self.manifest()
        if batch is not None and m["batch"] is not None and batch <= m["batch"]:
            return m["version"]
        changed = materialise(self._changes(rows, m["buckets"], order), "changes")
        touched = sorted(r[0] for r in changed.select("_bucket").distinct().collect())  # as many as buckets at most
        if order is None and changed.groupBy(self.key).count().where("count > 1").limit(1).count():
            raise ValueError(f"rows of one {self.key} in a change without an order")
        if not touched and m["version"]:
            return m["version"]
        old = self._frame(m["schema"], [m["folders"][str(b)] for b in touched if str(b) in m["folders"]])
        merged = changed
        if old is not None:
            kept = old.join(changed.select(self.key), self.key, "left_anti")
            merged = self._changes(kept, m["buckets"], None).unionByName(changed)
        folder = self._write(merged, len(touched))
        made = {n.removeprefix("_bucket="): f"{folder}/{n}" for n in self._listed(folder) if n.startswith("_bucket=")}
        return self._commit(m, batch, m["schema"] or _ddl(rows), m["folders"] | made)

    def vacuum(self, keep: int = 3) -> int:
        """Deletes versions but the last ``keep`` and folders that none of these names; the number of folders deleted.

        Not beside a writer: what it has not committed yet is deleted too.
        """
        known = self.versions()
        for version in known[:-keep]:
            path, system = self._path(f"versions/{version:010d}.json")
            system.delete(path, False)
        used = {f for v in known[-keep:] for f in self.manifest(v)["folders"].values()}
        gone = 0
        for write in self._listed("data"):
            for bucket in self._listed(f"data/{write}"):
                if bucket.startswith("_bucket=") and f"data/{write}/{bucket}" not in used:
                    path, system = self._path(f"data/{write}/{bucket}")
                    system.delete(path, True)
                    gone += 1
            if not any(f.startswith(f"data/{write}/") for f in used):
                path, system = self._path(f"data/{write}")
                system.delete(path, True)
        return gone


def _ddl(rows: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "_bucket")
