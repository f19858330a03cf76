"""The master inventory of a corpus, the identity of its files, and what it leaves uncovered."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quernstone.functions import text as T
from quernstone.operators.relational import ambiguous, require_unique, split_by_index
from quernstone.sources.extract import scan_files
from quernstone.sources.sheets import cell_text, sheets

#: The sheet, its columns (the folder may be empty), phenomena, characters that no file name may have.
SHEET = "Inventario de Archivos"
COLUMNS = {
    "phenomenon": "Fenómeno", "observatory": "Observatorio", "observatory_code": "Código Observatorio", "doc_id": "DOC_ID",
    "source": "Nombre estandarizado", "folder": "Carpeta", "declared": "Tipo",
}
OPTIONAL = ("folder",)
PHENOMENA = {"F1": 1, "F2": 2, "F3": 3}
FORBIDDEN = r'[/\\:*?"<>|]'
#: Folder names that state a phenomenon, in order.
FOLDERS = (r"(?i)^F([123])[_\s\-]", r"(?i)^fen[oó]meno[\s_\-]?([123])$")
INVENTORY = "doc_id string, source string, relative string, phenomenon int, observatory string, observatory_code string, declared string"


def workbook_rows(spark: SparkSession, path: str) -> DataFrame:
    """(sheet, row, cells) of a workbook, cells as text and null where empty; rows count from 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column("content"):
                for title, rows in sheets(data.as_py()):
                    cells = [[None if v is None else cell_text(v) for v in row] for row in rows]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([title] * len(rows), pa.string()), pa.array(range(1, len(rows) + 1), pa.int32()), pa.array(cells, pa.list_(pa.string()))], names=["sheet", "row", "cells"]
                    )

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, "sheet string, row int, cells array<string>")


def column_places(header: list[str | None]) -> dict[str, int]:
    """Place of each inventory column, whatever their order; missing ones raise."""
    at = {name.strip(): k for k, name in enumerate(header) if name is not None}
    missing = [c for c in COLUMNS.values() if c not in at]
    if missing:
        raise ValueError(f"the inventory lacks columns {missing}; it has {sorted(at)}")
    return {k: at[c] for k, c in COLUMNS.items()}


def _checked(value: Column, wrong: Column, why: Column) -> Column:
    return F.when(wrong, F.raise_error(why)).otherwise(value)


def inventory_of(rows: DataFrame) -> DataFrame:
    """The inventory (INVENTORY columns) of :func:`workbook_rows`.

    A missing sheet or column, an empty cell that must not be, an unknown
    phenomenon, a doc_id that cannot name a file, a repeated path or doc_id raise.
    Rows without any cell are passed over.
    """
    own = rows.where(F.col("sheet") == SHEET)
    header = own.where("row = 1").head()
    if header is None:
        names = [r[0] for r in rows.select("sheet").distinct().limit(20).collect()]
        raise ValueError(f"the inventory has no sheet {SHEET!r} with a header; it has {names}")
    at = column_places(header["cells"])
    body = own.where("row > 1").where(F.exists("cells", lambda c: c.isNotNull()))
    where = F.concat(F.lit("row "), F.col("row").cast("string"), F.lit(": "))

    def cell(key: str) -> Column:
        value = F.trim(F.coalesce(F.get("cells", F.lit(at[key])), F.lit("")))
        return value if key in OPTIONAL else _checked(value, value == "", F.concat(where, F.lit(f"{COLUMNS[key]} is empty")))

    known = F.create_map(*(F.lit(x) for pair in PHENOMENA.items() for x in pair))
    cells = body.select("row", *(cell(k).alias(k) for k in COLUMNS))
    number = known[F.upper("phenomenon")]
    folder = F.regexp_replace(F.replace("folder", F.lit("\\"), F.lit("/")), "^/+|/+$", "")
    made = cells.select(
        _checked(F.col("doc_id"), F.col("doc_id").rlike(FORBIDDEN), F.concat(where, F.lit("a doc_id that cannot name a file: "), F.col("doc_id"))).alias("doc_id"),
        "source",
        F.when(folder == "", F.col("source")).otherwise(F.concat_ws("/", folder, "source")).alias("relative"),
        _checked(number, number.isNull(), F.concat(where, F.lit("an unknown phenomenon: "), F.col("phenomenon"))).alias("phenomenon"),
        "observatory", "observatory_code", F.col("declared"),
    )
    return require_unique(require_unique(made, "relative"), "doc_id")


def read_inventory(spark: SparkSession, path: str) -> DataFrame:
    """The inventory of a workbook, a dimension of a few thousand rows."""
    return inventory_of(workbook_rows(spark, path))


def folder_phenomenon(relative: Column) -> Column:
    """The phenomenon that a folder of the path states, outermost first; null where none does."""
    folders = F.slice(F.split(relative, "/"), F.lit(1), F.size(F.split(relative, "/")) - 1)
    found = F.transform(folders, lambda p: F.coalesce(*(F.nullif(F.regexp_extract(p, x, 1), F.lit("")) for x in FOLDERS)))
    return F.get(F.filter(found, lambda x: x.isNotNull()), F.lit(0)).cast("int")


def identities(files: DataFrame, index: DataFrame | None, default: int = 1) -> DataFrame:
    """``files`` (relative, name, ...) with doc_id, phenomenon, where both come from, observatory, ambiguous_name.

    An indexed file has the index's identity; else doc_id is derived from the path
    and the phenomenon comes from a folder or is ``default``. Without an index all
    are derived; an empty index is one. A repeated doc_id raises.
    """
    names = ambiguous(files, F.col("name"), "relative").select("name", F.lit(True).alias("ambiguous_name"))
    marked = files.join(names, "name", "left").withColumn("ambiguous_name", F.coalesce("ambiguous_name", F.lit(False)))
    if index is None:
        index = files.sparkSession.createDataFrame([], INVENTORY)
    entry = index.select("relative", F.struct("doc_id", "phenomenon", "observatory", "observatory_code").alias("entry"))
    stated = folder_phenomenon(F.col("relative"))
    listed = F.col("entry").isNotNull()
    found = marked.join(entry, "relative", "left").withColumns(
        {
            "doc_id": F.when(listed, F.col("entry.doc_id")).otherwise(T.document_id(F.col("relative"))),
            "phenomenon": F.coalesce("entry.phenomenon", stated, F.lit(default)),
            "id_origin": F.when(listed, "indice").otherwise("derivado"),
            "phenomenon_origin": F.when(listed, "indice").when(stated.isNotNull(), "carpeta").otherwise("defecto"),
            "observatory": F.col("entry.observatory"),
            "observatory_code": F.col("entry.observatory_code"),
        }
    )
    return require_unique(found.drop("entry"), "doc_id")


def with_identity(docs: DataFrame, identity: DataFrame) -> DataFrame:
    """Extracted documents under the identity of their files; ``source`` never changes."""
    known = identity.select("relative", "doc_id", "phenomenon", "id_origin", "phenomenon_origin", "observatory", "observatory_code", "ambiguous_name")
    rows = docs.drop("doc_id").join(known, docs["path"] == known["relative"])
    said = {"ruta_relativa": F.col("relative"), "fuente_ambigua": F.col("ambiguous_name").cast("string"), "origen_doc_id": F.col("id_origin"), "origen_fenomeno": F.col("phenomenon_origin"), "observatorio": F.col("observatory"), "codigo_observatorio": F.col("observatory_code")}
    extra = F.map_filter(F.create_map(*(x for k, v in said.items() for x in (F.lit(k), v))), lambda _, v: v.isNotNull())
    kept = F.map_filter("meta", lambda k, _: ~k.isin(*said))
    return rows.select("doc_id", *(c for c in docs.columns if c not in ("doc_id", "meta")), "phenomenon", "observatory", "ambiguous_name", F.map_concat(kept, extra).alias("meta"))


@dataclass(frozen=True)
class Coverage:
    """What is left out and why, as frames; the report's lines come from :meth:`report`."""

    files: DataFrame
    without_extractor: DataFrame
    orphans: DataFrame
    outside: DataFrame
    identity: DataFrame

    def report(self) -> DataFrame:
        """(what, kind, n): labelled counts in one frame."""
        count = lambda df, what: df.agg(F.lit(what).alias("what"), F.lit("").alias("kind"), F.count("*").alias("n"))
        by = lambda key, what: self.identity.groupBy(F.col(key).alias("kind")).agg(F.count("*").alias("n")).select(F.lit(what).alias("what"), "kind", "n")
        shared = self.identity.where("ambiguous_name")
        parts = [
            count(self.without_extractor, "without extractor"), count(self.orphans, "in the index, not on disk"), count(self.outside, "on disk, not in the index"),
            by("id_origin", "doc_id by origin"), by("phenomenon_origin", "phenomenon by origin"),
            count(shared.select("name").distinct(), "names on several paths"), count(shared, "files with such a name"),
        ]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out


def cover(files: DataFrame, index: DataFrame | None, default: int = 1) -> Coverage:
    """Which files are extracted under which identity, and which are not."""
    able = files.where("format IS NOT NULL")
    listed, outside, _ = split_by_index(able, index, "relative")
    orphans = index.join(files.select("relative"), "relative", "left_anti").select("relative") if index is not None else files.select("relative").limit(0)
    return Coverage(files, files.where("format IS NULL").select("relative"), orphans, outside.select("relative"), identities(listed, index, default))


def survey(spark: SparkSession, root: str, index_path: str | None = None, default: int = 1) -> Coverage:
    """:func:`cover` of a folder, with the inventory in a workbook where one is named."""
    return cover(scan_files(spark, root), read_inventory(spark, index_path) if index_path else None, default)


def collision_notice(identity: DataFrame) -> str | None:
    """One line about names that several files share, or None."""
    r = identity.where("ambiguous_name").agg(F.count_distinct("name").alias("names"), F.count("*").alias("files")).first()
    if not r["names"]:
        return None
    some = lambda n, word: f"{n} {word}" + "s" * (n != 1)
    return f"{some(r['names'], 'file name')} on {some(r['files'], 'path')}; told apart by path and marked"
