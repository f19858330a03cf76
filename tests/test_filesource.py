import pytest
from pyspark.sql import functions as F

from quernstone.sources import filesource as S
from quernstone.sources.extract import extract_files


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    root = tmp_path_factory.mktemp("files")
    (root / "sub" / "más hondo").mkdir(parents=True)
    for k in range(30):
        (root / f"n{k:02d}.txt").write_text(f"Text number {k} about the agency. " * (k + 1))
    (root / "sub" / "dos.csv").write_text("a,b\nx,1\n")
    (root / "sub" / "más hondo" / "tres.JSON").write_text('{"title": "A title", "body_text": "It reads well."}')
    (root / "sub" / "cuatro.pdf").write_bytes(b"%PDF")
    (root / "broken.xlsx").write_bytes(b"broken")
    (root / ".DS_Store").write_bytes(b"x")
    (root / "none.zzz").write_bytes(b"x")
    return str(root)


def test_documents_as_by_sparks_reader(spark, folder):
    S.register(spark)
    got = spark.read.format("quernstone").load(folder)
    want = {r.path: (r.source, r.format, r.blocks, r.meta, r.errors) for r in extract_files(spark, folder).where("format <> 'pdf'").collect()}
    rows = {r.path: r for r in got.collect()}
    assert {p: (r.source, r.format, r.blocks, r.meta, r.errors) for p, r in rows.items() if r.format != "pdf"} == want and len(want) == 33
    assert bytes(rows["sub/cuatro.pdf"].content) == b"%PDF" and rows["sub/cuatro.pdf"].blocks is None and rows["n00.txt"].content is None
    with pytest.raises(Exception, match="no such folder"):
        spark.read.format("quernstone").load(f"{folder}/gone").collect()


def test_options_choose_files_before_they_are_opened(spark, folder, monkeypatch):
    S.register(spark)
    names = lambda **options: sorted(r.path for r in spark.read.format("quernstone").options(**options).load(folder).select("path").collect())
    assert names(formats="csv, json") == ["sub/dos.csv", "sub/más hondo/tres.JSON"]
    assert names(prefix="sub/") == ["sub/cuatro.pdf", "sub/dos.csv", "sub/más hondo/tres.JSON"]
    assert names(formats="txt", max_length=70) == ["n00.txt", "n01.txt"] and names(formats="none") == []
    opened = [f.path for p in S.CorpusReader(folder, S.Choice(frozenset({"csv"})), 1 << 30).partitions() for f in p.files]
    assert opened == ["sub/dos.csv"]
    df = spark.read.format("quernstone").load(folder)
    assert df.where("format = 'csv'").count() == 1 and df.where("source = 'n03.txt' OR format = 'csv'").count() == 2


def test_partitions_are_dealt_by_bytes(spark, folder):
    files = [S.File(f"f{k}", f"f{k}", "txt", size) for k, size in enumerate((10 << 20, 300 << 20, 1, 1, 60 << 20, 60 << 20, 60 << 20))]
    parts = [[f.path for f in p.files] for p in S.dealt(files, 128 << 20)]
    assert parts == [["f0"], ["f1"], ["f2", "f3", "f4", "f5"], ["f6"]]
    S.register(spark)
    df = spark.read.format("quernstone").option("partition_bytes", str(5 << 20)).load(folder)
    assert df.rdd.getNumPartitions() > 5 and df.select(F.count_distinct("path")).first()[0] == 34


def test_no_content_crosses_a_shuffle(spark, tmp_path):
    (tmp_path / "a.txt").write_text("One text about the agency.")
    plan = extract_files(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "FileScan binaryFile" in plan and "Join" not in plan and "Exchange" not in plan
