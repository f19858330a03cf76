import pytest
from pyspark.sql import functions as F

from quernstone.session import Written, materialise, scratch, shared_dir


def folders(spark):
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/quernstone")
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return {f.getPath().getName() for f in store.listStatus(path)} if store.exists(path) else set()


def test_scratch_deletes_what_was_written_inside(spark):
    outer = materialise(spark.range(5), "outer")
    before = folders(spark)
    with scratch():
        inner = materialise(outer.withColumn("x", F.lit(1)), "inner")
        with scratch():
            assert materialise(inner, "innermost").count() == 5
            assert len(folders(spark) - before) == 2
        assert inner.count() == 5 and len(folders(spark) - before) == 1
        stays = Written(inner, "stays", stays=True, n=F.count("*"))
    assert {n.split("-")[0] for n in folders(spark) - before} == {"stays"}
    assert stays.read().count() == stays.taken["n"] == outer.count() == 5
    stays.delete()
    assert folders(spark) == before


def test_scratch_deletes_after_an_error(spark):
    before = folders(spark)
    with pytest.raises(ValueError), scratch():
        materialise(spark.range(2), "lost")
        raise ValueError
    assert folders(spark) == before
    materialise(spark.range(2), "kept")  # outside of any scratch tables stay
    assert len(folders(spark)) == len(before) + 1
