from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from marquee.session import FREED, scratch_path, shared_dir, shuffles_freed, written


def fake(master, configured=None):
    state = {"dir": None}
    context = SimpleNamespace(
        master=master,
        getCheckpointDir=lambda: state["dir"],
        setCheckpointDir=lambda path: state.update(dir=path),
    )
    conf = SimpleNamespace(get=lambda key, default: configured or default)
    return SimpleNamespace(sparkContext=context, conf=conf)


def test_cluster_without_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(fake("yarn"))


def test_configured_folder_is_used():
    assert shared_dir(fake("spark://host:7077", "s3a://bucket/x")) == "s3a://bucket/x"


def test_local_session_falls_back():
    assert "marquee-" in shared_dir(fake("local[2]"))


def test_written_rows_stay_fixed(spark):
    assert scratch_path(spark, "a") != scratch_path(spark, "a")
    df = written(spark.range(5).selectExpr("id", "rand() as r"), "t")
    assert df.collect() == df.collect() and df.count() == 5
    assert spark.conf.get("spark.checkpoint.dir") in scratch_path(spark, "a")


def test_shuffle_files_go_with_the_write(spark, tmp_path):
    def kept():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {name for i in range(files.size()) if (name := files.apply(i).getName()).startswith("shuffle_")}

    before, setting = kept(), spark.conf.get(FREED)
    rows = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    with shuffles_freed(spark):
        with shuffles_freed(spark):
            rows.write.parquet(str(tmp_path / "freed"))
        assert not kept() - before
    assert spark.conf.get(FREED) == setting
    rows.write.parquet(str(tmp_path / "kept"))
    assert kept() - before and rows.count() == 7
