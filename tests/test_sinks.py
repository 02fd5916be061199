import pytest
from py4j.protocol import Py4JJavaError
from pyspark.sql import functions as F

from tierflow import storage
from tierflow.sinks import refresh, write_once
from tierflow.sources import list_files, read_table


def test_write_once(spark, tmp_path):
    path = str(tmp_path / "gold" / "model")
    assert write_once(spark.range(3), path) is True
    assert write_once(spark.range(5), path) is False
    assert read_table(spark, path).count() == 3


def test_write_once_fills_an_empty_directory(spark, tmp_path):
    assert write_once(spark.range(3), str(tmp_path)) is True
    assert read_table(spark, str(tmp_path)).count() == 3


def test_part_files_below_the_top_level_do_not_count(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "nested"))
    assert storage.has_part_file(spark, str(tmp_path / "nested"))
    assert not storage.has_part_file(spark, str(tmp_path))
    assert not storage.has_part_file(spark, str(tmp_path / "absent"))
    with pytest.raises(Py4JJavaError):  # a failed listing says nothing about the path
        storage.has_part_file(spark, "nosuchscheme://host/path")


def test_refresh_replaces_a_table_it_reads(spark, tmp_path):
    path = str(tmp_path / "silver")
    refresh(spark.range(3), path)
    refresh(read_table(spark, path).filter("id > 0"), path)
    assert sorted(r["id"] for r in read_table(spark, path).collect()) == [1, 2]
    assert [p.name for p in tmp_path.iterdir()] == ["silver"]


def test_a_failed_refresh_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "silver")
    refresh(spark.range(3), path)
    broken = spark.range(3).withColumn("x", F.raise_error(F.lit("lost")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        refresh(broken, path)
    assert read_table(spark, path).count() == 3


def test_refresh_variants(spark, tmp_path):
    df = spark.range(6).withColumn("k", F.col("id") % 2)
    for swap in (True, False):
        refresh(df, str(tmp_path / "t"), partition_by=["k"], swap=swap)
        assert read_table(spark, str(tmp_path / "t")).count() == 6
    refresh(df, str(tmp_path / "o"), table_format="orc", compression="zlib")
    assert read_table(spark, str(tmp_path / "o"), table_format="orc").count() == 6
    spark.sql("create schema if not exists sinks")
    refresh(df, name="sinks.t")
    refresh(df.limit(2), name="sinks.t")
    assert read_table(spark, name="spark_catalog.sinks.t").count() == 2
    for bad in ({}, {"path": "p", "name": "n"}):
        with pytest.raises(ValueError, match="either"):
            refresh(df, **bad)
        with pytest.raises(ValueError, match="either"):
            read_table(spark, **bad)


def test_list_files(spark, tmp_path):
    spark.range(3).coalesce(1).write.csv(str(tmp_path / "t"))
    (listed,) = list_files(spark, str(tmp_path / "t"), "*.csv").collect()
    assert listed["path"].endswith(".csv") and listed["length"] == 6


def test_staging_uses_the_folder_of_the_session(spark):
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    home = f"{root}/tierflow/{spark.sparkContext.applicationId}"
    assert storage.staging_path(spark, "x").startswith(f"{home}/x-")
    assert storage.stage(spark.range(3), "x").count() == 3
    storage.clear_staged(spark)
    assert not storage.exists(spark, home)


class Cluster:
    """Just enough of a session to stand for a cluster without a shared folder."""

    class sparkContext:
        master = "yarn"

        @staticmethod
        def getConf():
            return {}

        @staticmethod
        def getCheckpointDir():
            return None


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        storage.staging_root(Cluster)
