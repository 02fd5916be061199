import threading
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from tierflow import snapshots, storage
from tierflow.sinks import refresh, write_once
from tierflow.sources import read_table


def ids(spark, path):
    return sorted(r.id for r in read_table(spark, path).collect())


def test_a_version_replaces_the_one_it_reads(spark, tmp_path):
    path = str(tmp_path / "t")
    assert snapshots.current(spark, path) is None
    refresh(spark.range(3), path, snapshots=True)
    refresh(read_table(spark, path).filter("id > 0"), path, snapshots=True)
    assert ids(spark, path) == [1, 2]


def test_a_failed_write_leaves_the_old_version(spark, tmp_path):
    path = str(tmp_path / "t")
    refresh(spark.range(3), path, snapshots=True)
    broken = spark.range(3).withColumn("x", F.raise_error(F.lit("lost")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        refresh(broken, path, snapshots=True)
    assert ids(spark, path) == [0, 1, 2]


def test_of_writers_at_a_time_exactly_one_wins(spark, tmp_path):
    for attempt in range(5):
        path = str(tmp_path / f"once{attempt}")
        start = threading.Barrier(6)

        def write(k, path=path, start=start):
            rows = spark.range(k * 10, k * 10 + 5)
            start.wait()
            return write_once(rows, path, snapshots=True)

        with ThreadPoolExecutor(6) as pool:
            won = list(pool.map(write, range(6)))
        assert won.count(True) == 1
        winner = won.index(True)
        assert ids(spark, path) == list(range(winner * 10, winner * 10 + 5))
        assert len(storage.names_in(spark, f"{path}/_snapshots")) == 1
        assert not write_once(spark.range(1), path, snapshots=True)


def test_the_store_lets_one_writer_create_a_file(spark, tmp_path):
    for attempt in range(30):
        path = str(tmp_path / f"claim{attempt}")
        start = threading.Barrier(8)

        def claim(k, path=path, start=start):
            start.wait()
            return storage.write_new(spark, path, f"{k}\n")

        with ThreadPoolExecutor(8) as pool:
            won = list(pool.map(claim, range(8)))
        assert won.count(True) == 1 and storage.read_small(spark, path) == f"{won.index(True)}\n"


def test_a_reader_never_meets_a_missing_or_mixed_table(spark, tmp_path):
    path = str(tmp_path / "t")
    refresh(spark.range(40), path, snapshots=True)
    done = threading.Event()
    seen = []

    def read():
        while not done.is_set():
            seen.append(len({r.id // 40 for r in read_table(spark, path).collect()}))

    with ThreadPoolExecutor(2) as pool:
        reader = pool.submit(read)
        for k in range(1, 9):
            snapshots.publish(spark.range(k * 40, k * 40 + 40), path, kept=6)
        done.set()
        reader.result()
    assert seen and set(seen) == {1}
    assert ids(spark, path) == list(range(320, 360))


def test_writers_at_a_time_take_versions_in_turn(spark, tmp_path):
    path = str(tmp_path / "t")
    with ThreadPoolExecutor(6) as pool:
        versions = list(pool.map(lambda k: snapshots.publish(spark.range(k, k + 1), path, kept=9), range(6)))
    assert sorted(versions) == [1, 2, 3, 4, 5, 6]
    assert ids(spark, path) == [versions.index(6)]


def test_old_versions_go(spark, tmp_path):
    path = str(tmp_path / "t")
    for k in range(5):
        refresh(spark.range(k + 1), path, snapshots=True, partition_by=())
    assert len(storage.names_in(spark, f"{path}/_snapshots")) == snapshots.KEPT
    assert len(ids(spark, path)) == 5


def test_a_pointer_that_its_writer_did_not_finish(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(snapshots, "PATIENCE", 0.3)
    path = str(tmp_path / "t")
    storage.write_new(spark, f"{path}/_versions/{1:012}", "")
    with pytest.raises(OSError, match="delete it"):
        write_once(spark.range(1), path, snapshots=True)
    refresh(spark.range(2), path, snapshots=True)
    storage.write_new(spark, f"{path}/_versions/{3:012}", "")
    assert ids(spark, path) == [0, 1]
    refresh(spark.range(3), path, snapshots=True)
    assert ids(spark, path) == [0, 1, 2]


def test_what_snapshots_refuse(spark, tmp_path):
    with pytest.raises(ValueError, match="by path"):
        refresh(spark.range(1), str(tmp_path / "d"), table_format="delta", snapshots=True)
    spark.range(2).write.parquet(str(tmp_path / "plain"))
    with pytest.raises(ValueError, match="without snapshots"):
        refresh(spark.range(1), str(tmp_path / "plain"), snapshots=True)
    assert not write_once(spark.range(1), str(tmp_path / "plain"), snapshots=True)
