import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow import PipelineConfig, storage
from tierflow.functions import record_digest
from tierflow.plans import Layers, run_silver, stream_silver, streamed_counts
from tierflow.plans.pipeline import read_quarantine, read_silver
from tierflow.streaming import bronze_schema, memory, silver
from tierflow.streaming.batches import is_committed

RAW = T.StructType().add("Name", T.StringType()).add("Size", T.DoubleType())


@pytest.fixture
def config(tmp_path):
    return PipelineConfig(base_uri=str(tmp_path), raw_schema=RAW)


def arrive(spark, config, names, day=1):
    """One bronze file, as one batch of silver."""
    at = datetime.datetime(2024, 1, day)
    rows = [(n, 1.5, at, "file", None) for n in names]
    schema = bronze_schema(RAW)
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(Layers(config).bronze)


def held(spark, config):
    return sorted(r["name"] for r in read_silver(spark, config).collect())


def test_digests_tell_records_apart(spark):
    rows = [
        ("a", "b", 0.0, None, b"x", [1], datetime.datetime(2024, 1, 1)),
        ("a", "b", -0.0, None, b"x", [1], datetime.datetime(2024, 1, 1)),
        ("ab", "", 0.0, None, b"x", [1], datetime.datetime(2024, 1, 1)),
        ("a", "b", 0.0, "", b"x", [1], datetime.datetime(2024, 1, 1)),
        ("a", "b", 0.0, None, b"y", [1], datetime.datetime(2024, 1, 1)),
        ("a", "b", 0.0, None, b"x", [1, None], datetime.datetime(2024, 1, 1)),
        (None, None, float("nan"), None, None, None, None),
        (None, None, float("nan"), None, None, None, None),
        (None,) * 7,
    ]
    df = spark.createDataFrame(rows, "p string, q string, d double, n string, b binary, a array<int>, t timestamp")
    keyed = df.withColumn("digest", record_digest(df.schema, df.columns))
    found = [r["digest"] for r in keyed.collect()]
    assert all(len(d) == 32 for d in found)
    assert len(set(found)) == df.distinct().count() == 7
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        again = df.withColumn("digest", record_digest(df.schema, reversed(df.columns)))
        assert [r["digest"] for r in again.collect()] == found
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    # a column without a value, and one that is not there, are the same
    less = df.drop("n")
    assert less.filter("p = 'ab'").select(record_digest(less.schema, less.columns)).first()[0] == found[2]


def test_a_batch_reads_its_own_buckets_only(spark, config, monkeypatch):
    """What a batch reads stays flat while the table grows, and no record is read."""
    monkeypatch.setattr(memory, "BUCKET_ROWS", 12)
    read = []
    digests = memory.digests

    def counted(session, path, buckets=None):
        found = digests(session, path, buckets)
        if buckets is not None:
            read.append((found.count(), found.inputFiles()))
        return found

    monkeypatch.setattr(memory, "digests", counted)
    monkeypatch.setattr(silver.memory, "digests", counted)
    arrive(spark, config, [f"first {i}" for i in range(60)])
    stream_silver(spark, config)
    for step in range(3):
        arrive(spark, config, [f"small {step} {i}" for i in range(3)] + ["first 7"])
        stream_silver(spark, config)
        arrive(spark, config, [f"large {step} {i}" for i in range(60)])
        stream_silver(spark, config)
    assert len(held(spark, config)) == 60 * 4 + 9
    small = [rows for rows, _ in read[1::2]]
    assert len(small) == 3 and max(small) <= 4 * 12 * 1.5  # four records, four buckets
    assert all("_digests" in file for _, files in read for file in files)


def test_runs_are_merged(spark, config, monkeypatch):
    monkeypatch.setattr(memory, "MOST_RUNS", 3)
    for i in range(7):
        arrive(spark, config, [f"r{i}", "always"])
        stream_silver(spark, config)
        (place,) = (p for _, _, p in memory._generations(spark, Layers(config).silver))
        assert len(memory._sizes(spark, place)) <= 3
    assert held(spark, config) == ["always", *(f"r{i}" for i in range(7))]
    assert memory.digests(spark, Layers(config).silver).select("digest").distinct().count() == 8


def test_a_replaced_table_has_a_new_memory(spark, config):
    arrive(spark, config, ["a", "b"])
    stream_silver(spark, config)
    arrive(spark, config, ["b", "c"])
    run_silver(spark, config)  # also takes what the stream has not seen
    assert not memory.exists(spark, Layers(config).silver)
    stream_silver(spark, config)
    arrive(spark, config, ["c", "d"])
    stream_silver(spark, config)
    assert held(spark, config) == ["a", "b", "c", "d"]


@pytest.mark.parametrize("step", ["refine", "rows", "log", "digests", "commit"])
def test_a_rerun_after_a_failure(spark, config, monkeypatch, tmp_path, step):
    """A batch that fails at any step, and is run again, is in the table once."""
    arrive(spark, config, ["a", "b"])
    stream_silver(spark, config)
    arrive(spark, config, ["b", "c", "c"])
    path = Layers(config).silver

    def fail(*args, **kwargs):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        if step == "refine":
            broken.setattr(storage, "staged", fail)
        elif step == "rows":
            broken.setattr(storage, "publish", fail)
        elif step == "log":
            broken.setattr(storage, "write_new", fail)
        elif step == "digests":
            broken.setattr(memory, "add", fail)
        if step != "commit":
            with pytest.raises(Exception, match="lost"):
                stream_silver(spark, config)
    if step == "commit":
        stream_silver(spark, config)
        commits = tmp_path / "silver" / "_checkpoints" / "streaming_v1" / "commits"
        (commits / "1").unlink()
        (commits / ".1.crc").unlink(missing_ok=True)
    assert is_committed(spark, path, 1) == (step in ("digests", "commit"))
    stream_silver(spark, config)
    assert held(spark, config) == ["a", "b", "c"]
    arrive(spark, config, ["c", "d"])
    stream_silver(spark, config)
    assert held(spark, config) == ["a", "b", "c", "d"]


def test_records_meet_hits_only(spark, config):
    """The plan of a batch reads digests and the batch, not the table."""
    arrive(spark, config, ["a", "b"])
    stream_silver(spark, config)
    path = Layers(config).silver
    batch = spark.createDataFrame([("b", 1.5, None), ("z", 1.5, None)], "name string, size double, ingestion_time timestamp")
    with storage.staged(silver._keyed(batch, ("ingestion_time",)), "refined") as keyed:
        fresh = silver._fresh(spark, keyed, path, ("ingestion_time",), "parquet")
        assert [r["name"] for r in fresh.collect()] == ["z"]
        files = fresh.inputFiles()
        assert files and all("_digests" in f or "refined-" in f for f in files)
        assert fresh.filter(F.col("size") != 1.5).isEmpty()
    assert not [f for f in files if "refined-" in f and storage.exists(spark, f)]


def rules_config(tmp_path, action):
    rules = {"short": "length(name) < 3", "known": "name <> 'x'"}
    return PipelineConfig(base_uri=str(tmp_path), raw_schema=RAW, expectations=rules, on_violation=action)


@pytest.mark.parametrize("action", ["warn", "drop", "quarantine"])
def test_counts_of_streams_equal_those_of_a_whole_run(spark, tmp_path, action):
    """A record that comes again is not counted again, whether it was taken or not."""
    config = rules_config(tmp_path, action)
    for names in (["a", "x", "long", None], ["x", "long", "b", "longer"], ["a"]):
        arrive(spark, config, names)
        stream_silver(spark, config)
    streamed = streamed_counts(spark, config)
    assert streamed == {"row_count": 6, "short": 3, "known": 2}
    stayed = [r["name"] for r in read_silver(spark, config).collect()]
    assert len(stayed) == (6 if action == "warn" else 2)

    def rejected():
        rows = read_quarantine(spark, config)
        assert rows.columns == [*read_silver(spark, config).columns, "_violated"]
        return sorted((r["name"] or "", r["_violated"]) for r in rows.collect())

    wanted = [("", ["short", "known"]), ("long", ["short"]), ("longer", ["short"]), ("x", ["known"])]
    if action == "quarantine":
        assert rejected() == wanted
    assert run_silver(spark, config) == streamed
    if action == "quarantine":
        assert rejected() == wanted
    assert sorted(map(str, stayed)) == sorted(str(r["name"]) for r in read_silver(spark, config).collect())


def test_a_stream_that_fails_on_a_violation(spark, tmp_path):
    config = rules_config(tmp_path, "fail")
    arrive(spark, config, ["a", "x"])
    with pytest.raises(Exception, match="violated: known"):
        stream_silver(spark, config)
    with pytest.raises(ValueError, match="on_violation"):
        rules_config(tmp_path, "hide")


def test_a_quarantined_batch_that_is_run_again(spark, tmp_path, monkeypatch):
    config = rules_config(tmp_path, "quarantine")
    arrive(spark, config, ["a", "x"])
    with monkeypatch.context() as broken:
        broken.setattr(memory, "add", lambda *_: 1 / 0)
        with pytest.raises(Exception, match="division"):
            stream_silver(spark, config)
    stream_silver(spark, config)
    assert read_quarantine(spark, config).count() == 1 and held(spark, config) == ["a"]
    assert streamed_counts(spark, config) == {"row_count": 2, "short": 0, "known": 1}


def test_records_are_staged_once_where_none_is_held(spark, config, monkeypatch):
    labels = []
    staged = storage.staged
    monkeypatch.setattr(storage, "staged", lambda df, label: labels.append((label, df.columns)) or staged(df, label))
    for names in (["a", "b"], ["c", "c", "d"], ["d", "e"]):
        arrive(spark, config, names)
        stream_silver(spark, config)
    assert held(spark, config) == ["a", "b", "c", "d", "e"]
    assert [label for label, _ in labels] == ["refined", "refined", "near", "refined", "near", "fresh"]
    assert all("__digest" not in columns for _, columns in labels)


def test_digests_are_kept_as_bytes_in_as_many_buckets_as_due(spark, config, monkeypatch):
    """A large first batch makes its buckets at once; 16 bytes a digest."""
    monkeypatch.setattr(memory, "BUCKET_ROWS", 4)
    written = []
    write = memory._write_run
    monkeypatch.setattr(memory, "_write_run", lambda *args: written.append(args[4]) or write(*args))
    arrive(spark, config, [f"n{i}" for i in range(40)])
    stream_silver(spark, config)
    assert written == ["base"]
    found = memory.digests(spark, Layers(config).silver)
    assert [r[0] for r in found.select(F.octet_length("digest")).distinct().collect()] == [16] and found.count() == 40


def test_a_short_hash_in_common_drops_no_record(spark, config, monkeypatch):
    monkeypatch.setattr(silver, "_short", lambda: F.lit(1).cast("long").alias("short"))
    for names in (["a", "b"], ["b", "c"], ["d"]):
        arrive(spark, config, names)
        stream_silver(spark, config)
    assert held(spark, config) == ["a", "b", "c", "d"]
