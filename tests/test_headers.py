import json
import os

import pytest
from pyspark.sql import types as T

from tierflow import PipelineConfig, storage
from tierflow.plans import Layers, run_bronze, run_silver, stream_silver
from tierflow.plans.pipeline import RescuedValues, raw_schema, read_bronze, read_silver
from tierflow.sources import add_schema, by_header, infer_by_header, latest_schema, schema_versions
from tierflow.sources.headers import wider
from tierflow.streaming import append_stream, batch_log, headed_rows

RAW = T.StructType().add("Artist", T.StringType()).add("Plays (All)", T.LongType()).add("Year", T.IntegerType())


@pytest.fixture
def config(tmp_path):
    (tmp_path / "source" / "streaming").mkdir(parents=True)
    return PipelineConfig(base_uri=str(tmp_path), raw_schema=RAW, on_rescued="keep")


def drop(config, name, *lines):
    path = f"{Layers(config).source}/{name}"
    with open(path, "w") as file:
        file.write("".join(line + "\n" for line in lines))
    return path


def rows(df):
    """Rows by artist, without lineage."""
    names = [c for c in df.columns if c not in ("ingestion_time", "source_file")]
    return {r["artist"]: tuple(r[c] for c in names[1:]) for r in df.select(*names).collect()}


def test_columns_follow_each_files_header(spark, config):
    drop(config, "a.csv", "Artist,Plays (All),Year", "Ann,1,2001", "Abe,x,2002")
    drop(config, "b.csv", "Year,Artist,Plays (All)", "2003,Bob,3")
    drop(config, "c.csv", "Artist,Label,Year,Plays (All)", "Cid,Blue,2004,4", "Cox,,2004,4")
    drop(config, "d.csv", "plays (all) ,ARTIST", "5,Dan")
    drop(config, "e.csv", "", "Artist,Plays (All),Year", "Eve,6,2006,more", "Ede,7,2007")
    drop(config, "f.csv")
    drop(config, "g.csv", "Artist,Plays (All),Year")
    run_bronze(spark, config)
    bronze = read_bronze(spark, config)
    assert bronze.columns == ["artist", "plays_all", "year", "ingestion_time", "source_file", "_rescued_data"]
    got = rows(bronze)
    rescued = {name: json.loads(r[2]) for name, r in got.items() if r[2]}
    assert {name: r[:2] for name, r in got.items()} == {
        "Ann": (1, 2001),
        "Abe": (None, 2002),
        "Bob": (3, 2003),
        "Cid": (4, 2004),
        "Cox": (4, 2004),
        "Dan": (5, None),
        "Eve": (6, 2006),
        "Ede": (7, 2007),
    }
    assert rescued == {
        "Abe": {"plays_all": "x"},
        "Cid": {"_unknown_fields": '{"label":"Blue"}'},
        "Eve": {"_malformed_line": "Eve,6,2006,more"},
    }
    files = {r["artist"]: r["source_file"].rsplit("/", 1)[1] for r in bronze.collect()}
    assert files["Bob"] == "b.csv" and files["Ede"] == "e.csv"
    assert bronze.select("ingestion_time").distinct().count() == 1


def test_new_columns_stop_silver_unless_kept(spark, config, tmp_path):
    drop(config, "a.csv", "Artist,Plays (All),Year,Label", "Ann,1,2001,Blue")
    strict = PipelineConfig(base_uri=str(tmp_path), raw_schema=RAW)
    run_bronze(spark, strict)
    with pytest.raises(RescuedValues, match="_unknown_fields.*a.csv"):
        run_silver(spark, strict)
    run_silver(spark, config)
    assert read_silver(spark, config).count() == 1


def test_names_that_meet(spark, config):
    """Two columns of one cleaned name, and columns called like the lineage, lose nothing."""
    drop(config, "a.csv", "Artist,artist,Plays (All),source_file,Year", "Ann,Amy,1,disk,2001")
    run_bronze(spark, config)
    (row,) = read_bronze(spark, config).collect()
    assert (row["artist"], row["plays_all"], row["year"]) == ("Ann", 1, 2001)
    unknown = json.loads(json.loads(row["_rescued_data"])["_unknown_fields"])
    assert unknown == {"artist_1": "Amy", "source_file_3": "disk"}
    assert row["source_file"].endswith("a.csv")


def test_file_names_are_no_patterns(spark, config):
    drop(config, "x[1]{a} b*.csv", "Artist,Plays (All),Year", "Ann,1,2001")
    drop(config, "x1a b.csv", "Year,Artist,Plays (All)", "2002,Bob,2")
    run_bronze(spark, config)
    assert rows(read_bronze(spark, config)) == {"Ann": (1, 2001, None), "Bob": (2, 2002, None)}


def test_quotes_and_separators_are_those_of_the_reader(spark, config):
    path = drop(config, "a.csv", '"Plays (All)";"Year";"Artist; full"', '1;2001;"Ann; Lee"')
    schema = T.StructType().add("Artist; full", T.StringType()).add("Year", T.IntegerType())
    got, _ = headed_rows(spark, [path], schema, sep=";")
    row = got.first()
    assert (row["artist;_full"], row["year"]) == ("Ann; Lee", 2001)


def test_no_shuffle(spark, config):
    paths = [
        drop(config, "a.csv", "Artist,Plays (All),Year", "Ann,1,2001"),
        drop(config, "b.csv", "Year,Artist", "2002,Bob"),
    ]
    got, _ = headed_rows(spark, paths, RAW)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("FileScan csv") == 2


def test_a_repeated_batch_is_written_once(spark, config, tmp_path):
    """The checkpoint lost its last commit, once before and once after the batch was logged."""
    drop(config, "a.csv", "Artist,Plays (All),Year", "Ann,1,2001")
    run_bronze(spark, config)
    layers = Layers(config)
    before = storage.names_in(spark, layers.bronze)
    commit = tmp_path / "bronze" / "_checkpoints" / "streaming_v1" / "commits"
    for entry in (None, tmp_path / "bronze" / "streaming" / "v1" / "_batches" / "0000000000.json"):
        for file in commit.iterdir():
            file.unlink()
        if entry:
            entry.unlink()
        run_bronze(spark, config)
        assert rows(read_bronze(spark, config)) == {"Ann": (1, 2001, None)}
        assert storage.names_in(spark, layers.bronze) == before


def test_a_failed_batch_leaves_nothing(spark, config):
    drop(config, "a.csv", "Artist,Plays (All),Year", "Ann,1,2001")
    drop(config, "b.csv", "Artist,Plays (All),Year", "Bob,2,2002,more")
    with pytest.raises(Exception, match="(?i)malformed"):
        run_bronze(spark, config, mode="FAILFAST")
    with pytest.raises(Exception, match="nope"):
        run_bronze(spark, config, encoding="nope")
    assert read_bronze(spark, config).isEmpty()
    run_bronze(spark, config)
    assert {k: v[:2] for k, v in rows(read_bronze(spark, config)).items()} == {"Ann": (1, 2001), "Bob": (2, 2002)}


def test_in_place_writes_and_bounded_batches(spark, tmp_path, config):
    placed = PipelineConfig(base_uri=str(tmp_path), raw_schema=RAW, swap=False)
    for i in range(3):
        drop(config, f"{i}.csv", "Artist,Plays (All),Year", f"A{i},1,2001")
    run_bronze(spark, placed, maxFilesPerTrigger=1)
    log = batch_log(spark, Layers(placed).bronze, "batch long, schema long, files long")
    assert sorted(map(tuple, log.collect())) == [(0, 0, 1), (1, 0, 1), (2, 0, 1)]
    assert read_bronze(spark, placed).count() == 3


# ---- a schema that grows -------------------------------------------------------------------------


def growing(tmp_path, schema=None):
    return PipelineConfig(base_uri=str(tmp_path), raw_schema=schema, new_columns="add")


def test_new_columns_are_added_as_versions(spark, config, tmp_path):
    grown = growing(tmp_path)
    layers = Layers(grown)
    drop(config, "a.csv", "Artist,Plays (All)", "Ann,1")
    run_bronze(spark, grown)
    run_silver(spark, grown)
    drop(config, "b.csv", "Label,Plays (All),Artist,Rate", "Blue,2,Bob,0.5", ",3,Bea,1")
    run_bronze(spark, grown)
    drop(config, "c.csv", "Artist", "Cid")
    drop(config, "d.csv", "Artist,Plays (All),Rate", "Dan,many,2")
    run_bronze(spark, grown)
    versions = schema_versions(spark, layers.schema_store)
    assert {n: s.fieldNames() for n, s in versions.items()} == {
        1: ["Artist", "Plays (All)"],
        2: ["Artist", "Plays (All)", "Label", "Rate"],
    }
    assert versions[2]["Rate"].dataType == T.DoubleType()
    assert raw_schema(spark, grown) == versions[2]
    assert rows(read_bronze(spark, grown)) == {
        "Ann": (1, None, None, None),
        "Bob": (2, "Blue", 0.5, None),
        "Bea": (3, None, 1.0, None),
        "Cid": (None, None, None, None),
        "Dan": (None, None, 2.0, '{"plays_all":"many"}'),
    }
    log = batch_log(spark, layers.bronze, "batch long, schema long, files long")
    assert sorted(map(tuple, log.collect())) == [(0, 1, 1), (1, 2, 1), (2, 2, 2)]
    with pytest.raises(ValueError, match="new_columns"):
        PipelineConfig(base_uri=str(tmp_path), new_columns="drop")


def test_growth_within_one_run(spark, config, tmp_path):
    """The first batch of a run adds a column that the second one already knows, and the third adds to that."""
    grown = growing(tmp_path, RAW)
    for i, (header, line) in enumerate(
        [("Artist,Label", "Ann,Blue"), ("Label,Artist", "Red,Bob"), ("Artist,Label,Rate", "Cid,Green,3")]
    ):
        os.utime(drop(config, f"{i}.csv", header, line), (1000 + i, 1000 + i))
    run_bronze(spark, grown, maxFilesPerTrigger=1)
    log = batch_log(spark, Layers(grown).bronze, "batch long, schema long")
    assert sorted(map(tuple, log.collect())) == [(0, 2), (1, 2), (2, 3)]
    got = rows(read_bronze(spark, grown))
    assert {k: v[2:4] for k, v in got.items()} == {"Ann": ("Blue", None), "Bob": ("Red", None), "Cid": ("Green", 3)}


def test_silver_streams_across_versions(spark, config, tmp_path):
    """A record that comes again after a column was added is the same, as long as it has no value there."""
    grown = growing(tmp_path)
    drop(config, "a.csv", "Artist,Plays (All)", "Ann,1", "Amy,1")
    run_bronze(spark, grown)
    stream_silver(spark, grown)
    drop(config, "b.csv", "Artist,Plays (All),Label", "Ann,1,", "Amy,1,Blue")
    run_bronze(spark, grown)
    stream_silver(spark, grown)
    silver = read_silver(spark, grown)
    assert "label" in silver.columns
    assert sorted((r["artist"], r["plays_all"], r["label"] or "") for r in silver.collect()) == [
        ("Amy", 1, ""),
        ("Amy", 1, "Blue"),
        ("Ann", 1, ""),
    ]


def test_two_writers_of_a_version(spark, tmp_path, monkeypatch):
    """Whoever comes second finds the other's columns and appends its own."""
    path = str(tmp_path / "log")
    first = T.StructType().add("A", T.StringType())
    assert add_schema(spark, path, first) == (1, first)
    assert add_schema(spark, path, first) == (1, first)
    write, other = storage.write_new, first.add("C", T.LongType())

    def overtaken(session, name, text):
        monkeypatch.setattr(storage, "write_new", write)
        add_schema(session, path, T.StructType().add("A", T.StringType()).add("B", T.LongType()))
        return write(session, name, text)

    monkeypatch.setattr(storage, "write_new", overtaken)
    number, schema = add_schema(spark, path, other)
    assert (number, schema.fieldNames()) == (3, ["A", "B", "C"])
    assert latest_schema(spark, path)[0] == 3 and len(schema_versions(spark, path)) == 3


def test_an_unfinished_entry_is_passed_over(spark, tmp_path):
    path = tmp_path / "log"
    schema = T.StructType().add("A", T.StringType())
    add_schema(spark, str(path), schema)
    (path / "00000002.json").write_text('{"version": 2, "sch')
    assert latest_schema(spark, str(path)) == (1, schema)
    assert add_schema(spark, str(path), schema.add("B", T.LongType()))[0] == 3


def test_types_across_headers(spark, config):
    paths = [
        drop(config, "a.csv", "N,M,T", "1,1,1"),
        drop(config, "b.csv", "T,M,N", "x,2.5,3000000000"),
    ]
    found = infer_by_header(spark, by_header(spark, paths))
    assert {f.name: f.dataType for f in found} == {"N": T.LongType(), "M": T.DoubleType(), "T": T.StringType()}
    assert wider(T.DateType(), T.TimestampType()) == T.StringType()


def test_positional_streams_keep_their_paths(spark, config):
    drop(config, "a.csv", "Artist,Plays (All),Year", "Ann,1,2001")
    run_bronze(spark, config)
    from tierflow.streaming import bronze_stream

    layers = Layers(config)
    with pytest.raises(ValueError, match="another checkpoint"):
        append_stream(bronze_stream(spark, layers.source, RAW), layers.bronze, layers.checkpoint() + "x")
