import json
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow import PipelineConfig
from tierflow.plans import (
    Layers,
    layer_checks,
    register_tables,
    run_bronze,
    run_gold,
    run_pipeline,
    run_silver,
    stream_silver,
)
from tierflow.plans.pipeline import RescuedValues, raw_schema, read_bronze, read_silver
from tierflow.sources import read_file_stream, read_table
from tierflow.streaming import append_stream, bronze_schema, bronze_stream

RAW = (
    T.StructType()
    .add("Country", T.StringType())
    .add("Artist", T.StringType())
    .add("Album", T.StringType())
    .add("Genre", T.StringType())
    .add("Release Year", T.IntegerType())
    .add("Total Streams (Millions)", T.DoubleType())
    .add("Streams Last 30 Days (Millions)", T.DoubleType())
    .add("Avg Stream Duration (Min)", T.DoubleType())
    .add("Skip Rate (%)", T.DoubleType())
)
HEADER = ",".join(RAW.fieldNames())

CHUNK_1 = [
    "SE,Ann,First,Pop,2020,10.5,1.25,3.5,20",
    "SE,Ann,First,Pop,2020,10.5,1.25,3.5,20",
    "DE,Bob,Second,,2021,4.25,2.5,,30",
    "DE,Bob,Third,Rock,2021,,3.5,4,n/a",
]
CHUNK_2 = [
    "SE,Ann,First,Pop,2020,10.5,1.25,3.5,20",
    ",,Fourth,Jazz,,7,0.5,2.25,10",
]


@pytest.fixture
def config(tmp_path):
    config = PipelineConfig(base_uri=str(tmp_path), raw_schema=RAW, on_rescued="keep")
    (tmp_path / "source" / "streaming").mkdir(parents=True)
    return config


def drop(config, name, lines, header=HEADER, below=""):
    path = Layers(config).source + below
    with open(f"{path}/{name}", "w") as file:
        file.write("\n".join([header, *lines]) + "\n")


def bronze_count(spark, config):
    return read_bronze(spark, config).count()


def test_each_file_is_ingested_once(spark, config):
    run_bronze(spark, config, timeout=300)
    assert bronze_count(spark, config) == 0
    drop(config, "chunk_1.csv", CHUNK_1)
    drop(config, "notes.txt", ["x"])
    run_bronze(spark, config)
    assert bronze_count(spark, config) == 4
    run_bronze(spark, config)
    assert bronze_count(spark, config) == 4
    drop(config, "chunk_2.csv", CHUNK_2)
    run_bronze(spark, config)
    rows = read_bronze(spark, config)
    assert rows.count() == 6
    assert rows.columns[-3:] == ["ingestion_time", "source_file", "_rescued_data"]
    assert rows.select("ingestion_time").distinct().count() == 2
    names = {r[0].rsplit("/", 1)[1] for r in rows.select("source_file").distinct().collect()}
    assert names == {"chunk_1.csv", "chunk_2.csv"}
    (rescued,) = rows.filter("_rescued_data is not null").collect()
    assert rescued["_rescued_data"] == '{"skip_rate_%":"n/a"}' and rescued["skip_rate_%"] is None


def test_nested_directories_are_left_out(spark, config, tmp_path):
    (tmp_path / "source" / "streaming" / "deep").mkdir()
    drop(config, "chunk_1.csv", CHUNK_1)
    drop(config, "chunk_2.csv", CHUNK_2, below="/deep")
    run_bronze(spark, config, trigger="once")
    assert bronze_count(spark, config) == 4


def test_a_new_checkpoint_version_reads_all_again(spark, config, tmp_path):
    drop(config, "chunk_1.csv", CHUNK_1)
    run_bronze(spark, config)
    again = PipelineConfig(base_uri=str(tmp_path), raw_schema=RAW, checkpoint_version="v2")
    drop(config, "chunk_2.csv", CHUNK_2)
    run_bronze(spark, again)
    assert bronze_count(spark, config) == 4 and bronze_count(spark, again) == 6
    layers = Layers(config)
    with pytest.raises(ValueError, match="another checkpoint"):
        append_stream(
            bronze_stream(spark, layers.source, RAW), layers.bronze, layers.checkpoint() + "x"
        )


@pytest.mark.parametrize(
    "header",
    [HEADER.replace("Country,Artist", "Artist,Country"), HEADER + ",Extra"],
    ids=["reordered", "extra"],
)
def test_a_differing_header_stops_a_stream_bound_by_position(spark, config, header):
    layers = Layers(config)

    def run():
        append_stream(bronze_stream(spark, layers.source, RAW), layers.bronze, layers.checkpoint())

    drop(config, "chunk_1.csv", CHUNK_1)
    run()
    lines = [line + ",1" for line in CHUNK_2] if "Extra" in header else CHUNK_2
    drop(config, "chunk_2.csv", lines, header=header)
    with pytest.raises(Exception, match="header|chunk_2" if "Extra" in header else "chunk_2"):
        run()
    assert bronze_count(spark, config) == 4
    with pytest.raises(ValueError, match="another kind of stream"):
        run_bronze(spark, config)


def test_lines_that_do_not_parse_are_rescued(spark, config):
    drop(config, "chunk_1.csv", [CHUNK_1[0], CHUNK_1[0] + ",more", "SE,Ann"])
    run_bronze(spark, config)
    rows = read_bronze(spark, config).orderBy(F.length("_rescued_data")).collect()
    rescued = [r["_rescued_data"] and json.loads(r["_rescued_data"]) for r in rows]
    assert rescued == [
        None,
        {"_malformed_line": "SE,Ann"},
        {"_malformed_line": CHUNK_1[0] + ",more"},
    ]
    assert {r["artist"] for r in rows} == {"Ann"}


@pytest.mark.parametrize("source_format", ["json", "parquet"])
def test_other_source_formats(spark, tmp_path, source_format):
    config = PipelineConfig(base_uri=str(tmp_path), raw_schema=RAW, source_format=source_format)
    layers = Layers(config)
    rows = spark.createDataFrame([("SE", "Ann", "First", "Pop", 2020, 10.5, 1.25, 3.5, 20.0)], RAW)
    rows.write.format(source_format).save(layers.source)
    if source_format == "json":
        drop(config, "late.json", ['{"Artist": "Bob", "Release Year": "soon"}'], header="{broken")
    run_bronze(spark, config)
    got = read_bronze(spark, config)
    ann = got.filter("artist = 'Ann'").first()
    assert ann["release_year"] == 2020 and ann["skip_rate_%"] == 20.0
    assert ann["_rescued_data"] is None
    if source_format == "json":
        assert got.filter("artist = 'Bob'").first()["_rescued_data"] == '{"release_year":"soon"}'
        assert got.filter("artist is null").first()["_rescued_data"] == '{"_malformed_line":"{broken"}'


def test_batches_can_be_bounded(spark, config):
    drop(config, "chunk_1.csv", CHUNK_1)
    drop(config, "chunk_2.csv", CHUNK_2)
    run_bronze(spark, config, maxFilesPerTrigger=1)
    assert read_bronze(spark, config).select("ingestion_time").distinct().count() == 2


def test_a_running_stream_and_a_timeout(spark, config, tmp_path):
    drop(config, "chunk_1.csv", CHUNK_1)
    layers = Layers(config)
    rows = bronze_stream(spark, layers.source, RAW)
    query = append_stream(rows, layers.bronze, layers.checkpoint(), trigger="200 milliseconds")
    try:
        query.processAllAvailable()
        drop(config, "chunk_2.csv", CHUNK_2)
        time.sleep(0.5)
        query.processAllAvailable()
        assert query.isActive and bronze_count(spark, config) == 6
    finally:
        query.stop()
    slow = read_file_stream(spark, layers.source, RAW)
    with pytest.raises(TimeoutError, match="0.01"):
        append_stream(slow, str(tmp_path / "slow"), str(tmp_path / "c"), timeout=0.01)


def test_positional_ingestion_has_no_shuffle(spark, config):
    drop(config, "chunk_1.csv", CHUNK_1)
    layers = Layers(config)
    query = append_stream(
        bronze_stream(spark, layers.source, RAW), layers.bronze, layers.checkpoint()
    )
    assert "Exchange" not in query._jsq.explainInternal(False)


def test_copies_in_a_later_batch(spark, config):
    for name, lines in (("chunk_1.csv", CHUNK_1), ("chunk_2.csv", CHUNK_2)):
        drop(config, name, lines)
        run_bronze(spark, config)
    run_silver(spark, config, dedup_by="row")
    assert read_silver(spark, config).count() == 5
    run_silver(spark, config)
    silver = read_silver(spark, config)
    assert silver.count() == 4
    assert "source_file" not in silver.columns and "_rescued_data" not in silver.columns
    assert silver.columns[-1] == "silver_transform_time"
    first = read_bronze(spark, config).agg(F.min("ingestion_time")).first()[0]
    assert silver.filter("album = 'First'").first()["ingestion_time"] == first
    with pytest.raises(ValueError, match="dedup_by"):
        run_silver(spark, config, dedup_by="luck")


def test_silver_is_shaped_as_configured(spark, tmp_path):
    (tmp_path / "source" / "streaming").mkdir(parents=True)
    shape = {
        "text_columns": ("artist", "genre"),
        "required_columns": ("artist",),
        "expectations": {"known_genre": "genre is not null", "recent": "release_year > 2020"},
    }
    config = PipelineConfig(base_uri=str(tmp_path), raw_schema=RAW, **shape)
    same = ["SE, Ann  Lee ,First,Pop,2021,1,1,1,1", "SE,Ann Lee,First, Pop,2021,1,1,1,1"]
    drop(config, "chunk_1.csv", [*same, "DE,Bob,Second,  ,2020,1,1,1,1", "DE,  ,Third,Pop,2022,1,1,1,1"])
    run_bronze(spark, config)
    assert run_silver(spark, config) == {"row_count": 2, "known_genre": 1, "recent": 1}
    assert {r["artist"] for r in read_silver(spark, config).collect()} == {"Ann Lee", "Bob"}
    dropping = PipelineConfig(
        base_uri=str(tmp_path), raw_schema=RAW, on_violation="drop", text_case="upper", **shape
    )
    run_silver(spark, dropping)
    (kept,) = read_silver(spark, dropping).collect()
    assert (kept["artist"], kept["genre"]) == ("ANN LEE", "POP")
    failing = PipelineConfig(
        base_uri=str(tmp_path), raw_schema=RAW, on_violation="fail", **shape
    )
    with pytest.raises(Exception, match="known_genre|recent"):
        run_silver(spark, failing)
    assert read_silver(spark, failing).count() == 1


def gold(spark, config, model):
    return read_table(spark, Layers(config).gold(model))


def test_new_chunks_flow_through_to_gold(spark, config):
    drop(config, "chunk_1.csv", CHUNK_1)
    assert set(run_pipeline(spark, config).values()) == {True}
    totals = gold(spark, config, "top_songs_by_streams")
    assert totals.columns == ["album", "artist", "total_streams_millions", "gold_model_time"]
    assert [tuple(r)[:3] for r in totals.collect()] == [
        ("First", "Ann", 10.5),
        ("Second", "Bob", 4.25),
    ]

    drop(config, "chunk_2.csv", CHUNK_2)
    stale = run_pipeline(spark, config, gold_mode="once")
    assert set(stale.values()) == {False}
    assert gold(spark, config, "top_songs_by_streams").count() == 2

    run_gold(spark, config)
    albums = [r["album"] for r in gold(spark, config, "top_songs_by_streams").collect()]
    assert albums == ["First", "Fourth", "Second"]
    ranked = gold(spark, config, "top_streams_by_year")
    assert sorted((r["album"], r["release_year"], r["rank_in_year"]) for r in ranked.collect()) == [
        ("First", 2020, 1),
        ("Fourth", None, 1),
        ("Second", 2021, 2),
        ("Third", 2021, 1),
    ]
    genres = gold(spark, config, "avg_duration_by_genre").drop("gold_model_time")
    assert [tuple(r) for r in genres.collect()] == [
        ("Rock", 4.0),
        ("Pop", 3.5),
        ("Jazz", 2.25),
        (None, None),
    ]
    countries = gold(spark, config, "genre_country_platform").drop("gold_model_time")
    assert [tuple(r) for r in countries.collect()] == [
        ("DE", 6.0, 30.0),
        ("SE", 1.25, 20.0),
        (None, 0.5, 10.0),
    ]
    years = gold(spark, config, "yearly_stream_trends").drop("gold_model_time")
    assert [tuple(r) for r in years.collect()] == [
        (None, 1, 7.0, None),
        (2020, 1, 10.5, None),
        (2021, 2, 4.25, -6.25),
    ]
    assert [r["artist"] for r in gold(spark, config, "top_artists").collect()] == ["Ann", None, "Bob"]

    checks = {name: tuple(df.first()) for name, df in layer_checks(spark, config).items()}
    assert checks == {
        "row_counts": (6, 4, 3, 3, 3),
        "null_counts": (1, 0),
        "distinct_counts": (2, 2),
    }
    with pytest.raises(ValueError, match="mode"):
        run_gold(spark, config, mode="never")


def test_layers_by_catalog_name(spark, config, tmp_path):
    schemas = {layer: f"named_{layer}" for layer in ("bronze", "silver", "gold")}
    named = PipelineConfig(
        base_uri=str(tmp_path), raw_schema=RAW, catalog="spark_catalog", schemas=schemas, on_rescued="keep"
    )
    layers = Layers(named)
    sql = f"""
        SELECT
          (SELECT COUNT(*) FROM {layers.qualify("bronze", "streaming")}) AS bronze_rows,
          (SELECT COUNT(*) FROM {layers.qualify("silver", "streaming")}) AS silver_rows,
          (SELECT COUNT(*) FROM {layers.qualify("bronze", "streaming")} WHERE Artist IS NULL) AS nulls,
          (SELECT COUNT(DISTINCT Artist) FROM {layers.qualify("gold", "top_artists")}) AS artists
    """
    for name, lines, expected in (
        ("chunk_1.csv", CHUNK_1, (4, 3, 0, 2)),
        ("chunk_2.csv", CHUNK_2, (6, 4, 1, 2)),
    ):
        drop(named, name, lines)
        run_pipeline(spark, named)
        assert len(register_tables(spark, named)) == 9
        assert tuple(spark.sql(sql).first()) == expected


def test_schema_is_inferred_once_and_kept(spark, config, tmp_path):
    open_config = PipelineConfig(base_uri=str(tmp_path))
    with pytest.raises(ValueError, match="no csv"):
        raw_schema(spark, open_config)
    drop(config, "chunk_1.csv", CHUNK_1[:2])
    inferred = raw_schema(spark, open_config)
    assert inferred.fieldNames() == RAW.fieldNames()
    assert inferred["Release Year"].dataType == T.IntegerType()
    run_bronze(spark, open_config)
    drop(config, "chunk_2.csv", ["SE,Ann,Fifth,Pop,soon,1,1,1,1"])
    run_bronze(spark, open_config)
    assert raw_schema(spark, open_config) == inferred
    late = read_bronze(spark, open_config).filter("album = 'Fifth'").first()
    assert late["release_year"] is None and late["_rescued_data"] == '{"release_year":"soon"}'


def test_types_hold_for_all_files(spark, config, tmp_path):
    open_config = PipelineConfig(base_uri=str(tmp_path))
    for i in range(12):
        drop(config, f"chunk_{i:02}.csv", [f"SE,A{i},B,Pop,2020,{i if i < 10 else i + 0.75},1,1,1"])
    run_bronze(spark, open_config)
    run_silver(spark, open_config)
    total = read_silver(spark, open_config).agg(F.sum("total_streams_millions"), F.count("total_streams_millions"))
    assert tuple(total.first()) == (66 + 1.5, 12)


def test_a_value_that_does_not_fit_stops_silver(spark, config, tmp_path):
    strict = PipelineConfig(base_uri=str(tmp_path), raw_schema=RAW)
    drop(config, "chunk_1.csv", ["SE,Ann,First,Pop,2020.5,10.5,1.25,3.5,20"])
    run_bronze(spark, strict)
    with pytest.raises(RescuedValues, match=r"1 rows .*release_year.*chunk_1\.csv"):
        run_silver(spark, strict)
    run_silver(spark, config)  # which keeps them in bronze
    assert read_silver(spark, config).first()["release_year"] is None
    with pytest.raises(ValueError, match="on_rescued"):
        PipelineConfig(base_uri=str(tmp_path), on_rescued="hide")


def test_streaming_silver_equals_batch_silver(spark, config, tmp_path):
    for name, lines in (("chunk_1.csv", CHUNK_1 * 20), ("chunk_2.csv", CHUNK_2 * 20)):
        drop(config, name, lines)
        run_bronze(spark, config)
        stream_silver(spark, config)
    stream_silver(spark, config)  # nothing new
    streamed = read_silver(spark, config).drop("silver_transform_time")
    got = sorted(map(str, streamed.collect()))
    run_silver(spark, config)
    batch = read_silver(spark, config).drop("silver_transform_time").select(*streamed.columns)
    assert got == sorted(map(str, batch.collect()))
    assert len(got) == 4


def test_streaming_silver_is_shaped_as_configured(spark, tmp_path):
    (tmp_path / "source" / "streaming").mkdir(parents=True)
    config = PipelineConfig(
        base_uri=str(tmp_path),
        raw_schema=RAW,
        text_columns=("artist",),
        required_columns=("artist",),
        expectations={"known_genre": "genre is not null"},
        on_violation="drop",
    )
    same = ["SE, Ann  Lee ,First,Pop,2021,1,1,1,1", "SE,Ann Lee,First,Pop,2021,1,1,1,1"]
    drop(config, "chunk_1.csv", [*same, "DE,Bob,Second,,2020,1,1,1,1", "DE,  ,Third,Pop,2022,1,1,1,1"])
    run_bronze(spark, config)
    stream_silver(spark, config)
    assert [r["artist"] for r in read_silver(spark, config).collect()] == ["Ann Lee"]


def test_gold_written_once_is_not_built_again(spark, config):
    drop(config, "chunk_1.csv", CHUNK_1)
    run_pipeline(spark, config)

    def never(silver):
        raise AssertionError("built")

    assert run_gold(spark, config, {"top_artists": never}, mode="once") == {"top_artists": False}


def test_backlog_in_bounded_batches(spark, tmp_path):
    (tmp_path / "source" / "streaming").mkdir(parents=True)
    config = PipelineConfig(base_uri=str(tmp_path), raw_schema=RAW, stream_options={"maxFilesPerTrigger": "1"}, swap=False)
    for i in range(3):
        drop(config, f"chunk_{i}.csv", [f"SE,A{i},B,Pop,2020,1,1,1,1"])
    run_pipeline(spark, config)
    assert read_bronze(spark, config).select("ingestion_time").distinct().count() == 3


def test_a_catalog_that_cannot_be_used_is_left_out(spark, config, tmp_path):
    schemas = {layer: f"left_{layer}" for layer in ("bronze", "silver", "gold")}
    named = PipelineConfig(base_uri=str(tmp_path), raw_schema=RAW, catalog="nope", schemas=schemas, on_rescued="keep")
    assert Layers(named).bootstrap(spark) is None
    drop(named, "chunk_1.csv", CHUNK_1)
    run_pipeline(spark, named)
    names = register_tables(spark, named)
    assert "`left_silver`.`streaming`" in names and spark.table("left_silver.streaming").count() == 3


def test_json_fields_beyond_the_schema_are_rescued(spark, tmp_path):
    source = tmp_path / "source" / "streaming"
    source.mkdir(parents=True)
    lines = ['{"Artist":"A","Plays":1}', '{"Artist":"B","Plays":2,"Label":"new"}', "", "{broken", '{"Plays":"x"}']
    (source / "part.json").write_text("\n".join(lines))
    schema = T.StructType().add("Artist", T.StringType()).add("Plays", T.LongType())
    config = PipelineConfig(base_uri=str(tmp_path), raw_schema=schema, source_format="json")
    run_bronze(spark, config)
    rows = {(r["artist"], r["plays"]): r["_rescued_data"] for r in read_bronze(spark, config).filter("artist is not null").collect()}
    assert rows == {("A", 1): None, ("B", 2): '{"_unknown_fields":"{\\"Label\\":\\"new\\"}"}'}
    others = sorted(r[0] for r in read_bronze(spark, config).filter("artist is null").select("_rescued_data").collect())
    assert others == ['{"_malformed_line":"{broken"}', '{"plays":"x"}']


def test_gold_as_snapshots(spark, tmp_path):
    schemas = {layer: f"snap_{layer}" for layer in ("bronze", "silver", "gold")}
    config = PipelineConfig(base_uri=str(tmp_path), raw_schema=RAW, on_rescued="keep", snapshots=True, schemas=schemas)
    (tmp_path / "source" / "streaming").mkdir(parents=True)
    drop(config, "chunk_1.csv", CHUNK_1)
    assert set(run_pipeline(spark, config, gold_mode="once").values()) == {True}
    (name,) = [n for n in register_tables(spark, config) if "top_songs_by_streams" in n]
    assert gold(spark, config, "top_songs_by_streams").count() == spark.table(name).count() == 2
    drop(config, "chunk_2.csv", CHUNK_2)
    assert set(run_pipeline(spark, config, gold_mode="once").values()) == {False}
    run_gold(spark, config)
    register_tables(spark, config)
    found = gold(spark, config, "top_songs_by_streams")
    assert found.count() > 2 and sorted(map(tuple, spark.table(name).collect())) == sorted(map(tuple, found.collect()))
    assert all(check.count() == 1 for check in layer_checks(spark, config).values())
