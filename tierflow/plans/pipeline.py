"""The bronze, silver and gold stages, and the checks across them."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow import snapshots, storage
from tierflow.config import GOLD_TIME, SILVER_TIME, PipelineConfig
from tierflow.operators import (
    clean_names,
    dedup,
    distinct_counts,
    drop_technical,
    expect,
    normalize_text,
    null_counts,
    quarantined,
    require_not_null,
    row_counts,
    stamp,
    violation_counts,
)
from tierflow.plans.gold import GOLD_MODELS, Model
from tierflow.plans.layers import Layers
from tierflow.plans.sizing import sized_for
from tierflow.sinks import refresh, write_once
from tierflow.sources import (
    add_schema,
    by_header,
    infer_by_header,
    infer_schema,
    latest_schema,
    list_files,
    read_table,
)
from tierflow.streaming import append_headed, append_refined, append_stream, batch_log, bronze_schema, bronze_stream

# Names of columns and files that a report of rescued values lists.
REPORTED = 10

# Batches lie in directories of their own.
BATCH_OPTIONS = {"recursiveFileLookup": "true"}


class RescuedValues(ValueError):
    """Bronze holds values that did not fit the type of their column."""


def raw_schema(spark: SparkSession, config: PipelineConfig) -> T.StructType:
    """The last version of the kept schema, else the configured one, else one inferred now and kept.

    Types are inferred from all rows of all files that are there, in one distributed job for each CSV header. A
    configured schema is kept, and grows, only if new columns are to be added.
    """
    if config.raw_schema is not None and config.new_columns == "rescue":
        return config.raw_schema
    layers = Layers(config)
    _, known = latest_schema(spark, layers.schema_store)
    if known is not None:
        return known
    if config.raw_schema is not None:
        return add_schema(spark, layers.schema_store, config.raw_schema)[1]
    files = list_files(spark, layers.source, f"*.{config.source_format}")
    if files.isEmpty():
        raise ValueError(f"no {config.source_format} file in {layers.source} to infer a schema from")
    if config.source_format == "csv":
        paths = sorted(row["path"] for row in files.select("path").collect())
        found = infer_by_header(spark, by_header(spark, paths, **config.stream_options), **config.stream_options)
    else:
        found = infer_schema(spark, layers.source, file_format=config.source_format)
    return add_schema(spark, layers.schema_store, found)[1]


def _bronze_schema(spark: SparkSession, config: PipelineConfig) -> T.StructType:
    return bronze_schema(raw_schema(spark, config), config.ingestion_time, config.source_file, config.rescued)


def read_bronze(spark: SparkSession, config: PipelineConfig) -> DataFrame:
    schema = _bronze_schema(spark, config)
    return read_table(
        spark, Layers(config).bronze, table_format=config.table_format, schema=schema, **BATCH_OPTIONS
    )


def read_silver(spark: SparkSession, config: PipelineConfig) -> DataFrame:
    """The refined table, with the columns that the last version of the schema gives it."""
    bronze = spark.createDataFrame([], _bronze_schema(spark, config))
    schema = stamp(silver_rows(bronze, replace(config, wide_rows=False)), SILVER_TIME).schema
    return read_table(
        spark, Layers(config).silver, table_format=config.table_format, schema=schema, **BATCH_OPTIONS
    )


def run_bronze(
    spark: SparkSession,
    config: PipelineConfig,
    trigger: str = "available",
    timeout: float | None = None,
    **options: object,
) -> None:
    """Append what is new in the source directory to bronze; CSV files are bound each by its own header."""
    layers = Layers(config)
    if config.source_format == "csv":
        append_headed(
            spark,
            layers.source,
            raw_schema(spark, config),
            layers.bronze,
            layers.checkpoint(),
            layers.schema_store if config.new_columns == "add" else None,
            config.ingestion_time,
            config.source_file,
            config.rescued,
            config.table_format,
            trigger,
            timeout,
            config.swap,
            **{**config.stream_options, **options},
        )
        return
    rows = bronze_stream(
        spark,
        layers.source,
        raw_schema(spark, config),
        config.ingestion_time,
        config.source_file,
        config.rescued,
        config.source_format,
        **{**config.stream_options, **options},
    )
    append_stream(
        rows, layers.bronze, layers.checkpoint(), config.table_format, trigger, timeout
    )


def check_rescued(bronze: DataFrame, config: PipelineConfig) -> None:
    """Raise `RescuedValues` with the rows, columns and files concerned, unless the configuration keeps them."""
    if config.on_rescued == "keep" or config.rescued not in bronze.columns:
        return
    misfits = bronze.filter(F.col(config.rescued).isNotNull()).select(config.rescued, config.source_file)
    count = misfits.count()
    if count:
        columns = misfits.select(F.explode(F.json_object_keys(config.rescued)).alias("name"))
        named = sorted(r["name"] for r in columns.distinct().limit(REPORTED).collect())
        files = sorted(r[0] or "" for r in misfits.select(config.source_file).distinct().limit(REPORTED).collect())
        raise RescuedValues(f"{count} rows with values that do not fit, in columns {named}, from {files}")


def silver_rows(bronze: DataFrame, config: PipelineConfig, dedup_by: str = "record") -> DataFrame:
    """Bronze rows without technical columns and copies, shaped as configured.

    ``record`` compares the source columns and keeps the earliest ingestion time; ``row`` compares the
    ingestion time too, so that a record which came again in a later batch stays twice.
    """
    if dedup_by not in ("record", "row"):
        raise ValueError(f"dedup_by must be 'record' or 'row', not {dedup_by!r}")
    rows = drop_technical(
        clean_names(bronze, lower=False), (config.rescued, config.source_file)
    )
    if config.text_columns:
        rows = normalize_text(rows, config.text_columns, config.text_case)
    if config.required_columns:
        rows = require_not_null(rows, config.required_columns)
    ignore = [config.ingestion_time] if dedup_by == "record" else []
    return dedup(rows, ignore=ignore, wide=config.wide_rows)


def run_silver(
    spark: SparkSession,
    config: PipelineConfig,
    dedup_by: str = "record",
    at: datetime | None = None,
) -> dict[str, int]:
    """Recompute silver from all of bronze; the violations of each expectation, and the rows checked.

    Stops if bronze has rescued values, unless the configuration keeps them. This is the one shuffle of full
    rows, so it is sized to the input. The counts come from the same pass; they are empty without expectations.
    """
    bronze = read_bronze(spark, config)
    check_rescued(bronze, config)
    layers, rules = Layers(config), _rules(config)
    rows = silver_rows(bronze, config, dedup_by)
    target = {"table_format": config.table_format, "swap": config.swap}
    counts, seen = {}, None
    with sized_for(rows):
        if rules and config.on_violation == "quarantine":
            rows = storage.stage(rows, "silver")
            counts = violation_counts(rows, rules).first().asDict()
            rows, rejected = quarantined(rows, rules)
            refresh(stamp(rejected, SILVER_TIME, at), layers.quarantine, **target)
        elif rules:
            rows, seen = expect(rows, rules, config.on_violation)
        refresh(stamp(rows, SILVER_TIME, at), layers.silver, **target)
    return seen.get if seen else counts


def _rules(config: PipelineConfig) -> dict[str, Column]:
    return {name: F.expr(condition) for name, condition in config.expectations.items()}


def streamed_counts(spark: SparkSession, config: PipelineConfig) -> dict[str, int]:
    """The rows that `stream_silver` checked and the violations of each expectation, of all its batches."""
    kinds = ", ".join(f"`{name}`: bigint" for name in config.expectations)
    log = batch_log(spark, Layers(config).silver, f"batch long, row_count long, violations struct<{kinds}>")
    sums = [F.coalesce(F.sum(F.col("violations")[name]), F.lit(0)).alias(name) for name in config.expectations]
    return log.agg(F.coalesce(F.sum("row_count"), F.lit(0)).alias("row_count"), *sums).first().asDict()


def read_quarantine(spark: SparkSession, config: PipelineConfig) -> DataFrame:
    """Rows that broke an expectation, with the names of those that each broke in ``_violated``."""
    schema = T.StructType([*read_silver(spark, config).schema.fields])
    schema.add("_violated", T.ArrayType(T.StringType()))
    return read_table(
        spark, Layers(config).quarantine, table_format=config.table_format, schema=schema, **BATCH_OPTIONS
    )


def stream_silver(
    spark: SparkSession,
    config: PipelineConfig,
    at: datetime | None = None,
    trigger: str = "available",
    timeout: float | None = None,
    **options: object,
) -> None:
    """Append to silver what is new in bronze, shaped as by `run_silver`.

    A record stays as its first batch brought it, with the earliest ingestion time of that batch. What a batch reads
    beside its own rows does not grow with silver, see `append_refined`. Expectations are checked on new records, and
    `streamed_counts` tells the violations.
    """
    layers = Layers(config)
    schema = _bronze_schema(spark, config)

    def refine(batch: DataFrame) -> DataFrame:
        check_rescued(batch, config)
        return silver_rows(batch, config)

    settings = BATCH_OPTIONS | options
    raw = spark.readStream.schema(schema).format(config.table_format).options(**settings).load(layers.bronze)
    append_refined(
        raw,
        refine,
        layers.silver,
        layers.checkpoint("silver"),
        (config.ingestion_time, SILVER_TIME),
        config.table_format,
        trigger,
        timeout,
        config.swap,
        lambda rows: stamp(rows, SILVER_TIME, at),
        _rules(config),
        config.on_violation,
        layers.quarantine,
    )


def run_gold(
    spark: SparkSession,
    config: PipelineConfig,
    models: Mapping[str, Model] = GOLD_MODELS,
    mode: str = "refresh",
    at: datetime | None = None,
) -> dict[str, bool]:
    """Write the gold models; for each, whether it was written.

    ``refresh`` replaces them on each run, ``once`` leaves a model that is already there. The models
    are independent, so their jobs are submitted together and share the executors.
    """
    if mode not in ("refresh", "once"):
        raise ValueError(f"mode must be 'refresh' or 'once', not {mode!r}")
    layers = Layers(config)
    silver = read_silver(spark, config)

    def write(name: str) -> bool:
        path = layers.gold(name)
        if mode == "once" and (storage.has_part_file(spark, path) or snapshots.current(spark, path)):
            return False  # before the model is built, which may read silver already
        table = stamp(models[name](silver), GOLD_TIME, at)
        if mode == "once":
            return write_once(table, path, config.table_format, config.snapshots)
        refresh(table, path, table_format=config.table_format, swap=config.swap, snapshots=config.snapshots)
        return True

    with ThreadPoolExecutor(max_workers=max(len(models), 1)) as pool:
        return dict(zip(models, pool.map(write, models)))


def register_tables(
    spark: SparkSession, config: PipelineConfig, models: Iterable[str] = GOLD_MODELS
) -> list[str]:
    """Make the layers readable by catalog name, as tables over their paths; the names.

    Call it again after a run: a name that exists is refreshed, or moved to the newest snapshot.
    """
    layers = Layers(config)

    def gold(model: str) -> str:
        return snapshots.current(spark, layers.gold(model)) or layers.gold(model)

    if layers.bootstrap(spark) != config.catalog:
        layers = Layers(replace(config, catalog=None))
    tables = {
        layers.qualify("bronze", config.dataset): (layers.bronze, read_bronze(spark, config).schema, BATCH_OPTIONS),
        layers.qualify("silver", config.dataset): (layers.silver, read_silver(spark, config).schema, BATCH_OPTIONS),
        **{layers.qualify("gold", model): (gold(model), None, {}) for model in models},
    }
    for name, (path, schema, options) in tables.items():
        if spark.catalog.tableExists(name):
            if "/_snapshots/" in path:
                spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
            spark.catalog.refreshTable(name)
        else:
            spark.catalog.createTable(name, path, config.table_format, schema, **options)
    return list(tables)


def layer_checks(spark: SparkSession, config: PipelineConfig) -> dict[str, DataFrame]:
    """Row counts, nulls in key columns and distinct artists, one row for each check."""
    layers = Layers(config)

    def gold(model: str) -> DataFrame:
        return read_table(spark, layers.gold(model), table_format=config.table_format)

    bronze, silver, artists = (
        read_bronze(spark, config),
        read_silver(spark, config),
        gold("top_artists"),
    )
    return {
        "row_counts": row_counts(
            {
                "bronze_rows": bronze,
                "silver_rows": silver,
                "gold_rows_yearly_stream_trends": gold("yearly_stream_trends"),
                "gold_rows_top_songs_per_year": gold("top_songs_per_year"),
                "gold_rows_top_artists": artists,
            }
        ),
        "null_counts": null_counts(
            {
                "null_artists_bronze": (bronze, "artist"),
                "null_streams_silver": (silver, "streams_last_30_days_millions"),
            }
        ),
        "distinct_counts": distinct_counts(
            {
                "distinct_artists_silver": (silver, "artist"),
                "distinct_artists_gold": (artists, "artist"),
            }
        ),
    }


def run_pipeline(
    spark: SparkSession,
    config: PipelineConfig,
    models: Mapping[str, Model] = GOLD_MODELS,
    dedup_by: str = "record",
    gold_mode: str = "refresh",
    timeout: float | None = None,
) -> dict[str, bool]:
    """One triggered run: ingest what is new, recompute silver, write gold."""
    run_bronze(spark, config, timeout=timeout)
    run_silver(spark, config, dedup_by)
    return run_gold(spark, config, models, gold_mode)
