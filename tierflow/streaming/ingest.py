"""Incremental ingestion of files into the raw layer."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tierflow import storage
from tierflow.functions import clean_name, ref
from tierflow.operators import clean_names, conform
from tierflow.sources import (
    MALFORMED,
    TEXT_FORMATS,
    UNKNOWN,
    add_schema,
    as_text,
    by_header,
    infer_by_header,
    read_by_header,
    read_file_stream,
    with_lineage,
)
from tierflow.sources.files import settings_of
from tierflow.streaming.batches import is_committed, write_batch

# What a stream of files tells of each; the content is not read.
_FILES = "path string, modificationTime timestamp, length long, content binary"


def cleaned_schema(raw_schema: T.StructType) -> T.StructType:
    """The wanted types under the cleaned column names."""
    return T.StructType([T.StructField(clean_name(f.name), f.dataType) for f in raw_schema])


def bronze_schema(
    raw_schema: T.StructType,
    time_col: str = "ingestion_time",
    file_col: str = "source_file",
    rescue_col: str = "_rescued_data",
) -> T.StructType:
    """Schema of the raw table that `bronze_stream` writes."""
    return (
        T.StructType(list(cleaned_schema(raw_schema)))
        .add(time_col, T.TimestampType())
        .add(file_col, T.StringType())
        .add(rescue_col, T.StringType())
    )


def bronze_stream(
    spark: SparkSession,
    source: str,
    raw_schema: T.StructType,
    time_col: str = "ingestion_time",
    file_col: str = "source_file",
    rescue_col: str = "_rescued_data",
    file_format: str = "csv",
    **options: object,
) -> DataFrame:
    """Raw rows as a stream: lineage added, names cleaned, types checked, misfits rescued.

    Fields of a JSON line that are not in the schema go to the rescue column as well. One scan and projections,
    no shuffle, so it scales with the number of input splits.
    """
    text = file_format in TEXT_FORMATS
    read_schema = as_text(raw_schema) if text else raw_schema
    raw = read_file_stream(spark, source, read_schema, file_format, **options)
    rows = clean_names(with_lineage(raw, time_col, file_col))
    whole = [c for c in (MALFORMED, UNKNOWN) if c in rows.columns]
    return conform(rows, cleaned_schema(raw_schema), rescue=rescue_col, whole=whole)


def headed_rows(
    spark: SparkSession,
    paths: Sequence[str],
    raw_schema: T.StructType,
    schema_log: str | None = None,
    time_col: str = "ingestion_time",
    file_col: str = "source_file",
    rescue_col: str = "_rescued_data",
    at: datetime | None = None,
    **options: object,
) -> tuple[DataFrame | None, int]:
    """Raw rows of CSV files, each bound by its own header, and the version of the schema they have.

    Columns may be moved, added or missing from file to file: a missing one is null, one that the schema does not name
    is rescued. With a ``schema_log`` it is added to the schema instead, as a new version there, with a type inferred
    from these files. Names, lineage, types and misfits as in `bronze_stream`; scans, projections and a union,
    no shuffle. None without rows to read.
    """
    groups = by_header(spark, paths, **options)
    version = 0
    if schema_log is not None:
        version, raw_schema = add_schema(spark, schema_log, infer_by_header(spark, groups, raw_schema, **options))
    technical = (time_col, file_col, rescue_col)
    text = read_by_header(spark, groups, raw_schema, technical, **options)
    if text is None:
        return None, version
    names = [clean_name(f.name) for f in raw_schema]
    lineage = {time_col: F.lit(at or datetime.now(timezone.utc)), file_col: F.col("__file")}
    rows = text.withColumns(lineage).select(*map(ref, [*names, MALFORMED, UNKNOWN, time_col, file_col]))
    return conform(rows, cleaned_schema(raw_schema), rescue=rescue_col, whole=(MALFORMED, UNKNOWN)), version


def append_headed(
    spark: SparkSession,
    source: str,
    raw_schema: T.StructType,
    path: str,
    checkpoint: str,
    schema_log: str | None = None,
    time_col: str = "ingestion_time",
    file_col: str = "source_file",
    rescue_col: str = "_rescued_data",
    table_format: str = "parquet",
    trigger: str = "available",
    timeout: float | None = None,
    swap: bool = True,
    **options: object,
) -> StreamingQuery:
    """Append new CSV files of a directory to a table, each file bound by its own header; see `headed_rows`.

    The stream is one of file names, so triggers, bounds such as ``maxFilesPerTrigger`` and the checkpoint work as for
    any file source; a batch then reads its files. Each batch is written exactly once, in a directory of its
    own, with a log entry that names its schema version (`tierflow.streaming.batches`).
    """
    if table_format in storage.FILE_FORMATS:
        if storage.exists(spark, storage.join(path, "_spark_metadata")):
            raise ValueError(f"{path} was written by another kind of stream; use a new checkpoint version")
        _refuse_other_checkpoint(spark, path, checkpoint)
        storage.make_directory(spark, path)
    settings = settings_of("csv", options)
    files = spark.readStream.schema(_FILES).format("binaryFile").options(**settings).load(source).select("path")

    def write(batch: DataFrame, number: int) -> None:
        plain = table_format in storage.FILE_FORMATS
        if plain and is_committed(spark, path, number):
            return
        paths = sorted(row["path"] for row in batch.collect())  # names, as the source's own log holds them
        rows, version = headed_rows(
            spark, paths, raw_schema, schema_log, time_col, file_col, rescue_col, **options
        )
        if plain:
            write_batch(spark, rows, path, number, table_format, swap, schema=version, files=len(paths))
        elif rows is not None:
            once = {"txnAppId": checkpoint, "txnVersion": number, "mergeSchema": "true"}
            rows.write.format(table_format).options(**once).mode("append").save(path)

    writer = files.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    return start(writer, trigger, timeout, path)


def append_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    table_format: str = "parquet",
    trigger: str = "available",
    timeout: float | None = None,
) -> StreamingQuery:
    """Append a stream to a table, exactly once per checkpoint.

    ``trigger`` is ``available`` (all there is, in bounded batches, then stop), ``once`` (the same in
    one batch) or an interval such as ``10 seconds`` (runs on). The first two block until done; a
    ``timeout`` in seconds stops the query and raises.

    A new checkpoint reads the source in full again. Plain files then need a new path too: Spark's file
    sink remembers the batch numbers written to a path, and would skip the new stream's batches of the
    same numbers without a word.
    """
    if table_format in storage.FILE_FORMATS:
        _refuse_other_checkpoint(df.sparkSession, path, checkpoint)
    writer = (
        df.writeStream.format(table_format)
        .option("checkpointLocation", checkpoint)
        .option("path", path)
        .outputMode("append")
    )
    return start(writer, trigger, timeout, path)


def _refuse_other_checkpoint(spark: SparkSession, path: str, checkpoint: str) -> None:
    fresh = not storage.exists(spark, storage.join(checkpoint, "metadata"))
    if fresh and storage.holds_anything(spark, path):
        raise ValueError(f"{path} was written under another checkpoint than {checkpoint}")


def start(writer: DataStreamWriter, trigger: str, timeout: float | None, path: str) -> StreamingQuery:
    """Start a stream with a trigger as in `append_stream`; blocks unless it runs on."""
    if trigger == "available":
        writer = writer.trigger(availableNow=True)
    elif trigger == "once":
        writer = writer.trigger(once=True)
    else:
        return writer.trigger(processingTime=trigger).start()
    query = writer.start()
    if timeout is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError(f"stream into {path} did not finish within {timeout} seconds")
    return query
