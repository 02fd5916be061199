"""Raw files: schemas, batch and streaming reads, lineage."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Read options of the raw layer. ``enforceSchema=false`` compares each header with the
# schema; otherwise columns bind by position and a reordered file would be swapped silently.
READ_OPTIONS = {"header": "true", "enforceSchema": "false"}

# Write options that keep every value whole; Spark's defaults cut microseconds and trim
# blanks.
WRITE_OPTIONS = {
    "header": "true",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}

# Formats whose values are read as text first, so that one of the wrong type is not lost.
TEXT_FORMATS = ("csv", "json")

# Holds a line that does not parse, such as one with too many fields.
MALFORMED = "_malformed_line"

# Holds the fields of a JSON line that the schema does not name.
UNKNOWN = "_unknown_fields"


def settings_of(file_format: str, options: dict) -> dict:
    """Reader options of a raw format, those given last."""
    selected = {"pathGlobFilter": f"*.{file_format}", "recursiveFileLookup": "false"}
    return (READ_OPTIONS if file_format == "csv" else {}) | selected | options


def infer_schema(
    spark: SparkSession,
    sample: str | list[str],
    schema_path: str | None = None,
    file_format: str = "csv",
    **options: object,
) -> T.StructType:
    """Infer column types from the files under ``sample`` and keep them as JSON at ``schema_path``.

    Inference reads the sample in full, as one distributed job; values that do not fit in files that come
    later are rescued, not lost.
    """
    settings = settings_of(file_format, {"inferSchema": "true", "enforceSchema": "true"} | options)
    schema = spark.read.format(file_format).options(**settings).load(sample).schema
    if schema_path is not None:
        save_schema(spark, schema, schema_path)
    return schema


def save_schema(spark: SparkSession, schema: T.StructType, path: str) -> None:
    text = spark.createDataFrame([(schema.json(),)], "value string")
    text.coalesce(1).write.mode("overwrite").text(path)


def load_schema(spark: SparkSession, path: str) -> T.StructType:
    return T.StructType.fromJson(json.loads(spark.read.text(path).first().value))


def as_text(schema: T.StructType) -> T.StructType:
    """The same columns, all as strings, and one for lines that do not parse."""
    fields = [T.StructField(f.name, T.StringType()) for f in schema]
    return T.StructType(fields).add(MALFORMED, T.StringType())


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | None = None, **options: object
) -> DataFrame:
    """One-off read of CSV files with a header; types are inferred unless ``schema`` is given."""
    if schema is None:
        settings = settings_of("csv", {"inferSchema": "true", "enforceSchema": "true"} | options)
        return spark.read.options(**settings).csv(path)
    return spark.read.schema(schema).options(**settings_of("csv", options)).csv(path)


def read_file_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    file_format: str = "csv",
    **options: object,
) -> DataFrame:
    """Stream of the files of one format in one directory, each read once, with those already there.

    Pass ``maxFilesPerTrigger`` or ``maxBytesPerTrigger`` to bound a micro-batch, ``cleanSource`` to
    archive what is done so that the listing stays short. With a schema of text columns from `as_text`, JSON is
    read line by line, and fields that the schema does not name come as one more column.
    """
    settings = settings_of(file_format, options)
    if file_format == "json" and MALFORMED in schema.fieldNames():
        lines = spark.readStream.format("text").options(**settings).load(path)
        return _json_columns(lines, schema)
    if MALFORMED in schema.fieldNames():
        settings["columnNameOfCorruptRecord"] = MALFORMED
    return spark.readStream.format(file_format).schema(schema).options(**settings).load(path)


def _json_columns(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """The fields of each JSON line as text, blank lines left out; names are case-sensitive."""
    line, fields = F.col("value"), F.col("__fields")
    known = [f.name for f in schema if f.name != MALFORMED]
    parsed = lines.filter(F.trim(line) != "").withColumn("__fields", F.from_json(line, "map<string,string>"))
    others = F.map_filter(fields, lambda name, _: ~name.isin(known))
    return parsed.select(
        *(fields[name].alias(name) for name in known),
        F.when(fields.isNull(), line).alias(MALFORMED),
        F.when(F.size(others) > 0, F.to_json(others)).alias(UNKNOWN),
        "_metadata",
    )


def with_lineage(
    df: DataFrame, time_col: str = "ingestion_time", file_col: str = "source_file"
) -> DataFrame:
    """Add the time of the micro-batch and the path of the file each row comes from."""
    return df.withColumns(
        {time_col: F.current_timestamp(), file_col: F.col("_metadata.file_path")}
    )


def list_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Path, length and modification time of the files in a directory; contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    return files.select("path", "length", "modificationTime")
