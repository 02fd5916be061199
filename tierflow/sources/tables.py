"""Reads of whole tables, by path or by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tierflow import snapshots, storage


def read_table(
    spark: SparkSession,
    path: str | None = None,
    name: str | None = None,
    table_format: str = "parquet",
    schema: T.StructType | None = None,
    **options: object,
) -> DataFrame:
    """Read a table by path, or by its two- or three-part catalog name.

    With a ``schema`` a path that holds no file yet is an empty table, and no file footer is read to
    find the columns. A path with published snapshots is read as its newest one.
    """
    if (path is None) == (name is None):
        raise ValueError("give either a path or a name")
    if name is not None:
        return spark.table(name)
    if table_format in storage.FILE_FORMATS:
        path = snapshots.current(spark, path) or path
    reader = spark.read.format(table_format).options(**options)
    return (reader if schema is None else reader.schema(schema)).load(path)
