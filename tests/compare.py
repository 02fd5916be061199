"""Runs one contract query in Spark and DuckDB and compares names, types and values."""

import importlib.util
import math
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parent.parent
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# Spark type names and the DuckDB types that hold the same values.
SAME_TYPE = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def load_entry():
    spec = importlib.util.spec_from_file_location("spark_entry", ROOT / "__spark_entry__.py")
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module


def duck(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"create view {table} as select * from read_parquet('{sf_dir}/{table}.parquet')"
        )
    return connection


def _key(row):
    return tuple((value is None, str(type(value)), value if value is not None else 0) for value in row)


def _plain(value):
    return "nan" if isinstance(value, float) and math.isnan(value) else value


def differences(df, connection, sql):
    """None if equal, else a line that says how they differ."""
    expected = connection.sql(sql)
    spark_types = {f.name: SAME_TYPE.get(f.dataType.simpleString(), "?") for f in df.schema}
    duck_types = {n: str(t) for n, t in zip(expected.columns, expected.types)}
    if spark_types != duck_types:
        return f"schema: {spark_types} against {duck_types}"
    names = sorted(spark_types)
    order = [expected.columns.index(n) for n in names]
    have = sorted(
        (tuple(_plain(row[n]) for n in names) for row in df.select(*_refs(names)).collect()), key=_key
    )
    want = sorted((tuple(_plain(row[i]) for i in order) for row in expected.fetchall()), key=_key)
    if have == want:
        return None
    odd = [pair for pair in zip(have, want) if pair[0] != pair[1]][:3]
    return f"{len(have)} rows against {len(want)}; first differences {odd}"


def _refs(names):
    return [f"`{name}`" for name in names]
