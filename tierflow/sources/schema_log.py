"""Versions of a raw schema, kept as an append-only log of small files.

A version is never changed: columns are added in a new one, by whoever creates its file first.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from tierflow import storage
from tierflow.functions import clean_name
from tierflow.sources.files import load_schema

_DIGITS = 8


def _entry(path: str, version: int) -> str:
    return storage.join(path, f"{version:0{_DIGITS}}.json")


def schema_versions(spark: SparkSession, path: str) -> dict[int, T.StructType]:
    """All versions by number, from 1. A schema kept as one file, as `save_schema` does, is version 1."""
    found = {}
    for name in storage.names_in(spark, path):
        number, _, kind = name.partition(".")
        if kind == "json" and number.isdigit():
            text = storage.read_small(spark, storage.join(path, name))
            if text.endswith("\n"):  # else its writer has not finished, and may not have
                found[int(number)] = T.StructType.fromJson(json.loads(text)["schema"])
    if not found and storage.has_part_file(spark, path):
        found[1] = load_schema(spark, path)
    return found


def latest_schema(spark: SparkSession, path: str) -> tuple[int, T.StructType | None]:
    """Number and schema of the last version; 0 and None without one."""
    versions = schema_versions(spark, path)
    return max(versions.items(), default=(0, None))


def merged(known: T.StructType, other: T.StructType) -> T.StructType:
    """``known`` and the columns that only ``other`` has, by cleaned name; known columns keep their types."""
    names = {clean_name(f.name) for f in known}
    return T.StructType([*known, *(f for f in other if clean_name(f.name) not in names)])


def add_schema(spark: SparkSession, path: str, schema: T.StructType) -> tuple[int, T.StructType]:
    """Append what ``schema`` adds to the last version, as the next one; number and schema now valid.

    Nothing is written if it adds nothing. A writer that comes second merges with what the first one wrote.
    """
    while True:
        number, known = latest_schema(spark, path)
        wanted = schema if known is None else merged(known, schema)
        if wanted == known:
            return number, known
        before = set() if known is None else set(known.fieldNames())
        added = [name for name in wanted.fieldNames() if name not in before]
        taken = [int(n.partition(".")[0]) for n in storage.names_in(spark, path) if n.partition(".")[0].isdigit()]
        number = max([number, *taken]) + 1
        entry = {"version": number, "added": added, "schema": wanted.jsonValue()}
        if storage.write_new(spark, _entry(path, number), json.dumps(entry) + "\n"):
            return number, wanted
