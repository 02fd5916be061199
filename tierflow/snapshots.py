"""Tables published as immutable snapshots behind a versioned pointer, for stores where a rename is not atomic.

A snapshot is written whole under a name of its own and never changed. It becomes the table when its writer creates the
file of the next version, which names it; the store lets one writer create a file. So a reader meets the
table before or after, never half and never absent, and of two writers of one version one wins.

Below the table's path: ``_snapshots/<name>`` holds the data, ``_versions/<number>`` the name. A writer that dies leaves a
snapshot that no version names. One that dies while it writes the pointer leaves a version without a name: readers and
`publish` pass over it, `publish_once` stops and says which file to delete.
"""

from __future__ import annotations

import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from tierflow import storage

_DIGITS = 12
# Seconds that a writer waits for another's pointer, created but not yet written.
PATIENCE = 5.0
# Versions that stay readable after a new one, for readers that have resolved them already.
KEPT = 2


def _entry(path: str, version: int) -> str:
    return storage.join(path, "_versions", f"{version:0{_DIGITS}}")


def _numbers(spark: SparkSession, path: str) -> list[int]:
    return [int(n) for n in storage.names_in(spark, storage.join(path, "_versions")) if n.isdigit()]


def _named(spark: SparkSession, path: str, version: int) -> str | None:
    """The snapshot that a version names; None while its pointer is not whole, or when it is deleted by now."""
    try:
        text = storage.read_small(spark, _entry(path, version))
    except Py4JJavaError:
        if storage.exists(spark, _entry(path, version)):
            raise
        return None
    return storage.join(path, "_snapshots", text.strip()) if text.endswith("\n") else None


def current(spark: SparkSession, path: str) -> str | None:
    """Where the table's newest snapshot lies; None if nothing was published at ``path``."""
    seen: list[int] = []
    while (numbers := _numbers(spark, path)) != seen:  # listed again if writers went on meanwhile
        for version in reversed(numbers):
            if (found := _named(spark, path, version)) is not None:
                return found
        seen = numbers
    return None


def _written(df: DataFrame, path: str, table_format: str, partition_by=(), **options: object) -> str:
    """Write a snapshot that no version names yet; its name."""
    name = uuid.uuid4().hex
    writer = df.write.format(table_format).options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(storage.join(path, "_snapshots", name))
    return name


def publish(
    df: DataFrame, path: str, table_format: str = "parquet", partition_by=(), kept: int = KEPT, **options: object
) -> int:
    """Replace the table by ``df``, which may read it; the version. Of two writers the one that comes last stays.

    Versions before the last ``kept`` are deleted with their snapshots.
    """
    spark = df.sparkSession
    name = _written(df, path, table_format, partition_by, **options)
    version = max(_numbers(spark, path), default=0) + 1
    while not storage.write_new(spark, _entry(path, version), f"{name}\n"):
        version += 1
    _forget(spark, path, version, kept)
    return version


def _forget(spark: SparkSession, path: str, version: int, kept: int) -> None:
    # pointers that are not whole do not count as kept ones: the newest whole version always stays
    whole = {}
    for number in _numbers(spark, path):
        if number <= version:
            whole[number] = _named(spark, path, number)
    last = sorted((n for n, snapshot in whole.items() if snapshot), reverse=True)[: max(kept, 1)]
    for number, snapshot in whole.items():
        if number < last[-1]:
            storage.delete(spark, _entry(path, number))  # the pointer first: no pointer names what is gone
            if snapshot:
                storage.delete(spark, snapshot)


def publish_once(df: DataFrame, path: str, table_format: str = "parquet", **options: object) -> bool:
    """Publish unless something was published already; whether this call did. Of any number of writers one does."""
    spark = df.sparkSession
    if not _numbers(spark, path):
        name = _written(df, path, table_format, **options)
        if storage.write_new(spark, _entry(path, 1), f"{name}\n"):
            return True
        storage.delete(spark, storage.join(path, "_snapshots", name))
    until = time.monotonic() + PATIENCE
    while current(spark, path) is None:
        if time.monotonic() > until:
            raise OSError(f"{_entry(path, 1)} was created but not written; if its writer is dead, delete it")
        time.sleep(0.1)
    return False
