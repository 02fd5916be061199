"""Sizes of scan splits and shuffles, fitted to the input."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame

MEBIBYTE = 1024 * 1024

# Columnar files hold the rows compressed; a shuffle holds them as rows.
ROW_EXPANSION = 4
BYTES_PER_SHUFFLE_PARTITION = 256 * MEBIBYTE
MOST_SHUFFLE_PARTITIONS = 100_000
MOST_SCAN_TASKS = 100_000

_INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
_SPLIT = "spark.sql.files.maxPartitionBytes"


def input_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate for the leaves of the plan: bytes of the files to be scanned."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def settings_for(scanned: int, partitions: int, split: int) -> dict[str, str]:
    """Settings for a job that scans and shuffles ``scanned`` bytes, never below the session's own.

    More shuffle partitions keep each within executor memory; adaptive execution merges those that
    turn out small. Larger scan splits at very large inputs keep the number of map outputs, which the
    driver tracks, in bounds.
    """
    wanted = -(-scanned * ROW_EXPANSION // BYTES_PER_SHUFFLE_PARTITION)
    return {
        _INITIAL: str(max(partitions, min(wanted, MOST_SHUFFLE_PARTITIONS))),
        _SPLIT: f"{max(split, -(-scanned // MOST_SCAN_TASKS))}b",
    }


@contextmanager
def sized_for(df: DataFrame) -> Iterator[None]:
    """Run the actions of the block with settings fitted to the input of ``df``."""
    conf = df.sparkSession.conf
    partitions = int(conf.get(_INITIAL, None) or conf.get("spark.sql.shuffle.partitions"))
    fitted = settings_for(input_bytes(df), partitions, _as_bytes(df, conf.get(_SPLIT)))
    before = {key: conf.get(key, None) for key in fitted}
    try:
        for key, value in fitted.items():
            conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                conf.unset(key)
            else:
                conf.set(key, value)


def _as_bytes(df: DataFrame, size: str) -> int:
    jvm = df.sparkSession._jvm
    return jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(size)
