"""Sharding by sampled splitters: records in key order are cut into shards of equal weight.

Keys are content hashes, so equal texts lie together; the id and a row number order the copies of one text, so
that any group can be cut. A size-weighted sample of keys gives quantile splitters, which cut the keys into
many small ranges; ranges that turn out overfull are cut again by a sample of their own. The exact weights of
the ranges then place every record, so the shards come out equal to within one record.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

SAMPLES_PER_RANGE = 16
# The driver holds the splitters and one weight for each range, so their number is bounded.
MOST_RANGES = 10_000
# A range is overfull beyond so many times the mean weight.
OVERFULL = 4
RESAMPLINGS = 4

Splitter = tuple[int, int, int]


def _draw(rows: DataFrame, chance, seed: int) -> list[Splitter]:
    """Keys of a sample in which each row is drawn with its own ``chance``; repeatable."""
    u = F.pmod(F.xxhash64("key", "id", "row", F.lit(seed)), F.lit(1 << 40)) / float(1 << 40)
    return sorted(tuple(r) for r in rows.filter(u < chance).select("key", "id", "row").collect())


def _with_range(rows: DataFrame, splitters: list[Splitter]) -> DataFrame:
    """Adds ``range``: how many splitters are not above the row's key."""
    shared = rows.sparkSession.sparkContext.broadcast(splitters)

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts = shared.value
        keys = np.array([c[0] for c in cuts], np.int64)
        for batch in batches:
            key, names, numbers = (batch.column(c).to_numpy() for c in ("key", "id", "row"))
            low, high = np.searchsorted(keys, key, "left"), np.searchsorted(keys, key, "right")
            for i in np.flatnonzero(low < high):  # the key is a splitter's own: the id decides, then the row
                low[i] = bisect_right(cuts, (key[i], names[i], numbers[i]))
            yield batch.append_column("range", pa.array(low, pa.int64()))

    return rows.mapInArrow(locate, T.StructType([*rows.schema.fields, T.StructField("range", T.LongType())]))


def _splitters(rows: DataFrame, total: int, wanted: int) -> tuple[list[Splitter], list]:
    """Splitters that leave no range overfull, and (range, weight, rows) of each range."""
    mean = total / wanted
    sample = _draw(rows, F.col("weight") * float(SAMPLES_PER_RANGE * wanted / total), seed=0)
    splitters = sorted(set(sample[SAMPLES_PER_RANGE::SAMPLES_PER_RANGE]))
    for attempt in range(RESAMPLINGS + 1):
        placed = _with_range(rows, splitters)
        found = placed.groupBy("range").agg(F.sum("weight").alias("weight"), F.count(F.lit(1)).alias("rows")).collect()
        overfull = [r["range"] for r in found if r["weight"] > OVERFULL * mean and r["rows"] > 1]
        if not overfull or attempt == RESAMPLINGS or len(splitters) > 2 * MOST_RANGES:
            return splitters, found
        again = _draw(
            placed.filter(F.col("range").isin(overfull)), F.col("weight") * (2.0 / mean), seed=attempt + 1
        )
        splitters = sorted({*splitters, *again})
    raise AssertionError


def shards(
    docs: DataFrame, n_shards: int = 8, law: str = "bytes", id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Each row's shard and place: ``id_col, size, text_crc32, law, shard, slot, grown_shard``.

    With law ``bytes`` the shards' sizes are equal to within the largest record; with ``rows`` their
    counts are at most one apart. Size is the text's UTF-8 bytes plus 1; a null text has none, and its checksum
    is that of an empty one. Rows with equal texts lie in one shard, or in neighbouring ones where
    a boundary falls among them. A null id sorts before all others; repeated rows get slots of their own; an
    empty table gives an empty result. ``slot`` numbers a shard's rows from 0 without gaps. ``grown_shard`` is null
    under these laws. Other columns are not looked at.
    """
    if law not in ("bytes", "rows"):
        raise ValueError(f"unknown law: {law}")
    spark = docs.sparkSession
    text = common.whole_text(text_col)
    rows = common.stage(
        docs.select(
            F.col(id_col).cast("long").alias("doc"),
            F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("id"),
            F.xxhash64(text).alias("key"),
            (F.octet_length(text).cast("long") + 1).alias("size"),
            F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
            F.monotonically_increasing_id().alias("row"),
        ).withColumn("weight", F.col("size") if law == "bytes" else F.lit(1).cast("long")),
        "shard-keys",
    )
    total, count = rows.agg(F.sum("weight"), F.count(F.lit(1))).first()
    total = total or 1
    wanted = min(MOST_RANGES, max(4 * n_shards, common.shuffle_partitions(spark)), max(1, count))
    splitters, found = _splitters(rows, total, wanted)
    ranges = sorted((r["range"], r["weight"], r["rows"]) for r in found)
    before_weight = np.cumsum([0, *(r[1] for r in ranges)]).tolist()
    before_rows = np.cumsum([0, *(r[2] for r in ranges)]).tolist()
    starts = spark.createDataFrame(
        [(r[0], before_weight[i], before_rows[i]) for i, r in enumerate(ranges)],
        "range long, weight_before long, rows_before long",
    )
    in_range = Window.partitionBy("range").orderBy("key", "id", "row")
    placed = (
        _with_range(rows, splitters)
        .withColumn("weight_upto", F.sum("weight").over(in_range))
        .withColumn("place", F.row_number().over(in_range))
        .join(F.broadcast(starts), "range")
        .withColumn("start", F.col("weight_before") + F.col("weight_upto") - F.col("weight"))
        .withColumn("index", F.col("rows_before") + F.col("place") - 1)
        # the middle of the record decides
        .withColumn("shard", F.expr(f"cast(((2 * start + weight) * {n_shards}) div (2 * {total}) as int)"))
        .select("doc", "size", "text_crc32", "shard", "index")
    )
    placed = common.stage(placed, "shards")
    firsts = placed.groupBy("shard").agg(F.min("index").alias("first"))  # a row for each shard
    return placed.join(F.broadcast(firsts), "shard").select(
        F.col("doc").alias(id_col),
        "size",
        "text_crc32",
        F.lit(law).alias("law"),
        "shard",
        (F.col("index") - F.col("first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )

