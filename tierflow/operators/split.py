"""Exact contiguous row numbers and splits, without sorting all rows in one task."""

from __future__ import annotations

from collections.abc import Collection, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tierflow.functions import ref
from tierflow.sources import WRITE_OPTIONS
from tierflow.storage import stage

_ID = "__row_id"
_PLACE = "__place"
_PART = "__part"
_INDEX = "__index"
_CUTS = "__cuts"
_RANK = "__rank"

# Group keys and a number each; beyond this many, Catalyst picks the join by measured size.
MOST_BROADCAST_ROWS = 100_000

# Up to so many chunks a row is compared with the borders, where it is read.
MOST_CUTS = 64

# ``monotonically_increasing_id`` holds the partition number from bit 33 up, the position below it.
_POSITION_BITS = 33


def with_row_index(
    df: DataFrame,
    order_by: Sequence[str] = (),
    descending: Collection[str] = (),
    index_col: str = "row_index",
) -> DataFrame:
    """Number all rows 0, 1, 2, ... without gaps, in scan order or sorted by ``order_by``.

    A sorted index is one range shuffle of the rows, staged once. Calling this runs those jobs; ``df`` must be
    repeatable, as a scan is, since a sorted shuffle reads it twice.
    """
    if order_by:
        rows, _ = _sorted_rows(df, order_by, descending)
    else:
        rows, _ = _numbered(_identified(df).withColumnRenamed(_ID, _PLACE))
    return rows.select(*map(ref, df.columns), F.col(_INDEX).alias(index_col))


def first_of_groups(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    n: int,
    rank_col: str,
    descending: Collection[str] = (),
) -> DataFrame:
    """The first ``n`` rows of each group in the order given, ranked from 1, for large ``n``.

    Groups are runs of one global order, so a rank is a row's number less that of the first row in its
    group. Only the key and sort columns are shuffled to find the rows; no group is sorted in one task.
    """
    rows = _identified(df)
    numbered, _ = _numbered(_ranked(rows, [*keys, *order_by], descending))
    names = [f"__key{i}" for i in range(len(keys))]
    starts = stage(
        numbered.groupBy(*(ref(k).alias(name) for k, name in zip(keys, names))).agg(
            F.min(_INDEX).alias("__start")
        ),
        "starts",
    )
    if starts.count() <= MOST_BROADCAST_ROWS:
        starts = F.broadcast(starts)  # else adaptive execution splits the partition of a hot group
    same_group = [ref(k).eqNullSafe(F.col(name)) for k, name in zip(keys, names)]
    rank = F.col(_INDEX) - F.col("__start") + 1
    kept = numbered.join(starts, same_group).select(_ID, rank.alias(_RANK)).filter(F.col(_RANK) <= n)
    return rows.join(kept, _ID).select(
        *map(ref, df.columns), F.col(_RANK).cast("int").alias(rank_col)
    )


def assign_chunks(
    df: DataFrame,
    n: int,
    order_by: Sequence[str] = (),
    descending: Collection[str] = (),
    chunk_col: str = "chunk",
) -> DataFrame:
    """Split into ``n`` contiguous chunks numbered from 1, each of ``rows // n`` rows.

    The last chunk also takes the remainder; with fewer rows than chunks it takes them all. A sorted
    split into up to ``MOST_CUTS`` chunks shuffles the sort columns only: they give the ``n - 1`` sort values at
    which a chunk begins, and each full row is then compared with those where it is read. Where such a value occurs
    more than once, the rows are staged with an id that tells them apart. Beyond that many chunks, the rows
    are sorted and numbered, and a chunk is a division. ``df`` is read more than once and must be
    repeatable; `tierflow.storage.stage` makes it so. Calling this runs jobs.
    """
    if n < 1:
        raise ValueError(f"need at least one chunk, not {n}")
    if order_by and n <= MOST_CUTS:
        return _sorted_chunks(df, n, order_by, descending, chunk_col)
    if order_by:
        rows, total = _sorted_rows(df, order_by, descending)
    else:
        rows, total = _numbered(_identified(df).withColumnRenamed(_ID, _PLACE))
    size = total // n
    if size == 0:
        chunk = F.lit(n)
    else:
        chunk = F.least(F.call_function("div", F.col(_INDEX), F.lit(size)) + 1, F.lit(n))
    return rows.select(*map(ref, df.columns), chunk.cast("int").alias(chunk_col))


def _sorted_chunks(
    df: DataFrame, n: int, order_by: Sequence[str], descending: Collection[str], chunk_col: str
) -> DataFrame:
    rows, keys = df, list(dict.fromkeys(order_by))
    slim = _identified(df.select(*map(ref, keys)))
    numbered, total = _numbered(_ranked(slim, order_by, descending))
    size = total // n
    if size == 0:
        return df.withColumn(chunk_col, F.lit(n))
    begins = [i * size for i in range(1, n)]
    if _cuts_through_equals(numbered, keys, begins):
        rows, keys = _identified(df), [*keys, _ID]
        numbered, _ = _numbered(_ranked(rows, order_by, descending))
    first = numbered.filter(F.col(_INDEX).isin(begins))
    cuts = first.agg(F.collect_list(F.struct(*map(ref, keys)))).scalar()
    begun = F.filter(_CUTS, lambda cut: _at_or_after(cut, order_by, descending, _ID in keys))
    return rows.withColumn(_CUTS, cuts).select(
        *map(ref, df.columns), (F.size(begun) + 1).alias(chunk_col)
    )


def _cuts_through_equals(numbered: DataFrame, keys: Sequence[str], begins: Sequence[int]) -> bool:
    """Whether a chunk would begin at a row with the sort values of the row before it.

    Looks at two rows per chunk, which bounds the window.
    """
    before = Window.orderBy(_INDEX)
    around = numbered.filter(F.col(_INDEX).isin([i + step for i in begins for step in (-1, 0)]))
    same = reduce(and_, (ref(k).eqNullSafe(F.lag(ref(k)).over(before)) for k in keys))
    follows = F.col(_INDEX) == F.lag(_INDEX).over(before) + 1
    pairs = around.select(_INDEX, (same & follows).alias("__equal"))
    return not pairs.filter(F.col("__equal") & F.col(_INDEX).isin(list(begins))).isEmpty()


def write_chunks(
    df: DataFrame,
    path: str,
    n: int,
    order_by: Sequence[str] = (),
    descending: Collection[str] = (),
    files_per_chunk: int | None = None,
    **options: object,
) -> None:
    """Write ``n`` contiguous chunks as CSV with a header, one directory ``chunk=<i>`` for each.

    By default every task writes the rows it holds, so a chunk is many files and no task sees a whole
    chunk. ``files_per_chunk`` asks for about that many files instead, 1 meaning a single one, which
    fits only where a chunk fits in one task.
    """
    chunked = assign_chunks(df, n, order_by, descending)
    if files_per_chunk is not None:
        spread = F.pmod(F.xxhash64(*map(ref, df.columns)), F.lit(files_per_chunk))
        chunked = chunked.repartition(n * files_per_chunk, "chunk", spread)
    writer = chunked.write.mode("overwrite").partitionBy("chunk")
    writer.options(**(WRITE_OPTIONS | options)).csv(path)


def _identified(df: DataFrame) -> DataFrame:
    """Stage the rows once with a unique id, which a repeated task or a second scan cannot change."""
    return stage(df.withColumn(_ID, F.monotonically_increasing_id()), "rows")


def _sorted_rows(
    df: DataFrame, order_by: Sequence[str], descending: Collection[str]
) -> tuple[DataFrame, int]:
    """All rows with their number in the order given, and how many there are; one shuffle, one staged copy."""
    order = [F.desc(ref(c)) if c in descending else F.asc(ref(c)) for c in order_by]
    ranged = (
        df.withColumn(_ID, F.monotonically_increasing_id())
        .repartitionByRange(*order, _ID)
        .sortWithinPartitions(*order, _ID)
        .drop(_ID)
    )
    return _numbered(stage(ranged.withColumn(_PLACE, F.monotonically_increasing_id()), "sorted"))


def _ranked(rows: DataFrame, order_by: Sequence[str], descending: Collection[str]) -> DataFrame:
    """Sort columns and id of each row with its place in the global order.

    The id is the last sort column, so the range partitions split many rows of one sort value, or
    many copies of one row, as evenly as any others.
    """
    order = [F.desc(ref(c)) if c in descending else F.asc(ref(c)) for c in order_by]
    ranged = (
        rows.select(*map(ref, dict.fromkeys(order_by)), _ID)
        .repartitionByRange(*order, _ID)
        .sortWithinPartitions(*order, _ID)
    )
    return stage(ranged.withColumn(_PLACE, F.monotonically_increasing_id()), "places")


def _numbered(placed: DataFrame) -> tuple[DataFrame, int]:
    """Turn places into gapless numbers; also the total number of rows.

    A number is the place inside the partition plus the sizes of the partitions before. The table of
    sizes has one row per partition, which bounds the window and the broadcast.
    """
    part = F.shiftright(F.col(_PLACE), _POSITION_BITS)
    sizes = placed.groupBy(part.alias(_PART)).agg(F.count(F.lit(1)).alias("__size"))
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(_PART, F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__start"))
    position = F.col(_PLACE).bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    numbered = (
        placed.withColumn(_PART, part)
        .join(F.broadcast(starts), _PART)
        .withColumn(_INDEX, F.col("__start") + position)
        .drop(_PART, "__start", _PLACE)
    )
    total = sizes.agg(F.coalesce(F.sum("__size"), F.lit(0))).first()[0]
    return numbered, total


def _at_or_after(
    cut: Column, order_by: Sequence[str], descending: Collection[str], with_id: bool
) -> Column:
    """Whether the current row is the row ``cut`` or comes after it in the order of `_ranked`."""
    reached = F.col(_ID) >= cut[_ID] if with_id else F.lit(True)
    for name in reversed(order_by):
        mine, other = ref(name), cut[name]
        if name in descending:  # nulls last
            after = F.coalesce(mine < other, mine.isNull() & other.isNotNull())
        else:  # nulls first
            after = F.coalesce(mine > other, mine.isNotNull() & other.isNull())
        reached = after | (mine.eqNullSafe(other) & reached)
    return reached
