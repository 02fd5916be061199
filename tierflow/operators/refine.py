"""Operators that turn raw rows into refined rows."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.functions import (
    blank_to_null,
    cast_or_null,
    fold_case,
    lost_by_cast,
    record_digest,
    ref,
    squash_spaces,
)
from tierflow.storage import stage

# Rows that share a digest with another row and are still dropped by position: 24 bytes each are broadcast.
MOST_SHARED = 1_000_000

_ID = "__row_id"
_CAST = "__cast_"
_NULL = "__null_"


def conform(
    df: DataFrame,
    schema: T.StructType,
    rescue: str | None = "_rescued_data",
    whole: Sequence[str] = (),
) -> DataFrame:
    """Cast the columns named in ``schema`` to its types; other columns pass through.

    A value that does not fit becomes null, and its original text goes into the JSON column
    ``rescue`` (null for a row that fits, ``rescue=None`` to do without). The columns ``whole`` move
    there as they are. Projections only, no shuffle.
    """
    missing = [f.name for f in schema if f.name not in df.columns]
    if missing:
        raise ValueError(f"columns {missing} are not in the data, which has {df.columns}")
    have = {f.name: f.dataType for f in df.schema}
    wanted = {f.name: f.dataType for f in schema if have[f.name] != f.dataType}
    # Each value is cast once here; used twice below, the cast stays in a projection of its own.
    casts = df.withColumns({_CAST + c: cast_or_null(ref(c), to) for c, to in wanted.items()})
    rows = [
        ref(_CAST + c).alias(c) if c in wanted else ref(c) for c in df.columns if c not in whole
    ]
    if rescue is None:
        return casts.select(*rows)
    lost = [lost_by_cast(ref(c), ref(_CAST + c)).alias(c) for c in wanted] + [ref(c) for c in whole]
    rescued = F.lit(None).cast("string")
    if lost:
        rescued = F.when(F.coalesce(*lost).isNotNull(), F.to_json(F.struct(*lost)))
    return casts.select(*rows, rescued.alias(rescue))


def normalize_text(df: DataFrame, columns: Iterable[str], case: str | None = None) -> DataFrame:
    """Trim, collapse white space, fold case if asked, and turn blank text into null."""
    return df.withColumns(
        {c: fold_case(blank_to_null(squash_spaces(ref(c))), case) for c in columns}
    )


def require_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keep the rows whose ``columns`` are all non-null.

    Written as plain ``IS NOT NULL`` predicates, which reach the file scan; ``DataFrame.dropna`` does
    not, and would also drop NaN.
    """
    return df.filter(reduce(and_, (ref(c).isNotNull() for c in columns)))


def dedup(df: DataFrame, ignore: Sequence[str] = (), wide: bool = False) -> DataFrame:
    """One row for each distinct row.

    With ``ignore``, rows that differ only in those columns count as equal, and the smallest value of
    the ignored columns is kept, such as the earliest ingestion time; null counts as the largest.
    Several ignored columns are taken together from one row. All forms combine copies before the
    shuffle, so a record with very many copies costs one row per task.

    ``wide`` is for long rows of which few are copies: digests and positions are shuffled instead of rows, only
    rows that share a digest are compared in full, and the others are dropped by position where they lie. The rows are
    staged once, and calling this runs that job; where more than ``MOST_SHARED`` rows share a digest, they are
    compared as without ``wide``.
    """
    if wide:
        return _dedup_by_digest(df, ignore)
    if not ignore:
        return df.dropDuplicates()
    keys = [c for c in df.columns if c not in set(ignore)]
    if len(ignore) == 1:
        (only,) = ignore
        kept = df.groupBy(*map(ref, keys)).agg(F.min(ref(only)).alias(only))
    else:
        nulls_last = [part for c in ignore for part in (ref(c).isNull().alias(_NULL + c), ref(c))]
        kept = df.groupBy(*map(ref, keys)).agg(F.min(F.struct(*nulls_last)).alias("__kept"))
        kept = kept.select(*map(ref, keys), "__kept.*")
    return kept.select(*map(ref, df.columns))


def _dedup_by_digest(df: DataFrame, ignore: Sequence[str]) -> DataFrame:
    compared = [c for c in df.columns if c not in set(ignore)]
    rows = stage(df.withColumn(_ID, F.monotonically_increasing_id()), "wide-rows")
    digest = F.unhex(record_digest(df.schema, compared)).alias("digest")
    # 16 bytes and a position for each row
    groups = rows.select(digest, _ID).groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min(_ID).alias(_ID))
    digests = stage(groups.filter("n > 1"), "shared-digests")
    shared = digests.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    if shared == 0:
        return rows.drop(_ID)
    if shared > MOST_SHARED:
        return dedup(rows.drop(_ID), ignore)
    # at most MOST_SHARED rows from here on, beside the scans
    alike = F.broadcast(digests.select("digest"))
    alike = stage(rows.withColumn("digest", digest).join(alike, "digest", "left_semi").drop("digest"), "shared-rows")
    nulls_last = [part for c in ignore for part in (ref(c).isNull().alias(_NULL + c), ref(c).alias(c))]
    first = F.min(F.struct(*nulls_last, _ID)).getField(_ID).alias("kept")
    kept = alike.groupBy(*map(ref, compared)).agg(first)
    copies = alike.select(_ID).join(kept.select(F.col("kept").alias(_ID)), _ID, "left_anti")
    return rows.join(F.broadcast(copies), _ID, "left_anti").drop(_ID)
