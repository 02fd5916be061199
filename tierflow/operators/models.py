"""Reusable gold models: totals, per-group rankings, group summaries, yearly trends."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tierflow.functions import ref, round_half_up
from tierflow.operators.exact import is_floating, leading_groups, merged_sums, partial_sums
from tierflow.operators.split import MOST_BROADCAST_ROWS, first_of_groups

# Hash buckets of the bounds of `_with_large_groups`, the buckets whose groups are summed first, and the share
# of buckets beyond which all groups are summed.
BUCKETS = 1 << 16
TRIED_PER_GROUP = 4
LEAST_TRIED = 64
MOST_KEPT = 0.5
_BUCKET = "__bucket"

_AGGREGATES = {"sum": F.sum, "avg": F.avg}

# The task that ranks a hot group gets up to n rows from each task before it: 10 million rows of one
# group for 100 rows from 100,000 tasks, which it can still sort.
MOST_RANKED_BY_WINDOW = 100

# More classes bring the bound of `_contenders` closer to the n-th value, at the cost of
# as many more maxima per group.
CLASSES_PER_ROW = 16


def _ordering(value: str, tie_break: Sequence[str]) -> list[Column]:
    return [F.desc(ref(value)), *(F.asc(ref(c)) for c in tie_break)]


def top_groups_by_sum(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    n: int = 10,
    digits: int = 2,
    tie_break: Sequence[str] = (),
    exact: bool = False,
    many_groups: bool = False,
    small_groups: bool = False,
) -> DataFrame:
    """The ``n`` groups with the largest sum of ``value``, largest first.

    Null values are left out beforehand, so a group of nulls only does not appear. The cut is made on
    the unrounded sum; rounding comes last. ``tie_break`` names key columns that settle equal sums. With ``exact``
    the result does not depend on the order in which tasks end, see `exact_sums`.

    ``many_groups`` is for more groups than should be shuffled, with values that are not negative: two passes over the
    key and value columns find which groups can be among the first ``n``, and only their rows are summed. ``df`` is
    then read three times and must be repeatable, and calling this runs those passes. Where they exclude too
    little, or a value is negative or NaN, all groups are summed.

    ``small_groups`` is for nearly as many groups as rows, of which a few lead: of each group a hash and a bound are
    shuffled instead of its keys and sums, and only the rows of groups that can be among the first ``n`` are summed (see
    `leading_groups`). ``df`` is read three times too, and must be repeatable.
    """
    rows = df.filter(ref(value).isNotNull())
    if small_groups:
        amount = ref(value).cast("double")
        rows = leading_groups(rows.select(*map(ref, dict.fromkeys([*keys, value]))), [*map(ref, keys)], amount, F.abs(amount), n)
    if many_groups:
        rows = _with_large_groups(rows.select(*map(ref, dict.fromkeys([*keys, value]))), keys, value, n)
    return (
        _aggregated(rows, keys, {value: ("sum", value)}, exact)
        .orderBy(*_ordering(value, tie_break))
        .limit(n)
        .withColumn(value, round_half_up(ref(value), digits))
    )


def _with_large_groups(rows: DataFrame, keys: Sequence[str], value: str, n: int) -> DataFrame:
    """The rows of all groups that can be among the ``n`` with the largest sums of values that are not negative.

    Groups fall into buckets by hash; a bucket's sum is a bound that none of its groups exceeds. The groups of the
    largest buckets are summed: the ``n``-th of them is a total that the winners reach, so a bucket with a smaller sum
    holds none. Shuffled are one row per bucket and task, then the groups of a few buckets.
    """
    spark = rows.sparkSession
    bucketed = rows.withColumn(_BUCKET, F.pmod(F.xxhash64(*map(ref, keys)), F.lit(BUCKETS)))
    amount = ref(value).cast("double")
    found = (
        bucketed.groupBy(_BUCKET)
        .agg(F.sum(amount).alias("total"), F.min(amount).alias("least"), F.max(amount).alias("most"), F.count("*").alias("n"))
        .toArrow()  # at most BUCKETS rows
        .sort_by([("total", "descending"), (_BUCKET, "ascending")])
    )
    totals, least, most = (found[c].to_pylist() for c in ("total", "least", "most"))
    if not totals or min(least) < 0 or not all(x < float("inf") for x in most):  # NaN is not
        return rows

    def within(count: int) -> DataFrame:
        kept = spark.createDataFrame(found.slice(0, count).select([_BUCKET]))
        return bucketed.join(F.broadcast(kept), _BUCKET, "left_semi").drop(_BUCKET)

    tried = max(TRIED_PER_GROUP * n, LEAST_TRIED)
    if tried < len(totals):
        sums = within(tried).groupBy(*map(ref, keys)).agg(F.sum(amount).alias("total"))
        reached = sums.orderBy(F.desc("total")).limit(n).select("total").collect()
        if len(reached) == n:
            # what adding in another order may change: half a unit in the last place for each row, on both sides
            slack = [1 + rows_of * 2.0**-51 for rows_of in found["n"].to_pylist()]
            bound = reached[-1]["total"] / max(slack)
            kept = max(tried, sum(total * s >= bound for total, s in zip(totals, slack)))
            if kept <= len(totals) * MOST_KEPT:
                return within(kept)
    return rows


def top_n_per_group(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    n: int = 5,
    rank_col: str = "rank_in_group",
    tie_break: Sequence[str] = (),
    few_groups: bool = False,
) -> DataFrame:
    """The ``n`` rows with the largest ``value`` in each group, all columns kept, ranked from 1.

    Rows with a null ``value`` are left out; a null key is a group of its own. For small ``n`` each task
    sends at most ``n`` rows per group to the shuffle, which bounds a hot group. Beyond that, ranks come
    from a global row index, so that no group is ever sorted in one task.

    With ``few_groups``, for large groups such as years, and for large ``n``, a first pass over the key and value
    columns finds which rows can be among the first ``n``, so that the others are neither sorted nor staged. ``df``
    is then read twice and must be repeatable, and calling this runs that pass.
    """
    rows = df.filter(ref(value).isNotNull())
    limit = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold"))
    deep = n > min(limit, MOST_RANKED_BY_WINDOW)
    if few_groups or deep:
        rows = _contenders(rows, keys, value, n)
    if deep:
        return first_of_groups(rows, keys, [value, *tie_break], n, rank_col, descending=[value])
    window = Window.partitionBy(*map(ref, keys)).orderBy(*_ordering(value, tie_break))
    return rows.withColumn(rank_col, F.row_number().over(window)).filter(ref(rank_col) <= n)


def _contenders(rows: DataFrame, keys: Sequence[str], value: str, n: int) -> DataFrame:
    """The rows that can be among the ``n`` largest of their group.

    Rows fall into classes by a hash of the value. The largest values of ``n`` classes belong to ``n``
    different rows, so the smallest of them is a bound that no row below can overcome. A group with
    fewer classes keeps all its rows, and so does every group where there are too many to broadcast.
    """
    names = [f"__key{i}" for i in range(len(keys))]
    spread = F.pmod(F.xxhash64(ref(value)), F.lit(CLASSES_PER_ROW * n)).alias("__class")
    grouped = rows.groupBy(*(ref(k).alias(name) for k, name in zip(keys, names)), spread)
    largest = F.sort_array(F.collect_list("__largest"), asc=False)
    bounds = (
        grouped.agg(F.max(ref(value)).alias("__largest"))
        .groupBy(*names)
        .agg(F.try_element_at(largest, F.lit(n)).alias("__bound"))
    )
    found = bounds.limit(MOST_BROADCAST_ROWS + 1).toArrow()
    if found.num_rows > MOST_BROADCAST_ROWS:
        return rows
    bounds = rows.sparkSession.createDataFrame(found, bounds.schema)
    same_group = [ref(k).eqNullSafe(F.col(name)) for k, name in zip(keys, names)]
    near = F.col("__bound").isNull() | (ref(value) >= F.col("__bound"))
    return rows.join(F.broadcast(bounds), [*same_group, near]).select(*map(ref, rows.columns))


def avg_by_group(
    df: DataFrame, keys: Sequence[str], value: str, output: str, digits: int = 2, exact: bool = False
) -> DataFrame:
    """Mean of ``value`` for each group, largest first.

    Nulls do not count; a group of nulls only has a null mean and comes last. ``exact`` as in `group_summary`.
    """
    return group_summary(df, keys, {output: ("avg", value)}, order_by=output, digits=digits, exact=exact)


def group_summary(
    df: DataFrame,
    keys: Sequence[str],
    measures: dict[str, tuple[str, str]],
    order_by: str | None = None,
    digits: int = 2,
    exact: bool = False,
) -> DataFrame:
    """Rounded sums and means for each group, sorted descending on the rounded ``order_by``.

    ``measures`` maps an output name to ``("sum" | "avg", column)``; ``order_by`` defaults to the
    first one. With ``exact``, sums of doubles are exact and rounded once, and a mean is such a sum divided by the
    count, so that the result does not depend on the order in which tasks end.
    """
    unknown = sorted({kind for kind, _ in measures.values()} - set(_AGGREGATES))
    if unknown:
        raise ValueError(f"unknown aggregates {unknown}; expected {sorted(_AGGREGATES)}")
    first = order_by or next(iter(measures))
    rounded = [round_half_up(ref(name), digits).alias(name) for name in measures]
    return (
        _aggregated(df, keys, measures, exact)
        .select(*map(ref, keys), *rounded)
        .orderBy(F.desc(ref(first)))
    )


def _aggregated(
    df: DataFrame, keys: Sequence[str], measures: dict[str, tuple[str, str]], exact: bool, row_count: str | None = None
) -> DataFrame:
    """Keys and unrounded measures; with ``row_count`` the number of rows. Plain sums are exact unless of doubles."""
    floating = {c: is_floating(df, c) for _, c in measures.values()} if exact else {}
    if exact and all(floating.values()):
        partial = partial_sums(df, keys, {c: c for c in floating})
        return exact_measures(partial, keys, measures, row_count)
    if any(floating.values()):
        raise ValueError(f"exact measures are all of doubles or all not: {floating}")
    outputs = [_AGGREGATES[kind](ref(column)).alias(name) for name, (kind, column) in measures.items()]
    counted = [] if row_count is None else [F.count(F.lit(1)).alias(row_count)]
    return df.groupBy(*map(ref, keys)).agg(*counted, *outputs)


def exact_measures(
    partial: DataFrame, keys: Sequence[str], measures: dict[str, tuple[str, str]], row_count: str | None = None
) -> DataFrame:
    """Keys and unrounded measures from the `partial_sums` of the measures' columns."""
    columns = {column: column for _, column in measures.values()}

    def measure(kind: str, column: str) -> Column:
        held = F.col("__sums")[column]
        return held["total"] if kind == "sum" else F.try_divide(held["total"], held["n"])

    outputs = [measure(kind, column).alias(name) for name, (kind, column) in measures.items()]
    counted = [] if row_count is None else [F.col("__rows").alias(row_count)]
    return merged_sums(partial, keys, columns).select(*map(ref, keys), *counted, *outputs)


def yearly_trends(df: DataFrame, year: str, value: str, digits: int = 2, exact: bool = False) -> DataFrame:
    """Rows, total and change of the total against the year before, one row per year.

    The year before is the one before among those present, so after a gap the change spans it. A null year has
    a row without a change and is the year before of none. Our own definition: the surveyed pipeline names
    such a table and defines nothing. The window runs on one row per year, after the aggregation, so
    ``year`` should be a column of few values. ``exact`` as in `group_summary`.
    """
    return trends_of_totals(
        _aggregated(df, [year], {"__total": ("sum", value)}, exact, row_count="row_count"), year, digits
    )


def trends_of_totals(totals: DataFrame, year: str, digits: int = 2) -> DataFrame:
    """`yearly_trends` from one row per year with ``row_count`` and ``__total``."""
    known = Window.partitionBy(ref(year).isNull()).orderBy(F.asc(ref(year)))
    before = F.lag("__total").over(known)
    change = F.col("__total") - before
    return totals.select(
        ref(year),
        "row_count",
        round_half_up(F.col("__total"), digits).alias("total"),
        round_half_up(change, digits).alias("change"),
    ).orderBy(F.asc(ref(year)))
