"""Sums of doubles that are exact and rounded once, whatever the order in which rows meet.

A double is an integer of 53 bits times a power of two. Its bits are cut into four digits of base 2**22, counted from a
place that depends on the size of the value. Sums per place and digit are sums of whole numbers, which no order changes;
each task sends one row per group and place. At the end a group's digits, of a few places, are carried into one long
number, and that is rounded to a double: half to even, as a single addition would be. Built-in expressions only.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.functions import ref

# Bits of a digit: 2**40 rows of a group may share a place before a sum of digits leaves 64 bits, which raises.
_BITS = 22
_BASE = 1 << _BITS
# Digits that 53 bits can touch.
_DIGITS = 4
# Bits of the number that is rounded, more than a double's 53 and the two that decide.
_KEPT = 60

_DIGIT_NAMES = [f"d{i}" for i in range(_DIGITS)]
_STATE = "struct<carry:bigint,digits:array<bigint>>"


def exact_sums(df: DataFrame, keys: Sequence[str], columns: Mapping[str, str]) -> DataFrame:
    """For each group the sums of float or double columns, as if added without rounding and rounded once.

    ``columns`` maps output names to columns. Nulls do not count, and a group of nulls only has a null sum; without keys
    there is one row. Infinities and NaN give what adding them gives. A sum beyond the largest double is infinite. An
    empty table has no groups.
    """
    found = summed(df, keys, columns)
    return found.select(*map(ref, keys), *(F.col("__sums")[name]["total"].alias(name) for name in columns))


def is_floating(df: DataFrame, column: str) -> bool:
    return isinstance(df.select(ref(column)).schema[0].dataType, (T.FloatType, T.DoubleType))


def summed(df: DataFrame, keys: Sequence[str], columns: Mapping[str, str]) -> DataFrame:
    """Keys, ``__rows`` and ``__sums``, a struct that holds (total, n) for each of ``columns``: n counts non-null values."""
    return merged_sums(partial_sums(df, keys, columns), keys, columns)


def partial_sums(df: DataFrame, keys: Sequence[str], columns: Mapping[str, str]) -> DataFrame:
    """What `merged_sums` needs of the rows: one row per group, column and place, to be stored and combined."""
    return combined_sums(placed_rows(df, keys, columns), keys)  # each task combines its own rows first


def placed_rows(df: DataFrame, keys: Sequence[str], columns: Mapping[str, str]) -> DataFrame:
    """A row for each row and column, which `combined_sums` adds up to `partial_sums`; no shuffle."""
    other = [c for c in columns.values() if not is_floating(df, c)]
    if other:
        raise ValueError(f"columns {other} are not float or double; their plain sums are exact")
    names = _key_names(keys)
    values = F.array(*(F.struct(F.lit(i).alias("m"), ref(c).cast("double").alias("x")) for i, c in enumerate(columns.values())))
    long = df.select(*(ref(k).alias(name) for k, name in zip(keys, names)), F.inline(values))
    placed = _placed(long, [*names, "m"], _DIGIT_NAMES)
    return placed.select(
        *names,
        "m",
        "place",
        *_DIGIT_NAMES,
        "odd",
        F.col("x").isNotNull().cast("long").alias("n"),
        F.lit(1).cast("long").alias("rows"),
    )


def combined_sums(partial: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Partial sums of several parts of the rows, or their `placed_rows`, as the partial sums of all."""
    names = _key_names(keys)
    added = (*_DIGIT_NAMES, "odd", "n", "rows")
    return partial.groupBy(*names, "m", "place").agg(*(F.sum(c).alias(c) for c in added))


def rough_sizes(partial: DataFrame) -> tuple[Column, Column]:
    """Of each row of partial sums of one column, what it adds to the sum and a bound of its size, as doubles.

    Both are off by a few units in the last place of the bound; what is not finite is in both.
    """
    half = F.shiftright("place", 1)
    unit = _power(_BITS * half)
    parts = [F.col(d).cast("double") * F.lit(2.0 ** (-_BITS * i)) for i, d in enumerate(_DIGIT_NAMES)]
    by_place = _power(_BITS * (F.col("place") - half))
    whole = reduce(add, parts) * unit * by_place
    size = reduce(add, map(F.abs, parts)) * unit * by_place
    return F.coalesce("odd", whole), F.abs(F.coalesce("odd", size))


def sums_of_leading(partial: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """The rows of ``partial``, of one column, whose groups can be among the ``n`` largest; see `leading_groups`."""
    rows = partial.filter("n > 0")
    return leading_groups(rows, [F.col(name) for name in _key_names(keys)], *rough_sizes(rows), n)


# Hashes that the driver looks at, those whose groups are summed first, and the part of a sum that adding up to
# 2**40 doubles in any order can be off.
_MOST_LEADING = 1000
_TRIED_PER_GROUP = 4
_LEAST_TRIED = 64
_SLACK = 2.0**-12


def leading_groups(rows: DataFrame, keys: Sequence[Column], amount: Column, size: Column, n: int) -> DataFrame:
    """The rows of all groups that can be among the ``n`` with the largest sums of ``amount``.

    ``size`` bounds the absolute value of a row's amount. The sum of the sizes of all rows with one hash of the keys is a
    bound that no group of that hash exceeds. Groups of the largest bounds are summed: the ``n``-th of them is a total that
    the winners reach, so a hash with a smaller bound holds none. Shuffled are a hash and a bound for each group; calling
    this runs that. All rows are returned where there are fewer than ``n`` groups with a finite bound among those
    tried, or where many come close to the ``n``-th: even totals, or values of both signs that cancel out.
    """
    infinite = float("inf")
    # 40 bits, and a bound that was rounded up to a short one, are fewer bytes to shuffle
    short = (F.nanvl(size, F.lit(infinite)) * (1 + _SLACK)).cast("float").cast("double")
    some = F.shiftrightunsigned(F.xxhash64(*keys), 24)
    # beyond the range of floats, and below it, bounds are infinite or a little more than nothing
    hashed = rows.withColumns({"__hash": some, "__amount": amount, "__size": F.greatest(short, F.lit(2.0**-126))})
    most = max(_MOST_LEADING, 2 * _TRIED_PER_GROUP * n)
    largest = (
        hashed.groupBy("__hash").agg(F.sum("__size").alias("size")).orderBy(F.desc("size"), "__hash").limit(most + 1).collect()
    )

    def within(hashes: list[int]) -> DataFrame:
        wanted = rows.sparkSession.createDataFrame([(h,) for h in hashes], "__hash long")
        return hashed.join(F.broadcast(wanted), "__hash", "left_semi")

    tried = [r["__hash"] for r in largest[: max(_TRIED_PER_GROUP * n, _LEAST_TRIED)]]
    totals = within(tried).groupBy(*keys).agg(F.sum("__amount").alias("total"), F.sum("__size").alias("size"))
    sure = F.when(F.col("size") < infinite, F.col("total") - F.col("size") * _SLACK)
    reached = totals.select(sure.alias("sure")).filter("sure is not null").orderBy(F.desc("sure")).limit(n).collect()
    if len(reached) < n:
        return rows
    kept = [r["__hash"] for r in largest if r["size"] * (1 + _SLACK) >= reached[-1]["sure"]]
    return rows if len(kept) > most else within(kept).select(*rows.columns)


def merged_sums(partial: DataFrame, keys: Sequence[str], columns: Mapping[str, str]) -> DataFrame:
    """Keys, ``__rows`` and ``__sums`` as from `summed`; ``partial`` has one row per group, column and place."""
    names = _key_names(keys)
    groups = partial.groupBy(*names, "m").agg(
        F.sum("odd").alias("odd"),
        F.sum("n").alias("n"),
        F.sum("rows").alias("rows"),
        F.collect_list(F.struct("place", *_DIGIT_NAMES)).alias("bins"),
    )
    total = F.when(F.col("n") > 0, F.coalesce("odd", "nearest"))
    totals = _rounded(groups).select(*names, "m", "n", "rows", total.alias("total"))
    wide = totals.groupBy(*names).agg(
        F.max("rows").alias("__rows"),
        F.struct(
            *(
                F.struct(
                    F.max(F.when(F.col("m") == i, F.col("total"))).alias("total"),
                    F.max(F.when(F.col("m") == i, F.col("n"))).alias("n"),
                ).alias(name)
                for i, name in enumerate(columns)
            )
        ).alias("__sums"),
    )
    return wide.select(*(F.col(name).alias(k) for k, name in zip(keys, names)), "__rows", "__sums")


def _key_names(keys: Sequence[str]) -> list[str]:
    return [f"__key{i}" for i in range(len(keys))]


def _power(exponent: Column) -> Column:
    """Two to a whole exponent within a double's range, exactly."""
    return F.pow(F.lit(2.0), exponent)


def _placed(long: DataFrame, keys: Sequence[str], digits: Sequence[str]) -> DataFrame:
    """Each value as four signed digits from its place down; zero, null and what is not finite have none.

    The place comes from a logarithm that may be one off, which the first digit bears: all steps are exact.
    """
    size = F.abs("x")
    finite = F.coalesce(size < F.lit(float("inf")), F.lit(False))
    place = F.when(finite & (size > 0), F.floor(F.log2(size) / _BITS))
    rows = long.select(
        *keys,
        "x",
        F.when(~finite, F.col("x")).alias("odd"),
        F.when(finite, F.signum("x")).alias("sign"),
        F.when(finite, size).alias("size"),
        F.coalesce(place, F.lit(0)).alias("place"),
    )
    half = F.shiftright("place", 1)  # in two steps, so that no power leaves the range
    rest = F.col("size") * _power(-_BITS * half) * _power(-_BITS * (F.col("place") - half))
    for digit in digits:
        rows = rows.withColumn("rest", rest).withColumn(digit, F.floor("rest"))
        rest = (F.col("rest") - F.col(digit)) * F.lit(float(_BASE))
    signed = [(F.col(digit) * F.col("sign").cast("long")).alias(digit) for digit in digits]
    return rows.select(*keys, "x", "odd", "place", *signed)


def _rounded(groups: DataFrame) -> DataFrame:
    """Column ``nearest``: the double nearest to the digits of all ``bins``, ties to even.

    Step by step in projections of their own, so that no step is evaluated again inside the next one.
    """

    def at(place: Column) -> Column:
        """What all bins hold for one place."""

        def with_entry(total: Column, entry: Column) -> Column:
            held = (F.when(entry["place"] == place + i, entry[f"d{i}"]).otherwise(F.lit(0)) for i in range(_DIGITS))
            return total + reduce(add, held)

        return F.aggregate("bins", F.lit(0).cast("long"), with_entry)

    def carried(amounts: Column) -> Column:
        """Digits from 0 to 2**22 - 1, lowest first, and the carry beyond: 0, or -1 for a negative number."""

        def step(state: Column, amount: Column) -> Column:
            whole = state["carry"] + amount
            return F.struct(
                F.shiftright(whole, _BITS).alias("carry"),
                F.concat(state["digits"], F.array(whole.bitwiseAND(F.lit(_BASE - 1)))).alias("digits"),
            )

        start = F.struct(F.lit(0).cast("long").alias("carry"), F.array().cast("array<bigint>").alias("digits"))
        return F.aggregate(amounts, start.cast(_STATE), step)

    def shifted(name: str, value: Column, by: Column) -> Column:
        return F.call_function(name, value, by.cast("int"))

    sums = groups.withColumn("lowest", F.array_min("bins.place") - (_DIGITS - 1))
    # three places more take the last carries
    sums = sums.withColumn("highest", F.array_max("bins.place") + 3)
    sums = sums.withColumn("sums", F.transform(F.sequence("lowest", "highest"), at))
    signed = sums.withColumn("plain", carried(F.col("sums"))).withColumn("negative", F.col("plain.carry") < 0)
    turned = carried(F.transform("sums", lambda amount: -amount))["digits"]
    signed = signed.withColumn("digits", F.when(F.col("negative"), turned).otherwise(F.col("plain.digits")))
    # three digits more below, so that there are four from the first that is not zero
    zeros = F.array_repeat(F.lit(0).cast("long"), _DIGITS - 1)
    padded = signed.withColumn("padded", F.concat(zeros, "digits"))
    from_top = F.array_position(F.reverse(F.transform("padded", lambda d: (d != 0).cast("int"))), 1)
    found = padded.withColumn("from_top", from_top)
    found = found.withColumn("top", F.when(F.col("from_top") > 0, F.size("padded") + 1 - F.col("from_top")))
    for i in range(_DIGITS):
        found = found.withColumn(f"t{i}", F.element_at("padded", (F.col("top") - i).cast("int")))
    below = F.slice("padded", F.lit(1), F.greatest(F.col("top") - _DIGITS, F.lit(0)).cast("int"))
    parts = found.select(
        *groups.columns,
        "negative",
        "lowest",
        "top",
        (F.col("t0") * _BASE + F.col("t1")).alias("high"),
        (F.col("t2") * _BASE + F.col("t3")).alias("low"),
        (F.length(F.bin("t0")) + ((_DIGITS - 1) * _BITS - _KEPT)).alias("shift"),
        F.exists(below, lambda d: d != 0).alias("deeper"),
    )
    shift = F.col("shift")
    lost = F.col("low").bitwiseAND(shifted("shiftleft", F.lit(1).cast("long"), shift) - 1) != 0
    odd = (lost | F.col("deeper")).cast("long")  # stands for all that lies below the bits kept
    kept = shifted("shiftleft", F.col("high"), 2 * _BITS - shift) + shifted("shiftright", F.col("low"), shift)
    scaled = parts.withColumn("number", kept.bitwiseOR(odd).cast("double")).withColumn(
        "exponent", (F.col("lowest") + F.col("top") - (2 * _DIGITS - 1)) * _BITS + shift
    )
    half = F.shiftright("exponent", 1)
    size = F.coalesce(F.col("number") * _power(half) * _power(F.col("exponent") - half), F.lit(0.0))
    return scaled.select(*groups.columns, F.when(F.col("negative"), -size).otherwise(size).alias("nearest"))
