"""Data-quality checks: counts, nulls and distinct values across tables, and row expectations."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tierflow.functions import ref

_ACTIONS = ("warn", "drop", "fail")


def _one_row(labelled: list[tuple[DataFrame, Column]]) -> DataFrame:
    """Aggregates over several tables side by side in one row, in the given order.

    All aggregates over one table share one scan; the other tables come in as scalar subqueries.
    """
    tables: dict[int, tuple[DataFrame, list[Column]]] = {}
    for table, aggregate in labelled:
        tables.setdefault(id(table), (table, []))[1].append(aggregate)
    rows = [table.agg(*aggregates) for table, aggregates in tables.values()]
    first, *others = rows
    packed = [
        other.select(F.struct("*").alias("row")).scalar().alias(f"__other{i}")
        for i, other in enumerate(others)
    ]
    wide = first.select("*", *packed)
    spread = [ref(c) for c in first.columns]
    for i, other in enumerate(others):
        spread += [F.col(f"__other{i}")[c].alias(c) for c in other.columns]
    return wide.select(*spread)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row with the row count of each table, under its label."""
    counted = [(df, F.count(F.lit(1)).alias(label)) for label, df in tables.items()]
    return _one_row(counted).select(*map(ref, tables))


def null_counts(checks: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """One row with the number of nulls of each (table, column), under its label."""
    counted = [
        (df, F.count_if(ref(column).isNull()).alias(label))
        for label, (df, column) in checks.items()
    ]
    return _one_row(counted).select(*map(ref, checks))


def distinct_counts(
    checks: Mapping[str, tuple[DataFrame, str]], error: float | None = None
) -> DataFrame:
    """One row with the number of distinct non-null values of each (table, column).

    Exact counts shuffle every distinct value. With ``error``, a relative standard deviation such as 0.01, the
    numbers are estimates from sketches of fixed size, one per task.
    """

    def distinct(column: str) -> Column:
        return F.count_distinct(ref(column)) if error is None else F.approx_count_distinct(ref(column), error)

    counted = [(df, distinct(column).alias(label)) for label, (df, column) in checks.items()]
    return _one_row(counted).select(*map(ref, checks))


def newest(df: DataFrame, time_col: str, n: int = 20) -> DataFrame:
    """The ``n`` latest rows, for inspecting what the last run brought in."""
    return df.orderBy(F.desc(ref(time_col))).limit(n)


def violated(rules: Mapping[str, Column]) -> Column:
    """The names of the rules that a row breaks, in the order given; null counts as a violation."""
    names = [F.when(~F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items()]
    return F.array_compact(F.array(*names)) if names else F.array().cast("array<string>")


def quarantined(df: DataFrame, rules: Mapping[str, Column], violated_col: str = "_violated") -> tuple[DataFrame, DataFrame]:
    """The rows that break no rule, and the others with the list of the rules that each breaks.

    ``df`` is read once for each of the two and must be repeatable; `tierflow.storage.stage` makes it so.
    """
    marked = df.withColumn(violated_col, violated(rules))
    kept = marked.filter(F.size(violated_col) == 0).drop(violated_col)
    return kept, marked.filter(F.size(violated_col) > 0)


def violation_counts(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """One row with ``row_count`` and the violations of each rule; null counts as a violation."""
    broken = [F.count_if(~F.coalesce(rule, F.lit(False))).alias(name) for name, rule in rules.items()]
    return df.agg(F.count(F.lit(1)).alias("row_count"), *broken)


def expect(
    df: DataFrame, rules: Mapping[str, Column], action: str = "warn"
) -> tuple[DataFrame, Observation]:
    """Check every row against named conditions while it passes through.

    A row violates a rule unless its condition is true, so null counts as a violation. ``warn`` keeps
    such rows, ``drop`` removes them, ``fail`` ends the job at the first one and names all rules that it
    breaks. The observation holds
    ``row_count`` and the violations of each rule, counted in the same pass, once an action has run.
    """
    if action not in _ACTIONS:
        raise ValueError(f"action must be one of {_ACTIONS}, not {action!r}")
    passed = {name: F.coalesce(rule, F.lit(False)) for name, rule in rules.items()}
    seen = Observation()
    counted = df.observe(
        seen,
        F.count(F.lit(1)).alias("row_count"),
        *(F.count_if(~ok).alias(name) for name, ok in passed.items()),
    )
    if action == "warn" or not passed:
        return counted, seen
    if action == "drop":
        return counted.filter(reduce(and_, passed.values())), seen
    message = F.concat(F.lit("expectations violated: "), F.array_join(violated(rules), ", "))
    broken = F.raise_error(message).cast("boolean")
    return counted.filter(F.when(reduce(and_, passed.values()), F.lit(True)).otherwise(broken)), seen
