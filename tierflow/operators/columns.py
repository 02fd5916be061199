"""Column-level operators: name clean-up, technical columns, time stamps."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.functions import clean_name

# Columns of the raw layer that the refined layer does not keep.
TECHNICAL_COLUMNS = ("_rescued_data", "source_file")


def clean_names(df: DataFrame, lower: bool = True) -> DataFrame:
    """Clean every column name in one projection.

    ``lower=True`` is the raw-layer rule, ``lower=False`` the refined-layer rule. Names that become
    equal raise, since each later use of them would be ambiguous.
    """
    cleaned = [clean_name(name, lower) for name in df.columns]
    case_sensitive = df.sparkSession.conf.get("spark.sql.caseSensitive") == "true"
    sources = defaultdict(list)
    for old, new in zip(df.columns, cleaned):
        sources[new if case_sensitive else new.lower()].append(old)
    clashes = {new: old for new, old in sources.items() if len(old) > 1}
    if clashes:
        raise ValueError(f"column names collide after cleaning: {clashes}")
    return df.toDF(*cleaned)


def drop_technical(df: DataFrame, names: Iterable[str] = TECHNICAL_COLUMNS) -> DataFrame:
    """Drop those of ``names`` that exist."""
    return df.drop(*names)


def stamp(df: DataFrame, column: str, at: datetime | None = None) -> DataFrame:
    """Add the time of the run, constant over one query or micro-batch; ``at`` fixes it for replays."""
    return df.withColumn(column, F.current_timestamp() if at is None else F.lit(at))
