"""Rounding of aggregated doubles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_up(value: Column, digits: int) -> Column:
    """Round half away from zero to ``digits`` places, once, on the shortest decimal text of a double.

    A double sum depends on the order in which partial sums are merged. Where a result next to x.xx5 must
    not depend on that, sum exact decimals instead. Infinity, NaN and values of any magnitude pass through.
    """
    return F.round(value, digits)
