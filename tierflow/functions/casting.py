"""Casts that never fail a job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def cast_or_null(value: Column, to: T.DataType) -> Column:
    """Cast, or null where the value does not fit (a plain cast raises under ANSI mode).

    A value that the cast would cut does not fit: a fraction in a whole number, more decimals than a decimal
    holds, a time of day in a date. It is compared with what a wider type makes of it.
    """
    casted = value.try_cast(to)
    if isinstance(to, (T.IntegralType, T.DecimalType)):
        wide = T.DecimalType(38, 18)
        large = T.DoubleType()  # beyond 20 digits before the point
        cut = F.coalesce(value.try_cast(wide) != casted.try_cast(wide), value.try_cast(large) != casted.try_cast(large))
    elif isinstance(to, T.DateType):
        moment = T.TimestampNTZType()
        cut = value.try_cast(moment) != casted.try_cast(moment)
    else:
        return casted
    return F.when(~F.coalesce(cut, F.lit(False)), casted)


def lost_by_cast(value: Column, casted: Column) -> Column:
    """The original value as text where the cast lost it, else null. Blank text is no loss."""
    text = value.cast("string")
    return F.when(casted.isNull() & (F.trim(text) != ""), text)
