"""Digests that tell records apart."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.functions.naming import ref

# Hexadecimal digits kept of a SHA-256: 128 bits, where 10**12 records collide with a chance of 1 in 10**15.
_KEPT = 32


def record_digest(schema: T.StructType, columns: Collection[str]) -> Column:
    """128 bits, as 32 hexadecimal digits, over the names and values of the ``columns`` that are not null.

    Rows that are equal, nulls being equal to each other, have equal digests in any session. A column that a row has no
    value for does not count, so the digest stays when such a column is added.
    """
    parts = []
    for name in sorted(columns):
        text = _canonical(ref(name), schema[name].dataType)
        label = F.lit(f"{len(name)}:{name}")
        parts.append(F.coalesce(F.concat(label, F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("")))
    return F.substring(F.sha2(F.concat(F.lit(""), *parts), 256), 1, _KEPT)


def _canonical(value: Column, kind: T.DataType) -> Column:
    """The value as text that depends on nothing but the value."""
    if isinstance(kind, T.StringType):
        return value
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return (value + F.lit(0.0).cast(kind)).cast("string")  # one zero
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(value).cast("string")
    if isinstance(kind, T.BinaryType):
        return F.hex(value)
    if isinstance(kind, (T.ArrayType, T.StructType, T.MapType)):
        return F.to_json(value, {"timeZone": "UTC", "ignoreNullFields": "false"})
    return value.cast("string")
