"""Column names: references safe for names with dots, percent signs or back-ticks, and the cleaning rule."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A blank becomes an underscore, parentheses go, everything else stays.
_CHARACTERS = str.maketrans({" ": "_", "(": None, ")": None})


def ref(name: str) -> Column:
    """The column called exactly ``name``, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def clean_name(name: str, lower: bool = True) -> str:
    """One cleaned column name."""
    trimmed = name.strip()
    return (trimmed.lower() if lower else trimmed).translate(_CHARACTERS)
