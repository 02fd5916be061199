"""Column functions: rounding, text clean-up, checked casts."""

from tierflow.functions.casting import cast_or_null, lost_by_cast
from tierflow.functions.digests import record_digest
from tierflow.functions.naming import clean_name, ref
from tierflow.functions.rounding import round_half_up
from tierflow.functions.text import blank_to_null, fold_case, squash_spaces

__all__ = [
    "blank_to_null",
    "cast_or_null",
    "clean_name",
    "fold_case",
    "lost_by_cast",
    "record_digest",
    "ref",
    "round_half_up",
    "squash_spaces",
]
