"""Batch operators."""

from tierflow.operators.columns import clean_name, clean_names, drop_technical, stamp
from tierflow.operators.exact import exact_sums
from tierflow.operators.models import (
    avg_by_group,
    group_summary,
    top_groups_by_sum,
    top_n_per_group,
    yearly_trends,
)
from tierflow.operators.quality import (
    distinct_counts,
    expect,
    newest,
    null_counts,
    quarantined,
    row_counts,
    violated,
    violation_counts,
)
from tierflow.operators.refine import conform, dedup, normalize_text, require_not_null
from tierflow.operators.split import assign_chunks, with_row_index, write_chunks

__all__ = [
    "assign_chunks",
    "avg_by_group",
    "clean_name",
    "clean_names",
    "conform",
    "dedup",
    "distinct_counts",
    "drop_technical",
    "exact_sums",
    "expect",
    "group_summary",
    "newest",
    "normalize_text",
    "null_counts",
    "quarantined",
    "require_not_null",
    "row_counts",
    "stamp",
    "top_groups_by_sum",
    "top_n_per_group",
    "violated",
    "violation_counts",
    "with_row_index",
    "write_chunks",
    "yearly_trends",
]
