"""Row operators: DataFrame in, DataFrame out."""

from limpid.operators.dedup import duplicate_count, duplicate_groups, keep_first
from limpid.operators.integrity import missing_keys, split_by_reference
from limpid.operators.median import group_median, overall_median
from limpid.operators.missing import (
    delete_missing,
    handle_missing,
    impute_group_median,
    missing_rate,
    stats_before_after,
    zero_fill,
)
from limpid.operators.profile import distinct_profile, null_profile
from limpid.operators.union import tagged_union

__all__ = [
    "delete_missing",
    "distinct_profile",
    "duplicate_count",
    "duplicate_groups",
    "group_median",
    "handle_missing",
    "impute_group_median",
    "keep_first",
    "missing_keys",
    "missing_rate",
    "null_profile",
    "overall_median",
    "split_by_reference",
    "stats_before_after",
    "tagged_union",
    "zero_fill",
]
