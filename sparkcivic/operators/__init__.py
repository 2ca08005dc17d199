"""DataFrame -> DataFrame operators."""

from .aggregate import count_by, exact_mean, mean_rounded, rate_by_group
from .columns import first_present_column, project_cast, trim_names
from .filters import drop_null_island, flag_not_in, require
from .membership import any_code_match, explode_codes
from .nearest import nearest_coordinates, nearest_sites
from .sample import in_sample, sample_by_key, sample_rows
from .topk import topk_per_group
from .union import common_type, misfits, reconcile, union_eras

__all__ = [
    "count_by", "exact_mean", "mean_rounded", "rate_by_group",
    "first_present_column", "project_cast", "trim_names",
    "drop_null_island", "flag_not_in", "require",
    "any_code_match", "explode_codes",
    "nearest_coordinates", "nearest_sites",
    "in_sample", "sample_by_key", "sample_rows",
    "topk_per_group", "common_type", "misfits", "reconcile", "union_eras",
]
