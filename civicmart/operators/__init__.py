"""DataFrame -> DataFrame operators."""

from .aggregates import (
    count_by_date,
    observe_count,
    pick_last_values,
    pivot_sum,
    rotate_categories,
    union_measures,
    weekly_measure_matrix,
    weekly_resample,
)
from .filters import any_branch, branch_filter, exclude_values, not_in, not_like_prefix
from .joins import attach_row_counts, left_lookup, membership_flag
from .nested import catalog_scope, catalog_table, explode_results, flatten_resource
from .projection import iso_timestamps, map_fields, mapped_columns, snake_columns
from .reports import month_window, report_grid, slice_reports
from .upsert import last_wins, upsert

__all__ = [n for n in dir() if not n.startswith("_")]
