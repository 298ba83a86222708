"""Column -> Column functions (calendar, text, nulls, arrays, projection)."""

from .arrays import join_tags, last_value_of, merged_pairs, pairs_to_map, pick_metadata
from .dates import (
    fiscal_month,
    fiscal_year,
    fiscal_year_of,
    iso_text,
    iso_week_label,
    local_minute_stamp,
    month_end,
    month_end_text,
    month_name,
    parse_ts,
    parse_utc_text,
    previous_month,
    resolve_year_month,
    round_to_day,
    utc_to_local,
    week_ending_saturday,
)
from .geo import TEXAS_CENTRAL_FT, LambertZone, state_plane_to_wgs84, wgs84_to_state_plane
from .nulls import blank_to_null, empty_if_null, nan_to_null
from .text import dataset_url, oracle_concat, parse_report_name, permit_id, point_wkt, row_identifier, snake_name

__all__ = [n for n in dir() if not n.startswith("_")]
