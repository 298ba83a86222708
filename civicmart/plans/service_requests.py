"""Service requests: UTF-16 TSV report -> cleaned, projected rows -> keyed upsert."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions._util import quote
from ..functions.dates import fiscal_year, iso_text, parse_ts
from ..functions.geo import state_plane_to_wgs84
from ..functions.nulls import nan_to_null
from ..functions.text import point_wkt
from ..operators.projection import map_fields
from ..sinks.files import write_upsert
from ..sources.utf16 import read_utf16_tsv_ranges

# Report columns and their published names, in published order.
FIELD_MAPPING = {
    "Service Request (SR) Number": "service_request_sr_number",
    "Department": "department",
    "Group Description": "group_description",
    "SR Description": "sr_description",
    "Method Received": "method_received",
    "SR Status": "sr_status",
    "Is Duplicate? (1/0)": "is_duplicate_1_0",
    "Status Change Date": "status_change_date",
    "Created Date": "created_date",
    "Overdue On Date": "overdue_on_date",
    "Last Update Date": "last_update_date",
    "Close Date": "close_date",
    "SR Age (days)": "sr_age_days",
    "Response Days": "response_days",
    "Open Count": "open_count",
    "Closed Count": "closed_count",
    "Overdue Count": "overdue_count",
    "Closed on Time": "closed_on_time",
    "Closed Late": "closed_late",
    "# of Days Late": "of_days_late",
    "SR Location": "sr_location",
    "State Plane X Coordinate": "state_plane_x_coordinate",
    "State Plane Y Coordinate": "state_plane_y_coordinate",
    "location": "location",
    "fiscal_year": "fiscal_year",
}
# The report's date columns and coordinate columns.
DATE_COLUMNS = ["Status Change Date", "Created Date", "Overdue On Date", "Last Update Date", "Close Date"]
X_COL, Y_COL = "State Plane X Coordinate", "State Plane Y Coordinate"
KEY = "service_request_sr_number"


def transform_service_requests(raw: DataFrame, date_format: str | Mapping[str, str] | None = None, digits: int | None = 6) -> DataFrame:
    """Coordinates -> WGS 84 WKT point, dates -> ``yyyy-MM-ddTHH:mm:ss`` text, fiscal year of
    the creation date, projection to the published columns, NaN coordinates -> null.
    ``date_format`` is one pattern for all date columns, or one for each by column name; columns
    without one take ISO text. All in one projection (one pass, whole-stage codegen)."""
    patterns = date_format if isinstance(date_format, Mapping) else dict.fromkeys(DATE_COLUMNS, date_format)
    x = nan_to_null(F.col(quote(X_COL)).cast("double"))
    y = nan_to_null(F.col(quote(Y_COL)).cast("double"))
    parsed = {c: parse_ts(F.col(quote(c)).cast("string"), patterns.get(c)) for c in DATE_COLUMNS}
    # The projection is computed once into its own column; the WKT text references it
    # several times and Catalyst keeps the two projections apart (expensive expression).
    projected = raw.withColumns({X_COL: x, Y_COL: y}).withColumn(
        "__p", state_plane_to_wgs84(F.col(quote(X_COL)), F.col(quote(Y_COL)), digits=digits)
    )
    staged = projected.withColumns(
        {
            **{c: iso_text(parsed[c]) for c in DATE_COLUMNS},
            "location": point_wkt(F.col("__p.lon"), F.col("__p.lat")),
            "fiscal_year": fiscal_year(parsed["Created Date"]).cast("bigint"),
        }
    )
    return map_fields(staged, FIELD_MAPPING, strict=True)


def service_requests_job(spark: SparkSession, tsv_path: str, target_path: str, date_format: str | Mapping[str, str] | None = None, versioned: bool = False) -> DataFrame:
    """Read the UTF-16 report (large files in byte ranges), transform it, upsert on the request number."""
    rows = transform_service_requests(read_utf16_tsv_ranges(spark, tsv_path), date_format)
    return write_upsert(rows, target_path, keys=[KEY], versioned=versioned)
