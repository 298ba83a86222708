"""Weekly permit summary: five daily measures -> one row per Saturday-ending week."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions._util import quote
from ..functions.dates import iso_week_label
from ..operators.aggregates import union_measures, weekly_measure_matrix
from .permits import COUNT_COL, DS, EX, RW

# Measure names and the series name of the sheet counts.
APPLICATIONS = "Applications Received"
ISSUED = "Permits Issued"
COMMERCIAL = "Commercial DS Permit Requests"
EXTENSION = "Extension Requests"
RESIDENTIAL = "Residential DS Permit Requests"
SHEET_SERIES = "Count Permits"

# Output columns, in published order.
SUMMARY_COLUMNS = [
    "date",
    "extension_requests",
    "ds_applications_received",
    "ds_permits_issued",
    "ex_applications_received",
    "ex_permits_issued",
    "rw_applications_received",
    "rw_permits_issued",
]


def permit_daily(df: DataFrame, measure: str) -> DataFrame:
    """Long form of a permit-system daily count: (measure, series=type, day, n)."""
    return df.select(
        F.lit(measure).alias("measure"),
        F.col("foldertype").alias("series"),
        F.col("day").cast("date").alias("day"),
        F.col(COUNT_COL).cast("bigint").alias("n"),
    )


def sheet_daily(df: DataFrame, measure: str, date_col: str = "date", count_col: str = "count_permits") -> DataFrame:
    """Long form of a sheet's daily count: (measure, series='Count Permits', day, n)."""
    return df.select(
        F.lit(measure).alias("measure"),
        F.lit(SHEET_SERIES).alias("series"),
        F.col(date_col).cast("date").alias("day"),
        F.col(count_col).cast("bigint").alias("n"),
    )


def tag_measures(df: DataFrame, specs: Sequence[tuple[str, Column, Column, Column]]) -> DataFrame:
    """Daily long form of several measures in one pass over ``df``.

    ``specs``: ``(measure, condition, day, series)``; a row contributes ``n = 1`` to every
    measure whose condition it meets. Use when several measures come from the same table:
    one scan and one aggregate instead of one of each per measure. Rows that meet no condition
    are filtered at the scan, before any is multiplied.
    """
    any_of = reduce(lambda a, b: a | b, (cond for _, cond, _, _ in specs))
    tags = F.array(
        *[
            F.when(cond, F.struct(F.lit(name).alias("measure"), series.alias("series"), F.to_date(day).alias("day")))
            for name, cond, day, series in specs
        ]
    )
    # explode, then a plain filter: both stay in whole-stage codegen (a lambda ``filter``
    # on the array would be evaluated outside it)
    exploded = df.where(any_of).select(F.explode(tags).alias("__t")).where(F.col("__t").isNotNull())
    return exploded.select("__t.*", F.lit(1).cast("bigint").alias("n"))


def summary_from_long(long: DataFrame) -> DataFrame:
    """The published weekly table from the daily long form (measure, series, day, n)."""
    cells = [
        (EXTENSION, SHEET_SERIES, "extension_requests"),
        (APPLICATIONS, DS, "__ds_app"),
        (COMMERCIAL, SHEET_SERIES, "__commercial"),
        (RESIDENTIAL, SHEET_SERIES, "__residential"),
        (ISSUED, DS, "ds_permits_issued"),
        (APPLICATIONS, EX, "ex_applications_received"),
        (ISSUED, EX, "ex_permits_issued"),
        (APPLICATIONS, RW, "rw_applications_received"),
        (ISSUED, RW, "rw_permits_issued"),
    ]
    m = weekly_measure_matrix(long, cells)
    return m.select(
        iso_week_label("week").alias("date"),
        "extension_requests",
        (F.col("__ds_app") + F.col("__commercial") + F.col("__residential")).alias("ds_applications_received"),
        "ds_permits_issued",
        "ex_applications_received",
        "ex_permits_issued",
        "rw_applications_received",
        "rw_permits_issued",
    )


def weekly_permit_summary(
    applications: DataFrame,
    issued: DataFrame,
    commercial: DataFrame,
    extension: DataFrame,
    residential: DataFrame,
) -> DataFrame:
    """The published weekly table.

    ``applications``/``issued``: daily permit counts (foldertype, subcode, day,
    issuedrowpermits). ``commercial``/``extension``/``residential``: daily sheet counts
    (date, count_permits). Sheet requests for DS permits are added to the DS applications
    after the zero fill; the week label is ``yyyy-MM-ddT00:00:00.000``.
    """
    long = union_measures(
        permit_daily(applications, APPLICATIONS),
        permit_daily(issued, ISSUED),
        sheet_daily(commercial, COMMERCIAL),
        sheet_daily(extension, EXTENSION),
        sheet_daily(residential, RESIDENTIAL),
    )
    return summary_from_long(long)


@dataclass(frozen=True)
class Extract:
    """Headers of one daily extract, as published; ``series`` is None for a sheet's counts."""

    date: str
    count: str
    series: str | None = None


# Headers of the published extracts.
EXTRACTS = {
    "applications": Extract("TO_CHAR(ROUND(INDATE,'DDD'),'YYYY-MM-DD')", "ISSUEDROWPERMITS", "FOLDERTYPE"),
    "issued": Extract("TO_CHAR(ROUND(ISSUEDATE,'DDD'),'YYYY-MM-DD')", "ISSUEDROWPERMITS", "FOLDERTYPE"),
    "commercial": Extract("Date Created", "Count Permits"),
    "extension": Extract("Created", "Count Permits"),
    "residential": Extract("Date Created", "Count Permits"),
}
#: Headers of the extracts that this library writes.
OWN_PERMIT_EXTRACT = Extract("day", COUNT_COL, "foldertype")
OWN_SHEET_EXTRACT = Extract("date", "count_permits")


def read_extract(spark, path: str, spec: Extract) -> DataFrame:
    """A daily extract with the columns of :func:`weekly_permit_summary`, found by header name.

    The headers are those of ``spec`` or of this library's own extracts; other columns are
    ignored. Counts may be written with a zero fraction; a value that does not parse fails.
    """
    from ..sources.files import exact_number, read_csv_table

    raw = read_csv_table(spark, path, multiLine=True)
    own = OWN_PERMIT_EXTRACT if spec.series else OWN_SHEET_EXTRACT
    used = spec if spec.date in raw.columns else own
    given = raw.select(
        F.col(quote(used.date)).cast("date").alias(own.date),
        F.col(quote(used.count)).cast("decimal(38,6)").alias(own.count),
        *([F.col(quote(used.series)).alias(own.series)] if spec.series else []),
    )
    return given.withColumn(own.count, exact_number(own.count, "bigint"))


def weekly_summary_job(spark, paths: dict[str, str], out_path: str, extracts: dict[str, Extract] = EXTRACTS, versioned: bool = False) -> DataFrame:
    """Read the five daily-count extracts and replace the published weekly table.

    ``paths`` keys: applications, issued (permit extracts), commercial, extension, residential
    (sheet counts); ``extracts`` names the headers of each. ``versioned``: see ``write_replace``.
    """
    from ..sinks.files import write_replace

    out = weekly_permit_summary(**{k: read_extract(spark, paths[k], extracts[k]) for k in EXTRACTS})
    write_replace(out, out_path, versioned=versioned)
    return out


def weekly_summary_from_sources(
    folder: DataFrame,
    commercial_sheet: DataFrame,
    extension_sheet: DataFrame,
    residential_sheet: DataFrame,
    out_path: str | None = None,
    sheet_date_cols: tuple[str, str, str] = ("Date Created", "Created", "Date Created"),
    applications_params: dict | None = None,
    issued_params: dict | None = None,
    versioned: bool = False,
) -> DataFrame:
    """The weekly table as one Catalyst plan straight from the permit table (e.g. read over
    JDBC) and the three sheet exports: no extract files in between. The ``*_params`` go to
    the two named queries (defaults: the permit system's codes). Writes it (full replace)
    when ``out_path`` is given."""
    from ..plans.sheets import sheet_day_counts
    from ..sinks.files import write_replace
    from .permits import applications_received, issued_permits

    out = weekly_permit_summary(
        applications_received(folder, **(applications_params or {})),
        issued_permits(folder, **(issued_params or {})),
        sheet_day_counts(commercial_sheet, sheet_date_cols[0]),
        sheet_day_counts(extension_sheet, sheet_date_cols[1]),
        sheet_day_counts(residential_sheet, sheet_date_cols[2]),
    )
    if out_path:
        write_replace(out, out_path, versioned=versioned)
    return out
