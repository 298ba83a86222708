"""Report slicing by (department, fiscal year, period end) and month windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions._util import as_col
from ..functions.dates import fiscal_year_of, previous_month


def report_grid(spark: SparkSession, departments: Sequence[str], year: int, month: int) -> DataFrame:
    """Every department x {previous month, selected month} with fiscal year and month end.

    Built from the job's parameters: ``len(departments) * 2`` rows, a size known on the driver.
    """
    py, pm = previous_month(year, month)
    rows = [
        F.struct(F.lit(str(d)).alias("department"), F.lit(y).alias("year"), F.lit(m).alias("month"))
        for d in departments
        for (y, m) in ((py, pm), (year, month))
    ]
    # literal rows inside the JVM plan (no Python RDD, no Python worker)
    base = spark.range(1).select(F.inline(F.array(*rows)))
    return base.select(
        "department",
        "year",
        "month",
        fiscal_year_of("year", "month").alias("fiscal_year"),
        F.last_day(F.make_date("year", "month", F.lit(1))).alias("month_end"),
    )


def slice_reports(
    facts: DataFrame,
    grid: DataFrame,
    department_col: str,
    fiscal_year_col: str,
    month_end_col: str,
) -> DataFrame:
    """Fact rows whose (department, fiscal year, period end) is in the grid.

    The grid comes from the job's parameters (departments x 2 rows); its rows become literal
    predicates, so facts partitioned by these columns are pruned when the query is planned.
    """
    wanted = F.lit(False)
    by_period: dict[tuple, set] = {}
    for r in grid.select("department", "fiscal_year", "month_end").collect():
        by_period.setdefault((r["fiscal_year"], r["month_end"]), set()).add(r["department"])
    for (fiscal_year, month_end), departments in by_period.items():
        wanted = wanted | (
            (as_col(month_end_col) == F.lit(month_end))
            & (as_col(fiscal_year_col) == F.lit(fiscal_year))
            & as_col(department_col).isin(sorted(departments))
        )
    return facts.where(wanted)


def month_window(
    df: DataFrame, year: int, month: int, year_col: str = "year", month_col: str = "month", full_refresh: bool = False
) -> DataFrame:
    """Rows of the selected and the previous month, or all rows on a full refresh.

    On partition columns (or ``_metadata`` fields) the predicate prunes whole files.
    """
    if full_refresh:
        return df
    py, pm = previous_month(year, month)
    y, m = as_col(year_col), as_col(month_col)
    return df.where(((y == year) & (m == month)) | ((y == py) & (m == pm)))
