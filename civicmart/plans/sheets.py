"""Sheet exports: permit requests per calendar date."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions._util import quote
from ..functions.dates import parse_ts
from ..operators.aggregates import count_by_date
from ..sinks.files import write_csv, write_csv_object
from ..sources.files import read_csv_table


def sheet_day_counts(sheet: DataFrame, date_col: str, date_format: str | None = None) -> DataFrame:
    """``(date, count_permits)``: non-null dates counted per calendar day."""
    parsed = sheet.select(parse_ts(F.col(quote(date_col)).cast("string"), date_format).alias("__d"))
    return count_by_date(parsed, "__d")


def sheet_day_counts_job(spark: SparkSession, csv_path: str, date_col: str, out_path: str, date_format: str | None = None, one_object: bool = False) -> DataFrame:
    """Count a sheet export per calendar date and write the CSV extract (date first), as a folder or,
    with ``one_object``, as one file of that name."""
    counts = sheet_day_counts(read_csv_table(spark, csv_path, multiLine=True), date_col, date_format)
    (write_csv_object if one_object else write_csv)(counts, out_path, order_by=["date"], first=["date"])
    return counts
