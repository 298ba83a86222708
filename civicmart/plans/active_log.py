"""Active permit log: a snapshot row per extract file, keyed by its publish minute."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import snake_name
from ..sinks.files import write_upsert
from ..sources.files import read_csv_table, with_file_stamp

# Permit types of the snapshot columns.
CATEGORIES = ("DS", "EX", "RW")


def _type_columns(categories: Sequence[str]) -> list[Column]:
    return [
        F.avg(F.when(F.col("foldertype") == F.lit(c), F.col("activepermits").cast("double"))).alias(snake_name(c))
        for c in categories
    ]


def active_permit_snapshot(counts: DataFrame, categories: Sequence[str] = CATEGORIES, stamp: str = "published_date") -> DataFrame:
    """(foldertype, activepermits, published_date) rows -> one row per publish stamp with
    one column per type (mean of the counts, a double; null for a type that is missing) and the stamp."""
    aggs = _type_columns(categories)
    return counts.groupBy(F.col(stamp).alias(stamp)).agg(*aggs).select(*[snake_name(c) for c in categories], stamp)


def extract_snapshot(counts: DataFrame, categories: Sequence[str] = CATEGORIES, stamp: str = "published_date") -> DataFrame:
    """One row for a whole extract, whatever its number of part files: the latest of their stamps
    (texts of one format) stands for all. An empty extract gives no row."""
    row = counts.agg(*_type_columns(categories), F.max(stamp).alias(stamp))
    return row.where(F.col(stamp).isNotNull()).select(*[snake_name(c) for c in categories], stamp)


def active_permit_log_job(spark: SparkSession, extract_csv: str, log_path: str, tz: str = "US/Central", versioned: bool = False) -> DataFrame:
    """Read the active-permit extract, stamp it with its latest file's local modification minute,
    rotate it to one row and upsert it into the log (key: published_date)."""
    counts = read_csv_table(spark, extract_csv, schema="foldertype string, activepermits bigint")
    snap = extract_snapshot(with_file_stamp(counts, "published_date", tz))
    return write_upsert(snap, log_path, keys=["published_date"], versioned=versioned)
