"""The calendar and text helpers as Spark SQL functions (SQL-bodied temporary functions:
expanded inline by the analyzer, so they stay in whole-stage codegen; no Python)."""

from __future__ import annotations

from pyspark.sql import SparkSession

# name -> (signature, return type, SQL body); same semantics as civicmart.functions
SQL_FUNCTIONS = {
    "round_to_day": ("ts TIMESTAMP_NTZ", "DATE", "to_date(ts + INTERVAL 12 HOURS)"),
    "week_ending_saturday": ("d DATE", "DATE", "next_day(date_sub(d, 1), 'SAT')"),
    "fiscal_year": ("d DATE", "INT", "year(d) + IF(month(d) >= 10, 1, 0)"),
    "fiscal_month": ("m INT", "INT", "IF(m >= 10, m - 9, m + 3)"),
    "month_abbrev": ("m INT", "STRING", "date_format(make_date(2022, m, 1), 'MMM')"),
    "permit_id": ("y STRING, s STRING", "STRING", "concat(coalesce(y, ''), '-', coalesce(s, ''))"),
    "iso_text": ("ts TIMESTAMP_NTZ", "STRING", "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\")"),
    "utc_to_local": (
        "t STRING, tz STRING",
        "STRING",
        "date_format(convert_timezone('UTC', tz, "
        "IF(nullif(t, '') IS NULL, CAST(NULL AS TIMESTAMP_NTZ), "
        "to_timestamp_ntz(nullif(t, ''), \"yyyy-MM-dd'T'HH:mm:ss[.SSSSSSSSS]'Z'\"))), "
        "\"yyyy-MM-dd'T'HH:mm:ss\")",
    ),
}


def register_sql_functions(spark: SparkSession, prefix: str = "") -> list[str]:
    """Create the temporary SQL functions in ``spark`` (optionally name-prefixed)."""
    names = []
    for name, (args, ret, body) in SQL_FUNCTIONS.items():
        full = f"{prefix}{name}"
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {full}({args}) RETURNS {ret} RETURN {body}")
        names.append(full)
    return names
