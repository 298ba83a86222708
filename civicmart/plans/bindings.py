"""Operators bound to the driver's test tables.

Each binding maps driver columns onto the domain columns an operator expects (a cheap
projection that Catalyst prunes and pushes into the scan) and runs the operator over the
whole table. Parameters (codes, dates) are chosen so that every branch of the operator
is exercised. :mod:`civicmart.plans.oracle` holds the equivalent DuckDB SQL.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.arrays import join_tags
from ..functions.dates import (
    fiscal_month,
    fiscal_year,
    iso_text,
    month_end_text,
    month_name,
    round_to_day,
    utc_to_local,
)
from ..functions.geo import state_plane_to_wgs84
from ..functions.nulls import blank_to_null, nan_to_null
from ..functions.text import parse_report_name, point_wkt, row_identifier
from ..operators.aggregates import count_by_date, pick_last_values, rotate_categories, weekly_resample
from ..operators.filters import exclude_values
from ..operators.joins import attach_row_counts, membership_flag
from ..operators.nested import catalog_scope, parse_json
from ..operators.projection import map_fields, snake_columns
from ..operators.reports import month_window, report_grid, slice_reports
from ..operators.upsert import upsert
from ..sinks.records import to_records
from . import permits, round_trips, weekly


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table (Parquet) of the scale-factor folder, listed anew by each query: a table
    that was rewritten in the same session is read as it is now."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------- domain views of driver tables


def folder_from_events(events: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """events as permit folders: type from event_type, sub-code = user, status = props.k,
    intake = ts, issue = ts + floor(value) hours (``keep``: extra event columns)."""
    ftype = (
        F.when(F.col("event_type") == "view", "DS")
        .when(F.col("event_type") == "purchase", "EX")
        .when(F.col("event_type") == "click", "RW")
        .otherwise(F.upper("event_type"))
    )
    return events.select(
        F.col("event_id").alias("folderrsn"),
        ftype.alias("foldertype"),
        F.col("user_id").alias("subcode"),
        F.get_json_object("props", "$.k").cast("int").alias("statuscode"),
        F.col("ts").alias("indate"),
        F.timestamp_add("HOUR", F.floor("value").cast("int"), F.col("ts")).alias("issuedate"),
        *keep,
    )


def folder_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """lineitem as issued permits: return flag N/A/R -> DS/EX/RW, line number -> sub-code, ship date -> issue date."""
    ftype = (
        F.when(F.col("l_returnflag") == "N", "DS")
        .when(F.col("l_returnflag") == "A", "EX")
        .when(F.col("l_returnflag") == "R", "RW")
    )
    return lineitem.select(
        ftype.alias("foldertype"),
        F.col("l_linenumber").alias("subcode"),
        F.col("l_shipdate").alias("issuedate"),
    )


def folder_from_part(part: DataFrame) -> DataFrame:
    """part as permit folders: type from p_type, status = p_size, name = p_brand."""
    ftype = (
        F.when(F.col("p_type") == "MEDIUM", "DS")
        .when(F.col("p_type") == "LARGE", "EX")
        .when(F.col("p_type") == "SMALL", "RW")
        .otherwise(F.col("p_type"))
    )
    return part.select(
        ftype.alias("foldertype"), F.col("p_size").alias("statuscode"), F.col("p_brand").alias("foldername")
    )


# Input columns as SQL over the driver's tables, in the common subset of Spark and DuckDB: the
# oracle statements read the same inputs and state the operator's result in their own way.
SERVICE_TEXT = {
    "Group Description": "'group ' || o_orderstatus",
    "SR Description": "'customer ' || CAST(o_custkey AS STRING)",
    "Method Received": "lower(o_orderpriority)",
    "Is Duplicate? (1/0)": "CAST(o_custkey % 2 AS STRING)",
    "SR Age (days)": "CAST(o_orderkey % 90 AS STRING)",
    "Response Days": "CAST(o_orderkey % 30 AS STRING)",
    "Open Count": "CASE WHEN o_orderstatus = 'O' THEN '1' ELSE '0' END",
    "Closed Count": "CASE WHEN o_orderstatus = 'F' THEN '1' ELSE '0' END",
    "Overdue Count": "CASE WHEN o_orderstatus = 'P' THEN '1' END",
    "Closed on Time": "CASE WHEN o_custkey % 3 = 0 THEN '1' ELSE '0' END",
    "Closed Late": "CASE WHEN o_custkey % 3 = 0 THEN '0' ELSE '1' END",
    "# of Days Late": "CASE WHEN o_custkey % 3 <> 0 THEN CAST(o_custkey % 7 AS STRING) END",
    "SR Location": "'place ' || CAST(o_orderkey AS STRING)",
}
#: Days from the order date to each date column of the report.
SERVICE_DAYS = {"Status Change Date": 3, "Created Date": 0, "Overdue On Date": 21, "Last Update Date": 9, "Close Date": 30}
REPORT_KEYS = {
    "fund": "l_returnflag",
    "fund_name": "'fund ' || l_returnflag",
    "department": "'0000'",
    "department_name": "'department ' || CAST(l_suppkey AS STRING)",
    "unit": "l_linestatus",
    "unit_name": "'unit ' || l_linestatus",
}
EXPENSE_TEXT = REPORT_KEYS | {
    "object_category_code": "CAST(l_linenumber AS STRING)",
    "object_category_name": "'category ' || CAST(l_linenumber AS STRING)",
    "object_code": "CAST(l_partkey AS STRING)",
    "object_name": "'part ' || CAST(l_partkey AS STRING)",
    "object_spend_plan_code": "CAST(l_partkey % 10 AS STRING)",
    "object_spend_plan_name": "'plan ' || CAST(l_partkey % 10 AS STRING)",
    "budget_ytd_with_period_cutoff": "CASE WHEN l_linenumber = 2 THEN '' ELSE CAST(l_orderkey AS STRING) END",
    "proposed_budget_cye_amount": "CAST(l_orderkey % 1000 AS STRING)",
    "expenses_mtd": "CASE WHEN l_linenumber = 3 THEN '' ELSE CAST(l_orderkey % 100 AS STRING) END",
    "expenses_ytd": "CASE WHEN l_linenumber = 4 THEN '' ELSE CAST(l_partkey % 100 AS STRING) END",
    "encumbrance_ytd": "CASE WHEN l_linenumber < 3 THEN CAST(l_suppkey AS STRING) END",
    "unobligated": "CASE WHEN l_linenumber = 1 THEN '' ELSE CAST(l_linenumber AS STRING) END",
    "percent_obligated": "CAST(l_linenumber AS STRING)",
}
REVENUE_TEXT = REPORT_KEYS | {
    "revenue_source_category_code": "CAST(l_linenumber AS STRING)",
    "revenue_source_category_name": "'category ' || CAST(l_linenumber AS STRING)",
    "revenue_source_code": "CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(l_partkey AS STRING) END",
    "revenue_source_name": "'source ' || CAST(l_partkey AS STRING)",
    "revenue_budget_ytd": "CASE WHEN l_linenumber = 1 THEN '' ELSE CAST(l_orderkey AS STRING) END",
    "revenue_cye": "CASE WHEN l_linenumber = 2 THEN '' ELSE CAST(l_orderkey % 1000 AS STRING) END",
    "revenue_mtd": "CAST(l_partkey % 100 AS STRING)",
    "revenue_ytd": "CASE WHEN l_linenumber = 4 THEN '' ELSE CAST(l_partkey % 50 AS STRING) END",
    "revenue_itd": "CASE WHEN l_linenumber = 5 THEN '' ELSE CAST(l_suppkey AS STRING) END",
    "unrecognized_amount": "CASE WHEN l_linenumber < 3 THEN CAST(l_suppkey % 9 AS STRING) END",
    "percent_unrecognized": "CASE WHEN l_linenumber = 6 THEN '' ELSE CAST(l_linenumber AS STRING) END",
}
#: Minutes per character that each catalog time lies after the start of 2020.
CATALOG_MINUTES = {"updatedAt": 7, "createdAt": 1, "metadata_updated_at": 5, "data_updated_at": 3, "publication_date": 2}

# Binding parameters.
EVENTS_APPLICATIONS = dict(
    since=dt.date(2024, 1, 3),
    ds_excluded_status=(9, 58, 99),
    other_excluded_status=(99, 58),
    excluded_subcodes=(8, 46),
)
EVENTS_ISSUED = dict(since=dt.date(2024, 1, 5), excluded_subcodes=(8, 46))
LINEITEM_ISSUED = dict(since=dt.date(1996, 1, 1), excluded_subcodes=(6, 7))
PART_ACTIVE = dict(active_status=tuple(range(1, 26)), excluded_prefix="Brand#1")


# ---------------------------------------------------------------- queries


def q_applications_received(spark, sf):
    """Applications per (type, user, rounded day) over all events."""
    return permits.applications_received(folder_from_events(table(spark, sf, "events")), **EVENTS_APPLICATIONS)


def q_issued_permits(spark, sf):
    """Issued permits per (type, line number, rounded ship day) over all of lineitem."""
    return permits.issued_permits(folder_from_lineitem(table(spark, sf, "lineitem")), **LINEITEM_ISSUED)


def q_active_permits(spark, sf):
    """Active permits per type over all parts (brand prefix excluded for RW)."""
    return permits.active_permits(folder_from_part(table(spark, sf, "part")), **PART_ACTIVE)


def q_review_time(spark, sf):
    """Review milestones: urgent finished orders with their first and second lines and returned lines."""
    o = table(spark, sf, "orders")
    li = table(spark, sf, "lineitem")
    folder = o.select(
        F.col("o_custkey").alias("customfoldernumber"),
        F.col("o_orderkey").alias("folderrsn"),
        F.col("o_orderstatus").alias("foldertype"),
        F.col("o_orderpriority").alias("subcode"),
        F.col("o_orderpriority").alias("workcode"),
        F.col("o_orderdate").alias("indate"),
        F.lit(None).cast("timestamp_ntz").alias("issuedate"),
    )
    process = li.select(
        F.col("l_orderkey").alias("folderrsn"),
        F.col("l_linenumber").alias("processcode"),
        F.col("l_shipdate").alias("startdate"),
        F.timestamp_add("DAY", F.floor("l_quantity").cast("int"), F.col("l_shipdate")).alias("enddate"),
    )
    attempt = li.select(
        F.col("l_orderkey").alias("folderrsn"),
        F.col("l_returnflag").alias("resultcode"),
        F.col("l_shipdate").alias("attemptdate"),
    )
    return permits.review_time(
        folder,
        process,
        attempt,
        folder_type="F",
        subcode="1-URGENT",
        workcode="1-URGENT",
        webapp_process=1,
        extension_process=2,
        comment_result="R",
    )


def q_ex_permits_issued(spark, sf):
    """Open medium-priority orders since 1996 with the customer segment as sub-code description."""
    o = table(spark, sf, "orders")
    c = table(spark, sf, "customer")
    folder = o.select(
        F.col("o_orderstatus").alias("foldertype"),
        F.col("o_custkey").alias("subcode"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_orderdate").alias("indate"),
        F.col("o_orderdate").alias("issuedate"),
        F.year("o_orderdate").alias("folderyear"),
        F.col("o_orderkey").alias("foldersequence"),
        F.concat(F.lit("ORD-"), F.col("o_orderkey").cast("string")).alias("foldername"),
    )
    validsub = c.select(F.col("c_custkey").alias("subcode"), F.col("c_mktsegment").alias("subdesc"))
    return permits.ex_permits_issued(folder, validsub, folder_type="O", since=dt.date(1996, 1, 1), priority="3-MEDIUM")


def q_count_by_date(spark, sf):
    """Events per calendar date."""
    return count_by_date(table(spark, sf, "events"), "ts")


def q_weekly_resample(spark, sf):
    """Weekly quantity and line count per supplier with zero-filled weeks."""
    li = table(spark, sf, "lineitem").select("l_suppkey", "l_shipdate", "l_quantity", F.lit(1).alias("n"))
    return weekly_resample(li, "l_shipdate", ["l_quantity", "n"], by=["l_suppkey"])


def q_weekly_permit_summary(spark, sf):
    """All five measures come from ``events``: tagged in one scan (see :func:`tag_measures`);
    equal to ``weekly_permit_summary`` over the five separate daily extracts."""
    events = table(spark, sf, "events")
    folder = folder_from_events(events, keep=("event_type", "ts"))
    ts, et = F.col("ts"), F.col("event_type")
    sheet = F.lit(weekly.SHEET_SERIES)
    specs = [
        (weekly.APPLICATIONS, permits.applications_condition(**EVENTS_APPLICATIONS), round_to_day("indate"), F.col("foldertype")),
        (weekly.ISSUED, permits.issued_condition(**EVENTS_ISSUED), round_to_day("issuedate"), F.col("foldertype")),
        (weekly.COMMERCIAL, (et == "signup") & ts.isNotNull(), ts, sheet),
        (weekly.EXTENSION, (et == "error") & ts.isNotNull(), ts, sheet),
        (weekly.RESIDENTIAL, (et == "view") & ts.isNotNull(), ts, sheet),
    ]
    return weekly.summary_from_long(weekly.tag_measures(folder, specs))


def q_weekly_permit_summary_extracts(spark, sf):
    """The same table through the five separate daily extracts (five scans)."""
    events = table(spark, sf, "events")
    folder = folder_from_events(events)
    apps = permits.applications_received(folder, **EVENTS_APPLICATIONS)
    issued = permits.issued_permits(folder, **EVENTS_ISSUED)
    commercial = count_by_date(events.where(F.col("event_type") == "signup"), "ts")
    extension = count_by_date(events.where(F.col("event_type") == "error"), "ts")
    residential = count_by_date(events.where(F.col("event_type") == "view"), "ts")
    return weekly.weekly_permit_summary(apps, issued, commercial, extension, residential)


def q_rotate_categories(spark, sf):
    """Active permits per type rotated into one row."""
    active = permits.active_permits(folder_from_part(table(spark, sf, "part")), **PART_ACTIVE)
    return rotate_categories(active, "foldertype", "activepermits", ["DS", "EX", "RW"])


def q_fiscal_fields(spark, sf):
    """Fiscal year/month, month name, month end and ISO text of every order date."""
    o = table(spark, sf, "orders")
    d = F.col("o_orderdate")
    return o.select(
        "o_orderkey",
        fiscal_year(d).cast("bigint").alias("fiscal_year"),
        fiscal_month(F.month(d)).cast("bigint").alias("fiscal_month"),
        month_name(F.month(d)).alias("month_name"),
        month_end_text(F.year(d), F.month(d)).alias("month_end"),
        iso_text(d).alias("order_time"),
    )


def q_utc_to_local(spark, sf):
    """Event times written as UTC text, converted to US Central local text."""
    e = table(spark, sf, "events")
    utc_text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    return e.select("event_id", utc_to_local(utc_text).alias("local_time"))


def q_state_plane_to_wgs84(spark, sf):
    """Coordinates derived from order and customer keys projected to WGS 84, with WKT points."""
    o = table(spark, sf, "orders")
    x = F.lit(3000000.0) + F.lit(100.0) * F.col("o_custkey")
    y = F.lit(9900000.0) + F.lit(10.0) * F.col("o_orderkey")
    p = o.select("o_orderkey", state_plane_to_wgs84(x, y, digits=6).alias("p"))
    return p.select(
        "o_orderkey",
        F.col("p.lat").alias("latitude"),
        F.col("p.lon").alias("longitude"),
        point_wkt(F.col("p.lon"), F.col("p.lat")).alias("location"),
    )


def q_row_identifier(spark, sf):
    """Row identifier of every order from (year, status, customer)."""
    o = table(spark, sf, "orders")
    rid = row_identifier([F.year("o_orderdate"), F.col("o_orderstatus"), F.col("o_custkey")])
    return o.select("o_orderkey", rid.alias("row_identifier"))


def q_membership_flag(spark, sf):
    """Whether each customer has an urgent pending order."""
    c = table(spark, sf, "customer").select("c_custkey")
    o = table(spark, sf, "orders")
    urgent_pending = o.where((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "P"))
    return membership_flag(c, "c_custkey", urgent_pending, "o_custkey", flag="has_urgent_pending")


def q_attach_row_counts(spark, sf):
    """Lineitem rows per supplier, for suppliers typed as datasets."""
    s = table(spark, sf, "supplier")
    assets = s.select(
        "s_suppkey", F.when(F.col("s_acctbal") >= 0, F.lit("dataset")).otherwise(F.lit("chart")).alias("type")
    )
    return attach_row_counts(assets, "s_suppkey", "type", table(spark, sf, "lineitem"), "l_suppkey")


def q_pick_metadata(spark, sf):
    """Last text per role of every conversation (later turns win)."""
    conv = table(spark, sf, "conversations")
    return pick_last_values(
        conv, ["conv_id"], "role", "text", "turn", {"user": "user", "assistant": "assistant", "system": "system"}
    )


def q_join_tags(spark, sf):
    """Sorted distinct order priorities of each customer as tag text."""
    o = table(spark, sf, "orders")
    tags = o.groupBy("o_custkey").agg(F.array_sort(F.collect_set("o_orderpriority")).alias("priorities"))
    return tags.select("o_custkey", join_tags("priorities").alias("tags"))


def q_json_field(spark, sf):
    """The ``k`` member of every event's JSON properties, by an explicit schema."""
    e = table(spark, sf, "events")
    return parse_json(e.select("event_id", "props"), "props", "k bigint")


def q_upsert(spark, sf):
    """Published customers upserted with two increments of the
    BUILDING segment (doubled balances, then tripled for nations below 10): the later
    increment wins per key."""
    c = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment", "c_nationkey")
    cols = ["c_custkey", "c_name", "c_acctbal", "c_mktsegment"]
    target = c.select(*cols)
    building = c.where(F.col("c_mktsegment") == "BUILDING")
    v1 = building.withColumn("c_acctbal", F.col("c_acctbal") * 2).select(*cols, F.lit(1).alias("seq"))
    v2 = building.where(F.col("c_nationkey") < 10).withColumn("c_acctbal", F.col("c_acctbal") * 3).select(*cols, F.lit(2).alias("seq"))
    return upsert(target, v1.unionByName(v2), ["c_custkey"], order_cols=["seq"])


def q_exclude_values(spark, sf):
    """Documents minus a deny-list on the language (null language kept)."""
    d = table(spark, sf, "documents").select(
        "doc_id", F.nullif(F.col("lang"), F.lit("fr")).alias("flex_question"), F.col("source").alias("flex_answer")
    )
    return exclude_values(d, "flex_question", ["de"])


def q_catalog_scope(spark, sf):
    """Documents as catalog assets scoped by owner or category, drafts dropped."""
    d = table(spark, sf, "documents")
    rid = F.when(F.col("n_chars") > 10000, F.concat(F.col("doc_id").cast("string"), F.lit(":draft"))).otherwise(
        F.col("doc_id").cast("string")
    )
    assets = d.select(
        F.struct(rid.alias("id")).alias("resource"),
        F.struct(F.col("source").alias("id")).alias("owner"),
        F.struct(F.nullif(F.col("lang"), F.lit("fr")).alias("domain_category")).alias("classification"),
    )
    scoped = catalog_scope(assets, owner_id="src3", category="en")
    return scoped.select(
        F.col("resource.id").alias("id"),
        F.col("owner.id").alias("owner_id"),
        F.col("classification.domain_category").alias("category"),
    )


def q_blank_to_null(spark, sf):
    """Blank size text of promo parts -> null, others -> decimal."""
    p = table(spark, sf, "part")
    text = F.when(F.col("p_type") == "PROMO", F.lit("")).otherwise(F.col("p_size").cast("string"))
    t = p.select("p_partkey", text.alias("size_text"))
    return t.select("p_partkey", "size_text", blank_to_null("size_text", "decimal(18,2)").alias("size_amount"))


def q_map_fields(spark, sf):
    """Customer fields mapped and renamed, an absent field as null."""
    c = table(spark, sf, "customer")
    return map_fields(c, {"c_custkey": "customer_id", "c_name": "name", "c_fax": "fax"}, strict=False)


def q_slice_reports(spark, sf):
    """Orders of two priorities in the selected and previous month windows."""
    o = table(spark, sf, "orders")
    facts = o.select(
        "o_orderkey",
        F.col("o_orderpriority").alias("department"),
        fiscal_year("o_orderdate").cast("bigint").alias("fiscal_year"),
        F.last_day("o_orderdate").alias("month_end"),
    )
    grid = report_grid(spark, ["1-URGENT", "2-HIGH"], 1998, 1)
    return slice_reports(facts, grid, "department", "fiscal_year", "month_end")


def q_to_records(spark, sf):
    """Every customer as one JSON record with explicit nulls."""
    c = table(spark, sf, "customer")
    mapped = map_fields(c, {"c_custkey": "customer_id", "c_name": "name", "c_fax": "fax"}, strict=False)
    return to_records(mapped, keep=["customer_id"])


def q_service_requests(spark, sf):
    """orders as service requests: the whole transform (projection, WKT, ISO dates,
    fiscal year, 25-column mapping); coordinates are missing for pending orders."""
    from .service_requests import FIELD_MAPPING, transform_service_requests

    o = table(spark, sf, "orders")
    pending = F.col("o_orderstatus") == "P"
    given = {
        "Service Request (SR) Number": F.concat(F.lit("SR-"), F.col("o_orderkey").cast("string")),
        "Department": F.col("o_orderpriority"),
        "SR Status": F.col("o_orderstatus"),
        **{c: F.expr(sql) for c, sql in SERVICE_TEXT.items()},
        **{c: F.date_format(F.timestamp_add("DAY", F.lit(n), F.col("o_orderdate")), "yyyy-MM-dd HH:mm:ss") for c, n in SERVICE_DAYS.items()},
        "State Plane X Coordinate": F.when(~pending, F.lit(3000000.0) + F.lit(100.0) * F.col("o_custkey")),
        "State Plane Y Coordinate": F.when(~pending, F.lit(9900000.0) + F.lit(10.0) * F.col("o_orderkey")),
    }
    cols = [given[c].alias(c) for c in FIELD_MAPPING if c not in ("location", "fiscal_year")]
    return transform_service_requests(o.select(*cols))


def report_rows_from_lineitem(li: DataFrame, given: dict[str, str]) -> DataFrame:
    """lineitem as mapped report rows: ship month = report month, supplier = the department in the
    file name."""
    return li.select(
        *[F.expr(sql).alias(c) for c, sql in given.items()],
        F.year("l_shipdate").alias("year"),
        F.month("l_shipdate").alias("month"),
        F.col("l_suppkey").cast("int").alias("department_from_file"),
        F.concat(F.date_format(F.last_day("l_shipdate"), "yyyy-MM-dd"), F.lit("_"), F.col("l_suppkey").cast("string"), F.lit(".csv")).alias("source_file"),
    )


def q_finance_rows(spark, sf):
    """lineitem rows as expense report rows: the load's derived fields and row identifier."""
    from .finance import EXPENSES, derive_report_rows

    return derive_report_rows(report_rows_from_lineitem(table(spark, sf, "lineitem"), EXPENSE_TEXT), EXPENSES)


def q_revenue_rows(spark, sf):
    """lineitem rows as revenue report rows: the load's derived fields and row identifier."""
    from .finance import REVENUE, derive_report_rows

    return derive_report_rows(report_rows_from_lineitem(table(spark, sf, "lineitem"), REVENUE_TEXT), REVENUE)


def q_flex_notes(spark, sf):
    """Conversation turns as question/answer rows: renamed, denied questions dropped. Assistant
    turns ask two denied questions in turn, system turns have no question."""
    from .flex_notes import IGNORED_QUESTIONS, transform_flex_notes

    role, odd = F.col("role"), F.col("turn") % 2 == 1
    denied = F.when(odd, F.lit(IGNORED_QUESTIONS[0])).otherwise(F.lit(IGNORED_QUESTIONS[-1]))
    raw = table(spark, sf, "conversations").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("Flex Notes ID"),
        F.concat(F.lit("SR-"), F.col("conv_id").cast("string")).alias("Service Request Number"),
        F.col("turn").alias("Flex Notes Definition ID"),
        F.col("conv_id").alias("Service Request ID"),
        F.when((role == "assistant") & (F.col("conv_id") % 2 == 0), denied).when(role != "system", role).alias("Flex Question"),
        F.col("text").alias("Flex Answer"),
    )
    return transform_flex_notes(raw)


def q_month_window(spark, sf):
    """Orders of January 1998 and the month before it, which is in another year."""
    o = table(spark, sf, "orders").select("o_orderkey", F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"))
    return month_window(o, 1998, 1)


def q_report_name_fields(spark, sf):
    """Report file names of both layouts, and some that are neither, parsed; one per lineitem row."""
    li = table(spark, sf, "lineitem")
    end = F.date_format(F.last_day("l_shipdate"), "yyyy-MM-dd")
    department = F.lpad((F.col("l_suppkey") % 10000).cast("string"), 4, "0")
    name = (
        F.when(F.col("l_linenumber") == 1, F.concat(F.lit("notes/"), end, F.lit(".csv")))
        .when(F.col("l_linenumber") == 2, F.concat(F.lit("r/month_end="), end, F.lit("/department="), department, F.lit("/part-0.csv")))
        .otherwise(F.concat(F.lit("r/"), end, F.lit("_"), department, F.lit(".csv")))
    )
    return li.select("l_orderkey", "l_linenumber", parse_report_name(name).alias("p")).select("l_orderkey", "l_linenumber", "p.*")


def q_snake_columns(spark, sf):
    """Customers under headers with spaces and capitals, renamed for the portal."""
    c = table(spark, sf, "customer")
    return snake_columns(c.select(F.col("c_custkey").alias("Customer Key"), F.col("c_mktsegment").alias("Market Segment"), F.col("c_acctbal").alias("ACCOUNT balance")))


def q_nan_to_null(spark, sf):
    """Event values, those of errors replaced by NaN, with NaN as null."""
    value = F.when(F.col("event_type") == "error", F.lit(float("nan"))).otherwise(F.col("value"))
    return table(spark, sf, "events").select("event_id", nan_to_null(value).alias("value"))


def q_pivot_sum(spark, sf):
    """Issued permits per day with one column per type (sums over sub-codes)."""
    from ..operators.aggregates import pivot_sum

    daily = permits.issued_permits(folder_from_lineitem(table(spark, sf, "lineitem")), **LINEITEM_ISSUED)
    out = pivot_sum(daily, "day", "foldertype", ["DS", "EX", "RW"], permits.COUNT_COL)
    return out.select("day", *[F.col(c).cast("bigint").alias(c.lower()) for c in ("DS", "EX", "RW")])


def q_sheet_day_counts(spark, sf):
    """orders as a sheet export whose creation date is text: parsed, then counted per day."""
    from .sheets import sheet_day_counts

    sheet = table(spark, sf, "orders").select(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("Date Created"))
    return sheet_day_counts(sheet, "Date Created")


def q_last_wins(spark, sf):
    """The latest turn of every conversation (whole rows, last-wins by turn)."""
    from ..operators.upsert import last_wins

    return last_wins(table(spark, sf, "conversations"), ["conv_id"], ["turn"])


def q_active_permit_snapshot(spark, sf):
    """One snapshot row per order month: order counts per status (F/O/P as DS/EX/RW),
    rotated into columns and stamped with the month."""
    from .active_log import active_permit_snapshot

    o = table(spark, sf, "orders")
    ftype = F.when(F.col("o_orderstatus") == "F", "DS").when(F.col("o_orderstatus") == "O", "EX").otherwise("RW")
    stamp = F.date_format(F.trunc("o_orderdate", "MM"), "yyyy-MM-dd'T'00:00:00.000")
    counts = o.groupBy(stamp.alias("published_date"), ftype.alias("foldertype")).agg(F.count(F.lit(1)).alias("activepermits"))
    return active_permit_snapshot(counts)


def q_pairs_to_map(spark, sf):
    """Per document, four pairs whose keys depend on its language, source and length folded into
    a map where the later pair wins; the looked-up values are returned."""
    from ..functions.arrays import pairs_to_map

    d = table(spark, sf, "documents")
    pair = lambda key, value: F.struct(F.coalesce(key, F.lit("none")).alias("key"), value.alias("value"))
    size = F.when(F.col("n_chars") % 2 == 0, F.col("lang")).otherwise(F.col("source"))
    pairs = F.array(
        pair(F.col("lang"), F.lit("first")),
        pair(F.col("source"), F.col("lang")),
        pair(size, F.col("n_chars").cast("string")),
        pair(F.when(F.col("n_chars") % 3 == 0, F.col("lang")), F.lit("last")),
    )
    m = pairs_to_map(pairs)
    get = lambda key: F.try_element_at(m, F.coalesce(key, F.lit("none")))
    return d.select("doc_id", get(F.col("lang")).alias("lang_value"), get(F.col("source")).alias("source_value"), get(F.lit("none")).alias("none_value"))


CATALOG_PUBLIC_BASE = "https://public.example/d/"
CATALOG_INTERNAL_BASE = "https://internal.example/d/"


def catalog_assets_from_documents(d: DataFrame) -> DataFrame:
    """documents as nested catalog assets (resource / classification / owner structs)."""
    kv = "struct<key:string,value:string>"
    return d.select(
        F.struct(
            F.col("doc_id").cast("string").alias("id"),
            F.col("source").alias("name"),
            F.col("lang").alias("description"),
            F.lit(None).cast("string").alias("attribution"),
            F.when(F.col("n_chars") > 5000, F.lit("dataset")).otherwise(F.lit("story")).alias("type"),
            *[
                F.when(
                    (F.lit(c) != "publication_date") | (F.col("lang") != "fr"),
                    F.date_format(F.timestamp_add("MINUTE", F.col("n_chars") * n, F.lit("2020-01-01").cast("timestamp_ntz")), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"),
                ).alias(c)
                for c, n in CATALOG_MINUTES.items()
            ],
            F.col("n_chars").alias("download_count"),
            F.struct(
                (F.col("n_chars") / 100).cast("bigint").alias("page_views_last_week"),
                (F.col("n_chars") / 10).cast("bigint").alias("page_views_last_month"),
                F.col("n_chars").alias("page_views_total"),
            ).alias("page_views"),
        ).alias("resource"),
        F.struct(
            F.nullif(F.col("lang"), F.lit("fr")).alias("domain_category"),
            F.array(F.col("lang"), F.col("source")).alias("domain_tags"),
            F.array(F.struct(F.lit("Ownership_Department-name").alias("key"), F.col("source").alias("value"))).cast(f"array<{kv}>").alias("domain_metadata"),
            F.array(
                F.struct(F.lit("Ownership_Department-name").alias("key"), F.lit("private").alias("value")),
                F.struct(F.lit("Ownership_Program-Name").alias("key"), F.col("lang").alias("value")),
            ).cast(f"array<{kv}>").alias("domain_private_metadata"),
        ).alias("classification"),
        F.struct(F.col("source").alias("id"), F.upper("source").alias("display_name")).alias("owner"),
    )


def q_catalog_table(spark, sf):
    """The catalog job: documents as assets, labelled-good documents as the public list,
    label rows as dataset rows."""
    from .catalog import build_catalog

    assets = catalog_assets_from_documents(table(spark, sf, "documents"))
    labels = table(spark, sf, "labels")
    public = labels.where(F.col("quality") == 1).select(F.col("doc_id").cast("string").alias("id"))
    rows = labels.select(F.col("doc_id").cast("string").alias("dataset_id"))
    return build_catalog(assets, public, rows, "src3", "en", CATALOG_PUBLIC_BASE, CATALOG_INTERNAL_BASE)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "weekly_permit_summary": q_weekly_permit_summary,
    "weekly_permit_summary_extracts": q_weekly_permit_summary_extracts,
    "applications_received": q_applications_received,
    "issued_permits": q_issued_permits,
    "active_permits": q_active_permits,
    "review_time": q_review_time,
    "ex_permits_issued": q_ex_permits_issued,
    "count_by_date": q_count_by_date,
    "weekly_resample": q_weekly_resample,
    "rotate_categories": q_rotate_categories,
    "fiscal_fields": q_fiscal_fields,
    "utc_to_local": q_utc_to_local,
    "state_plane_to_wgs84": q_state_plane_to_wgs84,
    "row_identifier": q_row_identifier,
    "membership_flag": q_membership_flag,
    "attach_row_counts": q_attach_row_counts,
    "pick_metadata": q_pick_metadata,
    "join_tags": q_join_tags,
    "json_field": q_json_field,
    "upsert": q_upsert,
    "exclude_values": q_exclude_values,
    "catalog_scope": q_catalog_scope,
    "blank_to_null": q_blank_to_null,
    "map_fields": q_map_fields,
    "slice_reports": q_slice_reports,
    "to_records": q_to_records,
    "service_requests": q_service_requests,
    "finance_rows": q_finance_rows,
    "revenue_rows": q_revenue_rows,
    "flex_notes": q_flex_notes,
    "month_window": q_month_window,
    "report_name_fields": q_report_name_fields,
    "snake_columns": q_snake_columns,
    "nan_to_null": q_nan_to_null,
    "catalog_table": q_catalog_table,
    "pivot_sum": q_pivot_sum,
    "sheet_day_counts": q_sheet_day_counts,
    "last_wins": q_last_wins,
    "active_permit_snapshot": q_active_permit_snapshot,
    "pairs_to_map": q_pairs_to_map,
}

QUERIES |= round_trips.QUERIES
