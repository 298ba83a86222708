"""Plan checks: no Python in any plan, scans read only needed columns, filters reach the
scan, file pruning by name, review joins reuse one partitioning."""

import os

import pytest

import __spark_entry__ as E
from civicmart.plans.bindings import QUERIES

from conftest import TESTDATA

SF_DIR = f"{TESTDATA}/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver test data not present")


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_udf(spark, name):
    text = plan_text(E.queries()[name](spark, SF_DIR))
    for node in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas", "MapInPandas", "ExistingRDD"):
        assert node not in text, (name, node)


def test_scan_prunes_columns_and_pushes_filters(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        text = plan_text(E.queries()["ex_permits_issued"](spark, SF_DIR))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    scan = [line for line in text.split("\n") if "FileScan parquet" in line and "orders.parquet" in line][0]
    assert "o_totalprice" not in scan  # column pruning: 5 of 6 columns read
    assert "EqualTo(o_orderstatus,O)" in scan and "EqualTo(o_orderpriority,3-MEDIUM)" in scan
    assert "GreaterThanOrEqual(o_orderdate" in scan


def test_review_time_shuffles_each_input_once(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan_text(E.queries()["review_time"](spark, SF_DIR))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # folder, attempts, web-app processes, extension processes: four exchanges, all on folderrsn
    assert text.count("Exchange hashpartitioning") == 4


def test_report_files_pruned_by_name(spark, tmp_path):
    from civicmart.sources import read_report_files

    root = tmp_path / "expenses"
    root.mkdir()
    for name in ("2022-01-31_2400", "2021-12-31_6200", "2021-11-30_2400"):
        (root / f"{name}.csv").write_text("Fund@Code\nF\n")
    df = read_report_files(spark, str(root), {"Fund@Code": "fund"}, [(2022, 1)])
    assert df.count() == 1
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    files = [leaves.apply(i).metrics().apply("numFiles").value() for i in range(leaves.size()) if leaves.apply(i).metrics().contains("numFiles")]
    assert files == [1]


def test_flagship_scans_events_once(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = plan_text(E.queries()["weekly_permit_summary"](spark, SF_DIR))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert text.count("FileScan parquet") == 1
    # (week, measure, series) aggregate, then its few rows by week
    assert text.count("Exchange hashpartitioning") == 2
    assert "SortMergeJoin" not in text and "BroadcastHashJoin" not in text


def test_weekly_resample_single_pass(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = plan_text(E.queries()["weekly_resample"](spark, SF_DIR))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert text.count("FileScan parquet") == 1
    assert "Join" not in text


def test_review_time_on_bucketed_tables_needs_no_shuffle(spark, tmp_path):
    from pyspark.sql import functions as F

    from civicmart.plans import bindings as B
    from civicmart.plans import permits
    from civicmart.sinks import write_bucketed

    o, li = B.table(spark, SF_DIR, "orders"), B.table(spark, SF_DIR, "lineitem")
    frames = {
        "cm_folder": o.select(F.col("o_custkey").alias("customfoldernumber"), F.col("o_orderkey").alias("folderrsn"),
                              F.col("o_orderstatus").alias("foldertype"), F.col("o_orderpriority").alias("subcode"),
                              F.col("o_orderpriority").alias("workcode"), F.col("o_orderdate").alias("indate"),
                              F.col("o_orderdate").alias("issuedate")),
        "cm_process": li.select(F.col("l_orderkey").alias("folderrsn"), F.col("l_linenumber").alias("processcode"),
                                F.col("l_shipdate").alias("startdate"), F.col("l_shipdate").alias("enddate")),
        "cm_attempt": li.select(F.col("l_orderkey").alias("folderrsn"), F.col("l_returnflag").alias("resultcode"),
                                F.col("l_shipdate").alias("attemptdate")),
    }
    for name, df in frames.items():
        write_bucketed(df, name, "folderrsn", 8, str(tmp_path / name))
    params = dict(folder_type="F", subcode="1-URGENT", workcode="1-URGENT", webapp_process=1, extension_process=2,
                  comment_result="R")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        bucketed = permits.review_time(spark.table("cm_folder"), spark.table("cm_process"), spark.table("cm_attempt"), **params)
        assert "Exchange" not in plan_text(bucketed)
        plain = permits.review_time(*frames.values(), **params)
        assert sorted(map(tuple, bucketed.collect())) == sorted(map(tuple, plain.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
