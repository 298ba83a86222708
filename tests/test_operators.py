"""Operators on small hand-made frames with hand-computed results, plus properties."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from civicmart.operators import (
    attach_row_counts,
    catalog_scope,
    count_by_date,
    exclude_values,
    last_wins,
    map_fields,
    membership_flag,
    month_window,
    pick_last_values,
    pivot_sum,
    report_grid,
    rotate_categories,
    slice_reports,
    snake_columns,
    upsert,
    weekly_measure_matrix,
    weekly_resample,
)

D = dt.date


def test_weekly_resample_fills_empty_weeks(spark):
    df = spark.createDataFrame([(D(2022, 1, 1), 3), (D(2022, 1, 30), 5)], "d date, n int")
    got = sorted((r.week, r.n) for r in weekly_resample(df, "d", ["n"]).collect())
    assert got == [
        (D(2022, 1, 1), 3),
        (D(2022, 1, 8), 0),
        (D(2022, 1, 15), 0),
        (D(2022, 1, 22), 0),
        (D(2022, 1, 29), 0),
        (D(2022, 2, 5), 5),
    ]


def test_weekly_resample_per_group_spans_and_total(spark):
    rows = [("a", D(2022, 1, 3), 1), ("a", D(2022, 1, 20), 2), ("b", D(2022, 2, 1), 4), ("b", None, 9)]
    df = spark.createDataFrame(rows, "g string, d date, n int")
    out = weekly_resample(df, "d", ["n"], by=["g"]).collect()
    a = sorted((r.week, r.n) for r in out if r.g == "a")
    b = sorted((r.week, r.n) for r in out if r.g == "b")
    assert a == [(D(2022, 1, 8), 1), (D(2022, 1, 15), 0), (D(2022, 1, 22), 2)]
    assert b == [(D(2022, 2, 5), 4)]
    # property: total preserved (null dates dropped), weeks contiguous per group
    assert sum(r.n for r in out) == 7
    for wk in (a, b):
        assert all((wk[i + 1][0] - wk[i][0]).days == 7 for i in range(len(wk) - 1))


def test_weekly_measure_matrix_alignment(spark):
    rows = [
        ("permits", "DS", D(2022, 1, 1), 3),
        ("permits", "DS", D(2022, 1, 30), 5),
        ("sheet", "Count", D(2022, 2, 5), 7),
        ("sheet", "Count", D(2022, 3, 1), 8),
    ]
    df = spark.createDataFrame(rows, "measure string, series string, day date, n bigint")
    cells = [("permits", "DS", "ds"), ("permits", "EX", "ex"), ("sheet", "Count", "sheet")]
    got = {r.week: (r.ds, r.ex, r.sheet) for r in weekly_measure_matrix(df, cells).collect()}
    weeks = sorted(got)
    assert weeks[0] == D(2022, 1, 1) and weeks[-1] == D(2022, 3, 5)
    assert len(weeks) == 10
    assert got[D(2022, 1, 1)] == (3.0, 0.0, 0.0)
    assert got[D(2022, 2, 5)] == (5.0, 0.0, 7.0)
    assert got[D(2022, 3, 5)] == (0.0, 0.0, 8.0)
    assert got[D(2022, 1, 15)] == (0.0, 0.0, 0.0)


def test_weekly_measure_matrix_gap_between_spans(spark):
    rows = [("m1", "s", D(2022, 1, 1), 1), ("m2", "s", D(2022, 1, 29), 2)]
    df = spark.createDataFrame(rows, "measure string, series string, day date, n bigint")
    got = sorted(r.week for r in weekly_measure_matrix(df, [("m1", "s", "a"), ("m2", "s", "b")]).collect())
    assert got == [D(2022, 1, 1), D(2022, 1, 29)]  # weeks in no measure's span do not appear


def test_count_by_date_drops_null(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2022, 1, 1, 8),), (dt.datetime(2022, 1, 1, 20),), (None,)], "t timestamp_ntz"
    )
    assert [(r.date, r.count_permits) for r in count_by_date(df, "t").collect()] == [(D(2022, 1, 1), 2)]


def test_pivot_sum(spark):
    df = spark.createDataFrame([("d1", "DS", 1), ("d1", "DS", 2), ("d1", "RW", 5)], "day string, t string, n int")
    r = pivot_sum(df, "day", "t", ["DS", "EX", "RW"], "n").first()
    assert (r.DS, r.EX, r.RW) == (3, None, 5)


def test_rotate_categories(spark):
    df = spark.createDataFrame([("RW", 3), ("DS", 1), ("EX", 2)], "foldertype string, activepermits bigint")
    r = rotate_categories(df, "foldertype", "activepermits", ["DS", "EX", "RW"]).first()
    assert r.asDict() == {"ds": 1.0, "ex": 2.0, "rw": 3.0}


def test_exclude_values_keeps_null(spark):
    df = spark.createDataFrame([("a",), (None,), ("b",)], "q string")
    assert sorted([r.q for r in exclude_values(df, "q", ["a"]).collect()], key=str) == [None, "b"]
    assert [r.q for r in exclude_values(df, "q", ["a"], keep_null=False).collect()] == ["b"]


def test_exclude_values_has_one_meaning_at_every_length(spark):
    df = spark.createDataFrame([("a",), (None,), ("b",), ("c",)], "q string")
    numbers = spark.createDataFrame([(1,), (2,)], "n int")
    for extra in ([], [f"z{i}" for i in range(1_500)]):
        assert sorted([r.q for r in exclude_values(df, "q", ["a", "c", *extra]).collect()], key=str) == [None, "b"]
        assert exclude_values(df, "q", ["a", None, *extra], keep_null=False).count() == 0
        assert exclude_values(numbers, "n", [1.5, *(1e6 + i for i in range(len(extra)))]).count() == 2


def test_map_fields_strict_and_lenient(spark):
    df = spark.createDataFrame([(1, "x")], ["Is Duplicate? (1/0)", "# of Days.Late"])
    out = map_fields(df, {"Is Duplicate? (1/0)": "dup", "# of Days.Late": "late"})
    assert out.first().asDict() == {"dup": 1, "late": "x"}
    lenient = map_fields(df, {"Is Duplicate? (1/0)": "dup", "missing": "m"}, strict=False)
    assert lenient.first().asDict() == {"dup": 1, "m": None}
    with pytest.raises(Exception):
        map_fields(df, {"missing": "m"}, strict=True).collect()


def test_snake_columns(spark):
    df = spark.createDataFrame([(1,)], ["DS Applications Received"])
    assert snake_columns(df).columns == ["ds_applications_received"]


def test_last_wins_and_upsert_properties(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, v string")
    inc = spark.createDataFrame([(2, "b1", 1), (2, "b2", 2), (3, "c", 1), (None, "n2", 1)], "k int, v string, seq int")
    dedup = last_wins(inc, ["k"], ["seq"])
    assert sorted((r.k or 0, r.v) for r in dedup.collect()) == [(0, "n2"), (2, "b2"), (3, "c")]
    merged = upsert(target, inc, ["k"], order_cols=["seq"])
    got = sorted((r.k or 0, r.v) for r in merged.collect())
    assert got == [(0, "n2"), (1, "a"), (2, "b2"), (3, "c")]
    again = upsert(merged, inc, ["k"], order_cols=["seq"])
    assert sorted((r.k or 0, r.v) for r in again.collect()) == got  # idempotent, keys unique


def test_membership_and_row_counts(spark):
    assets = spark.createDataFrame([("a", "dataset"), ("b", "dataset"), ("c", "chart")], "id string, type string")
    rows = spark.createDataFrame([("a",), ("a",), ("c",)], "dataset_id string")
    out = {r.id: r.row_count for r in attach_row_counts(assets, "id", "type", rows, "dataset_id").collect()}
    assert out == {"a": 2, "b": 0, "c": None}
    flagged = {r.id: r.is_member for r in membership_flag(assets, "id", rows, "dataset_id").collect()}
    assert flagged == {"a": True, "b": False, "c": True}


def test_pick_last_values(spark):
    df = spark.createDataFrame(
        [(1, 0, "k", "x"), (1, 1, "k", "y"), (1, 2, "j", "z"), (2, 0, "j", "w")], "g int, t int, key string, value string"
    )
    out = {r.g: (r.k, r.j) for r in pick_last_values(df, ["g"], "key", "value", "t", {"k": "k", "j": "j"}).collect()}
    assert out == {1: ("y", "z"), 2: ("", "w")}


def test_catalog_scope_drops_drafts(spark):
    schema = "resource struct<id:string>, owner struct<id:string>, classification struct<domain_category:string>"
    df = spark.createDataFrame(
        [(("abcd-1234:draft",), ("me",), ("T",)), (("abcd-1234",), ("me",), (None,)), (("x",), ("other",), (None,)),
         (("y",), ("other",), ("T",))],
        schema,
    )
    got = sorted(r.resource.id for r in catalog_scope(df, "me", "T").collect())
    assert got == ["abcd-1234", "y"]


def test_report_grid_and_slice(spark):
    grid = report_grid(spark, ["2400", "6200"], 2022, 1).collect()
    assert sorted((g.department, g.year, g.month, g.fiscal_year, g.month_end) for g in grid) == [
        ("2400", 2021, 12, 2022, D(2021, 12, 31)),
        ("2400", 2022, 1, 2022, D(2022, 1, 31)),
        ("6200", 2021, 12, 2022, D(2021, 12, 31)),
        ("6200", 2022, 1, 2022, D(2022, 1, 31)),
    ]
    facts = spark.createDataFrame(
        [("2400", 2022, D(2022, 1, 31), 1), ("2400", 2022, D(2021, 11, 30), 2), ("9999", 2022, D(2022, 1, 31), 3)],
        "dept string, fy int, end date, v int",
    )
    g = report_grid(spark, ["2400", "6200"], 2022, 1)
    assert [r.v for r in slice_reports(facts, g, "dept", "fy", "end").collect()] == [1]


def test_month_window(spark):
    df = spark.createDataFrame([(2021, 12), (2022, 1), (2021, 11)], "year int, month int")
    assert sorted(tuple(r) for r in month_window(df, 2022, 1).collect()) == [(2021, 12), (2022, 1)]
    assert month_window(df, 2022, 1, full_refresh=True).count() == 3


def test_weekly_measure_matrix_empty_measure_is_zero(spark):
    rows = [("m1", "s", D(2022, 1, 1), 2), ("m1", "s", D(2022, 1, 15), 3)]
    df = spark.createDataFrame(rows, "measure string, series string, day date, n bigint")
    out = weekly_measure_matrix(df, [("m1", "s", "a"), ("m2", "s", "b")]).collect()
    assert sorted((r.week, r.a, r.b) for r in out) == [
        (D(2022, 1, 1), 2.0, 0.0),
        (D(2022, 1, 8), 0.0, 0.0),
        (D(2022, 1, 15), 3.0, 0.0),
    ]


def test_weekly_resample_empty_input(spark):
    df = spark.createDataFrame([], "d date, n int")
    assert weekly_resample(df, "d", ["n"]).count() == 0


def test_branch_filter_union_measures_iso_timestamps(spark):
    from civicmart.operators import branch_filter, iso_timestamps, union_measures

    df = spark.createDataFrame([("DS", 1), ("RW", 2), ("RW", None)], "t string, s int")
    got = branch_filter(df, [F.col("t") == "DS"], [F.col("t") == "RW", ~F.col("s").isin([1])]).collect()
    assert sorted((r.t, r.s) for r in got) == [("DS", 1), ("RW", 2)]  # null status: NOT IN unknown -> dropped
    a = spark.createDataFrame([(1,)], "x int")
    b = spark.createDataFrame([(2, "y")], "x int, y string")
    assert sorted((r.x, r.y) for r in union_measures(a, b, a).collect()) == [(1, None), (1, None), (2, "y")]
    t = spark.createDataFrame([("2022-01-02 03:04:05", dt.datetime(2022, 1, 2, 3, 4, 5)), (None, None)], "a string, b timestamp_ntz")
    assert [tuple(r) for r in iso_timestamps(t, ["a", "b"]).collect()] == [("2022-01-02T03:04:05", "2022-01-02T03:04:05"), (None, None)]
