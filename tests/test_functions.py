"""Golden cases (hand-computed) for the column functions."""

import datetime as dt

from pyspark.sql import functions as F

from civicmart.functions import (
    blank_to_null,
    dataset_url,
    fiscal_month,
    fiscal_year,
    iso_text,
    iso_week_label,
    join_tags,
    last_value_of,
    local_minute_stamp,
    merged_pairs,
    month_end,
    month_name,
    nan_to_null,
    parse_report_name,
    permit_id,
    point_wkt,
    previous_month,
    round_to_day,
    row_identifier,
    state_plane_to_wgs84,
    utc_to_local,
    week_ending_saturday,
    wgs84_to_state_plane,
)


def one(spark, *cols):
    return spark.range(1).select(*cols).first()


def test_round_to_day_noon_goes_up(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2022, 1, 1, 11, 59, 59),), (dt.datetime(2022, 1, 1, 12, 0, 0),), (None,)], "ts timestamp_ntz"
    )
    got = [r[0] for r in df.select(round_to_day("ts")).collect()]
    assert got == [dt.date(2022, 1, 1), dt.date(2022, 1, 2), None]


def test_week_label_is_closing_saturday(spark):
    days = [dt.date(2022, 1, 1), dt.date(2022, 1, 2), dt.date(2022, 1, 8)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = [r[0] for r in df.select(week_ending_saturday("d")).collect()]
    assert got == [dt.date(2022, 1, 1), dt.date(2022, 1, 8), dt.date(2022, 1, 8)]


def test_fiscal_october_switch(spark):
    df = spark.createDataFrame([(dt.date(2021, 9, 30),), (dt.date(2021, 10, 1),), (None,)], "d date")
    got = df.select(fiscal_year("d").alias("fy"), fiscal_month(F.month("d")).alias("fm")).collect()
    assert [(r.fy, r.fm) for r in got] == [(2021, 12), (2022, 1), (None, None)]


def test_month_helpers(spark):
    r = one(spark, month_end(F.lit(2024), F.lit(2)).alias("e"), month_name(F.lit(1)).alias("n"))
    assert r.e == dt.date(2024, 2, 29) and r.n == "Jan"
    assert previous_month(2022, 1) == (2021, 12)
    assert previous_month(2022, 7) == (2022, 6)


def test_utc_to_local_summer_winter_and_nulls(spark):
    df = spark.createDataFrame(
        [("2022-07-01T03:04:05.678Z",), ("2022-01-01T03:04:05.999Z",), ("",), (None,)], "t string"
    )
    got = [r[0] for r in df.select(utc_to_local("t")).collect()]
    assert got == ["2022-06-30T22:04:05", "2021-12-31T21:04:05", None, None]


def test_iso_texts(spark):
    r = one(
        spark,
        iso_text(F.lit(dt.datetime(2022, 3, 4, 5, 6, 7, 890)).cast("timestamp_ntz")).alias("a"),
        iso_week_label(F.lit(dt.date(2022, 1, 8))).alias("b"),
    )
    assert r.a == "2022-03-04T05:06:07" and r.b == "2022-01-08T00:00:00.000"


def test_local_minute_stamp(spark):
    ts = F.lit(dt.datetime(2022, 7, 1, 15, 4, 59)).cast("timestamp")  # session zone is UTC
    assert one(spark, local_minute_stamp(ts).alias("s")).s == "2022-07-01T10:04:00.000"


def test_permit_id_and_row_identifier(spark):
    r = one(
        spark,
        permit_id(F.lit(2022), F.lit(None).cast("string")).alias("p"),
        row_identifier([F.lit(2022), F.lit(None).cast("string"), F.lit("")]).alias("r"),
    )
    assert r.p == "2022-"
    assert r.r == "2022None"


def test_row_identifier_absent_and_blank(spark):
    df = spark.createDataFrame([(2022, None)], "y int, fund string")
    r = df.select(row_identifier(["y", "fund", "unit"], absent=["unit"], null_text="").alias("r")).first()
    assert r.r == "2022None"


def test_report_name(spark):
    r = one(spark, parse_report_name(F.lit("expenses/2022-01-31_2400.csv")).alias("p")).p
    assert (r.year, r.month, r.department) == (2022, 1, 2400)


def test_tags(spark):
    df = spark.createDataFrame([(["x", None],), ([],), (None,)], "tags array<string>")
    assert [r[0] for r in df.select(join_tags("tags")).collect()] == ["x, None", "", ""]


def test_last_key_wins_public_over_private(spark):
    df = spark.createDataFrame(
        [([("a", "9")], [("a", "1"), ("a", "2")]), (None, [("b", "1")])],
        "priv array<struct<key:string,value:string>>, pub array<struct<key:string,value:string>>",
    )
    got = df.select(last_value_of(merged_pairs("priv", "pub"), "a").alias("a")).collect()
    assert [r.a for r in got] == ["2", ""]


def test_blank_and_nan(spark):
    df = spark.createDataFrame([("",), (" ",), ("1.5",), (None,)], "s string")
    got_text = [r[0] for r in df.select(blank_to_null("s")).collect()]
    assert got_text == [None, " ", "1.5", None]
    d = spark.createDataFrame([(float("nan"),), (1.0,)], "x double")
    assert [r[0] for r in d.select(nan_to_null("x")).collect()] == [None, 1.0]


def test_point_and_url(spark):
    df = spark.createDataFrame([(-97.7404, 30.2747, True), (None, 30.0, False)], "lon double, lat double, pub boolean")
    got = df.select(point_wkt("lon", "lat").alias("p"), dataset_url("pub", F.lit("abcd-1234"), "https://p/d/", "https://i/d/").alias("u")).collect()
    assert got[0].p == "POINT (-97.7404 30.2747)" and got[1].p is None
    assert got[0].u == "https://p/d/abcd-1234" and got[1].u == "https://i/d/abcd-1234"


def test_projection_golden_and_round_trip(spark):
    df = spark.createDataFrame([(3115014.7786, 10073182.9191), (None, 1.0)], "x double, y double")
    p = df.select(state_plane_to_wgs84("x", "y").alias("p"))
    rows = p.collect()
    assert rows[1].p.lat is None and rows[1].p.lon is None
    lat, lon = rows[0].p.lat, rows[0].p.lon
    assert abs(lat - 30.2747) < 1e-6 and abs(lon - (-97.7404)) < 1e-6
    back = p.where(F.col("p.lat").isNotNull()).select(wgs84_to_state_plane(F.col("p.lat"), F.col("p.lon")).alias("q")).first().q
    assert abs(back.x - 3115014.7786) < 1e-6 and abs(back.y - 10073182.9191) < 1e-6


def test_projection_round_trip_grid(spark):
    xs = [(2900000.0 + 25000.0 * i, 9900000.0 + 20000.0 * j) for i in range(10) for j in range(10)]
    df = spark.createDataFrame(xs, "x double, y double")
    p = df.select("x", "y", state_plane_to_wgs84("x", "y").alias("p"))
    q = p.select("x", "y", wgs84_to_state_plane(F.col("p.lat"), F.col("p.lon")).alias("q"))
    worst = q.select(F.max(F.greatest(F.abs(F.col("q.x") - F.col("x")), F.abs(F.col("q.y") - F.col("y")))).alias("e")).first().e
    assert worst < 1e-6


def test_pairs_to_map_last_wins(spark):
    from civicmart.functions import pairs_to_map

    df = spark.createDataFrame([([("a", "9"), ("b", "1"), ("a", "2")],), ([],)], "p array<struct<key:string,value:string>>")
    got = [r[0] for r in df.select(pairs_to_map("p")).collect()]
    assert got == [{"b": "1", "a": "2"}, {}]


def test_resolve_year_month():
    import datetime as dt

    from civicmart.functions import resolve_year_month

    assert resolve_year_month(None, None, dt.date(2023, 5, 2)) == (2023, 5)
    assert resolve_year_month(2020, None, dt.date(2023, 5, 2)) == (2020, 5)


def test_sql_functions_match_column_functions(spark):
    from civicmart.sql_functions import register_sql_functions

    register_sql_functions(spark, prefix="cm_")
    rows = [(dt.datetime(2021, 9, 30, 12, 0), "2022-07-01T03:04:05.678Z", "2022", None),
            (dt.datetime(2021, 10, 1, 11, 59), "", None, "7")]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, u string, y string, s string")
    df.createOrReplaceTempView("cm_probe")
    sql = spark.sql(
        "SELECT cm_round_to_day(ts) AS r, cm_week_ending_saturday(to_date(ts)) AS w, cm_fiscal_year(to_date(ts)) AS fy,"
        " cm_fiscal_month(month(ts)) AS fm, cm_month_abbrev(month(ts)) AS mn, cm_permit_id(y, s) AS p,"
        " cm_iso_text(ts) AS i, cm_utc_to_local(u, 'US/Central') AS l FROM cm_probe"
    ).collect()
    col = df.select(
        round_to_day("ts").alias("r"), week_ending_saturday("ts").alias("w"), fiscal_year("ts").alias("fy"),
        fiscal_month(F.month("ts")).alias("fm"), month_name(F.month("ts")).alias("mn"), permit_id("y", "s").alias("p"),
        iso_text("ts").alias("i"), utc_to_local("u").alias("l"),
    ).collect()
    assert [r.asDict() for r in sql] == [r.asDict() for r in col]


def test_previous_month_year_rollover():
    assert previous_month(2022, 1) == (2021, 12)
    assert previous_month(2024, 3) == (2024, 2)


def test_recommended_settings():
    from civicmart.session import recommended_settings

    big = recommended_settings(100 * 2**40, 8000)
    assert big["spark.sql.shuffle.partitions"] == str(100 * 2**40 // (256 << 20))
    small = recommended_settings(10 * 2**20, 64)
    assert small["spark.sql.shuffle.partitions"] == "256"
