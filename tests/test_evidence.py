"""Published control points and headers, multi-part extracts, a hot folder, counts in the log."""

import logging
import os

import pytest
from pyspark.sql import functions as F

from civicmart.functions.geo import US_SURVEY_FOOT, LambertZone, state_plane_to_wgs84
from civicmart.plans.active_log import active_permit_log_job, extract_snapshot
from civicmart.plans.permits import review_time
from civicmart.plans.service_requests import FIELD_MAPPING, transform_service_requests
from civicmart.plans.weekly import read_extract, EXTRACTS, weekly_summary_job
from civicmart.sinks.files import write_upsert


def put(path, text, mtime=None):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as f:
        f.write(text)
    if mtime is not None:
        os.utime(path, (mtime, mtime))


def test_worked_example_of_the_guidance_note(spark):
    # EPSG guidance note 7-2, Lambert conic conformal (2SP): NAD27 / Texas South Central
    zone = LambertZone(
        lat0=27 + 50 / 60, lon0=-99.0, lat1=28 + 23 / 60, lat2=30 + 17 / 60,
        false_easting=2_000_000.0, false_northing=0.0, unit_m=US_SURVEY_FOOT, a=6378206.4, inv_f=294.978698214,
    )
    p = spark.range(1).select(state_plane_to_wgs84(F.lit(2963503.91), F.lit(254759.80), zone).alias("p")).first().p
    assert p.lat == pytest.approx(28.5, abs=3e-8) and p.lon == pytest.approx(-96.0, abs=3e-8)


def test_weekly_job_reads_published_headers(spark, scratch):
    paths = {k: f"{scratch}/{k}.csv" for k in EXTRACTS}
    for k in ("applications", "issued"):
        e = EXTRACTS[k]
        put(paths[k], f'FOLDERTYPE,SUBCODE,"{e.date}",{e.count}\nDS,1,2022-01-03,3.0\nRW,,2022-01-12,4\n')
    for k in ("commercial", "extension", "residential"):
        put(paths[k], f"{EXTRACTS[k].date},Count Permits\n2022-01-03,2\n")
    rows = {r.date[:10]: r for r in weekly_summary_job(spark, paths, f"{scratch}/weekly").collect()}
    assert sorted(rows) == ["2022-01-08", "2022-01-15"]
    first, second = rows["2022-01-08"], rows["2022-01-15"]
    assert (first.ds_applications_received, first.ds_permits_issued, first.extension_requests) == (7.0, 3.0, 2.0)
    assert (second.rw_applications_received, second.ds_applications_received) == (4.0, 0.0)
    put(f"{scratch}/bad.csv", "Created,Count Permits\n2022-01-03,2.5\n")
    with pytest.raises(Exception):
        read_extract(spark, f"{scratch}/bad.csv", EXTRACTS["extension"]).collect()


def test_parts_of_one_extract_make_one_snapshot(spark, scratch):
    put(f"{scratch}/x/part-0.csv", "foldertype,activepermits\nDS,5\n", 1_650_000_000)
    put(f"{scratch}/x/part-1.csv", "foldertype,activepermits\nRW,7\n", 1_650_000_090)
    active_permit_log_job(spark, f"{scratch}/x", f"{scratch}/log", tz="UTC")
    rows = spark.read.parquet(f"{scratch}/log").collect()
    assert [(r.ds, r.ex, r.rw, r.published_date) for r in rows] == [(5.0, None, 7.0, "2022-04-15T05:21:00.000")]
    empty = spark.createDataFrame([], "foldertype string, activepermits long, published_date string")
    assert extract_snapshot(empty).count() == 0


def test_hot_folder_is_split(spark):
    n = 200_000
    folder = spark.createDataFrame([(i, i, "RW", 1, 1, None, None) for i in range(50)],
                                   "customfoldernumber int, folderrsn int, foldertype string, subcode int, workcode int, indate date, issuedate date")
    hot = F.when(F.col("id") % 3 < 2, F.lit(7)).otherwise((F.col("id") % 50).cast("int")).alias("folderrsn")
    attempt = spark.range(n, numPartitions=8).select(hot, F.lit(3).alias("resultcode"), F.sha2(F.col("id").cast("string"), 256).alias("attemptdate"))
    process = spark.range(100).select((F.col("id") % 50).cast("int").alias("folderrsn"), (F.floor(F.col("id") / 50) + 1).cast("int").alias("processcode"),
                                      F.col("id").alias("startdate"), F.col("id").alias("enddate"))
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
    }
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        out = review_time(folder, process, attempt, subcode=1, workcode=1, webapp_process=1, extension_process=2, comment_result=3)
        assert len(out.collect()) == n
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k in conf:
            spark.conf.unset(k)


def test_upsert_counts_its_rows(spark, scratch, caplog):
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    with caplog.at_level(logging.INFO, logger="civicmart.sinks"):
        write_upsert(rows, f"{scratch}/t", ["k"])
        write_upsert(rows.where("k > 5"), f"{scratch}/u", ["k"])
    assert [r.args[0] for r in caplog.records] == [2, 0]


def test_a_date_format_for_each_column(spark):
    formats = {"Created Date": "MM/dd/yyyy HH:mm", "Close Date": "dd.MM.yyyy HH:mm"}
    given = {"Created Date": "10/02/2021 08:30", "Close Date": "03.10.2021 09:00", "Last Update Date": "2021-10-02 10:00:00"}
    cols = [F.lit(given.get(c)).cast("string").alias(c) for c in FIELD_MAPPING if c not in ("location", "fiscal_year")]
    r = transform_service_requests(spark.range(1).select(*cols), formats).first()
    assert (r.created_date, r.close_date, r.last_update_date, r.fiscal_year) == ("2021-10-02T08:30:00", "2021-10-03T09:00:00", "2021-10-02T10:00:00", 2022)
