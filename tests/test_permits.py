"""The five named permit queries on hand-made permit tables."""

import datetime as dt

import pytest

from civicmart.plans import permits

T = dt.datetime
FOLDER_SCHEMA = (
    "folderrsn bigint, foldertype string, subcode int, statuscode int, workcode int, priority int, "
    "indate timestamp_ntz, issuedate timestamp_ntz, foldername string, folderyear string, "
    "foldersequence string, customfoldernumber string"
)


@pytest.fixture
def folder(spark):
    rows = [
        (1, "DS", 1, 50010, 0, 3, T(2019, 1, 1, 11, 0), T(2019, 2, 1, 13, 0), "A-1", "2019", "1", "c1"),
        (2, "DS", 1, 50005, 0, 3, T(2019, 1, 1, 12, 0), None, "A-2", "2019", "2", "c2"),  # excluded status (DS)
        (3, "RW", 50510, 1, 0, 3, T(2019, 1, 1, 12, 0), T(2019, 1, 5), "LA-3", "2019", "3", "c3"),  # excluded subcode
        (4, "RW", 50500, 50010, 50590, 3, T(2019, 1, 2, 12, 0), T(2019, 1, 9), "LA-4", "2019", "4", "c4"),
        (5, "EX", 7, None, 0, 3, T(2019, 1, 2), T(2019, 1, 3, 12), "X-5", None, "5", "c5"),  # null status: NOT IN drops
        (6, "EX", 7, 50010, 0, 3, T(2018, 9, 30), T(2019, 1, 3, 11), "LA-6", "2018", None, "c6"),  # before bound
        (7, "ZZ", 1, 50010, 0, 3, T(2019, 1, 1), T(2019, 1, 1), "Z", "2019", "7", "c7"),  # other type
        (8, "RW", 50500, 50010, 50590, 3, T(2019, 1, 2), T(2019, 1, 9), "B-8", "2019", "8", "c8"),
        (9, "EX", 7, 50010, 0, 2, T(2019, 1, 2), T(2019, 1, 3), "X-9", "2019", "9", "c9"),
    ]
    return spark.createDataFrame(rows, FOLDER_SCHEMA)


def test_applications_received(spark, folder):
    got = sorted((r.foldertype, r.subcode, r.day, r.issuedrowpermits) for r in permits.applications_received(folder).collect())
    assert got == [
        ("DS", 1, dt.date(2019, 1, 1), 1),
        ("EX", 7, dt.date(2019, 1, 2), 1),
        ("RW", 50500, dt.date(2019, 1, 2), 1),  # folder 8, 00:00
        ("RW", 50500, dt.date(2019, 1, 3), 1),  # folder 4, noon goes up
    ]


def test_issued_permits(spark, folder):
    got = sorted((r.foldertype, r.day, r.issuedrowpermits) for r in permits.issued_permits(folder).collect())
    assert got == [
        ("DS", dt.date(2019, 2, 2), 1),
        ("EX", dt.date(2019, 1, 3), 2),  # folders 6 (11:00) and 9 (00:00)
        ("EX", dt.date(2019, 1, 4), 1),  # folder 5 (12:00 goes up; no status filter here)
        ("RW", dt.date(2019, 1, 9), 2),
    ]


def test_active_permits_land_prefix_only_for_rw(spark, folder):
    got = {r.foldertype: r.activepermits for r in permits.active_permits(folder).collect()}
    assert got == {"DS": 1, "EX": 2, "RW": 1}


def test_review_time_fan_out_and_inner_attempt(spark, folder):
    process = spark.createDataFrame(
        [(4, 70000, T(2019, 1, 3), T(2019, 1, 4)), (4, 50680, T(2019, 1, 6), None), (8, 70000, T(2019, 1, 3), None)],
        "folderrsn bigint, processcode int, startdate timestamp_ntz, enddate timestamp_ntz",
    )
    attempt = spark.createDataFrame(
        [(4, 61510, T(2019, 1, 7)), (4, 61510, T(2019, 1, 8)), (8, 1, T(2019, 1, 7))],
        "folderrsn bigint, resultcode int, attemptdate timestamp_ntz",
    )
    out = permits.review_time(folder, process, attempt).collect()
    assert len(out) == 2  # folder 8 has no matching attempt -> dropped; folder 4 fans out 1:2
    assert {r.dept_comments for r in out} == {T(2019, 1, 7), T(2019, 1, 8)}
    assert all(r.webappstart == T(2019, 1, 3) and r.extend == T(2019, 1, 6) for r in out)


def test_ex_permits_issued(spark, folder):
    validsub = spark.createDataFrame([(7, "Seven")], "subcode int, subdesc string")
    out = sorted(permits.ex_permits_issued(folder, validsub).collect(), key=lambda r: r.permit_id)
    assert [(r.permit_id, r.subdesc, r.issuedate_text) for r in out] == [
        ("-5", "Seven", "01-03-2019 12:00:00"),
        ("2018-", "Seven", "01-03-2019 11:00:00"),
    ]


def test_named_registry(spark, folder):
    df = permits.run_named_query("active_permits", {"folder": folder})
    assert df.count() == 3
    with pytest.raises(KeyError):
        permits.run_named_query("nope", {})
