"""Whole jobs end to end on small files in scratch folders."""

import datetime as dt
import json
import os

import pytest

from pyspark.sql import functions as F

from civicmart.plans.active_log import active_permit_log_job
from civicmart.plans.catalog import catalog_job
from civicmart.plans.finance import EXPENSES, finance_extract, finance_load, finance_load_job
from civicmart.plans.flex_notes import IGNORED_QUESTIONS, flex_notes_job
from civicmart.plans.service_requests import FIELD_MAPPING, service_requests_job
from civicmart.plans.sheets import sheet_day_counts_job
from civicmart.plans.weekly import SUMMARY_COLUMNS, weekly_summary_job


def write(path, text, encoding="utf-8"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding=encoding, newline="") as fh:
        fh.write(text)


def test_weekly_summary_job(spark, scratch):
    write(f"{scratch}/apps.csv", "foldertype,subcode,day,issuedrowpermits\nDS,1,2022-01-01,3\nRW,2,2022-01-30,5\nEX,1,2022-01-02,1\n")
    write(f"{scratch}/iss.csv", "foldertype,subcode,day,issuedrowpermits\nDS,1,2022-01-08,2\n")
    write(f"{scratch}/com.csv", "date,count_permits\n2022-01-03,4\n")
    write(f"{scratch}/ext.csv", "date,count_permits\n2022-03-01,8\n")
    write(f"{scratch}/res.csv", "date,count_permits\n2022-01-01,1\n")
    paths = dict(applications=f"{scratch}/apps.csv", issued=f"{scratch}/iss.csv", commercial=f"{scratch}/com.csv",
                 extension=f"{scratch}/ext.csv", residential=f"{scratch}/res.csv")
    out = weekly_summary_job(spark, paths, f"{scratch}/weekly")
    assert out.columns == SUMMARY_COLUMNS
    got = {r.date: r for r in spark.read.parquet(f"{scratch}/weekly").collect()}
    # applications span 01-01..02-05, extension only 03-05: weeks 02-12..02-26 are in no span
    assert sorted(got) == [f"2022-{d}T00:00:00.000" for d in ["01-01", "01-08", "01-15", "01-22", "01-29", "02-05", "03-05"]]
    first = got["2022-01-01T00:00:00.000"]
    assert first.ds_applications_received == 4.0  # 3 DS + 1 residential
    assert got["2022-01-08T00:00:00.000"].ds_applications_received == 4.0  # commercial 4
    assert got["2022-01-08T00:00:00.000"].ex_applications_received == 1.0
    assert got["2022-01-08T00:00:00.000"].ds_permits_issued == 2.0
    assert got["2022-02-05T00:00:00.000"].rw_applications_received == 5.0
    assert got["2022-03-05T00:00:00.000"].extension_requests == 8.0


def test_sheet_day_counts_job(spark, scratch):
    write(f"{scratch}/sheet.csv", "Date Created,Name\n2022-01-01 08:00:00,a\n2022-01-01 20:00:00,b\n,c\n2022-01-03 00:00:00,d\n")
    out = sheet_day_counts_job(spark, f"{scratch}/sheet.csv", "Date Created", f"{scratch}/out")
    assert sorted((r.date, r.count_permits) for r in out.collect()) == [(dt.date(2022, 1, 1), 2), (dt.date(2022, 1, 3), 1)]


def test_active_permit_log_job(spark, scratch):
    p = f"{scratch}/active_permits.csv"
    write(p, "foldertype,activepermits\nRW,3\nDS,1\nEX,2\n")
    when = dt.datetime(2022, 1, 1, 18, 30, 10, tzinfo=dt.timezone.utc).timestamp()
    os.utime(p, (when, when))
    active_permit_log_job(spark, p, f"{scratch}/log")
    active_permit_log_job(spark, p, f"{scratch}/log")  # same stamp: upsert, not a second row
    rows = spark.read.parquet(f"{scratch}/log").collect()
    assert [r.asDict() for r in rows] == [{"ds": 1.0, "ex": 2.0, "rw": 3.0, "published_date": "2022-01-01T12:30:00.000"}]


def test_service_requests_job(spark, scratch):
    cols = [c for c in FIELD_MAPPING if c not in ("location", "fiscal_year")]
    base = {c: "" for c in cols}
    r1 = dict(base, **{"Service Request (SR) Number": "SR-1", "Created Date": "2021-10-01 08:00:00",
                       "Close Date": "2021-10-03 09:10:11", "State Plane X Coordinate": "3115014.7786",
                       "State Plane Y Coordinate": "10073182.9191", "Is Duplicate? (1/0)": "0"})
    r2 = dict(base, **{"Service Request (SR) Number": "SR-2", "Created Date": "2021-09-30 23:00:00"})
    text = "\t".join(cols) + "\r\n" + "".join("\t".join(r[c] for c in cols) + "\r\n" for r in (r1, r2))
    write(f"{scratch}/csr.tsv", text, encoding="utf-16")
    out = service_requests_job(spark, f"{scratch}/csr.tsv", f"{scratch}/csr_out")
    assert out.columns == list(FIELD_MAPPING.values())
    got = {r.service_request_sr_number: r for r in spark.read.parquet(f"{scratch}/csr_out").collect()}
    assert got["SR-1"].location == "POINT (-97.7404 30.2747)"
    assert got["SR-1"].fiscal_year == 2022 and got["SR-2"].fiscal_year == 2021
    assert got["SR-1"].close_date == "2021-10-03T09:10:11" and got["SR-2"].close_date is None
    assert got["SR-2"].location is None and got["SR-2"].state_plane_x_coordinate is None


def test_flex_notes_job(spark, scratch):
    head = "Flex Notes ID,Service Request Number,Flex Notes Definition ID,Service Request ID,Flex Question,Flex Answer\n"
    rows = [
        f'1,SR-1,10,100,"{IGNORED_QUESTIONS[1]}",ABC123\n',
        "2,SR-1,11,100,,free text\n",
        '3,SR-2,12,101,"Color?",red\n',
    ]
    write(f"{scratch}/flex.csv", head + "".join(rows))
    flex_notes_job(spark, f"{scratch}/flex.csv", f"{scratch}/flex_out")
    got = sorted((r.flex_note_id, r.flex_question) for r in spark.read.parquet(f"{scratch}/flex_out").collect())
    assert got == [(2, None), (3, "Color?")]


def _expense_csv(rows):
    cols = list(EXPENSES.mapping)
    out = ",".join(f'"{c}"' for c in cols) + "\n"
    for r in rows:
        out += ",".join(f'"{r.get(c, "")}"' for c in cols) + "\n"
    return out


def test_finance_load_window_and_derivations(spark, scratch):
    root = f"{scratch}/fin"
    row = {"Fund@Code": "1000", "Department@Dept": "9999", "Unit@Unit Code": "U1", "Object Code@Code": "O1",
           "Unobligated": "12.50", "% Obligated": ""}
    write(f"{root}/expenses/2022-01-31_2400.csv", _expense_csv([row]))
    write(f"{root}/expenses/2021-12-31_6200.csv", _expense_csv([dict(row, **{"Fund@Code": "2000"})]))
    write(f"{root}/expenses/2021-10-31_2400.csv", _expense_csv([dict(row, **{"Fund@Code": "3000"})]))
    df = finance_load(spark, root, EXPENSES, 2022, 1)
    got = sorted(df.collect(), key=lambda r: r.fund)
    assert [r.fund for r in got] == ["1000", "2000"]
    a = got[0]
    assert (a.department, a.year, a.month, a.month_name, a.fiscal_year, a.fiscal_month) == (2400, 2022, 1, "Jan", 2022, 4)
    assert a.row_identifier == "2022410002400U1O1"
    assert a.percent_obligated is None and a.unobligated == "12.50"
    assert finance_load(spark, root, EXPENSES, 2022, 1, full_refresh=True).count() == 3
    oct_row = [r for r in finance_load(spark, root, EXPENSES, 2022, 1, full_refresh=True).collect() if r.fund == "3000"][0]
    assert (oct_row.fiscal_year, oct_row.fiscal_month) == (2022, 1)
    typed = finance_load(spark, root, EXPENSES, 2022, 1, typed=True)
    assert dict(typed.dtypes)["unobligated"] == "decimal(18,2)" and dict(typed.dtypes)["percent_obligated"] == "double"


def test_finance_load_job_upserts(spark, scratch):
    root = f"{scratch}/fin2"
    row = {"Fund@Code": "1000", "Unit@Unit Code": "U1", "Object Code@Code": "O1", "Unobligated": "1"}
    write(f"{root}/expenses/2022-01-31_2400.csv", _expense_csv([row]))
    write(f"{root}/revenue/2022-01-31_2400.csv", "Fund@Code,Unit@Unit Code\n1000,U1\n")
    finance_load_job(spark, root, f"{scratch}/pub", 2022, 1)
    write(f"{root}/expenses/2022-01-31_2400.csv", _expense_csv([dict(row, Unobligated="2")]))
    finance_load_job(spark, root, f"{scratch}/pub", 2022, 1)
    exp = spark.read.parquet(f"{scratch}/pub/expenses").collect()
    assert [(r.row_identifier, r.unobligated) for r in exp] == [("2022410002400U1O1", "2")]
    rev = spark.read.parquet(f"{scratch}/pub/revenue").collect()
    assert rev[0].row_identifier == "2022410002400U1NoneNone"  # absent key columns print None


def test_finance_extract(spark):
    facts = spark.createDataFrame(
        [("2400", 2022, dt.date(2022, 1, 31), 1), ("6200", 2022, dt.date(2021, 12, 31), 2), ("2400", 2021, dt.date(2021, 9, 30), 3)],
        "department string, fiscal_year int, month_end date, v int",
    )
    assert sorted(r.v for r in finance_extract(facts, 2022, 1).collect()) == [1, 2]


CATALOG = {
    "results": [
        {
            "resource": {"id": "aaaa-0001", "name": "A", "type": "dataset", "updatedAt": "2022-07-01T03:04:05.678Z",
                         "createdAt": "2022-01-01T03:04:05.999Z", "download_count": 3,
                         "page_views": {"page_views_last_week": 1, "page_views_last_month": 2, "page_views_total": 3}},
            "classification": {"domain_category": "Transportation", "domain_tags": ["x", None],
                               "domain_metadata": [{"key": "Ownership_Program-Name", "value": "pub"}],
                               "domain_private_metadata": [{"key": "Ownership_Program-Name", "value": "priv"},
                                                           {"key": "Ownership_Department-name", "value": "D"}]},
            "owner": {"id": "zzzz-9999", "display_name": "Someone"},
        },
        {"resource": {"id": "aaaa-0002:draft", "type": "dataset"}, "classification": {}, "owner": {"id": "me"}},
        {"resource": {"id": "aaaa-0003", "type": "chart"}, "classification": {"domain_metadata": []},
         "owner": {"id": "me", "display_name": "Me"}},
        {"resource": {"id": "aaaa-0004", "type": "dataset"}, "classification": {}, "owner": {"id": "other"}},
    ]
}


def test_catalog_job(spark, scratch):
    write(f"{scratch}/cat.json", json.dumps(CATALOG))
    write(f"{scratch}/pub.json", json.dumps({"results": [{"resource": {"id": "aaaa-0001"}}]}))
    rows = spark.createDataFrame([("aaaa-0001",), ("aaaa-0001",), ("aaaa-0003",)], "dataset_id string")
    out = catalog_job(spark, f"{scratch}/cat.json", f"{scratch}/pub.json", rows, f"{scratch}/catalog", "me",
                      "Transportation", "https://public.example/d/", "https://internal.example/d/")
    got = {r.id: r for r in spark.read.parquet(f"{scratch}/catalog").collect()}
    assert sorted(got) == ["aaaa-0001", "aaaa-0003"]
    a, c = got["aaaa-0001"], got["aaaa-0003"]
    assert a.is_public and a.dataset_url == "https://public.example/d/aaaa-0001"
    assert not c.is_public and c.dataset_url == "https://internal.example/d/aaaa-0003"
    assert a.updatedAt == "2022-06-30T22:04:05" and a.createdAt == "2021-12-31T21:04:05" and c.updatedAt is None
    assert a.tags == "x, None" and c.tags == ""
    assert a.program_name == "pub" and a.department_name == "D" and a.strategic_area == ""
    assert a.row_count == 2 and c.row_count is None
    assert a.page_views_total == 3 and a.owner_display_name == "Someone"
    assert "row_count" in out.columns


def test_finance_extract_then_load_round_trip(spark, scratch):
    from civicmart.plans.finance import finance_extract_job

    facts = spark.createDataFrame(
        [
            ("2400", 2022, dt.date(2022, 1, 31), "1000", "U1", "O1", "5"),
            ("6200", 2022, dt.date(2021, 12, 31), "2000", "U2", "O2", ""),
            ("2400", 2021, dt.date(2021, 9, 30), "3000", "U3", "O3", "9"),  # outside the window
        ],
        "department string, fiscal_year int, month_end date, `Fund@Code` string, `Unit@Unit Code` string, "
        "`Object Code@Code` string, Unobligated string",
    )
    finance_extract_job({"expenses": facts}, f"{scratch}/extract", 2022, 1)
    rows = finance_load(spark, f"{scratch}/extract", EXPENSES, 2022, 1).collect()
    got = sorted((r.fund, r.department, r.year, r.month, r.row_identifier, r.unobligated) for r in rows)
    assert got == [
        ("1000", 2400, 2022, 1, "2022410002400U1O1", "5"),
        ("2000", 6200, 2021, 12, "2022320006200U2O2", None),
    ]


def test_permit_lifecycle_extracts_to_weekly_table(spark, scratch):
    """Named queries -> CSV extracts -> weekly job equals the one-pass flagship query."""
    import __spark_entry__ as E
    from civicmart.operators import count_by_date
    from civicmart.plans import bindings as B
    from civicmart.plans.permits import permit_extract_job
    from civicmart.sinks import write_csv

    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("driver test data not present")
    events = B.table(spark, sf, "events")
    tables = {"folder": B.folder_from_events(events)}
    permit_extract_job(tables, "applications_received", f"{scratch}/apps", **B.EVENTS_APPLICATIONS)
    permit_extract_job(tables, "issued_permits", f"{scratch}/iss", **B.EVENTS_ISSUED)
    sheets = {
        "com": events.where(F.col("event_type") == "signup"),
        "ext": events.where(F.col("event_type") == "error"),
        "res": events.where(F.col("event_type") == "view"),
    }
    for key, frame in sheets.items():
        write_csv(count_by_date(frame, "ts"), f"{scratch}/{key}", first=["date"])
    paths = dict(applications=f"{scratch}/apps", issued=f"{scratch}/iss", commercial=f"{scratch}/com",
                 extension=f"{scratch}/ext", residential=f"{scratch}/res")
    weekly_summary_job(spark, paths, f"{scratch}/weekly")
    published = sorted(tuple(r) for r in spark.read.parquet(f"{scratch}/weekly").collect())
    direct = sorted(tuple(r) for r in E.queries()["weekly_permit_summary"](spark, sf).collect())
    assert published == direct and len(direct) > 0


def test_weekly_summary_from_sources_one_plan(spark, scratch):
    from civicmart.plans.weekly import weekly_summary_from_sources

    folder = spark.createDataFrame(
        [("DS", 1, 1, dt.datetime(2022, 1, 1, 9), dt.datetime(2022, 1, 8, 9)),
         ("RW", 2, 1, dt.datetime(2022, 1, 20, 13), None)],
        "foldertype string, subcode int, statuscode int, indate timestamp_ntz, issuedate timestamp_ntz",
    )
    com = spark.createDataFrame([("2022-01-03 10:00:00",)], "`Date Created` string")
    ext = spark.createDataFrame([("2022-01-15 10:00:00",)], "Created string")
    res = spark.createDataFrame([(None,)], "`Date Created` string")
    out = weekly_summary_from_sources(folder, com, ext, res, f"{scratch}/w")
    got = {r.date: r for r in spark.read.parquet(f"{scratch}/w").collect()}
    assert sorted(got) == ["2022-01-01T00:00:00.000", "2022-01-08T00:00:00.000", "2022-01-15T00:00:00.000", "2022-01-22T00:00:00.000"]
    assert got["2022-01-08T00:00:00.000"].ds_applications_received == 1.0  # commercial sheet
    assert got["2022-01-08T00:00:00.000"].ds_permits_issued == 1.0
    assert got["2022-01-22T00:00:00.000"].rw_applications_received == 1.0  # Jan 20 13:00 rounds to Jan 21
    assert got["2022-01-15T00:00:00.000"].extension_requests == 1.0
    assert out.columns[0] == "date"
