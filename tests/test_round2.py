"""Inputs that once lost or corrupted rows without an error."""

import csv
import os

import pytest
from pyspark.sql import functions as F

from civicmart.functions.arrays import last_value_of
from civicmart.operators import report_grid, slice_reports
from civicmart.operators.aggregates import pick_last_values
from civicmart.plans.finance import EXPENSES, finance_load
from civicmart.sinks.files import write_csv, write_report_partitions, write_upsert
from civicmart.sources.files import read_catalog_json, read_csv_strings, read_csv_table, read_report_files


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as f:
        f.write(text)


def test_null_partition_survives_an_upsert(spark, scratch):
    base = spark.createDataFrame([(1, "a", 1), (2, "b", None)], "k int, v string, month int")
    write_upsert(base, f"{scratch}/t", ["k"], partition_cols=["month"])
    write_upsert(spark.createDataFrame([(3, "c", None), (1, "z", 1)], "k int, v string, month int"), f"{scratch}/t", ["k"], partition_cols=["month"])
    assert sorted((r.k, r.v, r.month) for r in spark.read.parquet(f"{scratch}/t").collect()) == [(1, "z", 1), (2, "b", None), (3, "c", None)]


def test_first_load_is_deduplicated_and_text_partitions_stay_text(spark, scratch):
    rows = spark.createDataFrame([(1, "a", "01"), (1, "b", "01"), (None, "c", "02")], "k int, v string, month string")
    for _ in range(2):
        write_upsert(rows, f"{scratch}/t", ["k"], partition_cols=["month"])
        assert sorted(d for d in os.listdir(f"{scratch}/t") if d.startswith("month")) == ["month=01", "month=02"]
        assert sorted((r.k or 0, r.v) for r in spark.read.parquet(f"{scratch}/t").collect()) == [(0, "c"), (1, "b")]


def test_quotes_round_trip(spark, scratch):
    rows = [("1", 'Say ""hi"", now'.replace('""', '"')), ("2", "a,b"), ("3", "back\\slash"), ("4", "plain")]
    write_csv(spark.createDataFrame(rows, "id string, v string"), f"{scratch}/c", single_file=True)
    name = next(f for f in os.listdir(f"{scratch}/c") if f.endswith(".csv"))
    with open(f"{scratch}/c/{name}", newline="") as f:
        assert sorted(map(tuple, list(csv.reader(f))[1:])) == rows
    assert sorted((r.id, r.v) for r in read_csv_strings(spark, f"{scratch}/c").collect()) == rows


def test_counts_with_a_zero_fraction_and_bad_values(spark, scratch):
    put(f"{scratch}/ok/a.csv", "t,n\nDS,3.0\nEX,\nRW,4\n")
    read = lambda p: read_csv_table(spark, p, schema="t string, n bigint")
    assert sorted((r.t, r.n) for r in read(f"{scratch}/ok").collect()) == [("DS", 3), ("EX", None), ("RW", 4)]
    for bad in ("3.5", "x"):
        put(f"{scratch}/bad{bad}/a.csv", f"t,n\nDS,{bad}\n")
        with pytest.raises(Exception):
            read(f"{scratch}/bad{bad}").collect()


@pytest.mark.parametrize("text", ['{"results": [{"resource": {"id": "a"', '{"other": 1}'])
def test_broken_catalog_fails(spark, scratch, text):
    put(f"{scratch}/cat.json", text)
    with pytest.raises(Exception):
        read_catalog_json(spark, f"{scratch}/cat.json").collect()


def test_report_files_by_header_and_name(spark, scratch):
    root = f"{scratch}/expenses"
    put(f"{root}/2022-01-31_2400.csv", 'Fund@Code,Unobligated\nF1,"1\n2"\n')
    put(f"{root}/2021-12-31_2400.csv", "Unobligated,Fund@Code\n2,F2\n")
    put(f"{root}/2021-12-31_6200.csv", "Unobligated\n3\n")
    put(f"{root}/2019-01-31_2400.csv", "broken")
    got = read_report_files(spark, root, {"Fund@Code": "fund", "Unobligated": "left"}, [(2022, 1), (2021, 12)]).collect()
    assert sorted((r.fund or "", r.left, list(r.absent_columns)) for r in got) == [("", "3", ["fund"]), ("F1", "1\n2", []), ("F2", "2", [])]
    assert read_report_files(spark, root, {"Fund@Code": "fund"}, [(2000, 1)]).count() == 0
    put(f"{root}/notes.csv", "x\n1\n")
    with pytest.raises(ValueError):
        read_report_files(spark, root, {"Fund@Code": "fund"}, [(2022, 1)])


def test_identifier_follows_each_files_header(spark, scratch):
    fund = next(k for k, v in EXPENSES.mapping.items() if v == "fund")
    unit = next(k for k, v in EXPENSES.mapping.items() if v == "unit")
    put(f"{scratch}/expenses/2022-01-31_2400.csv", f"{fund},{unit}\nF,U\n")
    put(f"{scratch}/expenses/2022-01-31_6200.csv", f"{unit}\nU\n")
    ids = {r.department: r.row_identifier for r in finance_load(spark, scratch, EXPENSES, 2022, 1).collect()}
    assert "FU" not in ids[6200] and "F" in ids[2400].replace("None", "") and ids[6200].count("None") == ids[2400].count("None") + 1


def test_grid_prunes_partitions(spark, scratch):
    facts = spark.sql("SELECT id AS v, 2400 + id % 3 AS dept, 2022 AS fy, date_add(date'2022-01-31', CAST(id % 40 AS INT)) AS end FROM range(400)")
    facts.write.partitionBy("end").parquet(f"{scratch}/f")
    sliced = slice_reports(spark.read.parquet(f"{scratch}/f"), report_grid(spark, ["2400"], 2022, 1), "dept", "fy", "end")
    text = sliced._jdf.queryExecution().toString()
    assert "2022-01-31" in text[text.index("PartitionFilters"):]
    assert {str(r.end) for r in sliced.collect()} <= {"2022-01-31"}


def test_hot_report_slice_is_split(spark, scratch):
    rows = spark.range(0, 200_000, numPartitions=8).select(F.lit("r").alias("report"), F.lit("m").alias("month_end"), F.lit("d").alias("department"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        assert write_report_partitions(rows, f"{scratch}/rp") == 200_000
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len([f for _, _, names in os.walk(f"{scratch}/rp") for f in names if f.endswith(".csv")]) > 1


def test_present_null_value_stays_null(spark):
    df = spark.createDataFrame([([("a", "1"), ("a", None)],)], "p array<struct<key: string, value: string>>")
    assert df.select(last_value_of("p", "a"), last_value_of("p", "b")).first()[:] == (None, "")
    rows = spark.createDataFrame([(1, "a", "x", 1), (1, "a", None, 2)], "g int, k string, v string, o int")
    r = pick_last_values(rows, ["g"], "k", "v", "o", {"a": "a", "b": "b"}).first()
    assert (r.a, r.b) == (None, "")


def test_values_tied_in_the_order_column_are_the_greatest(spark):
    rows = spark.createDataFrame([(1, "a", x, 5) for x in "qzb"] + [(1, "a", "last", None), (1, "b", "x", None)], "g int, k string, v string, o int")
    for parts in (1, 3, 5):
        r = pick_last_values(rows.repartition(parts), ["g"], "k", "v", "o", {"a": "a", "b": "b"}).first()
        assert (r.a, r.b) == ("z", "")
