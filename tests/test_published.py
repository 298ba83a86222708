"""Versioned tables, named CSV objects, first-line probes, manifests, payload lists, key ranges."""

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from civicmart.plans.finance import EXPENSES, finance_reload_job
from civicmart.plans.permits import permit_extract_job, review_time
from civicmart.sinks import PublishConflict, published, publish_replace, publish_upsert, read_published, to_payloads, to_records, write_csv_object, write_replace, write_upsert
from civicmart.sources import key_ranges, load_changed, read_csv_table, read_jdbc_table, read_report_files
from civicmart.storage import AlreadyThere, Store


def rows_of(df):
    return sorted(map(repr, map(tuple, df.collect())))


def table(spark, rows, ddl="k int, v string, month int"):
    return spark.createDataFrame(rows, ddl)


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as f:
        f.write(text)


# ------------------------------------------------------------------------------ versioned tables


def failing(df):
    """Rows of which a later partition fails, after others were written."""
    bad = F.when(F.col("k") == 999, F.raise_error(F.lit("broken off"))).otherwise(F.col("v"))
    return df.unionByName(table(df.sparkSession, [(999, "x", 7)])).repartition(4, "k").withColumn("v", bad.cast("string"))


@pytest.mark.parametrize("cols", [[], ["month"]])
def test_a_write_that_fails_leaves_the_table(spark, scratch, cols):
    old = table(spark, [(i, "a", i % 3) for i in range(30)])
    publish_replace(old, scratch, cols)
    before = rows_of(read_published(spark, scratch))
    with pytest.raises(Exception, match="broken off"):
        publish_replace(failing(old), scratch, cols)
    with pytest.raises(Exception, match="broken off"):
        publish_upsert(failing(old), scratch, ["k"], partition_cols=cols)
    assert rows_of(read_published(spark, scratch)) == before
    assert publish_replace(table(spark, [(1, "n", 1)]), scratch, cols) == 1  # and the next one works
    assert rows_of(read_published(spark, scratch)) == ["(1, 'n', 1)"]


def test_upsert_writes_touched_slices_only(spark, scratch):
    publish_upsert(table(spark, [(1, "a", 1), (2, "b", None), (3, "c", 3), (1, "z", 1)]), scratch, ["k"], partition_cols=["month"])
    first = published.pointer(spark, scratch)
    got = publish_upsert(table(spark, [(4, "d", None), (1, "n", 1)]), scratch, ["k"], partition_cols=["month"])
    assert rows_of(got) == ["(1, 'n', 1)", "(2, 'b', None)", "(4, 'd', None)"]
    second = published.pointer(spark, scratch)
    assert rows_of(read_published(spark, scratch)) == ["(1, 'n', 1)", "(2, 'b', None)", "(3, 'c', 3)", "(4, 'd', None)"]
    assert len(second.slices) == 3 and len({s for s in first.slices if first.slices[s] == second.slices[s]}) == 1
    assert rows_of(read_published(spark, scratch, where=[{"month": None}, {"month": 3}])) == ["(2, 'b', None)", "(3, 'c', 3)", "(4, 'd', None)"]
    with pytest.raises(ValueError):
        publish_upsert(table(spark, [(1, "n", 1)]), scratch, ["k"])
    # the increment's types give way to the table's
    publish_upsert(spark.createDataFrame([(9, "w", "3")], "k bigint, v string, month string"), scratch, ["k"], partition_cols=["month"])
    assert read_published(spark, scratch).schema == table(spark, []).schema
    assert rows_of(read_published(spark, scratch, where=[{"month": 3}])) == ["(3, 'c', 3)", "(9, 'w', 3)"]


def test_of_two_writers_one_wins(spark, scratch, monkeypatch):
    publish_replace(table(spark, [(1, "a", 1)]), scratch)
    switch = published._switch

    def late(*args):
        monkeypatch.setattr(published, "_switch", switch)
        publish_upsert(table(spark, [(2, "other", 1)]), scratch, ["k"])
        switch(*args)

    monkeypatch.setattr(published, "_switch", late)
    with pytest.raises(PublishConflict):
        publish_upsert(table(spark, [(1, "mine", 1)]), scratch, ["k"])
    assert rows_of(read_published(spark, scratch)) == ["(1, 'a', 1)", "(2, 'other', 1)"]
    publish_upsert(table(spark, [(1, "mine", 1)]), scratch, ["k"])
    assert rows_of(read_published(spark, scratch)) == ["(1, 'mine', 1)", "(2, 'other', 1)"]


def test_old_versions_go_after_the_grace_count(spark, scratch):
    publish_upsert(table(spark, [(1, "v1", 1), (2, "v1", 2)]), scratch, ["k"], partition_cols=["month"])
    reader = read_published(spark, scratch)  # resolved now, read later
    for n in (2, 3):
        publish_upsert(table(spark, [(1, f"v{n}", 1)]), scratch, ["k"], partition_cols=["month"])
    assert rows_of(reader) == ["(1, 'v1', 1)", "(2, 'v1', 2)"]
    store = Store(spark)
    with pytest.raises(Exception):
        write = failing(table(spark, [(1, "x", 1)]))
        publish_replace(write, scratch, ["month"])
    for n in (4, 5, 6, 7):
        publish_upsert(table(spark, [(1, f"v{n}", 1)]), scratch, ["k"], partition_cols=["month"])
    assert store.names(f"{scratch}/pointers") == [f"{n:010d}" for n in (5, 6, 7)]
    versions = [int(v.split("-")[0]) for v in store.names(f"{scratch}/data")]
    assert versions == [1, 5, 6, 7]  # the first still holds the untouched slice, and only that; the failed write is gone
    kept = [n for n in store.names(f"{scratch}/data/" + store.names(f"{scratch}/data")[0]) if n.startswith("publish_slice")]
    assert len(kept) == 1
    assert rows_of(read_published(spark, scratch)) == ["(1, 'v7', 1)", "(2, 'v1', 2)"]
    assert rows_of(read_published(spark, scratch, 5)) == ["(1, 'v5', 1)", "(2, 'v1', 2)"]
    with pytest.raises(FileNotFoundError):
        read_published(spark, scratch, 4)


def test_empty_and_hot(spark, scratch):
    assert publish_replace(table(spark, []), f"{scratch}/e") == 0
    assert rows_of(read_published(spark, f"{scratch}/e")) == [] and read_published(spark, f"{scratch}/e").schema == table(spark, []).schema
    publish_upsert(table(spark, [(1, "a", 1)]), f"{scratch}/e", ["k"])
    publish_upsert(table(spark, []), f"{scratch}/e", ["k"])
    assert rows_of(read_published(spark, f"{scratch}/e")) == ["(1, 'a', 1)"]
    with pytest.raises(FileNotFoundError):
        read_published(spark, f"{scratch}/none")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200k")
    try:  # one month holds nearly all rows: its slice is written by several tasks
        hot = spark.range(0, 40_000, numPartitions=4).select(F.col("id").cast("int").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"), F.when(F.col("id") % 10 == 0, F.lit(2)).otherwise(1).alias("month"))
        assert publish_replace(hot, f"{scratch}/h", ["month"]) == 40_000
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(read_published(spark, f"{scratch}/h", where=[{"month": 1}]).inputFiles()) > 1


def test_jobs_take_versioned_targets(spark, scratch):
    rows = table(spark, [(1, "a", 1)])
    assert write_replace(rows, f"{scratch}/r", versioned=True) == 1
    write_upsert(rows, f"{scratch}/r", ["k"], versioned=True)
    assert rows_of(read_published(spark, f"{scratch}/r")) == ["(1, 'a', 1)"]


def test_rename_is_exclusive_or_replaces(spark, scratch):
    store = Store(spark)
    store.write(f"{scratch}/a", "one")
    store.write(f"{scratch}/b", "two")
    with pytest.raises(AlreadyThere):
        store.rename(f"{scratch}/a", f"{scratch}/b", replace=False)
    assert store.read(f"{scratch}/b") == "two"
    store.rename(f"{scratch}/a", f"{scratch}/b", replace=True)
    assert store.read(f"{scratch}/b") == "one" and [n for n in store.names(scratch) if not n.startswith(".")] == ["b"]


# ----------------------------------------------------------------------------------- CSV object


def test_csv_object_has_its_name_and_is_replaced_whole(spark, scratch):
    name = f"{scratch}/out/extract.csv"
    df = spark.range(0, 50, numPartitions=7).select(F.col("id").alias("n"), F.concat(F.lit('q"'), F.col("id").cast("string")).alias("t"))
    assert write_csv_object(df, name, order_by=["n"], first=["t"]) == 50
    lines = open(name).read().splitlines()
    assert lines[:3] == ["t,n", '"q""0",0', '"q""1",1'] and len(lines) == 51
    with pytest.raises(Exception, match="broken off"):
        write_csv_object(df.withColumn("t", F.when(F.col("n") == 49, F.raise_error(F.lit("broken off")).cast("string")).otherwise(F.col("t"))), name)
    assert open(name).read().splitlines() == lines  # the earlier object
    assert write_csv_object(df.limit(0), name) == 0
    assert open(name).read().splitlines() == ["n,t"]
    assert [f for f in os.listdir(f"{scratch}/out") if not f.startswith(".")] == ["extract.csv"]


def test_permit_extract_as_one_object(spark, scratch):
    folder = spark.createDataFrame([(1, "DS", 50010, "A"), (2, "EX", 50010, "B"), (3, "DS", 50010, "C")], "folderrsn int, foldertype string, statuscode int, foldername string")
    permit_extract_job({"folder": folder}, "active_permits", f"{scratch}/active_permits.csv", one_object=True)
    assert open(f"{scratch}/active_permits.csv").read().splitlines() == ["foldertype,activepermits", "DS,2", "EX,1"]
    assert read_csv_table(spark, f"{scratch}/active_permits.csv", "foldertype string, activepermits bigint").count() == 2


# ---------------------------------------------------------------------------- headers, manifests


def test_header_probe_reads_a_bounded_part_of_each_file(spark, scratch):
    for d in ("2400", "6200"):
        put(f"{scratch}/2022-01-31_{d}.csv", "Fund@Code,Left\n" + "F,1\n" * 2_000_000)
    files = [f"{scratch}/2022-01-31_{d}.csv" for d in ("2400", "6200")]
    stats = spark._jvm.org.apache.hadoop.fs.FileSystem
    read = lambda: sum(s.getBytesRead() for s in stats.getAllStatistics())
    before = read()
    assert Store(spark).first_lines(files) == ["Fund@Code,Left"] * 2
    assert read() - before < 2 * (1 << 17)  # of 16 MB
    before = read()
    df = read_report_files(spark, scratch, {"Fund@Code": "fund"})
    assert read() - before < 1 << 21  # headers, and a buffer of one file to name the columns
    assert df.columns[0] == "fund"


def test_names_with_spaces_are_read(spark, scratch):
    put(f"{scratch}/a b/2022-01-31_2400.csv", "Fund@Code\nF\n")
    assert read_report_files(spark, scratch, {"Fund@Code": "fund"}).first()[0] == "F"


def test_manifest_loads_what_changed(spark, scratch):
    for n in "abc":
        put(f"{scratch}/in/{n}.csv", "x\n1\n")
    seen = []
    load = lambda files: seen.append([f.rsplit("/", 1)[1] for f in files])
    run = lambda f=load: load_changed(spark, f"{scratch}/in", f"{scratch}/manifest", f)
    run()
    assert run() == [] and seen == [["a.csv", "b.csv", "c.csv"]]
    time.sleep(1.1)
    put(f"{scratch}/in/b.csv", "x\n2\n")
    put(f"{scratch}/in/d.csv", "x\n3\n")

    def fails(files):
        raise RuntimeError("load failed")

    with pytest.raises(RuntimeError):
        run(fails)
    run()  # not noted by the failed one
    run()
    assert seen[1:] == [["b.csv", "d.csv"]]
    assert load_changed(spark, f"{scratch}/none", f"{scratch}/manifest2", load) == []


def test_finance_reload(spark, scratch):
    field = {v: k for k, v in EXPENSES.mapping.items()}
    head = f"{field['fund']},{field['unobligated']}\n"
    for month in ("2021-11-30", "2022-01-31"):
        put(f"{scratch}/in/expenses/{month}_2400.csv", head + f"F{month},1\n")
    got = finance_reload_job(spark, f"{scratch}/in", f"{scratch}/out")
    assert len(got["expenses"]) == 2 and got["revenue"] == []
    time.sleep(1.1)
    put(f"{scratch}/in/expenses/2021-11-30_2400.csv", head + "F2021-11-30,5\n")
    assert [f.rsplit("/", 1)[1] for f in finance_reload_job(spark, f"{scratch}/in", f"{scratch}/out")["expenses"]] == ["2021-11-30_2400.csv"]
    rows = read_published(spark, f"{scratch}/out/expenses").select("fund", "unobligated").collect()
    assert sorted(map(tuple, rows)) == [("F2021-11-30", "5"), ("F2022-01-31", "1")]


# -------------------------------------------------------------------------------------- payloads


def test_payloads_hold_every_record_once_within_bounds(spark):
    rows = [(i, "é" * (i % 40), None if i % 3 else i) for i in range(1_000)]
    df = spark.createDataFrame(rows, "a int, b string, c int").repartition(3)
    records = to_records(df)
    lists = to_payloads(records, 17, 700).collect()
    found = []
    for p in lists:
        items = json.loads(p.payload)
        assert p.n_records == len(items) <= 17 and p.n_bytes == len(p.payload.encode()) <= 700
        found += [(x["a"], x["b"], x["c"]) for x in items]
    assert sorted(found, key=str) == sorted(rows, key=str)
    longest = max(len(r[0].encode()) for r in records.collect())
    assert all(json.loads(p.payload) for p in to_payloads(records, 17, longest + 2).collect())  # just fits
    with pytest.raises(Exception, match="does not fit"):
        to_payloads(records, 17, longest + 1).collect()
    assert to_payloads(records.limit(0)).count() == 0


# ------------------------------------------------------------------- key ranges, review milestones


def jdbc(spark, name, df):
    url, driver = f"jdbc:derby:memory:{name};create=true", "org.apache.derby.iapi.jdbc.AutoloadedDriver"
    df.write.format("jdbc").option("url", url).option("dbtable", "T").option("driver", driver).mode("overwrite").save()
    return url, driver


def test_ranges_of_a_skewed_key_hold_like_counts(spark):
    # nine tenths of the keys in a thousandth of their range, and far outliers
    dense, sparse = spark.range(500_000, 501_800).select("id"), spark.range(0, 1_000_000, 5_000).select("id")
    keys = dense.unionByName(sparse).unionByName(spark.createDataFrame([(10**12,), (None,)], "id long"))
    url, driver = jdbc(spark, "civicmart_skew", keys.select(F.col("id").alias("K")))
    df = read_jdbc_table(spark, url, "T", "K", num_partitions=8, driver=driver)
    sizes = [r[0] for r in df.groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert sum(sizes) == 2_002 and len(sizes) == 8 and max(sizes) <= 2 * min(sizes)
    assert sorted(map(repr, df.collect())) == sorted(map(repr, keys.select(F.col("id").alias("K")).collect()))  # each once, the null too


def test_ranges_with_one_hot_key_and_none(spark):
    keys = spark.range(0, 300).select(F.lit(7).cast("long").alias("K")).unionByName(spark.range(0, 300).select(F.col("id").alias("K")))
    url, driver = jdbc(spark, "civicmart_hot", keys)
    df = read_jdbc_table(spark, url, "T", "K", num_partitions=4, driver=driver)
    assert df.count() == 600 and df.rdd.getNumPartitions() <= 4
    url, driver = jdbc(spark, "civicmart_none", keys.limit(0))
    assert key_ranges(spark, url, "T", "K", 4, driver=driver) == ["1 = 1"]
    with pytest.raises(ValueError):
        read_jdbc_table(spark, url, "T", "K", lower_bound=1, num_partitions=4, driver=driver)


def test_review_milestones_scan_the_process_table_once(spark, scratch):
    folder = [(1, "RW", 50500, 50590, "c1"), (2, "RW", 50500, 50590, "c2"), (3, "EX", 50500, 50590, "c3")]
    frames = {
        "f": spark.createDataFrame([(*r, None, None) for r in folder], "folderrsn int, foldertype string, subcode int, workcode int, customfoldernumber string, indate timestamp_ntz, issuedate timestamp_ntz"),
        "p": spark.sql("SELECT * FROM VALUES (1, 70000, 1, 2), (1, 70000, 3, 4), (1, 50680, 5, 6), (1, 1, 7, 8), (2, 50680, 9, NULL) AS t(folderrsn, processcode, startdate, enddate)"),
        "a": spark.sql("SELECT * FROM VALUES (1, 61510, 'd1'), (2, 61510, 'd2'), (2, 1, 'd3'), (3, 61510, 'd4') AS t(folderrsn, resultcode, attemptdate)"),
    }
    for n, df in frames.items():
        df.write.parquet(f"{scratch}/{n}")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = review_time(*(spark.read.parquet(f"{scratch}/{n}") for n in "fpa"))
        got = sorted((r.folderrsn, r.webappstart, r.webappend, r.extend, r.dept_comments) for r in out.collect() if r.webappstart) + [
            (r.folderrsn, r.webappstart, r.webappend, r.extend, r.dept_comments) for r in out.collect() if not r.webappstart
        ]
        plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == [(1, 1, 2, 5, "d1"), (1, 3, 4, 5, "d1"), (2, None, None, 9, "d2")]
    assert plan.count("FileScan") == 3 and plan.count("ReusedExchange") == 1
