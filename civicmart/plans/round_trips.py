"""Sinks and sources bound to the driver's tables: each query writes a whole table through a sink and
reads it back through a source. The folders are made anew below the shared checkpoint folder for each
run and stay there, since the lazy result reads them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.aggregates import count_by_date
from ..session import ensure_checkpoint_dir
from ..sinks import publish_upsert, read_published, to_payloads, to_records, write_csv, write_csv_object, write_replace, write_report_partitions, write_upsert
from ..sources import load_changed, read_catalog_json, read_csv_files_by_name, read_csv_strings, read_csv_table, read_report_files, read_utf16_tsv, read_utf16_tsv_ranges

#: Payload bounds of the query; small, so that every table makes many lists.
PAYLOAD_RECORDS, PAYLOAD_BYTES = 50, 4_000
#: Assets in a catalog document.
DOCUMENT_ASSETS = 200


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _folder(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/round-trips/{uuid.uuid4().hex}"


def _month_end(c: str) -> Column:
    return F.last_day(c).cast("string")


def typed_csv_round_trip(spark, sf):
    """Orders as a sorted CSV extract (key column first), read with types; each part's rows in order."""
    at = _folder(spark)
    write_csv(_table(spark, sf, "orders"), at, order_by=["o_orderdate", "o_orderkey"], first=["o_orderdate"])
    back = read_csv_table(spark, at, "o_orderdate timestamp_ntz, o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderpriority string")
    return back


def csv_strings_round_trip(spark, sf):
    """Customers as CSV, read as strings by header name with a column that is not there."""
    at = _folder(spark)
    write_csv(_table(spark, sf, "customer"), at)
    names = {"c_name": "name", "c_custkey": "id", "c_fax": "fax", "c_mktsegment": "segment"}
    return read_csv_strings(spark, at, names, with_file=None)


def csv_by_name_round_trip(spark, sf):
    """Parts in two extracts of different column order, read by header name."""
    part, at = _table(spark, sf, "part").select("p_partkey", "p_name", "p_size"), _folder(spark)
    write_csv_object(part.where("p_size <= 25"), f"{at}/small.csv")
    write_csv_object(part.where("p_size > 25"), f"{at}/large.csv", first=["p_size", "p_name"])
    return read_csv_files_by_name(spark, [f"{at}/small.csv", f"{at}/large.csv"], {"p_partkey": "id", "p_name": "name", "p_size": "size"}, with_file=None)


def csv_object_round_trip(spark, sf):
    """Lines shipped per date as one object of a given name, written twice: the second replaces the first."""
    name = f"{_folder(spark)}/shipped.csv"
    counts = count_by_date(_table(spark, sf, "lineitem"), "l_shipdate")
    date, count = counts.columns
    write_csv_object(counts.limit(1), name)
    write_csv_object(counts, name, order_by=[date])
    return read_csv_table(spark, name, f"{date} date, {count} bigint").select(F.col(date).alias("day"), F.col(count).alias("n"))


def _utf16(spark, sf) -> str:
    at = _folder(spark)
    rows = _table(spark, sf, "conversations").where("text IS NULL OR text <> ''")
    rows.write.option("header", True).option("sep", "\t").option("encoding", "UTF-16").option("quote", '"').option("escape", '"').csv(at)
    return at


UTF16_SCHEMA = "conv_id long, turn long, role string, text string"


def utf16_round_trip(spark, sf):
    """Conversations as tab-separated UTF-16, read one task a file."""
    return read_utf16_tsv(spark, _utf16(spark, sf), UTF16_SCHEMA)


def utf16_ranges_round_trip(spark, sf):
    """The same report read in byte ranges."""
    return read_utf16_tsv_ranges(spark, _utf16(spark, sf), UTF16_SCHEMA)


def report_files_round_trip(spark, sf):
    """Orders as report files per month end and department, in two column orders, read by header."""
    o, at = _table(spark, sf, "orders"), _folder(spark)
    rows = o.select(
        F.col("o_orderkey").alias("Order@Key"), F.col("o_totalprice").cast("decimal(18,2)").alias("Total, all"),
        _month_end("o_orderdate").alias("month_end"), (F.col("o_custkey") % 3 + 2400).cast("string").alias("department"),
    )
    odd = F.col("department") == "2401"
    write_report_partitions(rows.where(~odd), at, partition_cols=("month_end", "department"))
    write_report_partitions(rows.where(odd).select("Total, all", "Order@Key", "month_end", "department"), at, partition_cols=("month_end", "department"))
    return read_report_files(spark, at, {"Order@Key": "order_key", "Total, all": "total", "Gone": "gone"}).select(
        "order_key", "total", "gone", "year", "month", "department_from_file", F.array_join("absent_columns", ",").alias("absent")
    )


def catalog_json_round_trip(spark, sf):
    """Documents as catalog documents of some assets each, read as one row per asset."""
    d, at = _table(spark, sf, "documents"), _folder(spark)
    asset = F.struct(
        F.struct(F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("id"), F.col("source").alias("name"), F.col("n_chars").alias("download_count")).alias("resource"),
        F.struct(F.col("lang").alias("domain_category")).alias("classification"),
    )
    group = F.floor(F.col("doc_id") / DOCUMENT_ASSETS)
    d.groupBy(group.alias("document")).agg(F.collect_list(asset).alias("results")).write.partitionBy("document").json(at)
    return read_catalog_json(spark, f"{at}/*/*.json").select(
        F.col("resource.id").alias("id"), F.col("resource.name").alias("name"), F.col("resource.download_count").alias("downloads"), F.col("classification.domain_category").alias("category")
    )


def _price_change(spark, sf) -> DataFrame:
    """Finished orders with doubled prices, and a new order for each pending one."""
    o = _table(spark, sf, "orders")
    doubled = o.where("o_orderstatus = 'F'").withColumn("o_totalprice", F.col("o_totalprice") * 2)
    fresh = o.where("o_orderstatus = 'P'").withColumn("o_orderkey", -1 - F.col("o_orderkey"))
    return doubled.unionByName(fresh)


def _keyed(orders: DataFrame) -> DataFrame:
    return orders.withColumn("priority", F.col("o_orderpriority"))


def upsert_round_trip(spark, sf):
    """Orders upserted into a partitioned table, then changed ones, twice."""
    at = _folder(spark)
    write_upsert(_keyed(_table(spark, sf, "orders")), at, ["o_orderkey"], partition_cols=["priority"])
    for _ in range(2):
        write_upsert(_keyed(_price_change(spark, sf)), at, ["o_orderkey"], partition_cols=["priority"])
    return spark.read.parquet(at).drop("priority")


def published_upsert_round_trip(spark, sf):
    """The same upserts into a versioned table, read through its pointer."""
    at = _folder(spark)
    publish_upsert(_keyed(_table(spark, sf, "orders")), at, ["o_orderkey"], partition_cols=["priority"])
    for _ in range(2):
        publish_upsert(_keyed(_price_change(spark, sf)), at, ["o_orderkey"], partition_cols=["priority"])
    return read_published(spark, at).drop("priority")


def published_replace_round_trip(spark, sf):
    """Customers in debt published by segment, then replaced by all customers; both versions read."""
    at = _folder(spark)
    c = _table(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    write_replace(c.where("c_acctbal < 0"), at, ["c_mktsegment"], versioned=True)
    write_replace(c, at, ["c_mktsegment"], versioned=True)
    first, second = read_published(spark, at, 1), read_published(spark, at)
    return first.select(F.lit(1).alias("version"), *c.columns).unionByName(second.select(F.lit(2).alias("version"), *c.columns))


def reload_round_trip(spark, sf):
    """Orders' report files loaded by manifest: all, then only the department that was rewritten with
    doubled prices; ``loads`` counts how often each row's file was loaded."""
    o, at = _table(spark, sf, "orders"), _folder(spark)
    rows = o.select("o_orderkey", "o_totalprice", _month_end("o_orderdate").alias("month_end"), (F.col("o_custkey") % 3 + 2400).cast("string").alias("department"))
    files, target = f"{at}/files", f"{at}/table"

    def load(paths: list[str]) -> None:
        found = read_report_files(spark, files, {"o_orderkey": "order_key", "o_totalprice": "price"}, files=paths)
        found = found.select(F.col("order_key").cast("long").alias("order_key"), F.col("price").cast("double").alias("price"))
        loads.append(found.select("order_key"))
        publish_upsert(found, target, ["order_key"])

    loads: list[DataFrame] = []
    write_report_partitions(rows, files, partition_cols=("month_end", "department"))
    load_changed(spark, files, f"{at}/manifest", load)
    counted = loads[0].agg(F.count(F.lit(1))).first()[0]  # before its files are rewritten
    changed = rows.where("department = '2401'").withColumn("o_totalprice", F.col("o_totalprice") * 2)
    write_report_partitions(changed, files, partition_cols=("month_end", "department"))
    load_changed(spark, files, f"{at}/manifest", load)
    again = load_changed(spark, files, f"{at}/manifest", load)
    return read_published(spark, target).join(loads[1].select("order_key", F.lit(2).alias("loads")), "order_key", "left").select(
        "order_key", "price", F.coalesce("loads", F.lit(1)).alias("loads"), F.lit(counted).cast("long").alias("first_load"), F.lit(len(again)).alias("third_load")
    )


def payloads_round_trip(spark, sf):
    """Customers' records packed into bounded lists and unpacked: each once, every list within bounds."""
    records = to_records(_table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey"))
    lists = to_payloads(records, PAYLOAD_RECORDS, PAYLOAD_BYTES)
    fits = (
        (F.col("n_records") <= PAYLOAD_RECORDS) & (F.col("n_bytes") <= PAYLOAD_BYTES)
        & (F.octet_length("payload") == F.col("n_bytes")) & (F.json_array_length("payload") == F.col("n_records"))
    )
    rows = lists.select(fits.alias("fits"), F.explode(F.from_json("payload", "array<struct<c_custkey: long, c_name: string, c_nationkey: int>>")).alias("r"))
    return rows.select("r.*", "fits")


QUERIES = {
    f.__name__: f
    for f in (
        typed_csv_round_trip, csv_strings_round_trip, csv_by_name_round_trip, csv_object_round_trip, utf16_round_trip, utf16_ranges_round_trip,
        report_files_round_trip, catalog_json_round_trip, upsert_round_trip, published_upsert_round_trip, published_replace_round_trip,
        reload_round_trip, payloads_round_trip,
    )
}

_CONVERSATIONS = "SELECT conv_id, turn, role, text FROM conversations WHERE text IS NULL OR text <> ''"
_CHANGED = """
SELECT o_orderkey, o_custkey, o_orderstatus, CASE o_orderstatus WHEN 'F' THEN 2 ELSE 1 END * o_totalprice AS o_totalprice, o_orderdate, o_orderpriority FROM orders
UNION ALL SELECT -1 - o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders WHERE o_orderstatus = 'P'"""

#: DuckDB statements over the tables as they were before the round trip.
ORACLE_SQL = {
    "typed_csv_round_trip": "SELECT o_orderdate, o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders",
    "csv_strings_round_trip": "SELECT c_name AS name, c_custkey::VARCHAR AS id, NULL::VARCHAR AS fax, c_mktsegment AS segment FROM customer",
    "csv_by_name_round_trip": "SELECT p_partkey::VARCHAR AS id, p_name AS name, p_size::VARCHAR AS size FROM part",
    "csv_object_round_trip": "SELECT l_shipdate::DATE AS day, count(*) AS n FROM lineitem WHERE l_shipdate IS NOT NULL GROUP BY 1",
    "utf16_round_trip": _CONVERSATIONS,
    "utf16_ranges_round_trip": _CONVERSATIONS,
    "report_files_round_trip": """
        SELECT o_orderkey::VARCHAR AS order_key, o_totalprice::DECIMAL(18, 2)::VARCHAR AS total, NULL::VARCHAR AS gone,
               year(o_orderdate)::INTEGER AS year, month(o_orderdate)::INTEGER AS month, (o_custkey % 3 + 2400)::INTEGER AS department_from_file, 'gone' AS absent
        FROM orders""",
    "catalog_json_round_trip": "SELECT 'doc-' || doc_id AS id, source AS name, n_chars AS downloads, lang AS category FROM documents",
    "upsert_round_trip": _CHANGED,
    "published_upsert_round_trip": _CHANGED,
    "published_replace_round_trip": """
        SELECT 1 AS version, c_custkey, c_acctbal, c_mktsegment FROM customer WHERE c_acctbal < 0
        UNION ALL SELECT 2, c_custkey, c_acctbal, c_mktsegment FROM customer""",
    "reload_round_trip": """
        SELECT o_orderkey AS order_key, CASE o_custkey % 3 WHEN 1 THEN 2 ELSE 1 END * o_totalprice AS price, CASE o_custkey % 3 WHEN 1 THEN 2 ELSE 1 END AS loads,
               (SELECT count(*) FROM orders) AS first_load, 0 AS third_load
        FROM orders""",
    "payloads_round_trip": "SELECT c_custkey, c_name, c_nationkey, TRUE AS fits FROM customer",
}
