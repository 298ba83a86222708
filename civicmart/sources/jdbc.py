"""Relational source: one table over JDBC, read in parallel ranges of equal row counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


#: Pieces that a range of keys is counted in at a time.
PIECES = 64


def key_ranges(spark: SparkSession, url: str, table: str, column: str, partitions: int, **properties) -> list[str]:
    """Conditions on a whole-number column that cut a table into about equally many rows each.

    The database counts: once the least and greatest key, then the rows in equal pieces between them,
    and again inside every piece that holds more than a quarter of a partition, until pieces are small
    enough or a single key. Cuts fall between pieces, so where no key is hotter than that, partitions
    differ by less than half; a hotter key is a partition of its own. At most ``4 * partitions``
    pieces are counted again on a level, and the driver gets ``PIECES`` rows of each. The first
    condition takes null keys in, the outer ones are open, so rows that come meanwhile are read too.
    """
    ask = lambda sql: read_jdbc_query(spark, url, sql, **properties).collect()
    low, high, total = ask(f"SELECT MIN({column}) AS FIRST_KEY, MAX({column}) AS LAST_KEY, COUNT({column}) AS KEY_ROWS FROM {table}")[0]
    if not total:
        return ["1 = 1"]
    if low != int(low) or high != int(high):
        raise ValueError(f"{column} is not a whole-number column")
    most = max(1, total // (4 * partitions))
    done: list[tuple[int, int, int]] = []  # (least key, greatest key, rows)
    todo = [(int(low), int(high), int(total))]
    while todo:
        first, last, rows = todo.pop()
        if rows <= most or first == last:
            done.append((first, last, rows))
            continue
        width = -(-(last - first + 1) // PIECES)
        counted = ask(
            f"SELECT MIN(K) AS FIRST_KEY, MAX(K) AS LAST_KEY, COUNT(*) AS KEY_ROWS FROM (SELECT {column} AS K, FLOOR(({column} - {first}) / {width}) AS B FROM {table} "
            f"WHERE {column} BETWEEN {first} AND {last}) T GROUP BY B"
        )
        todo += [tuple(map(int, r)) for r in counted]
    cuts, seen, share = [], 0, total / partitions
    for first, _, rows in sorted(done):
        # cut before a piece whose middle is past the next share
        if seen and seen + rows / 2 > (len(cuts) + 1) * share and len(cuts) < partitions - 1:
            cuts.append(first)
        seen += rows
    if not cuts:
        return ["1 = 1"]
    between = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(cuts, cuts[1:])]
    return [f"{column} < {cuts[0]} OR {column} IS NULL", *between, f"{column} >= {cuts[-1]}"]


def read_jdbc_table(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
    fetch_size: int = 10000,
    **properties,
) -> DataFrame:
    """A database table as a DataFrame.

    With ``partition_column`` the table is read by ``num_partitions`` parallel range queries: of
    equal width between the bounds if both are given, else of about equal row counts, for which
    the database is asked first (:func:`key_ranges`). Filters and column selections of the plan are pushed into the SQL sent
    to the database (``PushedFilters`` in the plan); grouping happens in Spark.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).option("fetchsize", fetch_size)
    if partition_column is not None:
        if num_partitions is None or (lower_bound is None) != (upper_bound is None):
            raise ValueError("partition_column needs num_partitions, and both bounds or none")
    if partition_column is not None and lower_bound is None:
        conditions = key_ranges(spark, url, table, partition_column, num_partitions, **properties)
        return spark.read.jdbc(url, table, predicates=conditions, properties={"fetchsize": str(fetch_size)} | {k: str(v) for k, v in properties.items()})
    if partition_column is not None:
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", lower_bound)
            .option("upperBound", upper_bound)
            .option("numPartitions", num_partitions)
        )
    for k, v in properties.items():
        reader = reader.option(k, v)
    return reader.load()


def read_permit_tables(
    spark: SparkSession,
    url: str,
    rsn_bounds: tuple[int, int] | None = None,
    num_partitions: int = 1,
    **properties,
) -> dict[str, DataFrame]:
    """The four permit-system tables the named queries read, keyed by query table name.

    The three folder tables are read in ``num_partitions`` parallel ranges of ``FOLDERRSN``: of
    equal width within ``rsn_bounds`` or, without them, of about equal row counts in each table;
    the sub-code table (a code list) in one query.
    """
    folder_tables = {"folder": "FOLDER", "folderprocess": "FOLDERPROCESS", "folderprocessattempt": "FOLDERPROCESSATTEMPT"}
    out = {}
    for key, name in folder_tables.items():
        if num_partitions > 1:
            low, high = rsn_bounds or (None, None)
            out[key] = read_jdbc_table(spark, url, name, "FOLDERRSN", low, high, num_partitions, **properties)
        else:
            out[key] = read_jdbc_table(spark, url, name, **properties)
    out["validsub"] = read_jdbc_table(spark, url, "VALIDSUB", **properties)
    return out


def read_jdbc_query(spark: SparkSession, url: str, sql: str, fetch_size: int = 10000, **properties) -> DataFrame:
    """The result of one SQL statement run by the database itself (the ``query`` option):
    for statements in the database's own dialect. Read as a single partition; prefer
    :func:`read_jdbc_table` plus DataFrame operators for large results."""
    reader = spark.read.format("jdbc").option("url", url).option("query", sql).option("fetchsize", fetch_size)
    for k, v in properties.items():
        reader = reader.option(k, v)
    return reader.load()
