"""File sinks: CSV extracts, partitioned report files, full replace, keyed upsert."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions._util import quote
from ..operators.aggregates import observe_count
from ..operators.upsert import last_wins, upsert
from ..session import cut_lineage
from ..storage import Store
from .published import publish_replace, publish_upsert

log = logging.getLogger("civicmart.sinks")

#: Quotes inside a field are doubled (RFC 4180), on the way out as on the way in.
CSV_QUOTES = {"quote": '"', "escape": '"'}


def _rows(obs: Observation, what: str, path: str) -> int:
    try:
        n = int(obs.get["rows"])
    except Py4JJavaError as e:
        if "toPyRow" not in str(e):
            raise
        n = 0  # the planner found the input empty and dropped the counter: its row has no fields
    log.info("wrote %d rows (%s) to %s", n, what, path)
    return n


def write_csv(
    df: DataFrame,
    path: str,
    order_by: Sequence[str] | None = None,
    single_file: bool = False,
    first: Sequence[str] = (),
    mode: str = "overwrite",
) -> int:
    """CSV with a header. ``first`` moves columns to the front (e.g. a date index);
    ``order_by`` sorts globally (a range shuffle, only at the sink); ``single_file``
    gathers the output into one file and is meant for small extracts only.
    Returns the number of rows written."""
    df, obs = observe_count(df, "write_csv")
    if first:
        df = df.select(*[quote(c) for c in first], *[quote(c) for c in df.columns if c not in first])
    if order_by:
        df = df.orderBy(*[quote(c) for c in order_by])
    if single_file:
        df = df.coalesce(1)
    df.write.mode(mode).option("header", True).options(**CSV_QUOTES).csv(path)
    return _rows(obs, "csv", path)


def write_report_partitions(
    df: DataFrame, path: str, partition_cols: Sequence[str] = ("report", "month_end", "department"), fmt: str = "csv"
) -> int:
    """One folder per (report, period end, department). Dynamic partition overwrite: only
    partitions that receive rows are replaced, so an empty result leaves the earlier
    files in place and no emptiness check (extra job) is needed. Returns the row count."""
    df, obs = observe_count(df, "write_report_partitions")
    (
        df.hint("rebalance", *[F.col(quote(c)) for c in partition_cols])  # a hot slice is split
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("header", True)
        .options(**(CSV_QUOTES if fmt == "csv" else {}))
        .partitionBy(*partition_cols)
        .format(fmt)
        .save(path)
    )
    return _rows(obs, "report partitions", path)


def _table_exists(spark, path: str) -> bool:
    """Whether a Parquet table exists at ``path``. Only a missing path counts as absent:
    any other read error (unreadable or corrupt table) is raised, never taken as empty."""
    from pyspark.errors import AnalysisException

    try:
        spark.read.parquet(path).schema
        return True
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def write_csv_object(df: DataFrame, name: str, order_by: Sequence[str] | None = None, first: Sequence[str] = ()) -> int:
    """One CSV file with a header under exactly ``name`` (an extract that others fetch by name).

    One task writes it, sorting with spills if it must, into a folder of its own beside the name;
    the finished part is then renamed over what is there. So readers see the earlier file or the
    new one, a failed write leaves the earlier one, and a rerun replaces it. Returns the row count.
    """
    df, obs = observe_count(df, "write_csv_object")
    if first:
        df = df.select(*[quote(c) for c in first], *[quote(c) for c in df.columns if c not in first])
    df = df.repartition(1)
    if order_by:
        df = df.sortWithinPartitions(*[quote(c) for c in order_by])
    folder, _, file = name.rpartition("/")
    draft = f"{folder}/_draft-{file}-{uuid.uuid4().hex}"
    store = Store(df.sparkSession)
    try:
        df.write.option("header", True).options(**CSV_QUOTES).csv(draft)
        part = [n for n in store.names(draft) if n.startswith("part-")]
        store.rename(f"{draft}/{part[0]}", name, replace=True)
    finally:
        store.delete(draft)
    return _rows(obs, "csv object", name)


def write_replace(df: DataFrame, path: str, partition_cols: Sequence[str] = (), versioned: bool = False) -> int:
    """Replace the whole published table (Parquet). Returns the row count.

    ``versioned`` publishes it as a new version (:mod:`civicmart.sinks.published`): readers see the
    old table or the new one, never none, and read it with ``read_published``."""
    if versioned:
        return publish_replace(df, path, partition_cols)
    df, obs = observe_count(df, "write_replace")
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.parquet(path)
    return _rows(obs, "replace", path)


def touched_partitions(target: DataFrame, increment: DataFrame, partition_cols: Sequence[str]) -> DataFrame:
    """Rows of ``target`` in the partitions that ``increment`` touches.

    A null-safe semi join, whatever their number: null is a partition like any other. The
    planner may broadcast the distinct values by its own size check and prune files by them.
    """
    touched = increment.select(*[F.col(quote(c)).alias(f"__p{i}") for i, c in enumerate(partition_cols)]).distinct()
    same = F.lit(True)
    for i, c in enumerate(partition_cols):
        same = same & target[quote(c)].eqNullSafe(F.col(f"__p{i}"))
    return target.join(touched, same, "left_semi")


def write_upsert(
    increment: DataFrame,
    path: str,
    keys: Sequence[str],
    order_cols: Sequence[str] | None = None,
    partition_cols: Sequence[str] = (),
    versioned: bool = False,
) -> DataFrame:
    """Upsert ``increment`` into the Parquet table at ``path`` (created when absent).

    The increment is evaluated once (checkpointed) and deduplicated last-wins, on a first load
    too. The target is read with the increment's types, so partition values written as text
    come back as text. Only partitions the increment touches are merged and rewritten (dynamic
    overwrite). Partition columns must be functions of the key. The merged slice is
    checkpointed into the reliable checkpoint folder before the overwrite, so the write does
    not read the files it replaces and survives executor loss. Returns the merged slice.

    ``versioned`` publishes the merged slices as a new version instead
    (:func:`civicmart.sinks.published.publish_upsert`); such a table is read with ``read_published``.
    """
    if versioned:
        return publish_upsert(increment, path, keys, order_cols, partition_cols)
    spark = increment.sparkSession
    order_cols = list(order_cols or [])
    increment = cut_lineage(increment)
    if _table_exists(spark, path):
        stored = spark.read.parquet(path).columns
        types = increment.schema
        known = [types[c] if c in types.names else spark.read.parquet(path).schema[c] for c in stored]
        target = spark.read.schema(StructType(known)).parquet(path)
        if partition_cols:
            target = touched_partitions(target, increment, partition_cols)
        merged = upsert(target, increment, keys, order_cols)
    else:
        kept = [c for c in increment.columns if c not in order_cols or c in keys or c in partition_cols]
        merged = last_wins(increment, keys, order_cols).select(*[quote(c) for c in kept])
    merged = cut_lineage(merged)
    counted, obs = observe_count(merged, "write_upsert")
    w = counted.write.mode("overwrite")
    if partition_cols:
        w = w.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_cols)
    else:
        w = w.option("partitionOverwriteMode", "static")
    w.parquet(path)
    _rows(obs, "upsert", path)
    return merged


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int, path: str, sort: bool = True) -> None:
    """Write ``df`` as an external Parquet table bucketed (and sorted) by ``key``.

    Tables bucketed on the same key with the same bucket count join without any shuffle
    (e.g. the three permit tables on ``folderrsn`` for ``review_time``). The bucket spec is
    kept in the session catalog: on a cluster use a persistent catalog so later jobs see it.
    """
    w = df.write.mode("overwrite").option("path", path).bucketBy(buckets, key)
    if sort:
        w = w.sortBy(key)
    w.format("parquet").saveAsTable(table)
