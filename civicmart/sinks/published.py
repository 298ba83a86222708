"""Versioned publishing: each write goes to a folder of its own, and a pointer switches last.

Layout of a published table::

    <path>/data/<version>/publish_slice=<key>/part-*.parquet
    <path>/pointers/<number>

A pointer is one small text: the table's schema, its partition columns and, for every slice (one per
value of the partition columns; one in all without them), the version that holds it. Pointers are
numbered, and the highest is the table. A pointer is written under another name and renamed into
place, so it is there whole or not at all; a number is given once, so of two writers that began from
the same version the later one fails with :class:`PublishConflict` instead of losing the other's rows.

Until its pointer is in place a write changes nothing that a reader sees: a job that fails half-way
leaves the table as it was, and a reader keeps the files it has resolved while ``KEEP`` more versions
are published. An upsert writes the slices it touches; the pointer keeps the others where they are.
The driver handles names only, as many as the table has slices.
"""

from __future__ import annotations

import json
import logging
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions._util import quote
from ..operators.aggregates import observe_count
from ..operators.upsert import last_wins, upsert
from ..session import cut_lineage
from ..storage import AlreadyThere, Store

log = logging.getLogger("civicmart.sinks")

#: Earlier versions that stay readable after a new one is published.
KEEP = 2
SLICE = "publish_slice"
WHOLE = "all"


class PublishConflict(Exception):
    """Another writer has published since this one read the table."""


@dataclass(frozen=True)
class Pointer:
    """What a table is at one version."""

    number: int
    schema: StructType
    partition_cols: tuple[str, ...]
    slices: Mapping[str, str]

    def text(self) -> str:
        return json.dumps({"schema": self.schema.jsonValue(), "partition_cols": list(self.partition_cols), "slices": dict(sorted(self.slices.items()))}, indent=1)

    @staticmethod
    def parse(number: int, text: str) -> Pointer:
        found = json.loads(text)
        return Pointer(number, StructType.fromJson(found["schema"]), tuple(found["partition_cols"]), found["slices"])


def pointer(spark: SparkSession, path: str, number: int | None = None) -> Pointer | None:
    """The table's pointer, or that of one version; None if nothing was published (or the version is gone)."""
    store = Store(spark)
    numbers = [int(n) for n in store.names(f"{path}/pointers") if n.isdigit()]
    if number is None and numbers:
        number = max(numbers)
    return Pointer.parse(number, store.read(_pointer_path(path, number))) if number in numbers else None


def _pointer_path(path: str, number: int) -> str:
    return f"{path}/pointers/{number:010d}"


def slice_key(partition_cols: Sequence[str]) -> Column:
    """Name of a row's slice: a digest of its partition values, null like any other value."""
    if not partition_cols:
        return F.lit(WHOLE)
    values = F.to_json(F.struct(*[F.col(quote(c)).cast("string").alias(f"p{i}") for i, c in enumerate(partition_cols)]), {"ignoreNullFields": "false"})
    return F.sha2(values, 256)


def _read(spark: SparkSession, path: str, at: Pointer, slices: Sequence[str]) -> DataFrame:
    if not slices:
        return spark.createDataFrame([], at.schema)
    return spark.read.schema(at.schema).parquet(*[f"{path}/data/{at.slices[s]}/{SLICE}={s}" for s in slices])


def read_published(spark: SparkSession, path: str, number: int | None = None, where: Sequence[Mapping] | None = None) -> DataFrame:
    """The published table (or a kept earlier version). ``where`` lists values of all partition
    columns: only those slices are opened."""
    at = pointer(spark, path, number)
    if at is None:
        raise FileNotFoundError(f"nothing published at {path}" + (f" as version {number}" if number is not None else ""))
    slices = sorted(at.slices)
    if where is not None:
        wanted = StructType([at.schema[c] for c in at.partition_cols])
        rows = spark.createDataFrame([tuple(w[c] for c in at.partition_cols) for w in where], wanted)
        keys = {r[0] for r in rows.select(slice_key(at.partition_cols)).collect()}
        slices = [s for s in slices if s in keys]
    return _read(spark, path, at, slices)


def _write(df: DataFrame, path: str, number: int, partition_cols: Sequence[str]) -> tuple[dict[str, str], int]:
    """Write one version's folder; its slices and rows."""
    version = f"{number:010d}-{uuid.uuid4().hex[:8]}"
    counted, obs = observe_count(df, "publish")
    keyed = counted.withColumn(SLICE, slice_key(partition_cols))
    if partition_cols:
        keyed = keyed.hint("rebalance", F.col(SLICE))  # a file or a few per slice; a hot one is split
    keyed.write.partitionBy(SLICE).parquet(f"{path}/data/{version}")
    names = Store(df.sparkSession).names(f"{path}/data/{version}")
    found = {n.removeprefix(f"{SLICE}="): version for n in names if n.startswith(f"{SLICE}=")}
    return found, int(obs.get["rows"]) if found else 0


def _switch(spark: SparkSession, path: str, new: Pointer, keep: int) -> None:
    store = Store(spark)
    draft = f"{path}/pointers/draft-{uuid.uuid4().hex}"
    store.write(draft, new.text())
    try:
        store.rename(draft, _pointer_path(path, new.number), replace=False)
    except AlreadyThere:
        store.delete(draft)
        raise PublishConflict(f"{path}: version {new.number} was published by another writer") from None
    drop_versions(spark, path, keep)


def drop_versions(spark: SparkSession, path: str, keep: int = KEEP) -> None:
    """Delete pointers older than the last ``keep`` before the current one, and the folders that only
    they, or writes that failed before them, refer to."""
    store = Store(spark)
    numbers = sorted(int(n) for n in store.names(f"{path}/pointers") if n.isdigit())
    kept, gone = numbers[-1 - keep :], numbers[: -1 - keep]
    live: dict[str, set[str]] = {}
    for n in kept:
        for s, version in Pointer.parse(n, store.read(_pointer_path(path, n))).slices.items():
            live.setdefault(version, set()).add(s)
    for n in gone:
        store.delete(_pointer_path(path, n))
    for version in store.names(f"{path}/data"):
        if int(version.split("-")[0]) > kept[0]:
            continue  # may be a write in progress, or a version that is kept
        if version not in live:
            store.delete(f"{path}/data/{version}")
            continue
        for name in store.names(f"{path}/data/{version}"):
            if name.startswith(f"{SLICE}=") and name.removeprefix(f"{SLICE}=") not in live[version]:
                store.delete(f"{path}/data/{version}/{name}")


def publish_replace(df: DataFrame, path: str, partition_cols: Sequence[str] = (), keep: int = KEEP) -> int:
    """Publish ``df`` as the whole table. Returns the row count."""
    spark = df.sparkSession
    before = pointer(spark, path)
    number = before.number + 1 if before else 1
    slices, rows = _write(df, path, number, partition_cols)
    _switch(spark, path, Pointer(number, df.schema, tuple(partition_cols), slices), keep)
    log.info("published %d rows (version %d) at %s", rows, number, path)
    return rows


def publish_upsert(
    increment: DataFrame,
    path: str,
    keys: Sequence[str],
    order_cols: Sequence[str] | None = None,
    partition_cols: Sequence[str] = (),
    keep: int = KEEP,
) -> DataFrame:
    """Upsert ``increment`` last-wins into the published table (created when absent) and publish the
    result; returns the slices written.

    The increment is evaluated once. Only slices that it touches are read and written; their names,
    no more than the table's pointer holds, are what comes to the driver. Partition columns must be
    functions of the key, and stay those of the table.
    """
    spark = increment.sparkSession
    order_cols = list(order_cols or [])
    before = pointer(spark, path)
    increment = cut_lineage(increment)
    if before is None:
        kept = [c for c in increment.columns if c not in order_cols or c in keys or c in partition_cols]
        schema = StructType([increment.schema[c] for c in kept])
        merged = last_wins(increment, keys, order_cols).select(*[quote(c) for c in kept])
    else:
        if tuple(partition_cols) != before.partition_cols:
            raise ValueError(f"{path} is partitioned by {list(before.partition_cols)}, not by {list(partition_cols)}")
        schema = before.schema
        typed = increment.withColumns({f.name: F.col(quote(f.name)).cast(f.dataType) for f in schema if increment.schema[f.name].dataType != f.dataType})
        touched = {r[0] for r in typed.select(slice_key(partition_cols)).distinct().collect()}
        target = _read(spark, path, before, sorted(touched & set(before.slices)))
        merged = upsert(target, typed, keys, order_cols)
    number = before.number + 1 if before else 1
    slices, rows = _write(merged, path, number, partition_cols)
    new = Pointer(number, schema, tuple(partition_cols), {**(before.slices if before else {}), **slices})
    _switch(spark, path, new, keep)
    log.info("published %d rows (version %d) at %s", rows, number, path)
    return _read(spark, path, new, sorted(slices))
