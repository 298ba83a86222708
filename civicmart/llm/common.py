"""Helpers shared by the operators: column picking, word splitting, shared-folder tables."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: A word: a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, found by exact name and position.

    A table may hold further columns whose names differ in case only; referring to a column
    by position keeps such a clash from making the name ambiguous.
    """
    numbered = [f"c{i}" for i in range(len(df.columns))]
    return df.toDF(*numbered).select(*(F.col(numbered[df.columns.index(n)]).alias(n) for n in names))


def numbered(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The table with its columns renamed by position, and the new name of each column."""
    names = [f"in_{i}" for i in range(len(df.columns))]
    return df.toDF(*names), {n: m for n, m in zip(reversed(df.columns), reversed(names))}


def words(text: Column) -> Column:
    """Array of the words of a text; none for null."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def text_key(text: Column) -> Column:
    """Digest that tells different texts of one doc_id apart (null and empty differ)."""
    return F.coalesce(F.md5(text), F.lit("null"))


def saved(df: DataFrame) -> DataFrame:
    """Write a table to the shared checkpoint folder and read it back.

    Cuts the lineage where a loop or several consumers use one result: a lost executor costs
    a re-read, not a recomputation. Reading back also forgets the partitioning, so a later
    join shuffles both sides and adaptive execution may split a hot key.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def in_order(rows: DataFrame, keys: list[Column], name: str = "rank") -> DataFrame:
    """``rows`` with their place from 1 on in the order of ``keys``, by a distributed sort.

    Rows are range-partitioned and sorted, and one count per range gives each its first place. The
    last key should tell rows apart that are equal otherwise, so that a group of them is spread.
    """
    parts = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranges = saved(
        rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
        .select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("place"))
    )
    sizes = ranges.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    starts = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).cast("long").alias("start"))
    return ranges.join(F.broadcast(starts), "part").select(*rows.columns, (F.col("start") + F.col("place") + 1).alias(name))


def discard(*frames: DataFrame) -> None:
    """Delete tables made by :func:`saved` that no result reads any more."""
    for df in frames:
        spark = df.sparkSession
        for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if "/llm-" not in path:
                raise ValueError(f"not a table of saved(): {path}")
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
