"""WARC records and a Merkle fixity audit of their replicas.

Records are laid out in one order (by id, null last, then digest); each has its number, its
offset and the archive file its offset falls into. Their digests are the leaves of a tree whose
nodes cover ordered ranges of ``FAN_OUT`` children. Two replicas are compared from the roots: a
level is read only under the nodes that differ one level above, down to the corrupted records.

Numbers and offsets come from a distributed prefix sum: rows are range-partitioned in order, each
range is summed by itself, and only one total per range meets in one place.

Defined results: null url or html counts as empty; repeated rows are records of their own, in any
order among themselves (they are equal); a record missing on one side has a null digest there; an
empty table gives an empty tree and an empty audit; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, pick, saved

FAN_BITS = 4
FAN_OUT = 1 << FAN_BITS
ARCHIVE_BYTES = 64 << 20


def record(record_id: Column, url: Column, body: Column) -> Column:
    """A WARC/1.1 response record as text."""
    text = F.coalesce(body, F.lit(""))
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"), F.coalesce(record_id.cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")),
        F.lit("\r\nContent-Length: "), F.octet_length(text).cast("string"), F.lit("\r\n\r\n"), text, F.lit("\r\n\r\n"),
    )


def layout(records: DataFrame, order: list[str], archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """``records`` (with ``length``) with idx, offset and archive, in ascending ``order``, nulls last.

    Only small columns should be passed: every row is shuffled once.
    """
    spark = records.sparkSession
    keys = [F.col(c).asc_nulls_last() for c in order]
    tie = F.col("layout_row")
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ranged = saved(
        saved(records.withColumn("layout_row", F.monotonically_increasing_id()))
        .repartitionByRange(parts, *keys, tie)
        .withColumn("part", F.spark_partition_id())
    )
    totals = ranged.groupBy("part").agg(F.count(F.lit(1)).alias("rows"), F.sum("length").alias("bytes"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    starts = saved(
        totals.select(
            "part",
            F.coalesce(F.sum("rows").over(before), F.lit(0).cast("long")).alias("idx0"),
            F.coalesce(F.sum("bytes").over(before), F.lit(0).cast("long")).alias("offset0"),
        )
    )
    own = Window.partitionBy("part").orderBy(*keys, tie)
    earlier = F.coalesce(F.sum("length").over(own.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long"))
    offset = F.col("offset0") + F.col("bytes_before")
    return saved(
        ranged.withColumn("place", F.row_number().over(own) - 1)
        .withColumn("bytes_before", earlier)
        .join(F.broadcast(starts), "part")  # as many rows as there are shuffle partitions, at most
        .select(
            *(c for c in records.columns),
            (F.col("idx0") + F.col("place")).alias("idx"),
            offset.alias("offset"),
            F.floor(offset / F.lit(archive_bytes)).cast("long").alias("archive"),
        )
    )


def tree(leaves: DataFrame) -> list[DataFrame]:
    """Levels of (node, digest), leaves first, up to one root, from (idx, digest)."""
    levels = [saved(leaves.select(F.col("idx").alias("node"), "digest"))]
    last = levels[0].agg(F.max("node")).first()[0]
    while last:
        child = F.struct("node", F.coalesce("digest", F.lit("")).alias("digest"))
        joined = F.array_join(F.transform(F.array_sort(F.collect_list(child)), lambda c: F.concat(c["node"].cast("string"), F.lit(":"), c["digest"])), ",")
        levels.append(saved(levels[-1].groupBy(F.shiftright("node", FAN_BITS).alias("parent")).agg(joined.alias("text")).select(F.col("parent").alias("node"), F.sha2("text", 256).alias("digest"))))
        last >>= FAN_BITS
    return levels


def mismatches(a: list[DataFrame], b: list[DataFrame]) -> DataFrame:
    """(node, digest_a, digest_b) of the leaves that differ, found from the roots down.

    Replicas of different height differ; the higher tree's upper levels are followed.
    """
    height = max(len(a), len(b))
    under: DataFrame | None = None
    for level in reversed(range(height)):
        sides = []
        for side, name in ((a, "digest_a"), (b, "digest_b")):
            nodes = side[level] if level < len(side) else side[0].limit(0)
            if under is not None:
                nodes = nodes.withColumn("up", F.shiftright("node", FAN_BITS)).join(under, "up", "left_semi").drop("up")
            sides.append(nodes.withColumnRenamed("digest", name))
        differ = saved(sides[0].join(sides[1], "node", "full").filter(~F.col("digest_a").eqNullSafe(F.col("digest_b"))))
        under = differ.select(F.col("node").alias("up"))
    return differ


def audit(leaves: DataFrame) -> DataFrame:
    """The rows of ``leaves`` (idx, digest_a, digest_b, ...) whose replicas differ, found by their trees."""
    trees = [tree(leaves.select("idx", F.col(c).alias("digest"))) for c in ("digest_a", "digest_b")]
    found = mismatches(*trees).select(F.col("node").alias("idx"))
    for levels in trees:
        discard(*levels)
    return leaves.join(found, "idx", "left_semi")


def replicas(pages: DataFrame, damaged: Column) -> DataFrame:
    """(page_id, length, digest_a, digest_b) of the records and of a copy in which ``damaged`` ones
    (a condition on page_id) have the last character of the body replaced."""
    rows = pick(pages, "page_id", "url", "html")
    hurt = damaged & (F.length("html") > 0)
    spoiled = F.when(hurt, F.concat(F.expr("left(html, length(html) - 1)"), F.lit("\u0000"))).otherwise(F.col("html"))
    original = record(F.col("page_id"), F.col("url"), F.col("html"))
    return rows.select(
        "page_id",
        F.octet_length(original).cast("long").alias("length"),
        F.sha2(original, 256).alias("digest_a"),
        F.sha2(record(F.col("page_id"), F.col("url"), spoiled), 256).alias("digest_b"),
    )
