"""Lookups, existence flags and per-key counts as joins.

No join here carries a ``broadcast()`` hint on data whose size grows: the planner's size
check (``spark.sql.autoBroadcastJoinThreshold`` on plan statistics, and AQE on the actual
shuffle sizes) decides. Aggregated sides are reduced map-side before they shuffle, so a
key holding a third of all rows costs one partial row per input partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions._util import as_col, quote


def left_lookup(df: DataFrame, lookup: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Left outer equi-join adding ``columns`` of ``lookup`` (1:n fan-out kept, like SQL)."""
    return df.join(lookup.select(*keys, *columns), list(keys), "left")


def membership_flag(
    df: DataFrame, key: str, members: DataFrame, member_key: str, flag: str = "is_member"
) -> DataFrame:
    """Add a boolean: is ``df[key]`` among ``members[member_key]``.

    The member ids are de-duplicated first (partial aggregate, so repeated ids collapse
    before the shuffle) and then left-joined; every row of ``df`` is kept exactly once.
    """
    ids = members.select(as_col(member_key).alias("__id")).where(F.col("__id").isNotNull()).distinct()
    ids = ids.withColumn("__hit", F.lit(True))
    out = df.join(ids, as_col(key) == F.col("__id"), "left")
    return out.select(*[F.col(quote(c)) for c in df.columns], F.coalesce(F.col("__hit"), F.lit(False)).alias(flag))


def attach_row_counts(
    assets: DataFrame,
    id_col: str,
    type_col: str,
    rows: DataFrame,
    rows_key: str,
    counted_type: str = "dataset",
    out: str = "row_count",
) -> DataFrame:
    """Row count per asset from the asset's rows, only for ``type == counted_type`` (0 when
    it has none); other types get null. One grouped count replaces one request per asset."""
    counts = rows.groupBy(as_col(rows_key).alias("__k")).agg(F.count(F.lit(1)).alias("__n"))
    joined = assets.join(counts, as_col(id_col) == F.col("__k"), "left")
    n = F.when(as_col(type_col) == F.lit(counted_type), F.coalesce(F.col("__n"), F.lit(0)).cast("bigint"))
    return joined.select(*[F.col(quote(c)) for c in assets.columns], n.alias(out))
