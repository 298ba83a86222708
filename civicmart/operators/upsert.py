"""Keyed upsert without a table format: a last-wins increment and a null-safe anti join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions._util import quote


def last_wins(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """One row per key: the row with the greatest ``order_cols`` (ties: greatest other values).

    Expressed as ``max(struct(order..., rest...))`` per key, an aggregate with map-side
    combine: a key holding a third of all rows is reduced inside each input partition and
    never gathered into one task (a window with ``row_number`` would sort all of it).
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys and c not in order_cols]
    packed = F.struct(*[F.col(quote(c)).alias(c) for c in [*order_cols, *rest]])
    winner = df.groupBy(*[F.col(quote(k)).alias(k) for k in keys]).agg(F.max(packed).alias("__w"))
    return winner.select(*[F.col(quote(c)) if c in keys else F.col("__w")[c].alias(c) for c in df.columns])


def upsert(
    target: DataFrame,
    increment: DataFrame,
    keys: Sequence[str],
    order_cols: Sequence[str] | None = None,
) -> DataFrame:
    """Rows of ``target`` whose key is not in ``increment``, plus the increment deduplicated
    last-wins by ``order_cols`` (without them, duplicate increment keys keep the row with the
    greatest values, which is deterministic). Keys compare null-safe; ``target`` is keyed (one
    row per key) and its columns define the output.

    The increment is combined by key first; the target is only anti-joined with its keys, so
    it need not move when the planner finds the keys small enough to broadcast.
    """
    keys = list(keys)
    cols = target.columns
    extra = [c for c in order_cols or [] if c not in cols]
    last = last_wins(increment.select(*[F.col(quote(c)) for c in [*cols, *extra]]), keys, list(order_cols or []))
    taken = last.select(*[F.col(quote(k)).alias(f"__k{i}") for i, k in enumerate(keys)])
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & target[quote(k)].eqNullSafe(F.col(f"__k{i}"))
    return target.join(taken, same, "left_anti").unionByName(last.select(*[F.col(quote(c)) for c in cols]))
