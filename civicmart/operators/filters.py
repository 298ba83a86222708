"""Filters with the null semantics of their origin (SQL three-valued vs. list membership)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions._util import as_col

def exclude_values(df: DataFrame, column: str, values: Sequence, keep_null: bool = True) -> DataFrame:
    """Drop rows whose ``column`` is in ``values``; the same rule for a list of any length.

    With ``keep_null`` (list-membership semantics) a null value is kept; without it the
    SQL ``NOT IN`` rule applies: a null is dropped, and a null in the list drops every row
    (except against an empty list, which drops nothing). Values compare as SQL compares the
    column with a literal of their type; long lists become a hash set in the filter.
    """
    values = list(values)
    if not values:
        return df
    hit = as_col(column).isin(values)
    return df.where(~F.coalesce(hit, F.lit(False)) if keep_null else ~hit)


def any_branch(*branches: Iterable[Column]) -> Column:
    """OR of AND-branches: ``(a1 & a2 ...) | (b1 & b2 ...)``."""
    out = None
    for branch in branches:
        conj = None
        for cond in branch:
            conj = cond if conj is None else conj & cond
        out = conj if out is None else out | conj
    return out


def branch_filter(df: DataFrame, *branches: Iterable[Column]) -> DataFrame:
    """Rows meeting every condition of at least one branch (SQL three-valued logic)."""
    return df.where(any_branch(*branches))


def not_in(column, values: Sequence) -> Column:
    """SQL ``NOT IN`` (null input -> unknown -> row dropped by a filter)."""
    return ~as_col(column).isin(list(values))


def not_like_prefix(column, prefix: str) -> Column:
    """SQL ``NOT LIKE 'prefix%'`` (null -> dropped)."""
    return ~as_col(column).startswith(prefix)
