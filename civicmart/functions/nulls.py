"""Null handling."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col


def blank_to_null(c, cast: str | None = None) -> Column:
    """Exactly empty text -> null (whitespace is kept); optionally cast, e.g. ``decimal(18,2)``."""
    out = F.nullif(as_col(c), F.lit(""))
    return out.cast(cast) if cast else out


def nan_to_null(c) -> Column:
    """NaN -> null for floating columns (Spark keeps NaN and null apart)."""
    x = as_col(c)
    return F.when(~F.isnan(x), x)


def empty_if_null(c) -> Column:
    """Null -> empty text."""
    return F.coalesce(as_col(c), F.lit(""))
