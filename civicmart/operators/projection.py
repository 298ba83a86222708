"""Projections: field mapping, portal column names."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions._util import quote
from ..functions.text import snake_name


def mapped_columns(df: DataFrame, mapping: Mapping[str, str], strict: bool = True, absent_type: str = "string"):
    """The column list of :func:`map_fields` (to combine with other columns in one select)."""
    have = set(df.columns)
    return [
        F.col(quote(src)).alias(dst) if (src in have or strict) else F.lit(None).cast(absent_type).alias(dst)
        for src, dst in mapping.items()
    ]


def map_fields(df: DataFrame, mapping: Mapping[str, str], strict: bool = True, absent_type: str = "string") -> DataFrame:
    """Select and rename by ``{source_name: output_name}``, in mapping order.

    ``strict=True``: a missing source column is an error (analysis fails on it).
    ``strict=False``: a missing source column becomes a typed null column.
    Source names may hold ``.``, ``#``, ``?``, ``(``: they are always back-quoted.
    """
    return df.select(*mapped_columns(df, mapping, strict, absent_type))


def iso_timestamps(df: DataFrame, columns, fmt: str | None = None) -> DataFrame:
    """Replace each listed column by ``yyyy-MM-ddTHH:mm:ss`` text (parsed first when it is
    text, with ``fmt`` or Spark's default parsing); null stays null. One projection."""
    from ..functions.dates import iso_text, parse_ts

    types = dict(df.dtypes)
    out = {}
    for c in columns:
        src = F.col(quote(c))
        out[c] = iso_text(parse_ts(src, fmt) if types[c] == "string" else src)
    return df.withColumns(out)


def snake_columns(df: DataFrame) -> DataFrame:
    """Lower-case every column name and turn spaces into underscores."""
    return df.toDF(*[snake_name(c) for c in df.columns])
