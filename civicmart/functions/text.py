"""String-building column functions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col

# Fixed value: report files are named ``<yyyy>-<mm>-<dd>_<dept4>.csv``; the partitioned
# layout written by Spark holds the same fields as ``month_end=<yyyy-mm-dd>/department=<dept4>/``.
REPORT_NAME_PATTERN = r"(\d{4})-(\d{2})-(\d{2})(?:_(\d{4})\.csv$|/department=(\d{4})/)"


def oracle_concat(*parts) -> Column:
    """String concatenation where a null operand counts as empty text (Oracle ``CONCAT``)."""
    return F.concat(*[F.coalesce(as_col(p).cast("string"), F.lit("")) for p in parts])


def permit_id(year, sequence) -> Column:
    """``<year>-<sequence>``; a missing part is left empty (``2022-`` when the sequence is null)."""
    return oracle_concat(year, F.lit("-"), sequence)


def row_identifier(cols: Sequence, absent: Sequence[str] = (), sep: str = "", null_text: str = "None") -> Column:
    """Key columns printed and glued (no separator by default); a null part prints
    ``null_text`` (``None``). ``absent`` names key columns missing from the input: they
    always print ``None`` (use ``null_text=""`` when a null stands for a blank field)."""
    parts = []
    for c in cols:
        if isinstance(c, str) and c in absent:
            parts.append(F.lit("None"))
        else:
            parts.append(F.coalesce(as_col(c).cast("string"), F.lit(null_text)))
    return F.concat_ws(sep, *parts) if sep else F.concat(*parts)


def parse_report_name(path) -> Column:
    """``struct(year int, month int, department int)`` parsed from a report file name or a
    partitioned report path; null fields when the path matches neither form."""
    p = as_col(path)

    def group(i):
        return F.nullif(F.regexp_extract(p, REPORT_NAME_PATTERN, i), F.lit(""))

    return F.struct(
        group(1).cast("int").alias("year"),
        group(2).cast("int").alias("month"),
        F.coalesce(group(4), group(5)).cast("int").alias("department"),
    )


def dataset_url(is_public, asset_id, public_base: str, internal_base: str) -> Column:
    """Public assets link to the public portal, the others to the internal one."""
    base = F.when(as_col(is_public), F.lit(public_base)).otherwise(F.lit(internal_base))
    return F.concat(base, as_col(asset_id))


def point_wkt(lon, lat) -> Column:
    """``POINT (<lon> <lat>)``; null when either coordinate is null (or NaN)."""
    x, y = as_col(lon), as_col(lat)
    ok = x.isNotNull() & y.isNotNull() & ~F.isnan(x) & ~F.isnan(y)
    return F.when(ok, F.concat(F.lit("POINT ("), x.cast("string"), F.lit(" "), y.cast("string"), F.lit(")")))


def snake_name(name: str) -> str:
    """Portal column name: lower case, spaces to underscores."""
    return name.lower().replace(" ", "_")
