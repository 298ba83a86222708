"""File sources: CSV (typed or all-string, matched by header name), UTF-16 TSV reports,
catalog JSON documents, report files whose name carries (year, month, department),
and the file's modification time as data."""

from __future__ import annotations

import re

from collections.abc import Mapping, Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegralType, StructField, StructType

from ..functions._util import quote
from ..functions.dates import local_minute_stamp
from ..functions.text import REPORT_NAME_PATTERN, parse_report_name
from ..operators.projection import mapped_columns
from ..storage import Store


#: RFC 4180: a quote inside a field is doubled.
CSV_QUOTES = {"quote": '"', "escape": '"'}


def exact_number(name: str, data_type) -> Column:
    """A count that was read as a decimal (``3.0`` is 3); a fraction fails the read."""
    c = F.col(quote(name))
    bad = F.raise_error(F.concat(F.lit(f"not a whole number in {name}: "), c.cast("string")))
    return F.when(c == F.floor(c), c.cast(data_type)).when(c.isNotNull(), bad.cast(data_type)).alias(name)


def read_csv_table(
    spark: SparkSession, path, schema: StructType | str | None = None, infer: bool = False, **options
) -> DataFrame:
    """CSV with a header row. An explicit schema avoids a second (inference) pass; without
    one, columns are strings unless ``infer`` is set. With a schema, every file's header is
    checked against the schema's names (``enforceSchema=false``), so a file with its columns
    in another order fails instead of being read by position; a value that does not parse
    fails the read as well, and whole numbers may be written with a zero fraction (``3.0``)."""
    reader = spark.read.option("header", True).options(**CSV_QUOTES)
    for k, v in options.items():
        reader = reader.option(k, v)
    if schema is not None:
        wanted = StructType.fromDDL(schema) if isinstance(schema, str) else schema
        whole = [isinstance(f.dataType, IntegralType) for f in wanted]
        loose = StructType([StructField(f.name, DecimalType(38, 6) if w else f.dataType) for f, w in zip(wanted, whole)])
        df = reader.schema(loose).option("enforceSchema", False).option("mode", "FAILFAST").csv(path)
        # the columns stay those of the file scan, so its _metadata stays readable
        return df.withColumns({f.name: exact_number(f.name, f.dataType) for f, w in zip(wanted, whole) if w})
    elif infer:
        reader = reader.option("inferSchema", True)
    return reader.csv(path)


def read_csv_strings(
    spark: SparkSession,
    path,
    mapping: Mapping[str, str] | None = None,
    strict: bool = False,
    with_file: str | None = "source_file",
) -> DataFrame:
    """All-string CSV rows matched by header name; an absent mapped column is null.

    Spark maps the columns of a multi-file read by position using one header, so every
    file's header is checked against it (``enforceSchema=false``): files whose columns
    come in another order make the read fail instead of silently mixing fields. Use
    :func:`read_csv_files_by_name` for such inputs.
    """
    df = (
        spark.read.option("header", True)
        .options(**CSV_QUOTES)
        .option("enforceSchema", False)
        .option("inferSchema", False)
        .csv(path)
    )
    return _map_with_file(df, mapping, strict, with_file)


def read_csv_files_by_name(
    spark: SparkSession,
    files: Sequence[str],
    mapping: Mapping[str, str],
    strict: bool = False,
    with_file: str | None = "source_file",
) -> DataFrame:
    """Files with differing header orders: one read for each distinct header, mapped by name, and
    the results are unioned by name into one plan."""
    frames = [
        _map_with_file(spark.read.option("header", True).options(**CSV_QUOTES, multiLine=True).option("inferSchema", False).csv(group), mapping, strict, with_file)
        for group in _by_header(spark, files).values()
    ]
    return reduce(lambda a, b: a.unionByName(b), frames)


def _map_with_file(df: DataFrame, mapping, strict: bool, with_file: str | None) -> DataFrame:
    src = [F.col("_metadata.file_path").alias(with_file)] if with_file else []
    if mapping is None:
        return df.select("*", *src)
    return df.select(*mapped_columns(df, mapping, strict), *src)


def read_utf16_tsv(spark: SparkSession, path, schema: StructType | str | None = None) -> DataFrame:
    """Tab-separated UTF-16 report with a header row; a malformed row fails the read.

    ``multiLine`` is required for UTF-16 (line splitting is byte based otherwise), so each
    file is one task: persist the result as Parquet before heavy work on large files.
    """
    reader = (
        spark.read.option("header", True)
        .option("sep", "\t")
        .option("encoding", "UTF-16")
        .options(**CSV_QUOTES)
        .option("multiLine", True)
        .option("mode", "FAILFAST")
    )
    if schema is not None:
        reader = reader.schema(schema).option("enforceSchema", False)
    return reader.csv(path)


def read_report_files(
    spark: SparkSession,
    root: str,
    mapping: Mapping[str, str],
    years_months: Sequence[tuple[int, int]] | None = None,
    files: Sequence[str] | None = None,
) -> DataFrame:
    """Report CSVs under ``root`` named ``<yyyy>-<mm>-<dd>_<dept>.csv`` (or in the
    ``month_end=/department=`` folders written by the extract), as all-string rows mapped by
    header name, plus ``year``, ``month``, ``department_from_file`` parsed from the path and
    ``source_file``.

    ``years_months`` keeps only files of those months; the others are pruned from the listing
    and never opened. A name that does not parse fails the load. Files are grouped by their
    header line: one read for each distinct header, joined by column name, so files may order
    their columns differently; ``absent_columns`` (array) names the mapped columns that a
    file's header lacks. ``files`` names the files instead of a listing of ``root``. Line breaks inside quotes are part of a field.
    """
    name = F.col("_metadata.file_path")
    if files is None:
        listing = spark.read.option("pathGlobFilter", "*.csv").option("recursiveFileLookup", True).text(root)
        files = [unquote(f) for f in listing.inputFiles()]  # listed as URIs, read as paths
    odd = [f for f in files if not re.search(REPORT_NAME_PATTERN, f)]
    if odd:
        raise ValueError(f"report names that do not parse: {', '.join(sorted(odd)[:5])}")
    if years_months is not None:
        months = {f"{y:04d}-{m:02d}" for y, m in years_months}
        files = [f for f in files if "-".join(re.search(REPORT_NAME_PATTERN, f).groups()[:2]) in months]
    parsed = parse_report_name(name)
    frames = []
    for header, group in _by_header(spark, files).items():
        df = (
            spark.read.option("header", True).options(**CSV_QUOTES, multiLine=True).option("enforceSchema", False).csv(group)
        )
        absent = [v for k, v in mapping.items() if k not in df.columns]
        frames.append(
            df.select(
                *mapped_columns(df, mapping, strict=False),
                parsed["year"].alias("year"),
                parsed["month"].alias("month"),
                parsed["department"].alias("department_from_file"),
                name.alias("source_file"),
                F.array(*[F.lit(a) for a in absent]).cast("array<string>").alias("absent_columns"),
            )
        )
    if frames:
        return reduce(lambda a, b: a.unionByName(b), frames)
    fields = ", ".join(f"`{v}` string" for v in mapping.values())
    return spark.createDataFrame([], f"{fields}, year int, month int, department_from_file int, source_file string, absent_columns array<string>")


def _by_header(spark: SparkSession, files: Sequence[str]) -> dict[str, list[str]]:
    """Files by their first line; empty files have none. Of each file only a reader's first buffer
    is read, through the file system; its name, which the driver has anyway, and that line are all
    that comes to the driver."""
    found: dict[str, list[str]] = {}
    for file, header in zip(files, Store(spark).first_lines(files)):
        if header is not None:
            found.setdefault(header.removeprefix("\ufeff"), []).append(file)
    return found


def with_file_stamp(df: DataFrame, out: str = "published_date", tz: str = "US/Central") -> DataFrame:
    """Add the source file's modification time as local text ``yyyy-MM-ddTHH:mm:00.000``."""
    return df.select("*", local_minute_stamp(F.col("_metadata.file_modification_time"), tz).alias(out))


file_snapshot_stamp = with_file_stamp


def read_catalog_json(spark: SparkSession, path, schema: StructType | str | None = None) -> DataFrame:
    """A catalog document (one JSON object with a ``results`` array) -> one row per asset.
    A document that does not parse, or has no ``results``, fails the read."""
    from .schemas import CATALOG_DOCUMENT

    doc = spark.read.option("multiLine", True).option("mode", "FAILFAST").schema(schema or CATALOG_DOCUMENT).json(path)
    missing = F.raise_error(F.lit("catalog document without results"))
    results = F.when(F.col("results").isNotNull(), F.col("results")).otherwise(missing)
    return doc.select(F.explode_outer(results).alias("r")).where("r IS NOT NULL").select("r.*")
