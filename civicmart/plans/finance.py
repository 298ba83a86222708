"""Finance reports: extract slices per (report, period end, department) and load the
report files into keyed tables with derived calendar fields."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import fiscal_month, fiscal_year_of, month_name, previous_month, resolve_year_month
from ..functions.nulls import blank_to_null
from ..functions.text import row_identifier
from ..operators.reports import report_grid, slice_reports
from ..sinks.files import write_report_partitions, write_upsert
from ..sources.files import read_report_files
from ..sources.manifest import load_changed

# Report columns -> published names, numeric columns and key columns.
EXPENSES_FIELD_MAPPING = {
    "Fund@Code": "fund",
    "Fund@Long Name": "fund_name",
    "Department@Dept": "department",
    "Department@Long Name": "department_name",
    "Unit@Unit Code": "unit",
    "Unit@Long Name": "unit_name",
    "Object Code Category@Code": "object_category_code",
    "Object Code Category@Long Name": "object_category_name",
    "Object Code@Code": "object_code",
    "Object Code@Long Name": "object_name",
    "Object Code - Spending Plan@Code": "object_spend_plan_code",
    "Object Code - Spending Plan@Long Name": "object_spend_plan_name",
    "Budget YTD with Period Cutoff": "budget_ytd_with_period_cutoff",
    "Proposed Budget CYE Amount FY & BFY Prompted (Phase 6)": "proposed_budget_cye_amount",
    "Expenses MTD with Period Cutoff": "expenses_mtd",
    "Expenses YTD with Period Cutoff": "expenses_ytd",
    "Encumbrance YTD with Period Cutoff": "encumbrance_ytd",
    "Unobligated": "unobligated",
    "% Obligated": "percent_obligated",
}
REVENUE_FIELD_MAPPING = {
    "Fund@Code": "fund",
    "Fund@Long Name": "fund_name",
    "Department@Dept": "department",
    "Department@Long Name": "department_name",
    "Unit@Unit Code": "unit",
    "Unit@Long Name": "unit_name",
    "Revenue Source Category@Code": "revenue_source_category_code",
    "Revenue Source Category@Long Name": "revenue_source_category_name",
    "Revenue Source@Code": "revenue_source_code",
    "Revenue Source@Long Name": "revenue_source_name",
    "Revenue Budget YTD with Period Cutoff": "revenue_budget_ytd",
    "Proposed Revenue Amount CYE Prompted FY & BFY (Phase 6)": "revenue_cye",
    "Revenue MTD with Period Cutoff": "revenue_mtd",
    "Revenue YTD with Period Cutoff": "revenue_ytd",
    "Revenue ITD with Period Cutoff": "revenue_itd",
    "Unrecognized Amount": "unrecognized_amount",
    "% Unrecognized": "percent_unrecognized",
}
EXPENSES_NUMERIC_COLS = [
    "budget_ytd_with_period_cutoff",
    "proposed_budget_cye_amount",
    "expenses_mtd",
    "expenses_ytd",
    "encumbrance_ytd",
    "unobligated",
    "percent_obligated",
]
REVENUE_NUMERIC_COLS = [
    "revenue_ytd",
    "revenue_budget_ytd",
    "revenue_cye",
    "revenue_mtd",
    "revenue_itd",
    "unrecognized_amount",
    "percent_unrecognized",
]
REVENUE_ID_COLUMN = [
    "fiscal_year",
    "fiscal_month",
    "fund",
    "department",
    "unit",
    "revenue_source_category_code",
    "revenue_source_code",
]
EXPENSES_ID_COLUMN = ["fiscal_year", "fiscal_month", "fund", "department", "unit", "object_code"]
# Departments the extract runs for.
DEPARTMENTS = ["2400", "6200"]


@dataclass(frozen=True)
class ReportSpec:
    """One report: folder name, header -> published field mapping, numeric and key columns."""

    name: str
    mapping: Mapping[str, str]
    numeric_cols: Sequence[str]
    id_cols: Sequence[str]


EXPENSES = ReportSpec("expenses", EXPENSES_FIELD_MAPPING, EXPENSES_NUMERIC_COLS, EXPENSES_ID_COLUMN)
REVENUE = ReportSpec("revenue", REVENUE_FIELD_MAPPING, REVENUE_NUMERIC_COLS, REVENUE_ID_COLUMN)

DERIVED = ["year", "month", "month_name", "fiscal_year", "fiscal_month", "row_identifier"]


def derive_report_rows(rows: DataFrame, spec: ReportSpec, absent: Sequence[str] = (), typed: bool = False) -> DataFrame:
    """Mapped report rows + ``year``, ``month``, ``department_from_file`` -> published rows.

    The department parsed from the file name replaces the mapped one before the row
    identifier is built; the identifier glues the key columns' text without separator
    (absent columns, named by ``absent`` or by each row's ``absent_columns``, print ``None``,
    blank ones nothing). Blank numeric text becomes null;
    ``typed`` casts amounts to ``decimal(18,2)`` and the ``percent_*`` columns to double.
    """
    mapped = list(spec.mapping.values())
    staged = rows.withColumns(
        {
            "department": F.col("department_from_file"),
            "month_name": month_name(F.col("month")),
            "fiscal_year": fiscal_year_of(F.col("year"), F.col("month")),
            "fiscal_month": fiscal_month(F.col("month")),
        }
    )
    derived = {"department", "year", "month", "fiscal_year", "fiscal_month"}
    absent_keys = [c for c in spec.id_cols if c in absent and c not in derived]
    parts = list(spec.id_cols)
    if "absent_columns" in rows.columns:  # per file: what its own header lacks
        lacks = lambda c: F.array_contains("absent_columns", F.lit(c))
        parts = [c if c in derived else F.when(lacks(c), F.lit("None")).otherwise(F.col(c)) for c in parts]
    rid = row_identifier(parts, absent=absent_keys, null_text="")
    numeric = {}
    for c in spec.numeric_cols:
        kind = ("double" if c.startswith("percent_") else "decimal(18,2)") if typed else None
        numeric[c] = blank_to_null(F.col(c), kind)
    staged = staged.withColumns({"row_identifier": rid, **numeric})
    return staged.select(*mapped, *DERIVED, "source_file")


def finance_load(
    spark: SparkSession,
    root: str,
    spec: ReportSpec,
    year: int,
    month: int,
    full_refresh: bool = False,
    typed: bool = False,
) -> DataFrame:
    """Rows of ``<root>/<report>/`` files of the selected and previous month (all files on a
    full refresh), with derived fields. File selection prunes on the file name."""
    months = None if full_refresh else [(year, month), previous_month(year, month)]
    rows = read_report_files(spark, f"{root}/{spec.name}", spec.mapping, months)
    return derive_report_rows(rows, spec, typed=typed)


def finance_load_job(
    spark: SparkSession,
    root: str,
    target: str,
    year: int | None = None,
    month: int | None = None,
    full_refresh: bool = False,
    versioned: bool = False,
) -> dict[str, DataFrame]:
    """Both reports; each upserted on ``row_identifier``, later files winning. Year and
    month default to the current ones."""
    year, month = resolve_year_month(year, month)
    out = {}
    for spec in (EXPENSES, REVENUE):
        rows = finance_load(spark, root, spec, year, month, full_refresh)
        out[spec.name] = write_upsert(
            rows, f"{target}/{spec.name}", keys=["row_identifier"], order_cols=["source_file"], partition_cols=["year", "month"], versioned=versioned
        )
    return out


def finance_reload_job(spark: SparkSession, root: str, target: str, versioned: bool = True) -> dict[str, list[str]]:
    """Both reports, from the files that are new or were rewritten since the last run, whatever their
    month; returns the files loaded. What was loaded is noted in ``<target>/manifests/<report>``.

    Like :func:`finance_load_job`, but an extract rewritten under its old name is loaded once and an
    untouched one not at all.
    """
    done = {}
    for spec in (EXPENSES, REVENUE):

        def load(files: list[str]) -> None:
            rows = derive_report_rows(read_report_files(spark, f"{root}/{spec.name}", spec.mapping, files=files), spec)
            write_upsert(rows, f"{target}/{spec.name}", ["row_identifier"], ["source_file"], ["year", "month"], versioned=versioned)

        done[spec.name] = load_changed(spark, f"{root}/{spec.name}", f"{target}/manifests/{spec.name}", load)
    return done


def finance_extract(
    facts: DataFrame,
    year: int,
    month: int,
    departments: Sequence[str] = DEPARTMENTS,
    department_col: str = "department",
    fiscal_year_col: str = "fiscal_year",
    month_end_col: str = "month_end",
) -> DataFrame:
    """Report rows of each department for the selected and the previous month."""
    grid = report_grid(facts.sparkSession, departments, year, month)
    return slice_reports(facts, grid, department_col, fiscal_year_col, month_end_col)


def finance_extract_job(
    reports: Mapping[str, DataFrame],
    out_root: str,
    year: int | None = None,
    month: int | None = None,
    departments: Sequence[str] = DEPARTMENTS,
) -> None:
    """Write each report's slices under ``<out_root>/<report>/month_end=/department=/``,
    the layout :func:`finance_load` reads (fiscal year is implied by the month end). Year
    and month default to the current ones."""
    year, month = resolve_year_month(year, month)
    for name, facts in reports.items():
        sliced = finance_extract(facts, year, month, departments).drop("fiscal_year")
        write_report_partitions(sliced, f"{out_root}/{name}", partition_cols=("month_end", "department"))
