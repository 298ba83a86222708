"""Dataset catalog: nested asset records -> one flat published table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import attach_row_counts
from ..operators.nested import catalog_scope, catalog_table
from ..sinks.files import write_replace
from ..sources.files import read_catalog_json


def build_catalog(
    assets: DataFrame,
    public_ids: DataFrame,
    dataset_rows: DataFrame,
    owner_id: str,
    category: str,
    public_base: str,
    internal_base: str,
    rows_key: str = "dataset_id",
) -> DataFrame:
    """Scope (owner or category, no drafts) -> flatten -> row counts of datasets."""
    scoped = catalog_scope(assets, owner_id, category)
    flat = catalog_table(scoped, public_ids, public_base, internal_base)
    return attach_row_counts(flat, "id", "type", dataset_rows, rows_key)


def catalog_job(
    spark: SparkSession,
    assets_json: str,
    public_json: str,
    dataset_rows: DataFrame,
    out_path: str,
    owner_id: str,
    category: str,
    public_base: str,
    internal_base: str,
    versioned: bool = False,
) -> DataFrame:
    """Read the catalog and public-id documents, build the flat table, replace the published one
    (``versioned``: see ``write_replace``)."""
    assets = read_catalog_json(spark, assets_json)
    public_ids = read_catalog_json(spark, public_json).select(F.col("resource.id").alias("id"))
    table = build_catalog(assets, public_ids, dataset_rows, owner_id, category, public_base, internal_base)
    write_replace(table, out_path, versioned=versioned)
    return table
