"""Nested catalog records: explode, scope filter, flatten."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions._util import quote
from ..functions.arrays import join_tags, merged_pairs, pick_metadata
from ..functions.dates import utc_to_local
from ..functions.text import dataset_url
from .joins import membership_flag

# The resource fields published, in output order (three of them are lifted
# from resource.page_views).
RESOURCE_FIELDS = [
    "id",
    "name",
    "description",
    "attribution",
    "type",
    "updatedAt",
    "createdAt",
    "metadata_updated_at",
    "data_updated_at",
    "download_count",
    "publication_date",
    "page_views_last_week",
    "page_views_last_month",
    "page_views_total",
]
# Fields lifted from resource.page_views, and UTC text fields shown in local time.
PAGE_VIEW_FIELDS = ("page_views_last_week", "page_views_last_month", "page_views_total")
UTC_TEXT_FIELDS = ("updatedAt", "createdAt", "metadata_updated_at", "data_updated_at", "publication_date")

# Catalog metadata keys and the output column each one fills.
METADATA_FIELDS = {
    "Publishing-Information_Automation-Method": "automation_method",
    "Publishing-Information_Automation-Method-(if-Other)": "automation_method_other",
    "Publishing-Information_Update-Frequency": "update_frequency",
    "Publishing-Information_Spatial-Information": "spatial_information",
    "Ownership_Department-name": "department_name",
    "Ownership_Program-Name": "program_name",
    "Strategic-Area_Strategic-Direction-Outcome": "strategic_area",
}


def explode_results(doc: DataFrame, array_col: str = "results") -> DataFrame:
    """One row per element of the document's result array (struct fields as columns)."""
    return doc.select(F.explode(F.col(array_col)).alias("__r")).select("__r.*")


def parse_json(df: DataFrame, column: str, schema: str) -> DataFrame:
    """The fields of a JSON text column, by an explicit schema, in place of the column.

    The text is parsed once for all fields; text that does not parse fails the query, a null
    text gives null fields.
    """
    rest = [F.col(quote(c)) for c in df.columns if c != column]
    return df.select(*rest, F.from_json(F.col(quote(column)), schema, {"mode": "FAILFAST"}).alias("__j")).select(
        *rest, "__j.*"
    )


def catalog_scope(assets: DataFrame, owner_id: str, category: str) -> DataFrame:
    """Assets owned by ``owner_id`` or in ``category`` (absent category = ``""``), drafts
    (id holding ``:``) dropped."""
    owner = F.coalesce(F.col("owner.id"), F.lit(""))
    cat = F.coalesce(F.col("classification.domain_category"), F.lit(""))
    keep = ((owner == F.lit(owner_id)) | (cat == F.lit(category))) & ~F.col("resource.id").contains(":")
    return assets.where(keep)


def flatten_resource(assets: DataFrame, fields: Sequence[str] = RESOURCE_FIELDS) -> list[Column]:
    """Columns for the published resource fields (page views lifted from the nested struct)."""
    cols = []
    for f in fields:
        src = F.col(f"resource.page_views.{f}") if f in PAGE_VIEW_FIELDS else F.col(f"resource.{f}")
        cols.append(src.alias(f))
    return cols


def catalog_table(
    assets: DataFrame,
    public_ids: DataFrame,
    public_base: str,
    internal_base: str,
    metadata_fields: Mapping[str, str] = METADATA_FIELDS,
    tz: str = "US/Central",
) -> DataFrame:
    """Flat table of catalog assets: public flag (by id membership), resource fields with
    local times, URL by visibility, owner name, tags text and seven metadata values
    (private pairs first, public pairs win). Scope filtering is :func:`catalog_scope`."""
    keyed = assets.withColumn("__rid", F.col("resource.id"))
    flagged = membership_flag(keyed, "__rid", public_ids, "id", flag="__pub")
    is_public = F.col("__pub")
    out_cols = []
    for f, c in zip(RESOURCE_FIELDS, flatten_resource(flagged)):
        out_cols.append(utc_to_local(F.col(f"resource.{f}"), tz).alias(f) if f in UTC_TEXT_FIELDS else c)
    pairs = merged_pairs(F.col("classification.domain_private_metadata"), F.col("classification.domain_metadata"))
    return flagged.select(
        *out_cols,
        dataset_url(is_public, F.col("resource.id"), public_base, internal_base).alias("dataset_url"),
        is_public.alias("is_public"),
        F.col("owner.display_name").alias("owner_display_name"),
        join_tags(F.col("classification.domain_tags")).alias("tags"),
        *pick_metadata(pairs, metadata_fields),
    )
