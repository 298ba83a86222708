"""Explicit schemas of the sources (no inference pass on large inputs)."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    LongType,
    StringType,
    StructField,
    StructType,
)

KEY_VALUE = ArrayType(StructType([StructField("key", StringType()), StructField("value", StringType())]))

CATALOG_ASSET = StructType(
    [
        StructField(
            "resource",
            StructType(
                [
                    StructField("id", StringType()),
                    StructField("name", StringType()),
                    StructField("description", StringType()),
                    StructField("attribution", StringType()),
                    StructField("type", StringType()),
                    StructField("updatedAt", StringType()),
                    StructField("createdAt", StringType()),
                    StructField("metadata_updated_at", StringType()),
                    StructField("data_updated_at", StringType()),
                    StructField("publication_date", StringType()),
                    StructField("download_count", LongType()),
                    StructField(
                        "page_views",
                        StructType(
                            [
                                StructField("page_views_last_week", LongType()),
                                StructField("page_views_last_month", LongType()),
                                StructField("page_views_total", LongType()),
                            ]
                        ),
                    ),
                ]
            ),
        ),
        StructField(
            "classification",
            StructType(
                [
                    StructField("domain_category", StringType()),
                    StructField("domain_tags", ArrayType(StringType())),
                    StructField("domain_metadata", KEY_VALUE),
                    StructField("domain_private_metadata", KEY_VALUE),
                ]
            ),
        ),
        StructField("owner", StructType([StructField("id", StringType()), StructField("display_name", StringType())])),
    ]
)

CATALOG_DOCUMENT = StructType([StructField("results", ArrayType(CATALOG_ASSET))])
