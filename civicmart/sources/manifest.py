"""Files that are new or were rewritten since they were last loaded.

A manifest is a small published table of (path, modified, length), a row per loaded file. The listing
of a folder, which Spark makes without opening a file, is anti-joined with it: what is left has a new
name, or an old name with another time or length. The manifest is written after the load it stands
for, so a load that fails is done again; loads are keyed upserts, which give the same table twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage
from ..sinks.published import pointer, publish_upsert, read_published

LISTING = "path string, modified timestamp, length long"


def file_listing(spark: SparkSession, root: str, pattern: str = "*.csv") -> DataFrame:
    """(path, modified, length) of the files under ``root``; none if the folder is absent."""
    try:
        files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(root)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LISTING)
    return files.select("path", F.col("modificationTime").alias("modified"), "length")


def changed_files(listing: DataFrame, manifest: str) -> DataFrame:
    """Rows of ``listing`` that the manifest does not have as they are."""
    spark = listing.sparkSession
    if pointer(spark, manifest) is None:
        return listing
    return listing.join(read_published(spark, manifest), ["path", "modified", "length"], "left_anti")


def load_changed(spark: SparkSession, root: str, manifest: str, load: Callable[[list[str]], None], pattern: str = "*.csv") -> list[str]:
    """Call ``load`` with the new and rewritten files under ``root`` and then note them; returns them.

    The listing is taken once: a file that is rewritten during the load has another time in the next
    listing and is loaded again then.
    """
    changed = cut_lineage(changed_files(file_listing(spark, root, pattern), manifest))
    files = sorted(r["path"] for r in changed.select("path").collect())  # names of the listing, as the driver has them
    if files:
        load(files)
        publish_upsert(changed, manifest, ["path"])
    return files
