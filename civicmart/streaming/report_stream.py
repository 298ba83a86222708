"""Incremental loads of landed report files as Structured Streaming jobs.

The scheduled loads (finance report files, active-permit extracts) pick up files that
arrived since the last run. Expressed as a file-source stream with
``trigger(availableNow=True)``: each run processes exactly the new files (tracked in the
stream checkpoint under ``spark.checkpoint.dir``) and stops. Each micro-batch is upserted
with :func:`civicmart.sinks.write_upsert`, which is idempotent, so a batch replayed after a
failure gives the same table (exactly-once results).

The file source tracks file *names*: it fits landing areas where each extract arrives as
a new file. For extracts rewritten under the same name there is :func:`start_reload_stream`, whose
ticks compare the folder's listing with a manifest of what was loaded
(:mod:`civicmart.sources.manifest`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.dates import local_minute_stamp
from ..functions.text import parse_report_name
from ..operators.projection import mapped_columns
from ..plans.active_log import active_permit_snapshot
from ..plans.finance import ReportSpec, derive_report_rows, finance_reload_job
from ..sources.files import CSV_QUOTES
from ..session import ensure_checkpoint_dir
from ..sinks.files import write_upsert


def _checkpoint(spark: SparkSession, name: str, given: str | None) -> str:
    return given or f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/{name}"


def report_file_stream(spark: SparkSession, root: str, spec: ReportSpec, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming rows of ``<root>/<report>/*.csv`` mapped by header name, with year, month,
    department parsed from the file path. The header of the files already present fixes
    the column order (so at least one file must have landed before the first run); a file
    with another header fails the batch instead of mixing fields."""
    folder = f"{root}/{spec.name}"
    header = spark.read.option("header", True).option("pathGlobFilter", "*.csv").csv(folder).schema
    reader = (
        spark.readStream.schema(header)
        .option("header", True)
        .options(**CSV_QUOTES, multiLine=True)
        .option("enforceSchema", False)
        .option("pathGlobFilter", "*.csv")
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.csv(folder)
    name = F.col("_metadata.file_path")
    parsed = parse_report_name(name)
    return raw.select(
        *mapped_columns(raw, spec.mapping, strict=False),
        parsed["year"].alias("year"),
        parsed["month"].alias("month"),
        parsed["department"].alias("department_from_file"),
        name.alias("source_file"),
    )


def start_finance_stream(
    spark: SparkSession,
    root: str,
    spec: ReportSpec,
    target: str,
    checkpoint: str | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Upsert rows of newly landed report files into ``<target>`` (key: row identifier,
    later files win; partitions: year, month)."""
    stream = report_file_stream(spark, root, spec)
    header = spark.read.option("header", True).option("pathGlobFilter", "*.csv").csv(f"{root}/{spec.name}").columns
    absent = [v for k, v in spec.mapping.items() if k not in header]

    def upsert_batch(batch: DataFrame, batch_id: int) -> None:
        rows = derive_report_rows(batch, spec, absent=absent)
        write_upsert(rows, target, keys=["row_identifier"], order_cols=["source_file"], partition_cols=["year", "month"])

    w = stream.writeStream.foreachBatch(upsert_batch).option("checkpointLocation", _checkpoint(spark, f"finance-{spec.name}", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def start_active_log_stream(
    spark: SparkSession,
    extract_dir: str,
    log_path: str,
    checkpoint: str | None = None,
    tz: str = "US/Central",
    available_now: bool = True,
) -> StreamingQuery:
    """Each new active-permit extract file becomes one snapshot row (stamped with the
    file's local modification minute), upserted into the log on ``published_date``."""
    raw = (
        spark.readStream.schema("foldertype string, activepermits bigint")
        .option("header", True)
        .options(**CSV_QUOTES, multiLine=True)
        .option("enforceSchema", False)
        .option("pathGlobFilter", "*.csv")
        .csv(extract_dir)
    )
    stamped = raw.select("*", local_minute_stamp(F.col("_metadata.file_modification_time"), tz).alias("published_date"))

    def upsert_batch(batch: DataFrame, batch_id: int) -> None:
        write_upsert(active_permit_snapshot(batch), log_path, keys=["published_date"])

    w = stamped.writeStream.foreachBatch(upsert_batch).option("checkpointLocation", _checkpoint(spark, "active-log", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def start_reload_stream(spark: SparkSession, root: str, target: str, checkpoint: str | None = None, seconds: int = 60) -> StreamingQuery:
    """Every ``seconds``, load the report files that are new or were rewritten (a clock stream whose
    batches run :func:`civicmart.plans.finance.finance_reload_job`; a batch that fails loads the same
    files again, with the same result)."""
    ticks = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 1).load()

    def reload(batch: DataFrame, batch_id: int) -> None:
        finance_reload_job(spark, root, target)

    w = ticks.writeStream.foreachBatch(reload).option("checkpointLocation", _checkpoint(spark, "finance-reload", checkpoint))
    return w.trigger(processingTime=f"{seconds} seconds").start()
