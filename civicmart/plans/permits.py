"""The five named permit queries, as DataFrame plans over the permit tables.

Inputs use the permit system's column names (case-insensitive in Spark): ``folder``
(folderrsn, foldertype, subcode, statuscode, workcode, priority, indate, issuedate,
foldername, folderyear, foldersequence, customfoldernumber), ``folderprocess``
(folderrsn, processcode, startdate, enddate), ``folderprocessattempt`` (folderrsn,
resultcode, attemptdate), ``validsub`` (subcode, subdesc). Codes are parameters whose
defaults are the permit system's values.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import round_to_day
from ..functions.text import permit_id
from ..operators.filters import any_branch, not_in, not_like_prefix

# Fixed values of the permit system.
SINCE = dt.date(2018, 10, 1)
DS, EX, RW = "DS", "EX", "RW"
ACTIVE_STATUS = (50010,)
DS_EXCLUDED_STATUS = (50005, 50003, 70045)
RW_EX_EXCLUDED_STATUS = (70045, 50003)
EXCLUDED_SUBCODES = (50510, 50505)
LAND_PREFIX = "LA-"
REVIEW_SUBCODE, REVIEW_WORKCODE = 50500, 50590
WEBAPP_PROCESS, EXTENSION_PROCESS, COMMENT_RESULT = 70000, 50680, 61510
EX_PRIORITY = 3

COUNT_COL = "issuedrowpermits"


def _daily_counts(folder: DataFrame, date_col: str, condition) -> DataFrame:
    return (
        folder.where(condition)
        .groupBy(
            F.col("foldertype").alias("foldertype"),
            F.col("subcode").alias("subcode"),
            round_to_day(F.col(date_col)).alias("day"),
        )
        .agg(F.count(F.lit(1)).alias(COUNT_COL))
    )


def applications_condition(
    since: dt.date = SINCE,
    ds_types: Sequence[str] = (DS,),
    other_types: Sequence[str] = (RW, EX),
    ds_excluded_status: Sequence[int] = DS_EXCLUDED_STATUS,
    other_excluded_status: Sequence[int] = RW_EX_EXCLUDED_STATUS,
    excluded_subcodes: Sequence[int] = EXCLUDED_SUBCODES,
):
    """Row filter of :func:`applications_received` (SQL three-valued logic)."""
    d = F.col("indate")
    dated = [d >= F.lit(since), d.isNotNull()]
    return any_branch(
        [F.col("foldertype").isin(list(ds_types)), not_in("statuscode", ds_excluded_status), *dated],
        [
            F.col("foldertype").isin(list(other_types)),
            not_in("statuscode", other_excluded_status),
            not_in("subcode", excluded_subcodes),
            *dated,
        ],
    )


def applications_received(folder: DataFrame, **params) -> DataFrame:
    """Applications per (type, sub-code, day of intake, rounded to the nearest day).

    ``params``: see :func:`applications_condition` (defaults: the permit system's codes).
    """
    return _daily_counts(folder, "indate", applications_condition(**params))


def issued_condition(
    since: dt.date = SINCE,
    any_subcode_types: Sequence[str] = (EX, DS),
    filtered_types: Sequence[str] = (RW,),
    excluded_subcodes: Sequence[int] = EXCLUDED_SUBCODES,
):
    """Row filter of :func:`issued_permits`."""
    d = F.col("issuedate")
    dated = [d >= F.lit(since), d.isNotNull()]
    return any_branch(
        [F.col("foldertype").isin(list(any_subcode_types)), *dated],
        [F.col("foldertype").isin(list(filtered_types)), not_in("subcode", excluded_subcodes), *dated],
    )


def issued_permits(folder: DataFrame, **params) -> DataFrame:
    """Issued permits per (type, sub-code, day of issue, rounded to the nearest day).

    ``params``: see :func:`issued_condition`.
    """
    return _daily_counts(folder, "issuedate", issued_condition(**params))


def active_permits(
    folder: DataFrame,
    active_status: Sequence[int] = ACTIVE_STATUS,
    any_name_types: Sequence[str] = (EX, DS),
    named_types: Sequence[str] = (RW,),
    excluded_prefix: str = LAND_PREFIX,
) -> DataFrame:
    """Active permits per type; for RW, names starting with the land prefix are left out."""
    active = F.col("statuscode").isin(list(active_status))
    cond = any_branch(
        [F.col("foldertype").isin(list(any_name_types)), active],
        [F.col("foldertype").isin(list(named_types)), active, not_like_prefix("foldername", excluded_prefix)],
    )
    return folder.where(cond).groupBy(F.col("foldertype").alias("foldertype")).agg(
        F.count(F.lit(1)).alias("activepermits")
    )


def review_time(
    folder: DataFrame,
    folderprocess: DataFrame,
    folderprocessattempt: DataFrame,
    folder_type: str = RW,
    subcode: int = REVIEW_SUBCODE,
    workcode: int = REVIEW_WORKCODE,
    webapp_process: int = WEBAPP_PROCESS,
    extension_process: int = EXTENSION_PROCESS,
    comment_result: int = COMMENT_RESULT,
) -> DataFrame:
    """Review milestones of RW permits: web-application start/end and extension (left joins),
    department comments (the attempt's result filter makes that join inner; it runs first to cut
    rows early).

    Every join is on ``folderrsn``, so each input is shuffled once and the partitioning is reused;
    where a folder is hot, AQE splits it at the price of one more shuffle (``session.BASE_CONF``).
    Both left joins read one and the same side, the process rows of either code, so the process
    table is scanned and shuffled once and the second join reuses that exchange. For that the
    sides must be the same to the planner: the code looked for stands in the folder row and is
    compared as a range of one (a literal or an equality would be pushed below the exchange or
    become a join key), and the dates are one value (one of two columns would be pruned)."""
    f = folder.where(
        (F.col("foldertype") == folder_type) & (F.col("subcode") == subcode) & (F.col("workcode") == workcode)
    )
    wanted = lambda code: F.when(F.col("foldertype") == folder_type, F.lit(code))
    f = f.select(
        "customfoldernumber", "folderrsn", "indate", "issuedate",
        wanted(webapp_process).alias("webapp_code"), wanted(extension_process).alias("extension_code"),
    )
    fa = folderprocessattempt.where(F.col("resultcode") == comment_result).select(
        "folderrsn", F.col("attemptdate").alias("dept_comments")
    )
    steps = folderprocess.where(F.col("processcode").isin(webapp_process, extension_process)).select(
        F.col("folderrsn").alias("rsn"), F.col("processcode").alias("code"), F.array("startdate", "enddate").alias("dates")
    )
    app, ext = steps.alias("app"), steps.alias("ext")
    out = (
        f.join(fa, "folderrsn", "inner")
        .join(app, (F.col("folderrsn") == F.col("app.rsn")) & F.col("app.code").between(F.col("webapp_code"), F.col("webapp_code")), "left")
        .join(ext, (F.col("folderrsn") == F.col("ext.rsn")) & F.col("ext.code").between(F.col("extension_code"), F.col("extension_code")), "left")
    )
    return out.select(
        "customfoldernumber", "folderrsn", "indate", "issuedate",
        F.col("app.dates")[0].alias("webappstart"), F.col("app.dates")[1].alias("webappend"),
        F.col("ext.dates")[0].alias("extend"), "dept_comments",
    )


def ex_permits_issued(
    folder: DataFrame,
    validsub: DataFrame,
    folder_type: str = EX,
    since: dt.date = SINCE,
    priority: int = EX_PRIORITY,
) -> DataFrame:
    """Issued EX permits with the sub-code description and text dates."""
    d = F.col("issuedate")
    f = folder.where(
        (F.col("foldertype") == folder_type) & (d >= F.lit(since)) & d.isNotNull() & (F.col("priority") == priority)
    )
    joined = f.join(validsub.select("subcode", "subdesc"), "subcode", "left")
    return joined.select(
        permit_id(F.col("folderyear"), F.col("foldersequence")).alias("permit_id"),
        "subcode",
        "subdesc",
        "foldername",
        F.date_format("indate", "MM-dd-yyyy HH:mm:ss").alias("indate_text"),
        F.date_format("issuedate", "MM-dd-yyyy HH:mm:ss").alias("issuedate_text"),
    )


# Registry: query name -> (plan, names of the tables it reads, in argument order).
NAMED_QUERIES: dict[str, tuple[Callable[..., DataFrame], tuple[str, ...]]] = {
    "applications_received": (applications_received, ("folder",)),
    "active_permits": (active_permits, ("folder",)),
    "issued_permits": (issued_permits, ("folder",)),
    "review_time": (review_time, ("folder", "folderprocess", "folderprocessattempt")),
    "ex_permits_issued": (ex_permits_issued, ("folder", "validsub")),
}


def run_named_query(name: str, tables: dict[str, DataFrame], **params) -> DataFrame:
    """Run a registered query by name on ``{table_name: DataFrame}``."""
    if name not in NAMED_QUERIES:
        raise KeyError(f"unknown query {name!r}; choose one of {sorted(NAMED_QUERIES)}")
    fn, needs = NAMED_QUERIES[name]
    return fn(*[tables[t] for t in needs], **params)


def permit_extract_job(tables: dict[str, DataFrame], name: str, out_path: str, one_object: bool = False, **params) -> DataFrame:
    """Run a named query and write it as a CSV extract, sorted by type where it has one. The other
    columns break ties, so the sort's ranges are not limited to the few types. The extract is a
    folder of parts or, with ``one_object``, one file of that name."""
    from ..sinks.files import write_csv, write_csv_object

    df = run_named_query(name, tables, **params)
    order = ["foldertype", *(c for c in df.columns if c != "foldertype")] if "foldertype" in df.columns else None
    (write_csv_object if one_object else write_csv)(df, out_path, order_by=order)
    return df
