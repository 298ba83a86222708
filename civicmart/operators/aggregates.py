"""Counting, pivoting and the calendar-week resample with zero fill."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions._util import as_col
from ..functions.dates import week_ending_saturday
from ..functions.text import snake_name

WEEK = "week"


def union_measures(*frames: DataFrame) -> DataFrame:
    """Outer union by column name (missing columns null, duplicates kept)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def count_by_date(df: DataFrame, date_col: str, out_date: str = "date", out_count: str = "count_permits") -> DataFrame:
    """Rows per calendar date; rows with a null date are dropped."""
    d = F.to_date(as_col(date_col))
    return df.where(d.isNotNull()).groupBy(d.alias(out_date)).agg(F.count(F.lit(1)).alias(out_count))


def pivot_sum(df: DataFrame, index: str, pivot_col: str, values: Sequence[str], value_col: str) -> DataFrame:
    """``index x category`` table of sums; the category list is given (no extra distinct job).

    Written as conditional sums so the plan is one hash aggregate with map-side combine.
    """
    aggs = [F.sum(F.when(as_col(pivot_col) == F.lit(v), as_col(value_col))).alias(v) for v in values]
    return df.groupBy(as_col(index).alias(index)).agg(*aggs)


def rotate_categories(
    df: DataFrame, category_col: str, value_col: str, categories: Sequence[str], lower: bool = True
) -> DataFrame:
    """Turn ``(category, n)`` rows into one row with one column per category holding the
    mean of ``n`` (a double). Categories are given, so no discovery job runs."""
    aggs = [
        F.avg(F.when(as_col(category_col) == F.lit(c), as_col(value_col).cast("double"))).alias(
            snake_name(c) if lower else c
        )
        for c in categories
    ]
    return df.agg(*aggs)


def _gap_weeks(week: Column, next_week: Column) -> Column:
    """This week followed by the empty weeks up to (not including) the next present week."""
    last = F.coalesce(F.date_sub(next_week, 7), week)
    return F.sequence(week, last, F.expr("INTERVAL 7 DAYS"))


def weekly_resample(
    df: DataFrame,
    date_col: str,
    value_cols: Sequence[str],
    by: Sequence[str] = (),
    week_col: str = WEEK,
) -> DataFrame:
    """Sum per calendar week (Sunday..Saturday, labelled by the Saturday) per ``by`` group.

    Weeks without rows inside a group's own first..last week appear with 0; no week outside
    that span appears. Plan: one partial+final aggregate by (group, week); then, per group
    ordered by week, each present week emits itself and the empty weeks up to the next
    present week (``lead`` + ``sequence``). One pass over the input, no join; the window
    sorts the aggregated weeks of a group, at most one row per calendar week, so a group
    holding a third of all rows costs calendar weeks, not rows.
    """
    d = F.to_date(as_col(date_col))
    wk = week_ending_saturday(d)
    keys = [as_col(b).alias(b) for b in by]
    weekly = (
        df.where(d.isNotNull())
        .groupBy(*keys, wk.alias(week_col))
        .agg(*[F.sum(as_col(c)).alias(c) for c in value_cols])
    )
    w = Window.partitionBy(*by).orderBy(week_col) if by else Window.orderBy(week_col)
    spread = weekly.select(*by, *value_cols, week_col, F.lead(week_col).over(w).alias("__next")).select(
        *by, *value_cols, F.posexplode(_gap_weeks(F.col(week_col), F.col("__next"))).alias("__pos", week_col)
    )
    return spread.select(
        *by,
        week_col,
        *[F.when(F.col("__pos") == 0, F.coalesce(F.col(c), F.lit(0))).otherwise(F.lit(0)).alias(c) for c in value_cols],
    )


def weekly_measure_matrix(
    long_df: DataFrame,
    cells: Sequence[tuple[str, str, str]],
    measure_col: str = "measure",
    series_col: str = "series",
    date_col: str = "day",
    value_col: str = "n",
    week_col: str = WEEK,
) -> DataFrame:
    """One row per week, one column per (measure, series) cell.

    ``long_df`` holds daily values ``(measure, series, day, n)`` of several measures;
    ``cells`` lists ``(measure, series, output_name)``. Each measure is resampled to weeks
    over its own first..last week (weeks inside with no value give 0); the output has the
    union of those weeks; a cell outside its measure's span is 0 as well.

    Plan: an aggregate to (week, measure, series) (map-side combine, one sum per row);
    conditional sums of those few rows into one row per calendar week; then one window
    over the week rows (ordered; per-measure span bounds and the next present week) that
    emits the empty weeks lying inside some measure's span. One pass over the input, no
    join. The window holds one row per calendar week, a size bounded by the date range,
    not by the data.
    """
    measures = sorted({cell[0] for cell in cells})
    d = F.to_date(as_col(date_col))
    # per-row work is one sum; the pivot into cells runs on (week, measure, series) rows
    cube = (
        long_df.where(d.isNotNull() & as_col(measure_col).isin([mm for mm, _, _ in cells]))
        .groupBy(week_ending_saturday(d).alias(week_col), as_col(measure_col).alias("__m"), as_col(series_col).alias("__s"))
        .agg(F.sum(as_col(value_col)).alias("__v"))
    )
    m, s, v = F.col("__m"), F.col("__s"), F.col("__v")
    aggs = [F.sum(F.when((m == F.lit(mm)) & (s == F.lit(ss)), v)).alias(out) for mm, ss, out in cells]
    present = [F.max(F.when(m == F.lit(mm), F.lit(True))).alias(f"__has{i}") for i, mm in enumerate(measures)]
    weekly = cube.groupBy(week_col).agg(*aggs, *present)
    whole = Window.orderBy(week_col).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ordered = Window.orderBy(week_col)
    spans = []
    for i in range(len(measures)):
        w = F.when(F.col(f"__has{i}"), F.col(week_col))
        spans.append(F.struct(F.min(w).over(whole).alias("lo"), F.max(w).over(whole).alias("hi")))
    outs = [out for _, _, out in cells]
    spread = weekly.select(
        *outs, week_col, F.array(*spans).alias("__spans"), F.lead(week_col).over(ordered).alias("__next")
    ).select(*outs, "__spans", F.posexplode(_gap_weeks(F.col(week_col), F.col("__next"))).alias("__pos", week_col))
    in_span = F.exists("__spans", lambda sp: (sp["lo"] <= F.col(week_col)) & (F.col(week_col) <= sp["hi"]))
    kept = spread.where((F.col("__pos") == 0) | in_span)
    return kept.select(
        week_col,
        *[
            F.when(F.col("__pos") == 0, F.coalesce(F.col(o).cast("double"), F.lit(0.0))).otherwise(F.lit(0.0)).alias(o)
            for o in outs
        ],
    )


def observe_count(df: DataFrame, name: str):
    """Attach a row counter that the action running ``df`` fills in (no extra job).

    Returns ``(observed_df, observation)``; read ``observation.get["rows"]`` afterwards.
    """
    from pyspark.sql import Observation

    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def pick_last_values(
    df: DataFrame,
    group_keys: Sequence[str],
    key_col: str,
    value_col: str,
    order_col: str,
    wanted: dict[str, str],
    default: str | None = "",
) -> DataFrame:
    """Fold (key, value) rows of each group into one row: for every wanted key the value
    of its last row by ``order_col`` (later rows win; of rows tied there the greatest value),
    ``default`` when the key is absent.

    One aggregate: ``max_by(value, when(key == k, (order, value)))`` per wanted key. ``max_by``
    skips rows whose ordering is null and combines map-side, so a group holding a third of
    all rows is reduced before the shuffle; no list of pairs is ever built.
    """
    k, v, o = as_col(key_col), as_col(value_col), as_col(order_col)
    aggs = []
    for key, out in wanted.items():
        last = F.max_by(v, F.when((k == F.lit(key)) & o.isNotNull(), F.struct(o, v)))
        if default is not None:  # a key that is present with a null value stays null
            last = F.when(F.count(F.when(k == F.lit(key), o)) > 0, last).otherwise(F.lit(default))
        aggs.append(last.alias(out))
    return df.groupBy(*[as_col(g).alias(g) for g in group_keys]).agg(*aggs)
