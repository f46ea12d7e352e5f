"""Watermarks of all symbols at once, and the plans of what to load next that follow from them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import scalars as S
from ..functions.predicates import matches
from .merge import last_wins, upsert


def watermarks(df: DataFrame, groups: Sequence[str], time: str, filters: Mapping[str, Any] | None = None) -> DataFrame:
    """The latest time of each group among rows that match; groups without one are absent."""
    rows = df.where(matches(filters)) if filters else df
    return rows.groupBy(*groups).agg(F.max(time).alias("watermark"))


def watermarks_or(universe: DataFrame, df: DataFrame, groups: Sequence[str], time: str, default: Column) -> DataFrame:
    """A watermark for every group of the universe; ``default`` where the table has none."""
    known = watermarks(df, groups, time)
    return universe.select(*groups).distinct().join(known, list(groups), "left").withColumn("watermark", F.coalesce("watermark", default))


def file_min_times(df: DataFrame, files: Sequence[str], time: str) -> DataFrame:
    """The first time of each file."""
    return df.groupBy(*files).agg(F.min(time).alias("min_time"))


def require_rows(files: DataFrame, min_times: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``min_times``, once every listed file is known to have a data row; else an error."""
    empty = files.join(min_times, list(keys), "left_anti").head(1)
    if empty:
        raise ValueError(f"no data rows in {empty[0].asDict()}")
    return min_times


def page_overlap(pages: DataFrame, marks: DataFrame, groups: Sequence[str], time: str) -> DataFrame:
    """Records at or after their group's watermark (all records of a group without one)."""
    return pages.join(marks, list(groups), "left").where(F.col("watermark").isNull() | (F.col(time) >= F.col("watermark"))).select(*pages.columns)


def sync(target: DataFrame, pages: DataFrame, groups: Sequence[str], keys: Sequence[str], time: str, order: Sequence[str]) -> DataFrame:
    """Incremental synchronisation: watermark, new records from it on, the last of each key, upsert. Groups
    whose fetch brought nothing stay as they are."""
    fresh = page_overlap(pages, watermarks(target, groups, time), groups, time)
    all_keys = [*groups, *keys]
    return upsert(target, last_wins(fresh, all_keys, order).select(*target.columns), all_keys)


def monthly_cover(monthly: DataFrame, groups: Sequence[str], period: str = "period") -> DataFrame:
    """The newest month that monthly files cover."""
    return monthly.groupBy(*groups).agg(F.max(period).alias("covered"))


def file_plan(manifest: DataFrame, marks: DataFrame, groups: Sequence[str], as_of: Column) -> DataFrame:
    """Files to load: (groups, name, period, daily). ``manifest`` has groups, name, period and daily, and
    ``marks`` the groups' watermark as a date.

    Monthly files from the watermark's month to the last complete month; daily files from the watermark's
    day to yesterday whose month is after the newest planned monthly file. Nothing for a group whose
    watermark is past yesterday."""
    yesterday, this_month = F.date_sub(as_of, 1), S.month_start(as_of)
    period, daily, mark = F.col("period"), F.col("daily"), F.col("watermark")
    wanted = F.when(daily, period.between(mark, yesterday)).when(~daily, (period >= S.month_start(mark)) & (period < this_month))
    rows = manifest.join(marks, list(groups)).where((mark <= yesterday) & wanted)
    # the newest planned month comes by a window over what is planned: names are read and dealt once
    covered = F.max(F.when(~daily, period)).over(Window.partitionBy(*groups))
    rows = rows.withColumn("__covered", covered).where(~daily | F.col("__covered").isNull() | (S.month_start(period) > F.col("__covered")))
    return rows.select(*groups, "name", "period", "daily")


def window_plan(marks: DataFrame, end: Column, today: Column, interval_ms: int = 300_000) -> DataFrame:
    """Request windows (window_start, window_end) for each row of ``marks``: from its clamped watermark, with
    one interval of overlap, to ``end`` in steps of the longest request."""
    start = S.clamped_start(S.request_start(F.col("watermark"), interval_ms), today)
    rows = marks.withColumn("__start", start).where(F.col("__start") < end)
    steps = F.sequence(F.col("__start"), end, F.expr(f"INTERVAL {S.REQUEST_MINUTES} MINUTES"))
    rows = rows.withColumn("window_start", F.explode(steps)).where(F.col("window_start") < end)
    return rows.withColumn("window_end", S.request_end(F.col("window_start"), end)).drop("__start")


def next_windows(cursors: DataFrame, pages: DataFrame, groups: Sequence[str], end: Column, time: str = "timestamp", interval_ms: int = 300_000) -> DataFrame:
    """The next request (groups, cursor, window_start, window_end) of every group whose last page has come:
    ``cursors`` holds where each stood, and ``pages`` the records that were found, if any, from there on.
    Groups that have reached ``end`` are done."""
    last = page_overlap(pages, cursors.withColumnRenamed("cursor", "watermark"), groups, time).groupBy(*groups).agg(F.max(time).alias("__last"))
    moved = cursors.join(last, list(groups), "left").withColumn("cursor", S.cursor_after(F.col("__last"), F.col("cursor"), interval_ms))
    moved = moved.where(F.col("cursor") < end)
    return moved.select(*groups, "cursor", S.request_start(F.col("cursor"), interval_ms).alias("window_start"), S.request_end(F.col("cursor"), end).alias("window_end"))


def reuse_complete(plan: DataFrame, verified: DataFrame, key: str = "name") -> DataFrame:
    """Planned files that are not yet there with a valid checksum."""
    return plan.join(verified.where("status = 'valid'").select(key), key, "left_anti")
