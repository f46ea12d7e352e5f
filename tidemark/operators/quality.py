"""Integrity reports: empty tables, invalid rows, all-zero columns, missing days, time units.

One scan, aggregated by symbol and day and then by symbol, gives a report's counts and gaps.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.scalars import day_date, day_number, is_finite

#: Missing days shown in a report; fixed default.
SHOWN_DAYS = 20


def row_counts(df: DataFrame, groups: Sequence[str], invalid: Column, checked: Sequence[str], more: Sequence[Column] = ()) -> DataFrame:
    """Per group: n_rows, n_invalid, zeros and unusable values (null or not finite) of checked columns, and
    ``more`` aggregates."""
    counts = [F.count(F.lit(1)).alias("n_rows"), F.count_if(invalid).alias("n_invalid"), *more]
    for c in checked:
        counts += [F.count_if(F.col(c) == 0).alias(f"{c}__zero"), F.count_if(~F.coalesce(is_finite(F.col(c).cast("double")), F.lit(False))).alias(f"{c}__unusable")]
    return df.groupBy(*groups).agg(*counts)


def _all_zero(c: str) -> Column:
    return (F.col("n_rows") > 0) & (F.col(f"{c}__unusable") == 0) & (F.col(f"{c}__zero") == F.col("n_rows"))


def all_zero_columns(df: DataFrame, groups: Sequence[str], checked: Sequence[str]) -> DataFrame:
    """(groups, column_name, n_rows) of the checked columns that hold nothing but zeros."""
    counts = row_counts(df, groups, F.lit(False), checked)
    names = F.array(*(F.when(_all_zero(c), F.lit(c)) for c in checked))
    return counts.select(*groups, F.explode(F.array_compact(names)).alias("column_name"), "n_rows")


def present_days(df: DataFrame, groups: Sequence[str], time: str, units_per_day: int) -> DataFrame:
    """Distinct (groups, day) with a positive time."""
    rows = df.where(F.col(time) > 0)
    return rows.select(*groups, day_number(F.col(time), units_per_day).alias("day")).distinct()


def day_gaps(days: DataFrame, groups: Sequence[str]) -> DataFrame:
    """(groups, day, next_day) where days are missing between the two."""
    following = F.lead("day").over(Window.partitionBy(*groups).orderBy("day"))
    return days.withColumn("next_day", following).where("next_day > day + 1")


def missing_days(df: DataFrame, groups: Sequence[str], time: str, units_per_day: int) -> DataFrame:
    """(groups, missing_day): UTC days without a row strictly between a group's first and last day."""
    gaps = day_gaps(present_days(df, groups, time, units_per_day), groups)
    each = gaps.select(*groups, F.explode(F.sequence(F.col("day") + 1, F.col("next_day") - 1)).alias("day"))
    return each.select(*groups, day_date(F.col("day")).alias("missing_day"))


def missing_day_samples(df: DataFrame, groups: Sequence[str], time: str, units_per_day: int, shown: int = SHOWN_DAYS) -> DataFrame:
    """Per group with gaps: n_missing, and the first ``shown`` missing days as text with ', ...' if there
    are more. No gap is expanded further than it is shown."""
    gaps = day_gaps(present_days(df, groups, time, units_per_day), groups)
    order = Window.partitionBy(*groups).orderBy("day")
    before = F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    gaps = gaps.withColumn("size", F.col("next_day") - F.col("day") - 1).withColumn("before", before)
    room = F.least(F.col("size"), F.lit(shown) - F.col("before"))
    some = F.when(room > 0, F.sequence(F.col("day") + 1, F.col("day") + room)).otherwise(F.array().cast("array<bigint>"))
    out = gaps.withColumn("some", some).groupBy(*groups).agg(F.sum("size").alias("n_missing"), F.array_sort(F.flatten(F.collect_list(F.when(F.size("some") > 0, F.col("some"))))).alias("days"))
    text = F.array_join(F.transform("days", lambda d: F.date_format(day_date(d), "yyyy-MM-dd")), ", ")
    return out.select(*groups, "n_missing", F.concat(text, F.when(F.col("n_missing") > shown, ", ..." if shown else "...").otherwise("")).alias("sample"))


def integrity_report(universe: DataFrame, df: DataFrame, groups: Sequence[str], invalid: Column, checked: Sequence[str], time: str, units_per_day: int, shown: int = SHOWN_DAYS, rows: bool = True, zeros: bool = True, days: bool = True, unreadable: Column | None = None, expected: DataFrame | None = None) -> DataFrame:
    """A row for each group of the universe: n_rows, n_invalid, zero_columns, n_missing, missing_sample,
    is_empty, failed, has_issue. Checks that are switched off report nothing; an empty table is not checked
    further. A group with an ``unreadable`` row, or with another number of rows than ``expected`` (groups,
    n_expected) says, has failed: it is counted, but not checked.

    One scan and one shuffle of partial counts by group and day give everything; a group's days then come
    together as one list, of as many entries as it has days."""
    daily = daily_counts(df, groups, invalid, checked, time, units_per_day, unreadable)
    return report_of(universe, daily, groups, checked, shown, rows, zeros, days, expected)


def daily_counts(df: DataFrame, groups: Sequence[str], invalid: Column, checked: Sequence[str], time: str, units_per_day: int, unreadable: Column | None = None) -> DataFrame:
    """A report's counts by group and ``__day``: they can be kept, and added up with those of other rows."""
    day = F.when(F.col(time) > 0, day_number(F.col(time), units_per_day))
    failed = F.lit(False) if unreadable is None else F.coalesce(unreadable, F.lit(False))
    return row_counts(df.withColumns({"__day": day, "__failed": failed}), [*groups, "__day"], invalid, checked, [F.max("__failed").alias("failed")])


def report_of(universe: DataFrame, daily: DataFrame, groups: Sequence[str], checked: Sequence[str], shown: int = SHOWN_DAYS, rows: bool = True, zeros: bool = True, days: bool = True, expected: DataFrame | None = None) -> DataFrame:
    """``integrity_report`` from daily counts, of which each group has one row a day."""
    sums = [F.sum(c).alias(c) for c in daily.columns if c not in (*groups, "__day", "failed")]
    counts = daily.groupBy(*groups).agg(*sums, F.max("failed").alias("failed"), F.array_sort(F.collect_list("__day")).alias("days"))
    names = F.array_join(F.array_compact(F.array(F.lit(None).cast("string"), *(F.when(_all_zero(c), F.lit(c)) for c in checked))), ",")
    n, following = F.size("days"), F.slice("days", 2, F.greatest(F.size("days") - 1, F.lit(0)))
    missing = F.when(n > 1, F.element_at("days", -1) - F.element_at("days", 1) + 1 - n).otherwise(0)
    pairs = F.filter(F.arrays_zip(F.col("days").alias("a"), following.alias("b")), lambda p: p["b"] > p["a"] + 1)
    some = F.flatten(F.transform(pairs, lambda p: F.sequence(p["a"] + 1, F.least(p["b"] - 1, p["a"] + max(shown, 1)))))
    text = F.array_join(F.transform(F.slice(some, 1, shown), lambda d: F.date_format(day_date(d), "yyyy-MM-dd")), ", ")
    sample = F.when(missing > 0, F.concat(text, F.when(missing > shown, ", ..." if shown else "...").otherwise("")))
    zero, none, ok = F.lit(0).cast("long"), F.lit(""), ~F.col("failed")
    if expected is not None:
        short = F.coalesce("n_expected", F.lit(0)) != F.coalesce("n_rows", F.lit(0))
        counts = counts.join(expected.select(*groups, "n_expected"), list(groups), "full").withColumn("failed", F.coalesce("failed", F.lit(False)) | short).drop("n_expected")
    counts = counts.select(
        *groups,
        "n_rows",
        "failed",
        (F.when(ok, F.col("n_invalid")) if rows else zero).alias("n_invalid"),
        (F.when(ok, names) if zeros else none).alias("zero_columns"),
        (F.when(ok, missing) if days else zero).alias("n_missing"),
        (F.when(ok, sample) if days else none).alias("missing_sample"),
    )
    out = universe.select(*groups).distinct().join(counts, list(groups), "left")
    out = out.select(*groups, F.coalesce("n_rows", zero).alias("n_rows"), F.coalesce("n_invalid", zero).alias("n_invalid"), F.coalesce("zero_columns", none).alias("zero_columns"), F.coalesce("n_missing", zero).alias("n_missing"), F.coalesce("missing_sample", none).alias("missing_sample"), F.coalesce("failed", F.lit(False)).alias("failed"))
    empty = (F.col("n_rows") == 0) & ~F.col("failed")
    return out.withColumn("is_empty", empty).withColumn("has_issue", empty | (F.col("n_invalid") > 0) | (F.col("zero_columns") != "") | (F.col("n_missing") > 0))


def summary(report: DataFrame) -> DataFrame:
    """One row of totals over a report. Failed tables count as tables, and as failed, but not as such with
    issues."""

    def total(column: Column, name: str) -> Column:
        return F.coalesce(F.sum(column), F.lit(0)).cast("long").alias(name)

    zero_columns = F.when(F.col("zero_columns") != "", F.size(F.split("zero_columns", ","))).otherwise(0)
    return report.agg(
        F.count(F.lit(1)).alias("n_tables"),
        total(F.col("has_issue").cast("long"), "n_with_issues"),
        total(F.col("is_empty").cast("long"), "n_empty"),
        total(F.col("n_missing"), "n_missing_days"),
        total(F.col("n_invalid"), "n_invalid_rows"),
        total(zero_columns, "n_zero_columns"),
        total(F.col("failed").cast("long"), "n_failed"),
    )


def time_unit_anomalies(lines: DataFrame, files: Sequence[str], line: str, order: str, unit: Column) -> DataFrame:
    """(files, digits, expected_unit) of files whose first non-blank line has a time, in its sixth field,
    of another length than the unit's: 13 or 14 digits for ms, 16 or 17 for us. A line with fewer fields,
    or without a number there (a header), says nothing."""
    first = lines.where(F.trim(F.col(line)) != "").groupBy(*files).agg(F.min_by(line, order).alias("first"))
    field = F.trim(F.try_element_at(F.split("first", ","), F.lit(6)))
    digits = F.length(F.regexp_replace(field, "^-+", ""))
    first = first.withColumn("digits", F.when(field.rlike(r"^-?\d+$"), digits)).withColumn("expected_unit", unit)
    wrong = F.when(F.col("expected_unit") == "us", ~F.col("digits").between(16, 17)).otherwise(~F.col("digits").between(13, 14))
    return first.where(wrong).select(*files, "digits", "expected_unit")
