"""Retention: rows older than a threshold go, and groups that are then empty with them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import not_before
from ..functions.scalars import repaired_micros
from ..schemas import DataType

#: Retention of every data type, in years; fixed value.
YEARS = 3


def drop_empty_groups(df: DataFrame, groups: Sequence[str], time: str) -> DataFrame:
    """Without the groups that have no time left (only null ones, or no row)."""
    alive = df.groupBy(*groups).agg(F.max(time).alias("__max")).where("__max IS NOT NULL").select(*groups)
    return df.join(alive, list(groups), "left_semi")


def expire(df: DataFrame, groups: Sequence[str], time: str, threshold: Column, measured: str | None = None) -> DataFrame:
    """Rows with ``time`` at or after the threshold, or null, of groups that still have a time. The group
    test looks at ``measured`` if that differs from the tested column."""
    return drop_empty_groups(df.where(not_before(F.col(time), threshold)), groups, measured or time)


def threshold(as_of: Column, unit: str) -> Column:
    """``YEARS`` before the given UTC date, as an epoch of the unit."""
    start = F.add_months(as_of, -12 * YEARS)
    days = F.datediff(start, F.lit("1970-01-01").cast("date")).cast("long")
    return days * F.lit(86_400_000 * (1000 if unit == "us" else 1))


def apply_retention(df: DataFrame, kind: DataType, as_of: Column, groups: Sequence[str] = ("market", "symbol")) -> DataFrame:
    """Retention of a data type; stored trade times are repaired first."""
    if kind.unit == "us":
        df = df.withColumn(kind.time, repaired_micros(F.col(kind.time)))
    return expire(df, groups, kind.retention_column, threshold(as_of, kind.unit), kind.time)
