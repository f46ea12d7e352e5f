"""The universe of symbols, and what leaves it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def delisted(stored: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct stored symbols that are not current (case-sensitive; nulls compare equal)."""
    return stored.select(*columns).subtract(current.select(*columns))


def stale(stored: DataFrame, current: DataFrame, symbol: str, groups: Sequence[str] = ()) -> DataFrame:
    """Stored rows whose symbol is not current, whatever its case."""
    names = current.select(*groups, F.lower(symbol).alias("__name")).distinct()
    return stored.withColumn("__name", F.lower(symbol)).join(names, [*groups, "__name"], "left_anti").drop("__name")


def current_only(stored: DataFrame, current: DataFrame, symbol: str, groups: Sequence[str] = ()) -> DataFrame:
    """Stored rows of current symbols: what is left when delisted symbols' data goes."""
    names = current.select(*groups, F.lower(symbol).alias("__name")).distinct()
    return stored.withColumn("__name", F.lower(symbol)).join(names, [*groups, "__name"], "left_semi").drop("__name")


def sync_universe(stored_info: DataFrame, current_info: DataFrame, tables: dict[str, DataFrame], symbol: str = "symbol", groups: Sequence[str] = ("market",)) -> tuple[DataFrame, DataFrame, dict[str, DataFrame]]:
    """(new symbol table, delisted symbols, every data table without delisted symbols' rows)."""
    gone = delisted(stored_info, current_info, [*groups, symbol])
    return current_info, gone, {name: current_only(df, current_info, symbol, groups) for name, df in tables.items()}


def column_values(df: DataFrame, column: str) -> DataFrame:
    """The values of a string column in ascending order; nulls go, duplicates stay."""
    return df.select(column).where(F.col(column).isNotNull()).orderBy(column)
