"""Filters and validity rules, as Column expressions."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalars import file_period, is_daily, is_finite


def _any(conditions: list[Column]) -> Column:
    out = F.lit(False)
    for c in conditions:
        out = out | c
    return out


def _names(name: Column, ignored: list[str]) -> tuple[Column, Column, Column]:
    return _any([F.contains(name, F.lit(x)) for x in ignored]), F.contains(name, F.lit("1000")), F.contains(name, F.lit("_"))


def spot_universe(name: Column, status: Column, ignored: list[str]) -> Column:
    """Trading symbols whose name holds no ignored coin, no 1000 and no underscore."""
    coin, thousand, under = _names(name, ignored)
    return ~coin & ~thousand & ~under & (status == "Trading")


def usd_universe(name: Column, status: Column, underlying: Column, contract: Column, ignored: list[str]) -> Column:
    return spot_universe(name, status, ignored) & (underlying == "Coin") & (contract == "Perpetual")


def coin_universe(name: Column, status: Column, underlying: Column, contract: Column, ignored: list[str]) -> Column:
    """Here the name tests qualify the ignored coins: only a name with an ignored coin and neither 1000 nor
    an underscore is dropped, so an empty list drops none by name."""
    coin, thousand, under = _names(name, ignored)
    return ~(coin & ~thousand & ~under) & (underlying == "Coin") & (contract == "Perpetual") & (status == "Trading")


def matches(filters: Mapping[str, Any]) -> Column:
    """Every column equals its value; a None value asks for null."""
    out = F.lit(True)
    for column, value in filters.items():
        out = out & (F.col(column).isNull() if value is None else F.col(column) == F.lit(value))
    return out


def not_before(time: Column, threshold: Column) -> Column:
    """What stays when rows older than the threshold are deleted: null times stay."""
    return time.isNull() | threshold.isNull() | (time >= threshold)


def before_tail(time: Column, start: Column) -> Column:
    """What stays when everything from ``start`` on is deleted: null times stay; no start deletes nothing."""
    return time.isNull() | start.isNull() | (time < start)


def _null(*columns: str) -> Column:
    return _any([F.col(c).isNull() for c in columns])


def _bad_amount(column: str) -> Column:
    return ~is_finite(F.col(column)) | (F.col(column) < 0)


def invalid_trade() -> Column:
    """Any column null; an id below 0; price or quantity not finite or below 0; the last id before the
    first; a time of 0 or less. A price or quantity of 0 is valid."""
    null = _null("agg_trade_id", "price", "quantity", "first_trade_id", "last_trade_id", "transact_time", "is_buyer_maker")
    ids = (F.col("agg_trade_id") < 0) | (F.col("first_trade_id") < 0) | (F.col("last_trade_id") < 0) | (F.col("last_trade_id") < F.col("first_trade_id"))
    return F.coalesce(null | ids | _bad_amount("price") | _bad_amount("quantity") | (F.col("transact_time") <= 0), F.lit(True))


def invalid_depth() -> Column:
    """Any column null; a time of 0 or less; a percentage below 0 (which bid levels have: they count as
    invalid); depth or notional not finite or below 0."""
    null = _null("snapshot_time", "percentage", "depth", "notional")
    return F.coalesce(null | (F.col("snapshot_time") <= 0) | (F.col("percentage") < 0) | _bad_amount("depth") | _bad_amount("notional"), F.lit(True))


def archive_in_window(name: Column, prefix: Column, daily: bool, start: Column, end: Column) -> Column:
    """A .zip of the given prefix whose readable period, daily or monthly, lies within start and end."""
    period = file_period(name)
    return F.coalesce(F.startswith(name, prefix) & F.endswith(name, F.lit(".zip")) & (is_daily(name) == daily) & period.between(start, end), F.lit(False))
