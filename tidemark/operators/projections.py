"""Source records to stored rows: one SELECT each, with explicit casts.

Source columns have the exchange's names in snake case; prices are decimals and times TIMESTAMP_NTZ.
Rows keep whatever else ``keep`` names (market, symbol, page order).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import joined, millis, ratio_or_null

_KEYS = ("market", "symbol")


def _double(*names: str) -> list[Column]:
    return [F.col(n).cast("double").alias(n) for n in names]


def _time(source: str, name: str | None = None) -> Column:
    return millis(F.col(source)).alias(name or source)


def project(df: DataFrame, columns: Sequence[Column], keep: Sequence[str] = _KEYS, where: Column | None = None) -> DataFrame:
    """The row mapping with an optional predicate that all projections go through."""
    return (df if where is None else df.where(where)).select(*keep, *columns)


_OHLC = ("open_price", "high_price", "low_price", "close_price")


def klines(df: DataFrame, keep: Sequence[str] = _KEYS) -> DataFrame:
    """Candles of any market."""
    columns = [_time("open_time"), *_double(*_OHLC, "volume"), _time("close_time"), *_double("quote_volume"), F.col("trade_count").cast("int").alias("trade_count"), *_double("taker_buy_base_volume", "taker_buy_quote_volume")]
    return project(df, columns, keep)


def price_klines(df: DataFrame, keep: Sequence[str] = _KEYS) -> DataFrame:
    """Premium-index, index-price and mark-price candles: prices and times only."""
    return project(df, [_time("open_time"), *_double(*_OHLC), _time("close_time")], keep)


premium_index_klines = index_price_klines = mark_price_klines = price_klines


def funding_rates(df: DataFrame, keep: Sequence[str] = _KEYS) -> DataFrame:
    """A missing mark price stays null."""
    return project(df, [_time("funding_time"), F.col("funding_rate").cast("double").alias("rate"), *_double("mark_price")], keep)


def _timed(df: DataFrame, columns: list[Column], keep: Sequence[str]) -> DataFrame:
    """Rows without a timestamp are dropped."""
    return project(df, [_time("timestamp"), *columns], keep, F.col("timestamp").isNotNull())


def open_interest(df: DataFrame, keep: Sequence[str] = _KEYS) -> DataFrame:
    return _timed(df, _double("sum_open_interest", "sum_open_interest_value"), keep)


def long_short_ratios(df: DataFrame, keep: Sequence[str] = _KEYS) -> DataFrame:
    """Top-position, top-account and global-account ratios."""
    return _timed(df, _double("long_short_ratio", "long_account", "short_account"), keep)


top_position_ratios = top_account_ratios = global_account_ratios = long_short_ratios


def taker_ratios_usd(df: DataFrame, keep: Sequence[str] = _KEYS) -> DataFrame:
    """The exchange gives the ratio; there are no value columns."""
    none = [F.lit(None).cast("double").alias(n) for n in ("buy_volume_value", "sell_volume_value")]
    return project(df, [_time("timestamp"), *_double("buy_sell_ratio", "buy_volume", "sell_volume"), *none], keep)


def taker_ratios_coin(df: DataFrame, keep: Sequence[str] = _KEYS) -> DataFrame:
    """The ratio is computed, from decimals of 8 places; null where nothing was sold."""
    buy, sell = (F.col(c).cast("decimal(20,8)") for c in ("buy_volume", "sell_volume"))
    ratio = ratio_or_null(buy, sell).cast("double").alias("buy_sell_ratio")
    return _timed(df, [ratio, *_double("buy_volume", "sell_volume", "buy_volume_value", "sell_volume_value")], keep)


def basis(df: DataFrame, keep: Sequence[str] = _KEYS) -> DataFrame:
    """A missing annualised rate stays null."""
    return project(df, [_time("timestamp"), *_double("futures_price", "index_price", "basis_value", "basis_rate", "annualized_basis_rate")], keep)


_LISTS = ("order_types", "permissions", "time_in_force", "underlying_sub_type")
#: The fields of the symbol table that each kind of market fills.
SPOT_FIELDS = ("name", "base_asset", "base_asset_precision", "base_fee_precision", "allow_trailing_stop", "cancel_replace_allowed", "iceberg_allowed", "is_margin_trading_allowed", "is_spot_trading_allowed", "oco_allowed", "order_types", "quote_asset", "quote_asset_precision", "quote_fee_precision", "permissions", "quote_order_quantity_market_allowed", "status")
FUTURES_FIELDS = ("name", "base_asset", "base_asset_precision", "quote_asset", "contract_type", "delivery_date", "liquidation_fee", "listing_date", "maint_margin_percent", "margin_asset", "market_take_bound", "required_margin_percent", "order_types", "pair", "price_precision", "quantity_precision", "quote_asset_precision", "status", "time_in_force", "trigger_protect", "underlying_type", "underlying_sub_type")
_DOUBLES = ("liquidation_fee", "maint_margin_percent", "market_take_bound", "required_margin_percent", "trigger_protect")


def _field(name: str) -> Column:
    if name in _LISTS:
        return joined(F.col(name)).alias(name)
    if name in ("delivery_date", "listing_date"):
        return _time(name)
    return F.col(name).cast("double").alias(name) if name in _DOUBLES else F.col(name)


def spot_symbols(df: DataFrame, keep: Sequence[str] = ("market",)) -> DataFrame:
    return project(df, [_field(n) for n in SPOT_FIELDS], keep)


def futures_symbols(df: DataFrame, keep: Sequence[str] = ("market",)) -> DataFrame:
    return project(df, [_field(n) for n in FUTURES_FIELDS], keep)


#: Data type and market -> its projection.
PROJECTIONS: dict[tuple[str, str], Callable[..., DataFrame]] = {
    **{("kline", m): klines for m in ("Spot", "UsdFutures", "CoinFutures")},
    **{(n, m): price_klines for n in ("premium_index_kline", "index_price_kline", "mark_price_kline") for m in ("UsdFutures", "CoinFutures")},
    **{(n, m): long_short_ratios for n in ("top_position_ratio", "top_account_ratio", "global_account_ratio") for m in ("UsdFutures", "CoinFutures")},
    **{("funding_rate", m): funding_rates for m in ("UsdFutures", "CoinFutures")},
    **{("open_interest", m): open_interest for m in ("UsdFutures", "CoinFutures")},
    **{("basis", m): basis for m in ("UsdFutures", "CoinFutures")},
    ("taker_ratio", "UsdFutures"): taker_ratios_usd,
    ("taker_ratio", "CoinFutures"): taker_ratios_coin,
    ("symbol_info", "Spot"): spot_symbols,
    ("symbol_info", "UsdFutures"): futures_symbols,
    ("symbol_info", "CoinFutures"): futures_symbols,
}
