"""Declared schemas and the registry of data types. Nothing is inferred, and nothing evolves silently."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import StructType

SPOT, USD_FUTURES, COIN_FUTURES = "Spot", "UsdFutures", "CoinFutures"
FUTURES = (USD_FUTURES, COIN_FUTURES)
MARKETS = (SPOT, *FUTURES)

_OHLC = "open_time long, open_price double, high_price double, low_price double, close_price double"
_RATIO = "timestamp long, long_short_ratio double, long_account double, short_account double"


@dataclass(frozen=True)
class DataType:
    """A stored table: one row a ``key`` within (market, symbol). Epochs are UTC; ``unit`` is ms or us."""

    name: str
    columns: str
    key: tuple[str, ...]
    time: str
    markets: tuple[str, ...] = FUTURES
    unit: str = "ms"
    retained_by: str = ""
    checked: tuple[str, ...] = ()
    large: bool = False

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(self.columns)

    @property
    def units_per_day(self) -> int:
        return 86_400_000 * (1000 if self.unit == "us" else 1)

    @property
    def retention_column(self) -> str:
        return self.retained_by or self.time


_ALL = [
    DataType("kline", f"{_OHLC}, volume double, close_time long, quote_volume double, trade_count int, taker_buy_base_volume double, taker_buy_quote_volume double", ("close_time",), "close_time", MARKETS, retained_by="open_time"),
    *(DataType(n, f"{_OHLC}, close_time long", ("close_time",), "close_time", retained_by="open_time") for n in ("premium_index_kline", "index_price_kline", "mark_price_kline")),
    DataType("funding_rate", "funding_time long, rate double, mark_price double", ("funding_time",), "funding_time"),
    DataType("open_interest", "timestamp long, sum_open_interest double, sum_open_interest_value double", ("timestamp",), "timestamp"),
    *(DataType(n, _RATIO, ("timestamp",), "timestamp") for n in ("top_position_ratio", "top_account_ratio", "global_account_ratio")),
    DataType("taker_ratio", "timestamp long, buy_sell_ratio double, buy_volume double, sell_volume double, buy_volume_value double, sell_volume_value double", ("timestamp",), "timestamp"),
    DataType("basis", "timestamp long, futures_price double, index_price double, basis_value double, basis_rate double, annualized_basis_rate double", ("timestamp",), "timestamp"),
    DataType("agg_trades", "agg_trade_id long, price double, quantity double, first_trade_id long, last_trade_id long, transact_time long, is_buyer_maker boolean", ("agg_trade_id",), "transact_time", MARKETS, "us", checked=("price", "quantity"), large=True),
    DataType("book_depth", "snapshot_time long, percentage decimal(10,2), depth double, notional double", ("snapshot_time", "percentage"), "snapshot_time", checked=("depth", "notional"), large=True),
]
DATA_TYPES = {d.name: d for d in _ALL}


def data_type(name: str, market: str) -> DataType:
    """The declared type; an unknown one, or one that the market does not have, is an error."""
    found = DATA_TYPES.get(name)
    if found is None or market not in found.markets:
        raise ValueError(f"{market} has no data type {name!r}")
    return found
