"""Scalar functions of market time series, as Column expressions (no UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Stored trade times below this are milliseconds (the year 2001 in microseconds); fixed value.
MICROS_FROM = 10**15
#: First day whose Spot files are in microseconds; fixed value.
SPOT_MICROS_SINCE = "2025-01-01"
#: Lookback of restricted series in days, their longest request and its slack in minutes.
RESTRICTED_DAYS, REQUEST_MINUTES, SLACK_MINUTES = 29, 2495, 5
#: Days that the cursor moves on after a page without records; fixed value.
EMPTY_PAGE_DAYS = 200
FUNDING_INTERVAL_MS = 8 * 3_600_000

_SECOND, _MINUTE, _HOUR, _DAY = 1000, 60_000, 3_600_000, 86_400_000
#: The length of each candle interval in milliseconds (a month counts as 31 days).
INTERVAL_MS = {
    "OneSecond": _SECOND,
    "OneMinute": _MINUTE,
    "ThreeMinutes": 3 * _MINUTE,
    "FiveMinutes": 5 * _MINUTE,
    "FifteenMinutes": 15 * _MINUTE,
    "ThirtyMinutes": 30 * _MINUTE,
    "OneHour": _HOUR,
    "TwoHour": 2 * _HOUR,
    "FourHour": 4 * _HOUR,
    "SixHour": 6 * _HOUR,
    "EightHour": 8 * _HOUR,
    "TwelveHour": 12 * _HOUR,
    "OneDay": _DAY,
    "ThreeDay": 3 * _DAY,
    "OneWeek": 7 * _DAY,
    "OneMonth": 31 * _DAY,
}


# --- epochs ---


def micros(ts: Column) -> Column:
    """UTC microseconds of a TIMESTAMP_NTZ."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts)


def millis(ts: Column) -> Column:
    """UTC milliseconds of a TIMESTAMP_NTZ, rounded down."""
    t = micros(ts)
    return F.call_function("div", t - F.pmod(t, F.lit(1000)), F.lit(1000))


def from_micros(t: Column) -> Column:
    return F.timestamp_micros(t).cast("timestamp_ntz")


def from_millis(t: Column) -> Column:
    return F.timestamp_millis(t).cast("timestamp_ntz")


def repaired_micros(t: Column) -> Column:
    """Stored trade time in microseconds: values below ``MICROS_FROM`` are taken for milliseconds. Null stays null."""
    return F.when(t < F.lit(MICROS_FROM), t * F.lit(1000)).otherwise(t)


def scaled_micros(t: Column, unit: Column) -> Column:
    """Trade time of a file in microseconds, by the file's unit; ANSI mode raises on overflow."""
    return F.when(unit == "ms", t * F.lit(1000)).otherwise(t)


def day_number(t: Column, units_per_day: int) -> Column:
    """Days since 1970-01-01, rounded down, in exact integer arithmetic."""
    return F.call_function("div", t - F.pmod(t, F.lit(units_per_day)), F.lit(units_per_day))


def day_date(day: Column) -> Column:
    return F.date_from_unix_date(day.cast("int"))


def month_start(d: Column) -> Column:
    return F.trunc(d, "MM")


# --- periods in file names ---


def _parts(name: Column) -> Column:
    return F.split(F.regexp_replace(name, r"\.[^.]*$", ""), "-")


def _tail(parts: Column, k: int) -> Column:
    return F.try_element_at(parts, F.lit(-k))


def file_period(name: Column) -> Column:
    """First day of the period that a file name ends in: year, month and day after at least two other
    segments, else year and month; null if neither."""
    parts = _parts(name)
    last, second, third = (_tail(parts, k) for k in (1, 2, 3))
    is_day = (F.size(parts) >= 5) & (F.length(third) == 4) & (F.length(second) == 2) & (F.length(last) == 2)
    is_month = (F.size(parts) >= 4) & (F.length(second) == 4) & (F.length(last) == 2)
    day = F.when(is_day, F.concat_ws("-", third, second, last))
    month = F.when(is_month, F.concat_ws("-", second, last, F.lit("01")))
    text = F.coalesce(day, month)
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_timestamp(text, F.lit("yyyy-MM-dd"))).cast("date")


def is_daily(name: Column) -> Column:
    """Whether the name ends in a day (as ``file_period`` reads it)."""
    parts = _parts(name)
    return F.coalesce((F.size(parts) >= 5) & (F.length(_tail(parts, 3)) == 4) & (F.length(_tail(parts, 2)) == 2) & (F.length(_tail(parts, 1)) == 2), F.lit(False))


def source_unit(market: Column, period: Column) -> Column:
    """'us' for Spot files from 2025 on (an unreadable period counts as far in the future), else 'ms'."""
    late = F.coalesce(period >= F.lit(SPOT_MICROS_SINCE).cast("date"), F.lit(True))
    return F.when((market == "Spot") & late, "us").otherwise("ms")


# --- strict parsing: null where the text is not exactly of the type ---


def strict_bool(x: Column) -> Column:
    t = F.lower(F.trim(x))
    return F.when(t == "true", True).when(t == "false", False)


def strict_long(x: Column) -> Column:
    return F.when(F.trim(x).rlike(r"^[+-]?\d+$"), F.trim(x).try_cast("long"))


def strict_double(x: Column) -> Column:
    t = F.trim(x)
    return F.when(t.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), t.try_cast("double")).when(t == "NaN", F.lit(float("nan"))).when(t.isin("Infinity", "∞"), F.lit(float("inf"))).when(t.isin("-Infinity", "-∞"), F.lit(float("-inf")))


def strict_decimal(x: Column, precision: int, scale: int) -> Column:
    """Text with more decimals than ``scale`` is refused instead of rounded (zeros at the end are no decimals)."""
    t = F.trim(x)
    fits = t.rlike(rf"^[+-]?\d*(\.\d{{0,{scale}}}0*)?$") & t.rlike(r"\d")
    return F.when(fits, t.try_cast(f"decimal({precision},{scale})"))


def exact_millis(x: Column) -> Column:
    """Epoch ms of a text that is exactly yyyy-MM-dd HH:mm:ss, in UTC."""
    shape = x.rlike(r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$")
    return F.when(shape, millis(x.try_cast("timestamp_ntz")))


# --- numbers ---


def is_finite(x: Column) -> Column:
    """False for NaN and infinities; null for null."""
    return F.when(x.isNotNull(), ~(F.isnan(x) | (F.abs(x) == F.lit(float("inf")))))


def ratio_or_null(buy: Column, sell: Column) -> Column:
    """buy / sell, null where sell is 0."""
    return F.when(sell != 0, F.try_divide(buy, sell))


# --- lists and names ---


def joined(items: Column) -> Column:
    return F.array_join(items, "|")


def json_list(items: Column) -> Column:
    """JSON array text; null items become empty strings, a null list stays null."""
    return F.when(items.isNotNull(), F.to_json(F.transform(items, lambda x: F.coalesce(x, F.lit("")))))


def pair_or_name(pair: Column, name: Column) -> Column:
    """The pair, or the name where the pair is blank."""
    return F.when(F.trim(F.coalesce(pair, F.lit(""))) != "", pair).otherwise(name)


#: Contract types by their lower-case name.
CONTRACT_TYPES = ("Perpetual", "PerpetualDelivering", "CurrentMonth", "CurrentQuarter", "CurrentQuarterDelivering", "NextQuarter", "NextQuarterDelivering", "NextMonth")


def contract_type(name: Column) -> Column:
    """The contract type of that name in any case; anything else is Perpetual."""
    out = F.when(F.lit(False), "")
    for c in CONTRACT_TYPES:
        out = out.when(F.lower(F.trim(name)) == c.lower(), c)
    return out.otherwise("Perpetual")


# --- request windows (timestamps are TIMESTAMP_NTZ, intervals milliseconds) ---


def _plus(ts: Column, ms: Column | int) -> Column:
    return F.timestamp_add("MILLISECOND", ms if isinstance(ms, Column) else F.lit(ms), ts)


def interval_ms(name: Column) -> Column:
    """Milliseconds of a candle interval's name; an unknown name is an error."""
    out = F.when(F.lit(False), F.lit(0).cast("long"))
    for k, v in INTERVAL_MS.items():
        out = out.when(name == k, F.lit(v).cast("long"))
    return out.otherwise(F.raise_error(F.concat(F.lit("unsupported interval: "), F.coalesce(name, F.lit("null")))).cast("long"))


def next_cursor(last: Column, cursor: Column, ms: Column | int) -> Column:
    """One interval past the later of the last record and the cursor, so that it always moves on."""
    return _plus(F.greatest(last, cursor), ms)


def cursor_after(last: Column, cursor: Column, ms: Column | int) -> Column:
    """The cursor after a page: past its last record, or far on if the page was empty (null)."""
    return F.when(last.isNull(), _plus(cursor, EMPTY_PAGE_DAYS * _DAY)).otherwise(next_cursor(last, cursor, ms))


def clamped_start(start: Column, today: Column) -> Column:
    return F.greatest(start, _plus(today, -RESTRICTED_DAYS * _DAY))


def request_start(start: Column, ms: Column | int) -> Column:
    """One interval of overlap before the cursor."""
    return _plus(start, -ms)


def request_end(start: Column, end: Column) -> Column:
    return F.least(_plus(start, REQUEST_MINUTES * _MINUTE), _plus(end, SLACK_MINUTES * _MINUTE))
