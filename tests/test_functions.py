import datetime as dt

import pytest
from market_helpers import rows
from pyspark.sql import functions as F

from tidemark.functions import predicates as P
from tidemark.functions import scalars as S
from tidemark.operators import quality, retention, universe
from tidemark.schemas import DATA_TYPES, data_type


def one(spark, *columns):
    return tuple(spark.range(1).select(*(c.alias(f"c{i}") for i, c in enumerate(columns))).first())


def ntz(text):
    return F.lit(text).cast("timestamp_ntz")


def test_cursor_arithmetic(spark):
    start, last = ntz("2025-01-01 12:30:00"), ntz("2025-01-01 12:34:59")
    minute, five, eight = (S.INTERVAL_MS[n] for n in ("OneMinute", "FiveMinutes", "EightHour"))
    got = one(spark, S.next_cursor(last, start, minute), S.next_cursor(last, start, five), S.next_cursor(last, start, eight), S.next_cursor(start, start, five))
    assert [f"{x:%H:%M:%S}" for x in got] == ["12:35:59", "12:39:59", "20:34:59", "12:35:00"]


def test_restricted_windows(spark):
    today = ntz("2025-03-01")
    got = one(spark, S.clamped_start(ntz("2024-01-01"), today), S.clamped_start(ntz("2025-02-20"), today), S.request_end(ntz("2025-02-28"), today), S.request_start(today, 300_000))
    assert [f"{x:%m-%d %H:%M}" for x in got] == ["01-31 00:00", "02-20 00:00", "03-01 00:05", "02-28 23:55"]


@pytest.mark.parametrize("name, period, unit", [("X-aggTrades-2024-12", "2024-12-01", "ms"), ("X-aggTrades-2025-01", "2025-01-01", "us"), ("X-aggTrades-2025-01-01.csv", "2025-01-01", "us"), ("2024-12-01.csv", None, "us"), ("a-b-c-xxxx-12-01", None, "us")])
def test_period_and_unit(spark, name, period, unit):
    got = one(spark, S.file_period(F.lit(name)).cast("string"), S.source_unit(F.lit("Spot"), S.file_period(F.lit(name))), S.source_unit(F.lit("UsdFutures"), S.file_period(F.lit(name))))
    assert got == (period, unit, "ms")


def test_strict_parsing(spark):
    assert one(spark, *(S.strict_bool(F.lit(x)) for x in ("True", " false ", "t", "1", ""))) == (True, False, None, None, None)
    assert one(spark, *(S.strict_long(F.lit(x)) for x in ("12", "-3", "1.0", "", "99999999999999999999"))) == (12, -3, None, None, None)
    assert one(spark, *(S.strict_double(F.lit(x)) for x in ("1.5", "1e3", "x", "1.5f"))) == (1.5, 1000.0, None, None)
    assert [None if x is None else str(x) for x in one(spark, *(S.strict_decimal(F.lit(x), 10, 2) for x in ("-0.2", "1.500", "1.005", "")))] == ["-0.20", "1.50", None, None]
    assert one(spark, *(S.exact_millis(F.lit(x)) for x in ("2025-01-01 00:00:00", "2025-01-01", "2025-13-01 00:00:00"))) == (1735689600000, None, None)


def test_epochs_and_days(spark):
    ts = ntz("1969-12-31 23:59:59.999999")
    assert one(spark, S.micros(ts), S.millis(ts), S.day_number(S.micros(ts), 86_400_000_000), S.repaired_micros(F.lit(1_700_000_000_000)), S.repaired_micros(F.lit(1_700_000_000_000_000)), S.repaired_micros(F.lit(0))) == (-1, -1, -1, 1_700_000_000_000_000, 1_700_000_000_000_000, 0)


def test_finite_lists_and_names(spark):
    inf, nan = float("inf"), float("nan")
    assert one(spark, *(S.is_finite(F.lit(x).cast("double")) for x in (0.0, inf, -inf, nan, None))) == (True, False, False, False, None)
    assert one(spark, S.json_list(F.array(F.lit("a"), F.lit(None).cast("string"))), S.joined(F.array(F.lit("a"), F.lit("b"))), S.json_list(F.lit(None).cast("array<string>"))) == ('["a",""]', "a|b", None)
    assert one(spark, S.pair_or_name(F.lit(" "), F.lit("N")), S.pair_or_name(F.lit(None).cast("string"), F.lit("N")), S.pair_or_name(F.lit("P"), F.lit("N")), S.contract_type(F.lit("nextquarter")), S.contract_type(F.lit("?"))) == ("N", "N", "P", "NextQuarter", "Perpetual")
    assert one(spark, S.ratio_or_null(F.lit(1.0), F.lit(0.0)), S.ratio_or_null(F.lit(1.0), F.lit(4.0))) == (None, 0.25)
    with pytest.raises(Exception, match="unsupported interval"):
        one(spark, S.interval_ms(F.lit("TwoYears")))


def test_universe_groupings(spark):
    df = spark.createDataFrame([("BTC",), ("1000BTC",), ("ETH_X",), ("BADX",), ("1000BAD",)], "n string")
    n, t, c, p = F.col("n"), F.lit("Trading"), F.lit("Coin"), F.lit("Perpetual")
    assert rows(df.where(P.spot_universe(n, t, ["BAD"]))) == [("BTC",)]
    assert rows(df.where(P.coin_universe(n, t, c, p, ["BAD"]))) == [("1000BAD",), ("1000BTC",), ("BTC",), ("ETH_X",)]
    assert df.where(P.coin_universe(n, t, c, p, [])).count() == 5
    assert df.where(P.usd_universe(n, t, c, p, [])).count() == 2


def test_retention_boundary_and_empty_groups(spark):
    df = spark.createDataFrame([("a", 1000), ("a", 2000), ("a", 3000), ("b", 1), ("c", None)], "s string, t long")
    assert rows(retention.expire(df, ["s"], "t", F.lit(2500))) == [("a", 3000)]
    kept = retention.apply_retention(spark.createDataFrame([("m", "s", 1_700_000_000_000), ("m", "s", 1_000_000_000_000_001)], "market string, symbol string, transact_time long"), DATA_TYPES["agg_trades"], F.lit("2025-01-01").cast("date"))
    assert [r.transact_time for r in kept.collect()] == [1_700_000_000_000_000]


def test_unsupported_data_types_raise():
    assert data_type("kline", "Spot").key == ("close_time",)
    for name, market in (("basis", "Spot"), ("nothing", "UsdFutures")):
        with pytest.raises(ValueError):
            data_type(name, market)
    assert all(d.schema.names for d in DATA_TYPES.values())


def test_sync_universe_drops_whatever_the_case(spark):
    old = spark.createDataFrame([("m", "AAA"), ("m", "BBB")], "market string, symbol string")
    new = spark.createDataFrame([("m", "bbb")], "market string, symbol string")
    info, gone, tables = universe.sync_universe(old, new, {"t": old.withColumn("x", F.lit(1))})
    assert rows(gone) == [("m", "AAA"), ("m", "BBB")]  # names differ in case: delisted, but data stays
    assert rows(tables["t"]) == [("m", "BBB", 1)] and rows(info) == [("m", "bbb")]


def test_missing_day_sample_and_summary(spark):
    day = 86_400_000
    df = spark.createDataFrame([("a", d * day + 1) for d in (1, 2, 6)] + [("b", 5 * day), ("c", -5), ("c", None)], "s string, t long")
    assert rows(quality.missing_day_samples(df, ["s"], "t", day, 2)) == [("a", 3, "1970-01-04, 1970-01-05, ...")]
    assert rows(quality.missing_day_samples(df, ["s"], "t", day, 0)) == [("a", 3, "...")]
    assert [r[1] for r in rows(quality.missing_days(df, ["s"], "t", day))] == [dt.date(1970, 1, 4), dt.date(1970, 1, 5), dt.date(1970, 1, 6)]
    every = spark.createDataFrame([("a",), ("z",)], "s string")
    report = quality.integrity_report(every, df.withColumn("v", F.lit(0.0)), ["s"], F.col("t").isNull(), ["v"], "t", day)
    assert rows(report.select("s", "n_rows", "zero_columns", "n_missing", "is_empty", "has_issue")) == [("a", 3, "v", 3, False, True), ("z", 0, "", 0, True, True)]
    assert tuple(quality.summary(report).first()) == (2, 2, 1, 3, 0, 1, 0)
    assert tuple(quality.summary(report.limit(0)).first()) == (0, 0, 0, 0, 0, 0, 0)
    failed = quality.integrity_report(every, df.withColumn("v", F.lit(0.0)), ["s"], F.col("t").isNull(), ["v"], "t", day, unreadable=F.col("t") == 6 * day + 1)
    assert rows(failed.select("s", "n_rows", "zero_columns", "n_missing", "failed", "has_issue")) == [("a", 3, "", 0, True, False), ("z", 0, "", 0, False, True)]
    assert tuple(quality.summary(failed).first()) == (2, 1, 1, 0, 0, 0, 1)
    off = quality.integrity_report(every, df.withColumn("v", F.lit(0.0)), ["s"], F.lit(True), ["v"], "t", day, rows=False, zeros=False, days=False)
    assert rows(off.select("s", "has_issue")) == [("a", False), ("z", True)]
