"""Registered queries: every operator of the library over the whole test tables, with equal SQL.

``events`` stand for trades, ``lineitem`` for order-book rows with a composite key, ``orders`` and
``customer`` for series and their universe.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import predicates as P
from ..functions import scalars as S
from ..operators import merge, projections, quality, retention, universe, watermark
from ..schemas import DATA_TYPES
from ..sources import landed

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}
DAY_US = 86_400_000_000


def query(sql: str) -> Callable[[Query], Query]:
    """Register a query under its name, with the SQL that gives the same rows."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__], ORACLE_SQL[f.__name__] = f, sql.strip()
        return f

    return add


def _table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _ntz(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def _trades(spark: SparkSession, d: str, symbol: str = "event_type") -> DataFrame:
    e = _table(spark, d, "events")
    return e.select(F.col(symbol).cast("string").alias("symbol"), F.col("event_id").alias("agg_trade_id"), F.col("value").alias("price"), F.col("value").alias("quantity"), F.col("event_id").alias("first_trade_id"), (F.col("event_id") + F.col("event_id") % 3).alias("last_trade_id"), S.micros(F.col("ts")).alias("transact_time"), (F.col("event_id") % 2 == 0).alias("is_buyer_maker"))


# --- watermarks ---


@query("SELECT event_type AS symbol, max(epoch_us(ts))::BIGINT AS watermark FROM events GROUP BY 1")
def watermark_by_symbol(spark: SparkSession, d: str) -> DataFrame:
    return watermark.watermarks(_trades(spark, d), ["symbol"], "transact_time")


@query("""
WITH o AS (SELECT o_custkey, max(epoch_ms(o_orderdate)) AS w FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01' GROUP BY 1)
SELECT c_custkey, coalesce(w, 915148800000)::BIGINT AS watermark, make_timestamp(coalesce(w, 915148800000)::BIGINT * 1000)::DATE AS watermark_date
FROM customer LEFT JOIN o ON o_custkey = c_custkey""")
def watermark_default(spark: SparkSession, d: str) -> DataFrame:
    late = _table(spark, d, "orders").where(F.col("o_orderdate") >= _ntz("2001-01-01"))
    late = late.select(F.col("o_custkey").alias("c_custkey"), S.millis(F.col("o_orderdate")).alias("t"))
    out = watermark.watermarks_or(_table(spark, d, "customer"), late, ["c_custkey"], "t", F.lit(915148800000))
    return out.withColumn("watermark_date", S.from_millis(F.col("watermark")).cast("date"))


@query("""
SELECT o_custkey, max(epoch_ms(o_orderdate))::BIGINT AS watermark FROM orders
WHERE o_orderstatus = 'F' AND nullif(o_orderpriority, '1-URGENT') IS NULL GROUP BY 1""")
def watermark_filtered(spark: SparkSession, d: str) -> DataFrame:
    o = _table(spark, d, "orders").select("o_custkey", "o_orderstatus", F.nullif(F.col("o_orderpriority"), F.lit("1-URGENT")).alias("priority"), S.millis(F.col("o_orderdate")).alias("t"))
    return watermark.watermarks(o, ["o_custkey"], "t", {"o_orderstatus": "F", "priority": None})


@query("SELECT event_type, ts::DATE AS day, min(epoch_us(ts))::BIGINT AS min_time FROM events GROUP BY 1, 2")
def file_min_time(spark: SparkSession, d: str) -> DataFrame:
    e = _table(spark, d, "events").select("event_type", F.col("ts").cast("date").alias("day"), S.micros(F.col("ts")).alias("t"))
    return watermark.file_min_times(e, ["event_type", "day"], "t")


# --- merging ---


@query("""
SELECT user_id, event_id, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def last_wins_single(spark: SparkSession, d: str) -> DataFrame:
    out = merge.last_wins(_table(spark, d, "events").select("user_id", "event_id", "event_type", "value", "ts"), ["user_id"], ["ts", "event_id"])
    return out.select("user_id", "event_id", "event_type", "value")


@query("SELECT count(*)::BIGINT AS n_rows, count(DISTINCT user_id)::BIGINT AS n_unique FROM events")
def duplicate_report(spark: SparkSession, d: str) -> DataFrame:
    return merge.duplicate_report(_table(spark, d, "events"), ["user_id"])


_LINE = ["l_partkey", "l_suppkey", "l_shipdate", "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"]
_LINE_ORDER = ["l_shipdate", "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"]
_LAST_LINE = """SELECT l_partkey, l_suppkey, l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_partkey, l_suppkey ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_quantity DESC, l_extendedprice DESC) = 1"""


def _last_lines(spark: SparkSession, d: str) -> DataFrame:
    return merge.last_wins(_table(spark, d, "lineitem").select(*_LINE), ["l_partkey", "l_suppkey"], _LINE_ORDER, combine=False).drop("l_shipdate")


@query(_LAST_LINE)
def last_wins_composite(spark: SparkSession, d: str) -> DataFrame:
    return _last_lines(spark, d)


@query("""
WITH i AS (SELECT event_id * 2 AS event_id, event_type, value * 2 AS value FROM events)
SELECT event_id, event_type, value FROM i
UNION ALL SELECT event_id, event_type, value FROM events e WHERE NOT EXISTS (SELECT 1 FROM i WHERE i.event_id = e.event_id)""")
def upsert(spark: SparkSession, d: str) -> DataFrame:
    target = _table(spark, d, "events").select("event_id", "event_type", "value")
    incoming = target.select((F.col("event_id") * 2).alias("event_id"), "event_type", (F.col("value") * 2).alias("value"))
    return merge.upsert(target, incoming, ["event_id"])


@query(f"""
WITH t AS ({_LAST_LINE}), i AS (SELECT l_partkey, l_suppkey + 1 AS l_suppkey, l_orderkey, l_linenumber, l_quantity * 2 AS l_quantity, l_extendedprice FROM t)
SELECT * FROM i UNION ALL SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM i WHERE i.l_partkey = t.l_partkey AND i.l_suppkey = t.l_suppkey)""")
def upsert_composite(spark: SparkSession, d: str) -> DataFrame:
    target = _last_lines(spark, d)
    incoming = target.withColumns({"l_suppkey": F.col("l_suppkey") + 1, "l_quantity": F.col("l_quantity") * 2})
    return merge.upsert(target, incoming, ["l_partkey", "l_suppkey"])


@query(f"""
WITH t AS (SELECT event_type AS symbol, event_id AS id, epoch_us(ts) AS t, value FROM events),
i AS (SELECT symbol, id * 2 AS id, t + 15 * {DAY_US} AS t, value * 2 AS value FROM t), m AS (SELECT symbol, min(t) AS f FROM i GROUP BY 1)
SELECT symbol, id, t::BIGINT AS t, value FROM i
UNION ALL SELECT symbol, id, t::BIGINT, value FROM t JOIN m USING (symbol) WHERE t < f AND NOT EXISTS (SELECT 1 FROM i WHERE i.symbol = t.symbol AND i.id = t.id)""")
def tail_replace_one(spark: SparkSession, d: str) -> DataFrame:
    target = _trades(spark, d).select("symbol", F.col("agg_trade_id").alias("id"), F.col("transact_time").alias("t"), F.col("price").alias("value"))
    incoming = target.select("symbol", (F.col("id") * 2).alias("id"), (F.col("t") + 15 * DAY_US).alias("t"), (F.col("value") * 2).alias("value"), F.col("id").alias("line"))
    return merge.replace_tail(target, incoming, ["symbol"], ["id"], "t", ["line"])


@query("""
WITH e AS (SELECT event_type AS symbol, event_id % 6000 AS id, epoch_us(ts) AS t, value, event_id AS line,
  event_id // 2500 + CASE WHEN event_id % 50 = 0 AND event_id % 2500 >= 2400 THEN 1 ELSE 0 END AS f FROM events),
l AS (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY symbol, id ORDER BY f DESC, line DESC) = 1),
m AS (SELECT symbol, f, min(t) AS m FROM e GROUP BY 1, 2),
c AS (SELECT symbol, f, min(m) OVER (PARTITION BY symbol ORDER BY f ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS cut FROM m)
SELECT symbol, id, t::BIGINT AS t, value FROM l JOIN c USING (symbol, f) WHERE cut IS NULL OR t < cut""")
def tail_replace_multi(spark: SparkSession, d: str) -> DataFrame:
    late = ((F.col("event_id") % 50 == 0) & (F.col("event_id") % 2500 >= 2400)).cast("int")
    e = _table(spark, d, "events").select(F.col("event_type").alias("symbol"), (F.col("event_id") % 6000).alias("id"), S.micros(F.col("ts")).alias("t"), "value", F.col("event_id").alias("line"), (F.call_function("div", F.col("event_id"), F.lit(2500)) + late).alias("f"))
    target = e.where("f = 0").select("symbol", "id", "t", "value")
    return merge.replace_tails(target, e.where("f > 0"), ["symbol"], ["id"], "t", "f", "line")


@query("""
WITH i AS (SELECT event_id // 2 * 3 AS event_id, event_type, value * 2 AS value FROM events QUALIFY row_number() OVER (PARTITION BY event_id // 2 ORDER BY events.event_id DESC) = 1)
SELECT event_id, event_type, value FROM i
UNION ALL SELECT event_id, event_type, value FROM events e WHERE NOT EXISTS (SELECT 1 FROM i WHERE i.event_id = e.event_id)""")
def append_import(spark: SparkSession, d: str) -> DataFrame:
    target = _table(spark, d, "events").select("event_id", "event_type", "value")
    third = F.call_function("div", F.col("event_id"), F.lit(2)) * 3
    return merge.append_import(target, target.select(third.alias("event_id"), "event_type", (F.col("value") * 2).alias("value"), F.col("event_id").alias("line")), ["event_id"], ["line"])


@query("SELECT l_partkey, l_suppkey, count(*)::BIGINT AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def duplicate_keys(spark: SparkSession, d: str) -> DataFrame:
    return merge.duplicate_keys(_table(spark, d, "lineitem"), ["l_partkey", "l_suppkey"])


# --- incremental ---


@query(f"""
WITH t AS (SELECT user_id, event_id // 2 AS id, max(epoch_us(ts)) AS t FROM events WHERE ts < TIMESTAMP '2024-01-16' GROUP BY 1, 2),
w AS (SELECT user_id, max(t) AS w FROM t GROUP BY 1),
i AS (SELECT user_id, event_id // 3 AS id, epoch_us(ts) + 2 * {DAY_US} AS t FROM events LEFT JOIN w USING (user_id) WHERE w IS NULL OR epoch_us(ts) + 2 * {DAY_US} >= w
  QUALIFY row_number() OVER (PARTITION BY user_id, event_id // 3 ORDER BY event_id DESC) = 1)
SELECT user_id, id, t::BIGINT AS t FROM i UNION ALL SELECT user_id, id, t::BIGINT FROM t WHERE NOT EXISTS (SELECT 1 FROM i WHERE i.user_id = t.user_id AND i.id = t.id)""")
def incremental_sync(spark: SparkSession, d: str) -> DataFrame:
    e = _table(spark, d, "events").select("user_id", "event_id", "ts", S.micros(F.col("ts")).alias("t"))
    half = F.call_function("div", F.col("event_id"), F.lit(2)).alias("id")
    target = e.where(F.col("ts") < _ntz("2024-01-16")).groupBy("user_id", half).agg(F.max("t").alias("t"))
    pages = e.select("user_id", F.call_function("div", F.col("event_id"), F.lit(3)).alias("id"), (F.col("t") + 2 * DAY_US).alias("t"), F.col("event_id").alias("line"))
    return watermark.sync(target, pages, ["user_id"], ["id"], "t", ["line"])


@query(f"""
WITH w AS (SELECT user_id, min(epoch_us(ts)) + 15 * {DAY_US} AS w FROM events GROUP BY 1)
SELECT user_id, event_id, value FROM events JOIN w USING (user_id) WHERE epoch_us(ts) >= w""")
def page_overlap(spark: SparkSession, d: str) -> DataFrame:
    e = _table(spark, d, "events").select("user_id", "event_id", "value", S.micros(F.col("ts")).alias("t"))
    marks = e.groupBy("user_id").agg((F.min("t") + 15 * DAY_US).alias("watermark"))
    return watermark.page_overlap(e, marks, ["user_id"], "t").drop("t")


@query("""
WITH r AS (SELECT l_suppkey, epoch_ms(l_shipdate) AS t FROM lineitem WHERE l_shipdate >= TIMESTAMP '2001-06-01' OR l_shipdate IS NULL)
SELECT l_suppkey, count(*)::BIGINT AS n_rows, min(t)::BIGINT AS first_time FROM r GROUP BY 1 HAVING max(t) IS NOT NULL""")
def retained(spark: SparkSession, d: str) -> DataFrame:
    rows = _table(spark, d, "lineitem").select("l_suppkey", S.millis(F.col("l_shipdate")).alias("t"))
    out = retention.expire(rows, ["l_suppkey"], "t", S.millis(_ntz("2001-06-01")))
    return out.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n_rows"), F.min("t").alias("first_time"))


@query("""
WITH o AS (SELECT o_custkey, o_orderdate::DATE AS day FROM orders),
f AS (SELECT DISTINCT o_custkey, date_trunc('month', day)::DATE AS period, false AS daily FROM o UNION ALL SELECT DISTINCT o_custkey, day, true FROM o),
x AS (SELECT f.*, w FROM f JOIN (SELECT o_custkey, min(day) + 700 AS w FROM o GROUP BY 1) w USING (o_custkey) WHERE w <= DATE '2001-06-14'),
m AS (SELECT * FROM x WHERE NOT daily AND period >= date_trunc('month', w) AND period < DATE '2001-06-01'),
c AS (SELECT o_custkey, max(period) AS c FROM m GROUP BY 1),
y AS (SELECT o_custkey, period, daily FROM m UNION ALL SELECT o_custkey, period, daily FROM x LEFT JOIN c USING (o_custkey)
  WHERE daily AND period BETWEEN w AND DATE '2001-06-14' AND (c IS NULL OR date_trunc('month', period) > c))
SELECT o_custkey, 'C' || o_custkey || '-1m-' || CASE WHEN daily THEN strftime(period, '%Y-%m-%d') ELSE strftime(period, '%Y-%m') END || '.zip' AS name, period, daily FROM y""")
def file_plan(spark: SparkSession, d: str) -> DataFrame:
    o = _table(spark, d, "orders").select("o_custkey", F.col("o_orderdate").cast("date").alias("day"))
    prefix = F.concat(F.lit("C"), F.col("o_custkey").cast("string"), F.lit("-1m-"))
    months, days = o.select("o_custkey", S.month_start(F.col("day")).alias("day")).distinct(), o.distinct()  # dates are told apart faster than names
    names = landed.concatenated([x.select("o_custkey", F.concat(prefix, F.date_format("day", form), F.lit(".zip")).alias("name")) for x, form in ((months, "yyyy-MM"), (days, "yyyy-MM-dd"))])
    files = names.select("o_custkey", "name", S.file_period(F.col("name")).alias("period"), S.is_daily(F.col("name")).alias("daily"))
    marks = o.groupBy("o_custkey").agg(F.date_add(F.min("day"), 700).alias("watermark"))
    return watermark.file_plan(files, marks, ["o_custkey"], F.lit("2001-06-15").cast("date"))


@query("""
WITH w AS (SELECT user_id, greatest(min(ts) - INTERVAL 5 MINUTE, TIMESTAMP '2024-01-31' - INTERVAL 29 DAY) AS s FROM events GROUP BY 1),
x AS (SELECT user_id, unnest(generate_series(s, TIMESTAMP '2024-01-31', INTERVAL 2495 MINUTE)) AS a FROM w WHERE s < TIMESTAMP '2024-01-31')
SELECT user_id, a AS window_start, least(a + INTERVAL 2495 MINUTE, TIMESTAMP '2024-01-31' + INTERVAL 5 MINUTE) AS window_end FROM x WHERE a < TIMESTAMP '2024-01-31'""")
def window_plan(spark: SparkSession, d: str) -> DataFrame:
    marks = _table(spark, d, "events").groupBy("user_id").agg(F.min("ts").alias("watermark"))
    end = _ntz("2024-01-31")
    return watermark.window_plan(marks, end, end).select("user_id", "window_start", "window_end")


@query("""
WITH x AS (SELECT event_id, ts, ts + to_seconds((event_id % 600)::INTEGER) - INTERVAL 5 MINUTE AS c, CASE event_id % 4 WHEN 0 THEN 60000 WHEN 1 THEN 300000 WHEN 2 THEN 28800000 ELSE 2678400000 END AS ms FROM events)
SELECT event_id, epoch_us(greatest(ts, c)) + ms * 1000 AS next_us, epoch_us(ts) - ms * 1000 AS start_us FROM x""")
def next_cursor(spark: SparkSession, d: str) -> DataFrame:
    name = F.element_at(F.array(*map(F.lit, ("OneMinute", "FiveMinutes", "EightHour", "OneMonth"))), (F.col("event_id") % 4 + 1).cast("int"))
    e = _table(spark, d, "events").withColumns({"ms": S.interval_ms(name), "cursor": F.timestamp_add("SECOND", F.col("event_id") % 600 - 300, F.col("ts"))})
    return e.select("event_id", S.micros(S.next_cursor(F.col("ts"), F.col("cursor"), F.col("ms"))).alias("next_us"), S.micros(S.request_start(F.col("ts"), F.col("ms"))).alias("start_us"))


# --- universe ---


@query("""
SELECT DISTINCT l_partkey FROM lineitem WHERE l_shipdate < TIMESTAMP '2001-01-01'
EXCEPT SELECT l_partkey FROM lineitem WHERE l_shipdate >= TIMESTAMP '2001-01-01'""")
def delisted(spark: SparkSession, d: str) -> DataFrame:
    rows = _table(spark, d, "lineitem")
    return universe.delisted(rows.where(F.col("l_shipdate") < _ntz("2001-01-01")), rows.where(F.col("l_shipdate") >= _ntz("2001-01-01")), ["l_partkey"])


@query("""
SELECT c_custkey, c_name FROM customer c WHERE NOT EXISTS (SELECT 1 FROM customer x WHERE x.c_acctbal >= 0 AND lower(upper(x.c_name)) = lower(c.c_name))""")
def stale_symbols(spark: SparkSession, d: str) -> DataFrame:
    c = _table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal")
    return universe.stale(c, c.where("c_acctbal >= 0").select(F.upper("c_name").alias("c_name")), "c_name").drop("c_acctbal")


_PART = "CASE WHEN p_partkey % 5 = 0 THEN '1000' ELSE '' END || CASE WHEN p_partkey % 4 = 0 THEN replace(p_name, ' ', '_') ELSE p_name END"


@query(f"""
WITH p AS (SELECT p_partkey, {_PART} AS name, p_size > 10 AS trading, p_type = 'ECONOMY' AS coin, p_brand <> 'Brand#2' AS perpetual FROM part),
q AS (SELECT *, contains(name, 'red') OR contains(name, 'small') AS i, contains(name, '1000') AS k, contains(name, '_') AS u FROM p)
SELECT p_partkey, NOT i AND NOT k AND NOT u AND trading AS spot_ok, NOT i AND NOT k AND NOT u AND trading AND coin AND perpetual AS usd_ok, NOT (i AND NOT k AND NOT u) AND trading AND coin AND perpetual AS coin_ok FROM q""")
def universe_filter(spark: SparkSession, d: str) -> DataFrame:
    p = _table(spark, d, "part").select("p_partkey", F.expr(_PART).alias("name"), F.when(F.col("p_size") > 10, "Trading").otherwise("Break").alias("status"), F.when(F.col("p_type") == "ECONOMY", "Coin").otherwise("Index").alias("underlying"), F.when(F.col("p_brand") == "Brand#2", "NextQuarter").otherwise("Perpetual").alias("contract"))
    ignored, c = ["red", "small"], F.col
    args = c("name"), c("status"), c("underlying"), c("contract"), ignored
    return p.select("p_partkey", P.spot_universe(c("name"), c("status"), ignored).alias("spot_ok"), P.usd_universe(*args).alias("usd_ok"), P.coin_universe(*args).alias("coin_ok"))


@query("SELECT nullif(c_mktsegment, 'MACHINERY') AS segment FROM customer WHERE nullif(c_mktsegment, 'MACHINERY') IS NOT NULL ORDER BY 1")
def column_values(spark: SparkSession, d: str) -> DataFrame:
    c = _table(spark, d, "customer").select(F.nullif(F.col("c_mktsegment"), F.lit("MACHINERY")).alias("segment"))
    return universe.column_values(c, "segment")


# --- quality ---

_ODD = "CASE WHEN c_custkey % 50 = 0 THEN CAST('NaN' AS DOUBLE) WHEN c_custkey % 51 = 0 THEN CAST('Infinity' AS DOUBLE) WHEN c_custkey % 53 = 0 THEN NULL ELSE c_acctbal END"


@query(f"""
WITH c AS (SELECT c_mktsegment, c_nationkey, c_custkey, {_ODD} AS v FROM customer)
SELECT c_mktsegment, count(*)::BIGINT AS n_rows, count(*) FILTER (v IS NULL OR NOT isfinite(v) OR v < 0 OR c_nationkey = 0)::BIGINT AS n_invalid FROM c GROUP BY 1""")
def invalid_trades(spark: SparkSession, d: str) -> DataFrame:
    v, one = F.expr(_ODD), F.lit(1).cast("long")
    rows = _table(spark, d, "customer").select("c_mktsegment", F.col("c_custkey").alias("agg_trade_id"), v.alias("price"), v.alias("quantity"), one.alias("first_trade_id"), one.alias("last_trade_id"), F.col("c_nationkey").cast("long").alias("transact_time"), F.lit(True).alias("is_buyer_maker"))
    return quality.row_counts(rows, ["c_mktsegment"], P.invalid_trade(), [])


@query("""
SELECT l_returnflag, count(*)::BIGINT AS n_rows, count(*) FILTER (l_discount < 0.02 OR l_quantity > 45)::BIGINT AS n_invalid FROM lineitem GROUP BY 1""")
def invalid_depths(spark: SparkSession, d: str) -> DataFrame:
    rows = _table(spark, d, "lineitem").select("l_returnflag", S.millis(F.col("l_shipdate")).alias("snapshot_time"), (F.col("l_discount").cast("decimal(10,2)") - F.lit("0.02").cast("decimal(10,2)")).alias("percentage"), F.when(F.col("l_quantity") <= 45, F.col("l_quantity")).otherwise(F.lit(float("nan"))).alias("depth"), F.col("l_extendedprice").alias("notional"))
    return quality.row_counts(rows, ["l_returnflag"], P.invalid_depth(), [])


@query("""
SELECT l_orderkey, 'l_tax' AS column_name, count(*)::BIGINT AS n_rows FROM lineitem GROUP BY 1 HAVING count(*) = count(*) FILTER (l_tax = 0)
UNION ALL SELECT l_orderkey, 'l_discount', count(*)::BIGINT FROM lineitem GROUP BY 1 HAVING count(*) = count(*) FILTER (l_discount = 0)""")
def all_zero_columns(spark: SparkSession, d: str) -> DataFrame:
    return quality.all_zero_columns(_table(spark, d, "lineitem"), ["l_orderkey"], ["l_tax", "l_discount"])


_MISSING = """
p AS (SELECT DISTINCT user_id::VARCHAR AS symbol, ts::DATE AS day FROM events),
g AS (SELECT symbol, unnest(generate_series(min(day), max(day), INTERVAL 1 DAY))::DATE AS day FROM p GROUP BY 1),
x AS (SELECT symbol, day FROM g ANTI JOIN p USING (symbol, day))"""


@query(f"WITH {_MISSING} SELECT symbol, day AS missing_day FROM x")
def missing_days(spark: SparkSession, d: str) -> DataFrame:
    return quality.missing_days(_trades(spark, d, "user_id"), ["symbol"], "transact_time", DAY_US)


_SAMPLE = """
s AS (SELECT symbol, count(*)::BIGINT AS n_missing, string_agg(strftime(day, '%Y-%m-%d'), ', ' ORDER BY day) FILTER (rn <= 3) || CASE WHEN count(*) > 3 THEN ', ...' ELSE '' END AS sample
  FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY day) AS rn FROM x) GROUP BY 1)"""


@query(f"WITH {_MISSING}, {_SAMPLE} SELECT * FROM s")
def missing_days_sample(spark: SparkSession, d: str) -> DataFrame:
    return quality.missing_day_samples(_trades(spark, d, "user_id"), ["symbol"], "transact_time", DAY_US, 3)


_REPORT = f"""
WITH {_MISSING}, {_SAMPLE},
u AS (SELECT c_custkey::VARCHAR AS symbol FROM customer UNION SELECT user_id::VARCHAR FROM events),
c AS (SELECT user_id::VARCHAR AS symbol, count(*) AS n, count(*) FILTER (value < 20) AS b, count(*) FILTER (value - value = 0) AS z, bool_or(event_id % 1499 = 0) AS f FROM events GROUP BY 1),
r AS (SELECT symbol, coalesce(n, 0)::BIGINT AS n_rows, CASE WHEN f THEN 0 ELSE coalesce(b, 0) END::BIGINT AS n_invalid, CASE WHEN n = z AND NOT f THEN 'quantity' ELSE '' END AS zero_columns,
  CASE WHEN f THEN 0 ELSE coalesce(n_missing, 0) END::BIGINT AS n_missing, CASE WHEN f THEN '' ELSE coalesce(sample, '') END AS missing_sample, coalesce(f, false) AS failed, n IS NULL AS is_empty FROM u LEFT JOIN c USING (symbol) LEFT JOIN s USING (symbol)),
q AS (SELECT *, is_empty OR n_invalid > 0 OR zero_columns <> '' OR n_missing > 0 AS has_issue FROM r)"""


def _report(spark: SparkSession, d: str) -> DataFrame:
    rows = _trades(spark, d, "user_id").withColumns({"price": F.col("price") - 20, "quantity": F.col("quantity") - F.col("quantity")})
    every = _table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("symbol")).unionByName(rows.select("symbol"))
    kind = DATA_TYPES["agg_trades"]
    return quality.integrity_report(every, rows, ["symbol"], P.invalid_trade(), kind.checked, kind.time, kind.units_per_day, 3, unreadable=F.col("agg_trade_id") % 1499 == 0)


@query(f"{_REPORT} SELECT * FROM q")
def quality_report(spark: SparkSession, d: str) -> DataFrame:
    return _report(spark, d)


@query(f"""{_REPORT}
SELECT count(*)::BIGINT AS n_tables, count(*) FILTER (has_issue)::BIGINT AS n_with_issues, count(*) FILTER (is_empty)::BIGINT AS n_empty, sum(n_missing)::BIGINT AS n_missing_days,
  sum(n_invalid)::BIGINT AS n_invalid_rows, count(*) FILTER (zero_columns <> '')::BIGINT AS n_zero_columns, count(*) FILTER (failed)::BIGINT AS n_failed FROM q""")
def quality_summary(spark: SparkSession, d: str) -> DataFrame:
    return quality.summary(_report(spark, d))


@query("""
WITH l AS (SELECT user_id, event_id, CASE WHEN event_type = 'click' THEN epoch_us(ts) // 1000 ELSE epoch_us(ts) END AS t FROM events),
f AS (SELECT user_id, arg_min(t, event_id) AS t FROM l GROUP BY 1)
SELECT user_id, length(t::VARCHAR)::INTEGER AS digits, CASE WHEN user_id % 2 = 0 THEN 'us' ELSE 'ms' END AS expected_unit FROM f
WHERE CASE WHEN user_id % 2 = 0 THEN length(t::VARCHAR) NOT IN (16, 17) ELSE length(t::VARCHAR) NOT IN (13, 14) END""")
def time_unit_anomaly(spark: SparkSession, d: str) -> DataFrame:
    t = F.when(F.col("event_type") == "click", S.millis(F.col("ts"))).otherwise(S.micros(F.col("ts")))
    lines = _table(spark, d, "events").select("user_id", "event_id", F.concat_ws(",", F.col("event_id").cast("string"), F.lit("1.5,2"), F.lit("1,2"), t.cast("string"), F.lit("true")).alias("line"))
    period = F.when(F.col("user_id") % 2 == 0, F.lit("2025-01-01")).otherwise(F.lit("2024-12-01")).cast("date")
    return quality.time_unit_anomalies(lines, ["user_id"], "line", "event_id", S.source_unit(F.lit("Spot"), period))


# --- times and names ---


@query("SELECT event_id, CASE WHEN event_id % 2 = 0 THEN epoch_us(ts) // 1000 * 1000 ELSE epoch_us(ts) END AS t, epoch_us(ts) // 1000 AS ms FROM events")
def time_normalise(spark: SparkSession, d: str) -> DataFrame:
    mixed = F.when(F.col("event_id") % 2 == 0, S.millis(F.col("ts"))).otherwise(S.micros(F.col("ts")))
    return _table(spark, d, "events").select("event_id", S.repaired_micros(mixed).alias("t"), S.millis(S.from_millis(S.millis(F.col("ts")))).alias("ms"))


_NAMED = """CASE o_orderkey % 4 WHEN 0 THEN 'BTCUSDT-aggTrades-' || {day} || '.zip' WHEN 1 THEN 'BTCUSDT-aggTrades-' || {month} || '.zip' WHEN 2 THEN {day} || '.csv' ELSE 'BTC-USDT-trades-' || {month} END"""


@query(f"""
WITH o AS (SELECT o_orderkey, (o_orderdate + INTERVAL 312 MONTH)::DATE AS d FROM orders),
p AS (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN d WHEN 2 THEN NULL ELSE date_trunc('month', d)::DATE END AS period,
  {_NAMED.format(day="strftime(d, '%Y-%m-%d')", month="strftime(d, '%Y-%m')")} AS name FROM o)
SELECT o_orderkey, name, period, o_orderkey % 4 = 0 AS daily,
  CASE WHEN o_orderkey % 3 = 0 AND coalesce(period, DATE '9999-01-01') >= DATE '2025-01-01' THEN 'us' ELSE 'ms' END AS unit,
  starts_with(name, 'BTCUSDT-') AND ends_with(name, '.zip') AND o_orderkey % 4 = 0 AND coalesce(period BETWEEN DATE '2022-01-01' AND DATE '2024-06-30', false) AS in_window FROM p""")
def period_and_unit(spark: SparkSession, d: str) -> DataFrame:
    day = F.add_months(F.col("o_orderdate").cast("date"), 312)
    o = _table(spark, d, "orders").select("o_orderkey", F.date_format(day, "yyyy-MM-dd").alias("day"), F.date_format(day, "yyyy-MM").alias("month"))
    o = o.withColumn("name", F.expr(_NAMED.format(day="day", month="month")))
    market = F.when(F.col("o_orderkey") % 3 == 0, "Spot").otherwise("UsdFutures")
    period, name = S.file_period(F.col("name")), F.col("name")
    inside = P.archive_in_window(name, F.lit("BTCUSDT-"), True, F.lit("2022-01-01").cast("date"), F.lit("2024-06-30").cast("date"))
    return o.select("o_orderkey", "name", period.alias("period"), S.is_daily(name).alias("daily"), S.source_unit(market, period).alias("unit"), inside.alias("in_window"))


@query("SELECT user_id, '[' || string_agg(DISTINCT '\"' || event_type || '\"', ',' ORDER BY '\"' || event_type || '\"') || ']' AS types FROM events GROUP BY 1")
def json_list(spark: SparkSession, d: str) -> DataFrame:
    e = _table(spark, d, "events").groupBy("user_id").agg(F.array_sort(F.collect_set("event_type")).alias("types"))
    return e.select("user_id", S.json_list(F.col("types")).alias("types"))


# --- projections ---


@query("SELECT l_orderkey, l_linenumber, l_quantity, l_tax, CASE WHEN l_tax <> 0 THEN l_quantity / l_tax END AS ratio FROM lineitem")
def taker_ratio(spark: SparkSession, d: str) -> DataFrame:
    return _table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_tax", S.ratio_or_null(F.col("l_quantity"), F.col("l_tax")).alias("ratio"))


@query("""
SELECT o_orderkey::VARCHAR AS symbol, epoch_ms(o_orderdate) AS open_time, o_totalprice AS open_price, o_totalprice + 1 AS high_price, o_totalprice - 1 AS low_price, o_totalprice AS close_price,
  o_custkey::DOUBLE AS volume, epoch_ms(o_orderdate) + 59999 AS close_time, o_totalprice AS quote_volume, (o_custkey % 1000)::INTEGER AS trade_count, 1.5::DOUBLE AS taker_buy_base_volume, 2.5::DOUBLE AS taker_buy_quote_volume FROM orders""")
def kline_projection(spark: SparkSession, d: str) -> DataFrame:
    price, opened = F.col("o_totalprice").cast("string").cast("decimal(18,2)"), F.col("o_orderdate")
    number = lambda x: F.lit(x).cast("decimal(18,8)")
    rows = _table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("symbol"), opened.alias("open_time"), price.alias("open_price"), (price + 1).alias("high_price"), (price - 1).alias("low_price"), price.alias("close_price"), F.col("o_custkey").cast("decimal(18,0)").alias("volume"), F.timestamp_add("MILLISECOND", F.lit(59999), opened).alias("close_time"), price.alias("quote_volume"), (F.col("o_custkey") % 1000).alias("trade_count"), number("1.5").alias("taker_buy_base_volume"), number("2.5").alias("taker_buy_quote_volume"))
    return projections.klines(rows, ["symbol"])


@query("""
WITH o AS (SELECT o_orderkey::VARCHAR AS symbol, o_orderdate AS x, CASE WHEN o_orderpriority <> '1-URGENT' THEN o_orderdate END AS n, o_custkey::DOUBLE AS a, (o_custkey % 7)::DOUBLE AS b FROM orders)
SELECT 'funding_rate' AS kind, symbol, epoch_ms(x) AS t, a AS first, NULL::DOUBLE AS second FROM o
UNION ALL SELECT 'open_interest', symbol, epoch_ms(n), a, b FROM o WHERE n IS NOT NULL
UNION ALL SELECT 'top_position_ratio', symbol, epoch_ms(n), a, b FROM o WHERE n IS NOT NULL
UNION ALL SELECT 'taker_ratio_usd', symbol, epoch_ms(x), a, NULL FROM o
UNION ALL SELECT 'taker_ratio_coin', symbol, epoch_ms(n), CASE WHEN b <> 0 THEN round(a / b, 18) END, b FROM o WHERE n IS NOT NULL AND (a % 7) * 0 = 0
UNION ALL SELECT 'basis', symbol, epoch_ms(x), a, NULL FROM o
UNION ALL SELECT 'index_price_kline', symbol, epoch_ms(x), a, b FROM o""")
def futures_projections(spark: SparkSession, d: str) -> DataFrame:
    o = _table(spark, d, "orders")
    a, b = F.col("o_custkey").cast("decimal(20,8)"), (F.col("o_custkey") % 7).cast("decimal(20,8)")
    always, some = F.col("o_orderdate"), F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_orderdate"))

    def part(kind: str, projection: Callable[..., DataFrame], columns: dict[str, Column], t: str, first: str, second: str | None) -> DataFrame:
        rows = projection(o.select(F.col("o_orderkey").cast("string").alias("symbol"), *(c.alias(n) for n, c in columns.items())), ["symbol"])
        return rows.select(F.lit(kind).alias("kind"), "symbol", F.col(t).alias("t"), F.col(first).alias("first"), (F.col(second) if second else F.lit(None).cast("double")).alias("second"))

    null = F.lit(None).cast("decimal(20,8)")
    volumes = {"buy_volume": a, "sell_volume": b}
    return landed.concatenated(
        [
            part("funding_rate", projections.funding_rates, {"funding_time": always, "funding_rate": a, "mark_price": null}, "funding_time", "rate", "mark_price"),
            part("open_interest", projections.open_interest, {"timestamp": some, "sum_open_interest": a, "sum_open_interest_value": b}, "timestamp", "sum_open_interest", "sum_open_interest_value"),
            part("top_position_ratio", projections.top_position_ratios, {"timestamp": some, "long_short_ratio": a, "long_account": b, "short_account": b}, "timestamp", "long_short_ratio", "long_account"),
            part("taker_ratio_usd", projections.taker_ratios_usd, {"timestamp": always, "buy_sell_ratio": a, **volumes}, "timestamp", "buy_sell_ratio", "buy_volume_value"),
            part("taker_ratio_coin", projections.taker_ratios_coin, {"timestamp": some, **volumes, "buy_volume_value": a, "sell_volume_value": b}, "timestamp", "buy_sell_ratio", "sell_volume"),
            part("basis", projections.basis, {"timestamp": always, "futures_price": a, "index_price": b, "basis_value": b, "basis_rate": b, "annualized_basis_rate": null}, "timestamp", "futures_price", "annualized_basis_rate"),
            part("index_price_kline", projections.index_price_klines, {"open_time": always, "close_time": always, "open_price": a, "high_price": b, "low_price": b, "close_price": b}, "open_time", "open_price", "close_price"),
        ]
    )


@query("""
SELECT p_partkey, p_name AS name, replace(p_name, ' ', '|') AS order_types, CASE WHEN p_size % 3 = 0 THEN p_name ELSE p_brand END AS pair,
  CASE WHEN p_type = 'ECONOMY' THEN 'CurrentQuarter' ELSE 'Perpetual' END AS contract_type FROM part""")
def symbol_info_projection(spark: SparkSession, d: str) -> DataFrame:
    none = F.lit(None).cast("string")
    listed = F.split("p_name", " ")
    filled = {"name": F.col("p_name"), "order_types": listed, "time_in_force": listed, "underlying_sub_type": listed, "pair": F.when(F.col("p_size") % 3 == 0, F.lit("  ")).otherwise(F.col("p_brand")), "contract_type": F.when(F.col("p_type") == "ECONOMY", "currentQUARTER").otherwise(F.col("p_type")), "delivery_date": _ntz("2024-01-01"), "listing_date": _ntz("2024-01-01")}
    rows = _table(spark, d, "part").select("p_partkey", *(filled.get(f, none).alias(f) for f in projections.FUTURES_FIELDS))
    out = projections.futures_symbols(rows, ["p_partkey"])
    return out.select("p_partkey", "name", "order_types", S.pair_or_name(F.col("pair"), F.col("name")).alias("pair"), S.contract_type(F.col("contract_type")).alias("contract_type"))


# --- parsing ---


def _lines(df: DataFrame, line: Column) -> DataFrame:
    return df.select(F.lit("f").alias("file"), F.lit("f").alias("name"), F.struct(F.lit(0).alias("block"), F.col("event_id").alias("row")).alias("place"), line.alias("line"))


@query("""
SELECT event_id AS row, CASE WHEN event_id % 97 <> 0 THEN event_id END AS agg_trade_id, value AS price, epoch_us(ts) // 1000 * 1000 AS transact_time, CASE WHEN event_id % 89 <> 0 THEN event_id % 2 = 0 END AS is_buyer_maker,
  CASE WHEN event_id % 101 = 0 THEN 'fields: 8' WHEN event_id % 97 = 0 THEN 'agg_trade_id' WHEN event_id % 89 = 0 THEN 'is_buyer_maker' END AS reject FROM events""")
def parse_trades(spark: SparkSession, d: str) -> DataFrame:
    e = _table(spark, d, "events")
    i = F.col("event_id")
    flag = F.when(i % 89 == 0, "yes").otherwise(F.when(i % 2 == 0, " True").otherwise("FALSE"))
    line = F.concat_ws(",", F.when(i % 97 == 0, "1.0").otherwise(i.cast("string")), F.col("value").cast("string"), F.lit("1"), F.lit("2"), F.lit("3"), S.millis(F.col("ts")).cast("string"), flag, F.when(i % 101 == 0, "x"))
    rows = landed.parse_trades(_lines(e, line), F.lit("UsdFutures"), F.lit("ms"))
    return rows.select(F.col("place.row").alias("row"), "agg_trade_id", "price", "transact_time", "is_buyer_maker", "reject")


@query("""
SELECT event_id AS row, CASE WHEN event_id % 97 <> 0 THEN epoch_ms(date_trunc('second', ts)) END AS snapshot_time, CASE WHEN event_id % 89 <> 0 THEN (event_id % 500 - 250) / 100 END::DECIMAL(10, 2) AS percentage, value AS depth,
  CASE WHEN event_id % 97 = 0 THEN 'snapshot_time' WHEN event_id % 89 = 0 THEN 'percentage' WHEN event_id % 83 = 0 THEN 'notional' END AS reject FROM events""")
def parse_depth(spark: SparkSession, d: str) -> DataFrame:
    e, i = _table(spark, d, "events"), F.col("event_id")
    at = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    cents = ((i % 500 - 250).cast("decimal(12,0)") / F.lit(100)).cast("decimal(10,2)").cast("string")
    line = F.concat_ws(",", F.when(i % 97 == 0, F.concat(at, F.lit("Z"))).otherwise(at), F.when(i % 89 == 0, F.concat(cents, F.lit("1"))).otherwise(cents), F.col("value").cast("string"), F.when(i % 83 == 0, "").otherwise("7.5"))
    return landed.parse_depth(_lines(e, line)).select(F.col("place.row").alias("row"), "snapshot_time", "percentage", "depth", "reject")
