import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from market_helpers import rows

from tidemark.operators import merge, watermark

KLINE = "close_time long, close double"


def test_upsert_replaces_only_equal_keys(spark):
    target = spark.createDataFrame([(1999, 100.0), (2999, 200.0), (3999, 300.0)], KLINE)
    incoming = spark.createDataFrame([(2999, 222.0), (3999, 333.0), (4999, 444.0)], KLINE)
    assert rows(merge.upsert(target, incoming, ["close_time"])) == [(1999, 100.0), (2999, 222.0), (3999, 333.0), (4999, 444.0)]


def test_upsert_of_nothing_changes_nothing(spark):
    target = spark.createDataFrame([(1, 1.0)], KLINE)
    assert rows(merge.upsert(target, target.limit(0), ["close_time"])) == [(1, 1.0)]
    assert rows(merge.upsert(target.limit(0), target, ["close_time"])) == [(1, 1.0)]


def test_unknown_key_and_duplicate_keys_fail(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 2.0)], KLINE)
    with pytest.raises(ValueError):
        merge.upsert(df, df, ["missing"])
    with pytest.raises(merge.DuplicateKeys):
        merge.require_unique(df, ["close_time"])
    assert rows(merge.duplicate_report(df, ["close_time"])) == [(2, 1)]
    assert rows(merge.duplicate_report(df.limit(0), ["close_time"])) == [(0, 0)]


def test_null_keys_never_match_in_upsert(spark):
    target = spark.createDataFrame([(None, 1.0), (1, 1.0)], KLINE)
    incoming = spark.createDataFrame([(None, 2.0)], KLINE)
    assert len(merge.upsert(target, incoming, ["close_time"]).collect()) == 3


def test_last_wins_keeps_columns_and_order(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, None, 2), (2, "c", 1)], "k int, v string, line int")
    assert rows(merge.last_wins(df, ["k"], ["line"])) == [(1, None, 2), (2, "c", 1)]


def _loop(table, files):
    """One file after the other, literally."""
    table = list(table)
    for f in files:
        start = min(t for _, t, _ in f)
        last = {k: (k, t, v) for k, t, v in f}
        table = [r for r in table if (r[1] is None or r[1] < start) and r[0] not in last]
        table += last.values()
    return sorted(table, key=repr)


ROW = st.tuples(st.integers(0, 6), st.integers(0, 12), st.integers(0, 99))
OLD = st.tuples(st.one_of(st.none(), st.integers(0, 6)), st.one_of(st.none(), st.integers(0, 12)), st.integers(0, 99))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(OLD, max_size=6), st.lists(st.lists(ROW, min_size=1, max_size=5), min_size=1, max_size=4))
def test_many_tails_at_once_equal_a_loop(spark, table, files):
    target = spark.createDataFrame([("s", *r) for r in table], "symbol string, k int, t int, v int")
    lines = [("s", *r, i + 1, n) for i, f in enumerate(files) for n, r in enumerate(f)]
    incoming = spark.createDataFrame(lines, "symbol string, k int, t int, v int, seq int, line int")
    out = merge.replace_tails(target, incoming, ["symbol"], ["k"], "t", "seq", "line")
    assert sorted((tuple(r)[1:] for r in out.collect()), key=repr) == _loop(table, files)


def test_replacing_the_same_tail_twice_changes_nothing(spark):
    target = spark.createDataFrame([("s", i, i * 10, i) for i in range(5)], "symbol string, k int, t int, v int")
    file = spark.createDataFrame([("s", 3, 25, 9, 1), ("s", 3, 26, 8, 2)], "symbol string, k int, t int, v int, line int")
    once = merge.replace_tail(target, file, ["symbol"], ["k"], "t", ["line"])
    assert rows(once) == [("s", 0, 0, 0), ("s", 1, 10, 1), ("s", 2, 20, 2), ("s", 3, 26, 8)]
    assert rows(merge.replace_tail(once, file, ["symbol"], ["k"], "t", ["line"])) == rows(once)


def test_backfill_only_where_there_is_no_time(spark):
    target = spark.createDataFrame([("a", 1, 10, 1), ("b", 1, None, 1)], "symbol string, k int, t int, v int")
    legacy = spark.createDataFrame([("a", 2, 20, 2, 1, 1), ("b", 2, 20, 2, 1, 1), ("b", 2, 21, 3, 2, 1)], "symbol string, k int, t int, v int, seq int, line int")
    assert rows(merge.backfill(target, legacy, ["symbol"], ["k"], "t", "seq", "line")) == [("a", 1, 10, 1), ("b", 1, None, 1), ("b", 2, 21, 3)]


def test_watermark_filters_and_missing(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 5, "x"), ("b", 3, None)], "s string, t long, c string")
    assert rows(watermark.watermarks(df, ["s"], "t", {"c": None})) == [("a", 1), ("b", 3)]
    assert rows(watermark.watermarks(df, ["s"], "t", {"c": "y"})) == []
    with pytest.raises(ValueError):
        watermark.require_rows(df.select("s"), watermark.file_min_times(df.where("s = 'a'"), ["s"], "t"), ["s"])


def test_complete_files_are_reused(spark):
    plan = spark.createDataFrame([("x.zip",), ("y.zip",)], "name string")
    verified = spark.createDataFrame([("x.zip", "valid"), ("y.zip", "mismatch")], "name string, status string")
    assert rows(watermark.reuse_complete(plan, verified)) == [("y.zip",)]


def test_last_wins_by_either_plan(spark):
    df = spark.createDataFrame([(k, v, t) for k in (1, 2, None) for v, t in (("a", 1), (None, 3), ("c", 3), ("z", None))], "k int, v string, t int")
    for combine in (True, False):
        out = merge.last_wins(df, ["k"], ["t"], combine)
        assert rows(out) == [(1, "c", 3), (2, "c", 3), (None, "c", 3)] and out.columns == df.columns
        plan = out._jdf.queryExecution().executedPlan().toString()
        below = plan[plan.index("Exchange hashpartitioning") :]
        assert ("Sort" in below and "WindowGroupLimit" in below) == combine
