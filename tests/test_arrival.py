"""Arriving files in any order of landing give what their periods' order gives."""

import itertools
import random

import pytest
from market_helpers import rows
from pyspark.sql import functions as F

from tidemark.operators import merge
from tidemark.schemas import DATA_TYPES
from tidemark.sources import landed, tables
from tidemark.streaming import arrival

TRADES = DATA_TYPES["agg_trades"]
MS = 1_700_000_000_000
#: Name -> (id, milliseconds after the start): overlapping tails, keys that move, cut and come back.
FILES = {
    "BTC-aggTrades-2023-11-14.csv": [(1, 0), (2, 1), (3, 2), (4, 9), (5, 10)],
    "BTC-aggTrades-2023-11-15.csv": [(4, 5), (6, 6), (1, 20), (7, 21)],
    "BTC-aggTrades-2023-11-16.csv": [(8, 15), (2, 16)],
    "BTC-aggTrades-2023-11-17.csv": [(9, 12), (6, 13), (10, 30)],
}


def _land(folder, names, files=FILES):
    folder.mkdir(exist_ok=True)
    for i, name in enumerate(names):
        (folder / name).write_text("".join(f"{k},{i + 1}.0,1.0,1,1,{MS + t},true\n" for k, t in files[name]))


def _want(spark, files=FILES):
    order = {n: i for i, n in enumerate(sorted(files))}
    df = spark.createDataFrame([(n.split("-")[0], k, (MS + t) * 1000, order[n], i) for n in files for i, (k, t) in enumerate(files[n])], "symbol string, id long, t long, f int, line int")
    out = merge.replace_tails(df.limit(0), df, ["symbol"], ["id"], "t", "f", "line")
    return rows(out.select("symbol", "id", "t"))


def _got(spark, table):
    return rows(tables.read(spark, str(table), TRADES).select("symbol", "agg_trade_id", "transact_time"))


def _ingest(spark, folder, names, table, batch=0):
    lines = landed.csv_lines(spark, [str(folder / n) for n in names])
    arrival.ingest_trades(lines, str(table), "UsdFutures", batch)


@pytest.mark.parametrize("order", random.Random(1).sample(list(itertools.permutations(range(4))), 2) + [(3, 2, 1, 0)])
def test_any_order_of_landing(spark, tmp_path, order):
    names, land, table = sorted(FILES), tmp_path / "land", tmp_path / "table"
    _land(land, names)
    for k, i in enumerate(order):
        _ingest(spark, land, [names[i]], table, k)
    assert _got(spark, table) == _want(spark)
    _ingest(spark, land, [names[order[1]]], table, 9)  # a replay
    assert _got(spark, table) == _want(spark)
    seen = arrival.ledger(spark, str(table))
    assert rows(seen.select("name", "first_time")) == sorted((n, (MS + min(t for _, t in FILES[n])) * 1000) for n in FILES)


def test_a_replay_after_a_crash_between_table_and_ledger(spark, tmp_path, monkeypatch):
    names, land, table = sorted(FILES), tmp_path / "land", tmp_path / "table"
    _land(land, names)
    _ingest(spark, land, [names[0], names[3]], table)
    with monkeypatch.context() as m:
        m.setattr(arrival.hashlib, "sha256", lambda *_: (_ for _ in ()).throw(OSError("crash")))
        with pytest.raises(OSError):
            _ingest(spark, land, [names[1]], table)
    _ingest(spark, land, [names[1]], table)
    _ingest(spark, land, [names[2]], table)
    assert _got(spark, table) == _want(spark)


def test_streams_of_several_symbols_with_a_late_file(spark, tmp_path):
    files = FILES | {n.replace("BTC", "Ä +TH"): x for n, x in FILES.items()}
    land, table, state = tmp_path / "land", tmp_path / "table", tmp_path / "state"
    late = ["BTC-aggTrades-2023-11-15.csv", "Ä +TH-aggTrades-2023-11-14.csv", "Ä +TH-aggTrades-2023-11-16.csv"]
    batches = []
    for names in ([n for n in files if n not in late], late, []):
        _land(land, names, files)
        arrival.start_ingestion(spark, str(land), str(table), "UsdFutures", str(state), batches.append).awaitTermination()
    assert batches == [0, 1] and _got(spark, table) == _want(spark, files)
    assert rows(arrival.ledger(spark, str(table)).groupBy("batch").agg(F.count("*"))) == [(0, 5), (1, 3)]


def test_a_landed_file_that_is_gone_is_an_error(spark, tmp_path):
    names, land, table = sorted(FILES), tmp_path / "land", tmp_path / "table"
    _land(land, names)
    _ingest(spark, land, [names[2]], table)
    (land / names[2]).unlink()
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        _ingest(spark, land, [names[0]], table)
    assert _got(spark, table) == [("BTC", 2, (MS + 16) * 1000), ("BTC", 8, (MS + 15) * 1000)]
