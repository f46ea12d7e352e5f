"""Stored tables: discovery, replacement, partition-scoped rewriting, copies, splits, layout, export.

Tables are Parquet, partitioned by market, symbol and month. There is no MERGE: a rewrite reads only the
partitions that may hold its keys, writes their new rows beside them, and commits which rows make up each
partition (``versions``). Many writers and readers can work on a table at once: a reader keeps the version it
began with, and a writer whose partitions have changed meanwhile starts again.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.scalars import from_micros, from_millis
from ..operators import quality
from ..operators.merge import replace_tail, replace_tails, require_unique, upsert
from ..schemas import DataType
from . import versions
from .scratch import release, stored
from .versions import Change, Part, Parts, Place, Snapshot

PARTITIONS = ("market", "symbol", "month")
#: Rows of a row group of the high-volume types; fixed value. Others keep Parquet's default.
LARGE_GROUP_ROWS = 524_288
#: Legacy tables that one commit takes over.
SPLIT_TABLES = 64


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = versions.fs(spark, path)
    return fs.exists(target)


def remove_path(spark: SparkSession, path: str) -> None:
    """Missing paths are no error."""
    fs, target = versions.fs(spark, path)
    fs.delete(target, True)


def partition_path(spark: SparkSession, market: str, symbol: str, month: str | None = None) -> str:
    """The folder of a partition below its data folder, its values escaped as Spark writes them."""
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    names = zip(PARTITIONS, (market, symbol, month) if month else (market, symbol), strict=False)
    return "/".join(f"{n}={escape(v) if v else '__HIVE_DEFAULT_PARTITION__'}" for n, v in names)


def table_names(spark: SparkSession, database: str | None = None) -> list[str]:
    """Tables of a database in the order of their names; none if it does not exist."""
    if database and not spark.catalog.databaseExists(database):
        return []
    return sorted(t.name for t in spark.catalog.listTables(database) if not t.isTemporary)


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def copy_table(spark: SparkSession, source: str, target: str) -> bool:
    """Create the target, replacing it, from the source; False if there is no source. The copy is made beside
    the target and then takes its name, so a copy that fails leaves the old target as it was."""
    if not table_exists(spark, source):
        return False
    mark = uuid.uuid4().hex[:8]
    staged, aside = f"{target}__new_{mark}", f"{target}__old_{mark}"
    try:
        spark.table(source).write.saveAsTable(staged)
    except Exception:
        drop_table(spark, staged)
        raise
    old = table_exists(spark, target)
    if old:
        spark.sql(f"ALTER TABLE {target} RENAME TO {aside}")
    try:
        spark.sql(f"ALTER TABLE {staged} RENAME TO {target}")
    except Exception:
        if old:
            spark.sql(f"ALTER TABLE {aside} RENAME TO {target}")
        drop_table(spark, staged)
        raise
    drop_table(spark, aside)
    return True


def discover(spark: SparkSession, root: str) -> DataFrame | None:
    """Distinct (market, symbol) of a data type's table, ordered whatever their case; None if it is missing.
    Names come from the table's version, without reading data."""
    found = versions.snapshot(spark, root)
    if not found.version:
        return None
    names = sorted({p[:2] for p in found.parts}, key=lambda p: ((p[1] or "").lower(), p[1] or "", p[0] or ""))
    return spark.createDataFrame(names, "market string, symbol string")


def places(found: Snapshot) -> list[tuple]:
    """(market, symbol, month, rows, min_time, max_time, min_key, max_key) of each part of a version."""
    return [(*p, x.rows, *(x.time or (None, None)), *(x.key or (None, None))) for p, parts in found.parts.items() for x in parts]


def partition_stats(spark: SparkSession, path: str) -> DataFrame:
    """What is known of the parts of each partition, without reading data: names, rows, and the least and
    greatest time and key. Row counts and watermarks of a stored table follow from it."""
    return spark.createDataFrame(places(versions.snapshot(spark, path)), "market string, symbol string, month string, n_rows long, min_time long, max_time long, min_key long, max_key long")


def stored_watermarks(spark: SparkSession, path: str) -> DataFrame:
    """(market, symbol, watermark, n_rows) of a stored table, from its log alone; symbols without a time have
    no watermark."""
    return partition_stats(spark, path).groupBy("market", "symbol").agg(F.max("max_time").alias("watermark"), F.sum("n_rows").alias("n_rows"))


def month_of(kind: DataType, time: str | None = None) -> Column:
    """Partition value of a row: its UTC month; rows without a time share one."""
    stamp = (from_micros if kind.unit == "us" else from_millis)(F.col(time or kind.time))
    return F.coalesce(F.date_format(stamp, "yyyy-MM"), F.lit("none"))


def laid_out(df: DataFrame, kind: DataType) -> DataFrame:
    """Rows by partition, sorted by time and key within, so that row groups cover narrow time ranges. Small
    partitions share a task, and a large one (a busy symbol's month) is split over several."""
    df = df if "month" in df.columns else df.withColumn("month", month_of(kind))
    order = list(dict.fromkeys([*PARTITIONS, kind.time, *kind.key]))
    # the optimizer strikes constants, such as one market's name, from a sort; the writer then no longer finds the
    # order it needs and puts its own, by partition alone, in this one's place
    either = (F.hash(*order[len(PARTITIONS) :]) < 0).cast("int")
    df = df.withColumns({p: F.get(F.array(p, p), either) for p in PARTITIONS})
    return df.hint("rebalance", *PARTITIONS).sortWithinPartitions(*order)


def _writer(df: DataFrame, kind: DataType):
    writer = laid_out(df, kind).write.partitionBy(*PARTITIONS)
    if kind.large:
        writer = writer.option("parquet.block.row.count.limit", LARGE_GROUP_ROWS).option("maxRecordsPerFile", 16 * LARGE_GROUP_ROWS)
    return writer


def _schema(kind: DataType) -> StructType:
    return StructType.fromDDL(f"{kind.columns}, market string, symbol string, month string")


def _folders(spark: SparkSession, path: str, found: Snapshot, wanted: Iterable[Place] | None) -> list[str]:
    """The folders of the wanted partitions; a data folder that is wanted whole is one folder."""
    chosen = found.parts if wanted is None else {p: found.parts[p] for p in wanted if p in found.parts}
    each: dict[tuple[str, int], set[Place]] = {}
    for p, parts in chosen.items():
        for x in parts:
            each.setdefault((x.data, x.among), set()).add(p)
    whole = [f"{path}/v={data}" for (data, among), some in each.items() if len(some) == among]
    return whole + [f"{path}/v={data}/{partition_path(spark, *p)}" for (data, among), some in each.items() if len(some) < among for p in sorted(some, key=str)]


def _frame(spark: SparkSession, path: str, kind: DataType, found: Snapshot, wanted: Iterable[Place] | None = None, tolerant: bool = False, data: bool = False) -> DataFrame:
    folders = _folders(spark, path.rstrip("/"), found, wanted)
    schema = _schema(kind).add("v", "string")
    names = schema.names if data else _schema(kind).names
    if not folders:
        return spark.createDataFrame([], schema).select(*names)
    reader = spark.read.schema(schema).option("basePath", path.rstrip("/"))
    if tolerant:
        reader = reader.option("ignoreCorruptFiles", "true").option("ignoreMissingFiles", "true")
    rows = reader.parquet(*folders)
    return rows.select(*names)


def read(spark: SparkSession, path: str, kind: DataType, version: int | None = None) -> DataFrame:
    """The table with its declared columns, as it is now or was at a version; an absent one is empty. Commits
    after the call do not change what the result reads."""
    return _frame(spark, path, kind, versions.snapshot(spark, path, version))


def integrity_report(spark: SparkSession, path: str, kind: DataType, invalid: Column, universe: DataFrame | None = None, **checks) -> DataFrame:
    """``quality.integrity_report`` of a stored table by (market, symbol), which goes on where files cannot be
    read: their rows are passed over, and a symbol with fewer rows than its commits wrote has failed. One scan
    finds the failures and gives the report of the rest."""
    found = versions.snapshot(spark, path)
    rows = _frame(spark, path, kind, found, tolerant=True)
    known = spark.createDataFrame([r[:4] for r in places(found)], "market string, symbol string, month string, n long").groupBy("market", "symbol").agg(F.sum("n").alias("n_expected"))
    universe = known if universe is None else universe
    return quality.integrity_report(universe, rows, ["market", "symbol"], invalid, kind.checked, kind.time, kind.units_per_day, expected=known, **checks)


def incremental_report(spark: SparkSession, path: str, kind: DataType, invalid: Column, name: str, universe: DataFrame | None = None, **checks) -> DataFrame:
    """``integrity_report`` that reads only what has been written since the last one of that ``name``.

    Counts by day are kept for every part of a partition; parts never change, so only new ones are scanned,
    and counts of parts that no longer belong to the table are left out. Counts of a part that could not be
    read whole are not kept. Other rules for ``invalid`` need another name."""
    found = versions.snapshot(spark, path)
    folder = f"{path.rstrip('/')}/_reports/{name}"
    part = ["v", "market", "symbol", "month"]
    needed = spark.createDataFrame([(x.data, *p, x.rows) for p, parts in found.parts.items() for x in parts], "v string, market string, symbol string, month string, n_expected long")
    kept = spark.read.parquet(f"{folder}/*") if path_exists(spark, folder) else None
    known = {tuple(r) for r in kept.select(*part).distinct().collect()} if kept is not None else set()  # one row a part
    fresh = {p: tuple(x for x in parts if (x.data, *p) not in known) for p, parts in found.parts.items()}
    rows = _frame(spark, path, kind, Snapshot(found.version, {p: x for p, x in fresh.items() if x}), tolerant=True, data=True)
    new = stored(quality.daily_counts(rows, part, invalid, kind.checked, kind.time, kind.units_per_day), "report-counts")
    whole = new.groupBy(*part).agg(F.sum("n_rows").alias("n")).join(needed, part).where("n = n_expected").select(*part)
    new.join(whole, part, "left_semi").coalesce(1).write.parquet(f"{folder}/{uuid.uuid4().hex}")
    every = new if kept is None else new.unionByName(kept.join(needed, part, "left_semi").select(*new.columns))
    groups = ["market", "symbol"]
    sums = [F.sum(c).alias(c) for c in new.columns if c not in (*part, "__day", "failed")]
    daily = every.groupBy(*groups, "__day").agg(*sums, F.max("failed").alias("failed"))
    expected = needed.groupBy(*groups).agg(F.sum("n_expected").alias("n_expected"))
    return quality.report_of(expected if universe is None else universe, daily, groups, kind.checked, expected=expected, **checks)


def fragmented(found: Snapshot, small_rows: int) -> list[Place]:
    """Partitions with more than one part, where parts are small or overlap in time."""
    out = []
    for p, parts in found.parts.items():
        spans = sorted(x.time for x in parts if x.time)
        overlap = any(b[0] <= a[1] for a, b in zip(spans, spans[1:], strict=False))
        if len(parts) > 1 and (overlap or sum(x.rows < small_rows for x in parts) > 1):
            out.append(p)
    return out


def compact_table(spark: SparkSession, path: str, kind: DataType, small_rows: int = LARGE_GROUP_ROWS, rows_at_once: int = 1 << 31) -> int:
    """Rewrite partitions that appends have left in small or overlapping parts, each in time order and in the
    table's layout; gives their number. Partitions are taken in commits of about ``rows_at_once`` rows, and
    one that other writers change meanwhile is looked at again."""
    done = 0
    todo = set(fragmented(versions.snapshot(spark, path), small_rows))
    while todo:
        taken: list[Place] = []

        def attempt(found: Snapshot, taken: list = taken) -> Change | None:
            taken.clear()
            rows = 0
            for p in (p for p in fragmented(found, small_rows) if p in todo):
                if taken and rows >= rows_at_once:
                    break
                taken.append(p)
                rows += sum(x.rows for x in found.parts[p])
            return rewrite(_frame(spark, path, kind, found, taken), taken, taken, path, kind) if taken else None

        if versions.transact(spark, path, attempt) is None:
            break
        done += len(taken)
        todo -= set(taken)
    return done


def _write(df: DataFrame, path: str, kind: DataType) -> tuple[str, Parts]:
    """Write rows to a data folder of their own; gives its name and what each partition there holds."""
    spark, data, key, time = df.sparkSession, f"c{uuid.uuid4().hex}", kind.key[0], kind.time
    columns = [*kind.schema.names, "market", "symbol", *(["month"] if "month" in df.columns else [])]
    staged = f"{path.rstrip('/')}/v={data}"
    try:
        _writer(df.select(*columns), kind).parquet(staged)
        rows = spark.read.schema(_schema(kind)).parquet(staged).groupBy(*PARTITIONS)
        found = rows.agg(F.count(F.lit(1)).alias("n"), F.min(time).alias("t0"), F.max(time).alias("t1"), F.min(key).alias("k0"), F.max(key).alias("k1")).collect()  # one row a partition written
    except Exception:
        versions.discard(spark, path, data)
        raise

    def ends(low: int | None, high: int | None) -> tuple[int, int] | None:
        return None if low is None or high is None else (low, high)

    return data, {(r.market, r.symbol, r.month): (Part(data, len(found), r.n, ends(r.t0, r.t1), ends(r.k0, r.k1)),) for r in found}


def replace(df: DataFrame, path: str, kind: DataType, unique: bool = True) -> None:
    """Replace the whole table in one commit. Keys are checked after the rows have been written and before
    they belong to the table. No rows leave an empty table."""
    spark = df.sparkSession
    data, parts = _write(df, path, kind)
    try:
        if unique:
            require_unique(_frame(spark, path, kind, Snapshot(0, parts)), ["market", "symbol", *kind.key])
    except Exception:
        versions.discard(spark, path, data)
        raise
    versions.transact(spark, path, lambda _: Change(set=parts, replace=True, data=data))


def append(df: DataFrame, path: str, kind: DataType) -> None:
    """Add rows with the declared columns, whatever other writers do."""
    data, parts = _write(df, path, kind)
    versions.transact(df.sparkSession, path, lambda _: Change(add=parts, data=data))


def rewrite(result: DataFrame, touched: Iterable[Place], reads: Iterable[tuple], path: str, kind: DataType) -> Change:
    """The change that replaces the ``touched`` partitions by their rows of ``result``, which holds no other
    rows; partitions without rows go. It depends on ``reads``: partitions, or whole symbols."""
    data, parts = _write(result, path, kind)
    touched = set(touched)
    if stray := set(parts) - touched:
        versions.discard(result.sparkSession, path, data)
        raise ValueError(f"rows of partitions that are not rewritten: {sorted(stray, key=str)[:3]}")
    return Change(set={p: parts.get(p, ()) for p in touched}, reads=frozenset(reads), data=data)


def vacuum(spark: SparkSession, path: str, keep: int = 1, orphan_hours: float = 168) -> int:
    """Delete the files that only versions before the last ``keep`` hold; gives the number of folders."""
    return versions.vacuum(spark, path, lambda p: partition_path(spark, *p), keep, orphan_hours)


def _values(rows: DataFrame) -> set[Place]:
    """Distinct partition values: names of symbols and months, whose number does not grow with the rows."""
    return {tuple(r) for r in rows.select(*PARTITIONS).distinct().collect()}


def _moved(spark: SparkSession, path: str, incoming: DataFrame, kind: DataType, found: Snapshot, symbols: set[tuple]) -> set[Place]:
    """Partitions that hold an incoming key now. A key with the time in it is in its own month; others are
    looked for among those partitions of their symbols whose range of keys has an incoming one."""
    if kind.time in kind.key:
        return set()
    key = kind.key[0]
    ranges = [(*r[:3], *r[6:]) for r in places(found) if r[:2] in symbols and r[6] is not None]
    if not ranges:
        return set()
    keys = incoming.select("market", "symbol", *kind.key).distinct()
    known = spark.createDataFrame(ranges, "market string, symbol string, month string, low long, high long")
    near = _values(keys.join(known, ["market", "symbol"]).where(F.col(key).between(F.col("low"), F.col("high"))))
    return _values(_frame(spark, path, kind, found, near).join(keys, ["market", "symbol", *kind.key], "left_semi")) if near else set()


def _held(incoming: DataFrame, kind: DataType, more: Sequence[str] = ()) -> DataFrame:
    """Incoming rows, evaluated once: every attempt and every use of them sees the same rows."""
    columns = list(dict.fromkeys([*kind.schema.names, "market", "symbol", *more]))
    return stored(incoming.select(*columns, month_of(kind).alias("month")), "incoming")


def upsert_table(spark: SparkSession, incoming: DataFrame, path: str, kind: DataType) -> None:
    """Keyed upsert of a stored table. A key that comes twice is an error before anything is written; no
    rows change nothing, and make no table. Only partitions that hold an old or a new row of an incoming
    key are read and written. Of two upserts at once that touch the same partition, or the same symbol where
    the key does not hold the time, the later one is done again from the earlier one's result."""
    new, keys = _held(incoming, kind), ["market", "symbol", *kind.key]
    try:
        own = _values(new)
        if not own:
            return
        require_unique(new, keys)
        symbols = {p[:2] for p in own}

        def attempt(found: Snapshot) -> Change:
            touched = own | _moved(spark, path, new, kind, found, symbols)
            result = upsert(_frame(spark, path, kind, found, touched), new, keys)
            return rewrite(result, touched, touched if kind.time in kind.key else symbols, path, kind)

        versions.transact(spark, path, attempt)
    finally:
        release(new)


def replace_tail_table(spark: SparkSession, incoming: DataFrame, path: str, kind: DataType, order: Sequence[str]) -> None:
    """Tail replacement of a stored table by one file a symbol."""
    _rewrite_tails(spark, incoming, path, kind, order, lambda target, new: replace_tail(target, new, ["market", "symbol"], list(kind.key), kind.time, order))


def replace_tails_table(spark: SparkSession, incoming: DataFrame, path: str, kind: DataType, file_seq: str, line: str) -> None:
    """Tail replacement of a stored table by many files a symbol, in the order of ``file_seq``."""
    _rewrite_tails(spark, incoming, path, kind, [file_seq, line], lambda target, new: replace_tails(target, new, ["market", "symbol"], list(kind.key), kind.time, file_seq, line))


def _rewrite_tails(spark: SparkSession, incoming: DataFrame, path: str, kind: DataType, more: Sequence[str], change: Callable[[DataFrame, DataFrame], DataFrame]) -> None:
    """``change`` the partitions from each symbol's first incoming month on, and those that hold its keys. A
    symbol's tail depends on all its partitions."""
    new = _held(incoming, kind, more)
    try:
        own = _values(new)
        if not own:
            return
        first: dict[tuple, str] = {}
        for p in sorted(own, key=str):
            first[p[:2]] = min(first.get(p[:2], p[2]), p[2])

        def attempt(found: Snapshot) -> Change:
            touched = own | {p for p in found.parts if p[:2] in first and p[2] != "none" and p[2] >= first[p[:2]]}
            touched |= _moved(spark, path, new, kind, found, set(first))
            return rewrite(change(_frame(spark, path, kind, found, touched), new), touched, first, path, kind)

        versions.transact(spark, path, attempt)
    finally:
        release(new)


def split_shared(spark: SparkSession, names: Sequence[str], market: str, path: str, kind: DataType) -> int:
    """Move legacy tables, one a symbol, into the partitioned table, then drop them; gives their number. A
    commit takes over ``SPLIT_TABLES`` of them. A symbol's legacy table replaces what the partitioned one holds
    of it, so that doing it again after a crash changes nothing."""
    found = [n for n in names if table_exists(spark, n)]
    symbol = {n: n.rsplit(".", 1)[-1].upper() for n in found}
    for at in range(0, len(found), SPLIT_TABLES):
        group = found[at : at + SPLIT_TABLES]
        each = [spark.table(n).select(*kind.schema.names).withColumns({"market": F.lit(market), "symbol": F.lit(symbol[n])}) for n in group]
        data, parts = _write(reduce(DataFrame.unionByName, each), path, kind)
        own = frozenset((market, symbol[n]) for n in group)

        def attempt(state: Snapshot, own: frozenset = own, parts: Parts = parts) -> Change:
            return Change(set={p: parts.get(p, ()) for p in {*parts, *(p for p in state.parts if p[:2] in own)}}, reads=own)

        versions.transact(spark, path, attempt)
        for name in group:
            drop_table(spark, name)
    return len(found)


def drop_symbols(spark: SparkSession, gone: DataFrame, path: str) -> int:
    """Remove the partitions of symbols, in any case, of (market, symbol) rows; gives the number of symbols.
    Their files go with the next ``vacuum``, when no reader needs them."""
    if not versions.snapshot(spark, path).version:
        return 0
    names = {(r.market, r.symbol.lower()) for r in gone.where("symbol IS NOT NULL").select("market", "symbol").distinct().collect()}  # names of symbols
    here: set[tuple] = set()

    def attempt(found: Snapshot) -> Change | None:
        left = {p for p in found.parts if (p[0], (p[1] or "").lower()) in names}
        here.clear()
        here.update(p[:2] for p in left)
        return Change(set=dict.fromkeys(left, ()), reads=frozenset(here)) if left else None

    versions.transact(spark, path, attempt)
    return len(here)


def sql_over(spark: SparkSession, views: dict[str, DataFrame], statement: str) -> DataFrame:
    """The result of an SQL statement over the frames, by the names given; the names end with the call."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    try:
        return spark.sql(statement)
    finally:
        for name in views:
            spark.catalog.dropTempView(name)


def export_snapshot(spark: SparkSession, path: str, target: str, kind: DataType) -> DataFrame | None:
    """Copy a table to a snapshot, replacing an older one, and give (name, length, sha256, line) of its
    files; None if there is no table. A failed copy leaves nothing."""
    found = versions.snapshot(spark, path)
    if not found.version:
        return None
    try:
        _frame(spark, path, kind, found).write.mode("overwrite").parquet(target)
    except Exception:
        remove_path(spark, target)
        raise
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(target)
    name = F.element_at(F.split("path", "/"), -1)
    digest = F.upper(F.sha2("content", 256))
    return files.select(name.alias("name"), "length", digest.alias("sha256"), F.concat(digest, F.lit(" *"), name).alias("line"))


