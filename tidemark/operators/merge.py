"""Last-wins deduplication, keyed upsert, and tail replacement, for all symbols of a batch at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.predicates import before_tail


class DuplicateKeys(ValueError):
    """A batch holds a key twice where each may come once."""


def last_wins(df: DataFrame, keys: Sequence[str], order: Sequence[str], combine: bool = True) -> DataFrame:
    """The row of each key that is last in ``order``, then in its other columns. Null keys form a key of their
    own. With ``combine``, Spark sorts and cuts each task's groups to one row before the shuffle, so a key
    that holds a large share of the rows sends one row a task; without, rows are sorted once, after the
    shuffle, which is the faster way for keys that repeat only as often as files overlap."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    latest = Window.partitionBy(*(F.col(f"`{c}`") for c in keys)).orderBy(*(F.desc_nulls_last(F.col(f"`{c}`")) for c in [*order, *rest]))
    first = F.row_number().over(latest) == 1 if combine else F.lag(F.lit(1)).over(latest).isNull()
    return df.withColumn("__first", first).where("__first").drop("__first")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that come more than once, with their number."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def duplicate_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: the batch's rows and how many are left after deduplication."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.count(F.lit(1)).alias("n_unique"))


def require_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df``, once it is known that no key comes twice; else an error, before anything is written."""
    first = duplicate_keys(df, keys).head(1)
    if first:
        raise DuplicateKeys(f"{first[0].asDict()} comes more than once")
    return df


def without_keys(target: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key is not among the incoming ones; a null in a key never matches."""
    missing = [k for k in keys if k not in target.columns or k not in incoming.columns]
    if missing:
        raise ValueError(f"unknown key columns: {missing}")
    return target.join(incoming.select(*keys), list(keys), "left_anti")


def upsert(target: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The table after incoming rows have replaced those of equal keys. ``incoming`` must hold each key
    once (``require_unique``, or ``last_wins`` first); an empty one changes nothing."""
    return without_keys(target, incoming, keys).unionByName(incoming.select(*target.columns))


def append_import(target: DataFrame, incoming: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Import of a file without tail deletion: equal keys are replaced by the file's last row of them."""
    # distinct keys instead of the deduplicated rows: a hash aggregation without the other columns
    return without_keys(target, incoming.select(*keys).distinct(), keys).unionByName(last_wins(incoming, keys, order, combine=False).select(*target.columns))  # one file, or a few


def replace_tail(target: DataFrame, incoming: DataFrame, groups: Sequence[str], keys: Sequence[str], time: str, order: Sequence[str]) -> DataFrame:
    """The table after one file a group has replaced everything from its first time on (null times stay),
    and its keys wherever they stand."""
    starts = incoming.groupBy(*groups).agg(F.min(time).alias("__from"))
    kept = target.join(starts, list(groups), "left").where(before_tail(F.col(time), F.col("__from"))).drop("__from")
    return append_import(kept.select(*target.columns), incoming, [*groups, *keys], order)


def replace_tails(target: DataFrame, incoming: DataFrame, groups: Sequence[str], keys: Sequence[str], time: str, file_seq: str, line: str) -> DataFrame:
    """The table after the files of each group, in the order of ``file_seq``, have each replaced the tail
    from their own first time on: the same as ``replace_tail`` file by file, without a loop.

    A key keeps the row of the latest file that holds it, and that row stays if its time is before the
    first time of every later file. A row superseded by a later file is gone even where the later row is
    cut off in turn, so deduplication comes before the cut. Rows of the table with a null in their key, and
    keys repeated in the table that no file holds, stay.
    """
    all_keys = [*groups, *keys]
    latest = last_wins(incoming, all_keys, [file_seq, line], combine=False)
    # one row a file: small next to the data
    firsts = incoming.groupBy(*groups, file_seq).agg(F.min(time).alias("__min"))
    later = Window.partitionBy(*groups).orderBy(file_seq).rowsBetween(1, Window.unboundedFollowing)
    cuts = firsts.select(*groups, file_seq, F.min("__min").over(later).alias("__from"))
    new = latest.join(cuts, [*groups, file_seq], "left").where(before_tail(F.col(time), F.col("__from")))
    old = without_keys(target, incoming.select(*all_keys).distinct(), all_keys)
    old = old.join(firsts.groupBy(*groups).agg(F.min("__min").alias("__from")), list(groups), "left").where(before_tail(F.col(time), F.col("__from")))
    return old.select(*target.columns).unionByName(new.select(*target.columns))


def backfill(target: DataFrame, legacy: DataFrame, groups: Sequence[str], keys: Sequence[str], time: str, file_seq: str, line: str) -> DataFrame:
    """Legacy files, in order and without tail deletion, for groups that have no time in the table yet."""
    known = target.groupBy(*groups).agg(F.max(time).alias("__max")).where("__max IS NOT NULL").select(*groups)
    fresh = legacy.join(known, list(groups), "left_anti")
    return append_import(target, fresh, [*groups, *keys], [file_seq, line])
