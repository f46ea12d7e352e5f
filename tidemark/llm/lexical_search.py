"""Ranked lexical search by pipelined term partitioning.

Terms have owners by weight, the heaviest first. A bundle of items carries sparse accumulators of one block of
documents through the owners' stages; each stage cogroups bundles with the owner's postings of the same block
and adds integer contributions. Between stages every item's tenth best sum over all blocks is a bound: what
cannot reach it with all terms to come is left behind. The last stage gives what is left its document ids, and
the best are selected. Bounds are exact, so no result depends on them.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import release, stored

#: Fixed value: terms of the UTF-8 bytes, of which only A-Z are lower-cased.
TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
SLICE_BYTES = 1 << 20
_BREAK = re.compile(rb"[^0-9A-Za-z\x80-\xff]")
#: Documents of a block, and items of a bundle: they bound what one cogrouped pair holds.
BLOCK_BITS, BUNDLE_ITEMS = 12, 512
#: Owners by weight: a document frequency of about N/400, N/33 and N/4.5 and less; the rest are the last's.
OWNERS = (6000, 3500, 1500)
#: Rows of the output of a task are cut into Arrow batches of so many documents.
_BATCH = 256


def term_counts(text: str | None) -> Counter:
    """Occurrences of each term of a whole text, slice by slice."""
    data, at, found = (text or "").encode(), 0, Counter()
    while at < len(data):
        cut = _BREAK.search(data, min(at + SLICE_BYTES, len(data)))
        to = cut.start() if cut else len(data)
        found.update(TERM.findall(data[at:to].lower()))
        at = to
    return found


def _counted(df: DataFrame, id_type) -> DataFrame:
    """(row, id, n, terms, tfs) of rows with a term. The empty term, once a row, stands for the row itself."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, _BATCH):
                batch = whole.slice(at, _BATCH)
                terms, tfs, ends, ns, rows = [], [], [0], [], []
                for i, text in enumerate(batch.column(2)):
                    found = term_counts(text.as_py())
                    if found:
                        rows.append(i)
                        ns.append(found.total())
                        terms += [b"", *found]
                        tfs += [1, *found.values()]
                        ends.append(len(terms))
                at_ = pa.array(ends, pa.int32())
                lists = [pa.ListArray.from_arrays(at_, pa.array(terms, pa.binary()).cast(pa.string())), pa.ListArray.from_arrays(at_, pa.array(tfs, pa.int64()))]
                yield pa.RecordBatch.from_arrays([*(c.take(pa.array(rows, pa.int64())) for c in batch.columns[:2]), pa.array(ns, pa.int64()), *lists], names=["row", "id", "n", "terms", "tfs"])

    return df.mapInArrow(count, f"row long, id {id_type}, n long, terms array<string>, tfs array<long>")


def _numbered(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))


def _exploded(df: DataFrame) -> DataFrame:
    return df.select("row", "id", "n", F.explode(F.arrays_zip("terms", "tfs")).alias("x")).select("row", "id", "n", F.col("x.terms").alias("term"), F.col("x.tfs").alias("tf"))


def _bundles(items: DataFrame, size: int) -> DataFrame:
    """(bundle, slot, item, term): items dealt into bundles of at most ``size``. A partition's items
    follow each other, so numbers are made from the counts of the partitions, not in one task."""
    part = F.shiftright("row", 33)
    before, starts = 0, []
    for p in items.where("term = ''").groupBy(part.alias("part")).agg(F.max("row").alias("last")).orderBy("part").collect():  # one row a partition of the items
        starts.append((p.part, before))
        before += (p["last"] & ((1 << 33) - 1)) + 1
    offsets = items.sparkSession.createDataFrame(starts, "part long, before long")
    number = F.col("before") + F.col("row").bitwiseAND((1 << 33) - 1)
    out = items.where("term != ''").withColumn("part", part).join(F.broadcast(offsets), "part").withColumn("number", number)
    return out.select(F.floor(F.col("number") / size).cast("long").alias("bundle"), (F.col("number") % size).cast("int").alias("slot"), F.col("id").alias("item"), "term")


def _stage(state: pa.Table, postings: pa.Table, k: int, bits: int) -> pa.Table:
    """One bundle and block at owner ``k``: its accumulators after the owner's contributions."""
    row = {c: state.column(c)[0] for c in state.column_names}
    get = lambda c: row[c].values.to_numpy(zero_copy_only=False)
    # postings of each term, one after the other
    terms, local, gain = (postings.column(c).to_numpy() for c in ("term_id", "local", "gain"))
    order = np.argsort(terms, kind="stable")
    terms, local, gain = terms[order], local[order], gain[order]
    mine = get("pair_owner") == k
    slot, term = get("pair_slot")[mine], get("pair_term")[mine]
    low, high = np.searchsorted(terms, term, "left"), np.searchsorted(terms, term, "right")
    slots, bound = get("slots"), get("bound")
    now, later = get(f"left_{k}"), get(f"left_{k + 1}")
    acc_slot, acc_local, acc_sum = get("acc_slot"), get("acc_local"), get("acc_sum")
    pair_at, acc_at = np.searchsorted(slot, [slots, slots + 1]), np.searchsorted(acc_slot, [slots, slots + 1])
    sums, outs, tops = np.zeros(1 << bits, np.int64), [], []
    for j, s in enumerate(slots.tolist()):
        sums[:] = 0
        a, b = acc_at[0][j], acc_at[1][j]
        sums[acc_local[a:b]] = acc_sum[a:b]
        known = sums > 0
        for p in range(pair_at[0][j], pair_at[1][j]):
            sums[local[low[p] : high[p]]] += gain[low[p] : high[p]]  # a document has a term's posting once
        if now[j] < bound[j]:
            sums[~known] = 0  # no document that has nothing yet can reach the bound
        kept = np.flatnonzero((sums > 0) & (sums + later[j] >= bound[j]))
        best = sums[kept]
        outs.append((np.full(len(kept), s, np.int32), kept.astype(np.int32), best))
        best = np.sort(best)[: -row["top"].as_py() - 1 : -1]
        tops.append((np.full(len(best), s, np.int32), best))
    rest = get("pair_owner") > k
    lists = {"pair_slot": get("pair_slot")[rest], "pair_term": get("pair_term")[rest], "pair_owner": get("pair_owner")[rest]}
    lists |= dict(zip(("acc_slot", "acc_local", "acc_sum"), (np.concatenate(x) for x in zip(*outs, strict=True)), strict=True))
    lists |= dict(zip(("top_slot", "top_sum"), (np.concatenate(x) for x in zip(*tops, strict=True)), strict=True))
    # numbers may be null by the declared type, whatever the plan knows of them
    types = {f.name: pa.list_(pa.field("element", f.type.value_type)) if pa.types.is_list(f.type) else f.type for f in state.schema}
    return pa.table({c: pa.array([lists[c]], t) if c in lists else state.column(c).cast(t) for c, t in types.items()})


def _visit(k: int, bits: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    return lambda state, postings: _stage(state, postings, k, bits)


_STATE = "bundle long, block long, top int, slots array<int>, bound array<long>, {left}, pair_slot array<int>, pair_term array<long>, pair_owner array<int>, acc_slot array<int>, acc_local array<int>, acc_sum array<long>, top_slot array<int>, top_sum array<long>"


def search(docs: DataFrame, items: DataFrame, top: int = 10, text_col: str = "text", id_col: str = "doc_id", item_col: str = "item_id", item_text: str = "text", owners: Sequence[int] = OWNERS, block_bits: int = BLOCK_BITS, bundle_items: int = BUNDLE_ITEMS) -> DataFrame:
    """(item_col, rank int, id_col, score long): each item's ``top`` documents with a score above 0, equal
    scores by ascending id (null ids last).

    Each row is a document or an item of its own, so that repeated rows, ids and null ids are ranked row by row;
    null, empty and termless texts match nothing and count for nothing; items that match nothing have no rows;
    without documents or items the result is empty; other columns are not read. Texts are read once and never
    shuffled; postings of the items' terms are.
    """
    id_type, item_type = docs.schema[id_col].dataType.simpleString(), items.schema[item_col].dataType.simpleString()
    wanted = stored(_exploded(_counted(_numbered(items, item_col, item_text), item_type)), "search-items")
    vocabulary = stored(wanted.select("term").union(wanted.sparkSession.createDataFrame([("",)], "term string")).distinct().select("term", F.when(F.col("term") == "", -1).otherwise(F.monotonically_increasing_id()).alias("term_id")), "search-terms")
    # Spark broadcasts the vocabulary if its files are below spark.sql.autoBroadcastJoinThreshold, else it shuffles both sides
    postings = stored(_exploded(_counted(_numbered(docs, id_col, text_col), id_type)).join(vocabulary, "term").select("row", "id", "n", "tf", "term_id"), "search-postings")
    schema = f"{item_col} {item_type}, rank int, {id_col} {id_type}, score long"
    corpus = postings.where("term_id = -1").agg(F.count(F.lit(1)).alias("N"), F.sum("n").alias("L")).first()
    if not corpus.N:
        return docs.sparkSession.createDataFrame([], schema)
    part = F.expr(f"(1000000000L * tf) div (1000L * tf + 8L * (10L + (90L * n * {corpus.N}L) div {corpus.L}L))")
    terms = postings.where("term_id >= 0").groupBy("term_id").agg(F.count(F.lit(1)).alias("df"), F.max(part).alias("most"))
    w = F.floor(1000 * F.log((2.0 * corpus.N + 2) / (2.0 * F.col("df") + 1))).cast("long")
    last = len(owners)
    owner = F.coalesce(*(F.when(F.col("w") >= least, k) for k, least in enumerate(owners)), F.lit(last))
    terms = terms.withColumn("w", w).where("w > 0").withColumns({"most": F.col("w") * F.col("most"), "owner": owner})
    pairs = _bundles(wanted, bundle_items).join(vocabulary, "term").join(terms, "term_id")
    pairs = stored(pairs.select("bundle", "slot", "item", "term_id", "owner", "w", "most"), "search-pairs")

    # what each item can still gain from owner k on, and its terms by slot
    left = [F.sum(F.when(F.col("owner") >= k, F.col("most")).otherwise(0)).alias(f"left_{k}") for k in range(last + 2)]
    slots = pairs.groupBy("bundle", "slot").agg(*left).groupBy("bundle").agg(F.array_sort(F.collect_list(F.struct("slot", *(f"left_{k}" for k in range(last + 2))))).alias("s"))
    terms_of = pairs.groupBy("bundle").agg(F.array_sort(F.collect_list(F.struct("slot", "term_id", "owner"))).alias("p"))  # bounded by the bundle's items
    bundles = slots.join(terms_of, "bundle")
    owned = pairs.select("bundle", "term_id", "owner", "w").distinct()
    dealt = postings.join(owned, "term_id").select("bundle", F.shiftright("row", block_bits).alias("block"), "term_id", "owner", F.col("row").bitwiseAND((1 << block_bits) - 1).cast("int").alias("local"), (part * F.col("w")).alias("gain"))
    routes = dealt.select("bundle", "block").distinct()
    ddl = _STATE.format(left=", ".join(f"left_{k} array<long>" for k in range(last + 2)))
    none = {c: F.array().cast(t) for c, t in (("acc_slot", "array<int>"), ("acc_local", "array<int>"), ("acc_sum", "array<long>"), ("top_slot", "array<int>"), ("top_sum", "array<long>"))}
    first = routes.join(bundles, "bundle").select(
        "bundle", "block", F.lit(top).alias("top"), F.col("s.slot").alias("slots"), F.transform("s", lambda _: F.lit(0).cast("long")).alias("bound"), *(F.col(f"s.left_{k}").alias(f"left_{k}") for k in range(last + 2)),
        F.col("p.slot").alias("pair_slot"), F.col("p.term_id").alias("pair_term"), F.col("p.owner").alias("pair_owner"), *(c.alias(n) for n, c in none.items()),
    )
    held = state = stored(first, "search-bundles")
    for k in range(last + 1):
        mine = dealt.where(F.col("owner") == k).select("bundle", "block", "term_id", "local", "gain")
        summed = stored(state.groupBy("bundle", "block").cogroup(mine.groupBy("bundle", "block")).applyInArrow(_visit(k, block_bits), ddl), f"search-{k}")
        release(held)
        held, state = summed, summed.drop("bound").join(_bounds(summed, top), "bundle").select(*summed.columns)
    found = _selected(state, postings, block_bits)
    names = pairs.select("bundle", "slot", "item").distinct()
    best = Window.partitionBy("bundle", "slot").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.join(names, ["bundle", "slot"]).select(F.col("item").alias(item_col), F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score")


def _bounds(state: DataFrame, top: int) -> DataFrame:
    """(bundle, bound): the sum that each slot's ``top``-th best document has by now, or 0."""
    best = state.select("bundle", F.explode(F.arrays_zip("top_slot", "top_sum")).alias("x")).select("bundle", F.col("x.top_slot").alias("slot"), F.col("x.top_sum").alias("sum"))
    nth = best.withColumn("r", F.row_number().over(Window.partitionBy("bundle", "slot").orderBy(F.desc("sum")))).where(F.col("r") <= top)
    nth = nth.where(F.col("r") == top).groupBy("bundle").agg(F.map_from_entries(F.collect_list(F.struct("slot", "sum"))).alias("m"))  # one entry a slot of the bundle
    slots = state.groupBy("bundle").agg(F.first("slots").alias("slots"))
    return slots.join(nth, "bundle", "left").select("bundle", F.transform("slots", lambda s: F.coalesce(F.try_element_at("m", s), F.lit(0).cast("long"))).alias("bound"))


def _selected(state: DataFrame, postings: DataFrame, bits: int) -> DataFrame:
    """(bundle, slot, id, score) of all accumulators that reach the last bound."""
    bound = F.get(F.col("bound"), F.array_position("slots", F.col("x.acc_slot")).cast("int") - 1)
    left = state.select("bundle", "block", "slots", "bound", F.explode(F.arrays_zip("acc_slot", "acc_local", "acc_sum")).alias("x")).where(F.col("x.acc_sum") >= bound)
    rows = left.select("bundle", F.col("x.acc_slot").alias("slot"), F.col("x.acc_sum").alias("score"), (F.shiftleft("block", bits) + F.col("x.acc_local")).alias("row"))
    return rows.join(postings.where("term_id = -1").select("row", "id"), "row").select("bundle", "slot", "id", "score")
