"""Quality rules as a short-circuit cascade.

Each measure's cost and the texts that each rule rejects are found on a small sample. Rules are then tried
in the order of rejections per cost, where both count only what a rule adds to those before it: texts that
are still there, and measures that are not yet made. A text's first rejection spares it all measures that
only later rules need. Only built-in SQL functions are used. The order never changes which texts are kept.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import stored

#: Fixed value: words are what lies between these characters.
SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]+"


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE), "")


def _dup_lines(text: Column) -> tuple[Column, Column]:
    """(lines with a word, how many of them equal an earlier line)"""
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return F.size(lines).cast("long"), (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def _sorted_windows(words: Column) -> Column:
    """(hash of three words, position), sorted; empty with fewer than three words."""
    hashed = F.transform(words, lambda w, i: F.struct(F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.alias("i")))
    return F.sort_array(F.slice(hashed, 1, F.greatest(F.size(words) - 2, F.lit(0))))


def _repeated_at(windows: Column) -> Column:
    """Positions of the windows whose hash is found at least twice, in order."""
    found = F.filter(windows, lambda x, k: F.coalesce((x["h"] == F.get(windows, k - 1)["h"]) | (x["h"] == F.get(windows, k + 1)["h"]), (x["h"] == F.get(windows, k - 1)["h"]), (x["h"] == F.get(windows, k + 1)["h"]), F.lit(False)))
    return F.array_sort(F.transform(found, lambda x: x["i"]))


def _covered(at: Column) -> Column:
    """Words in the union of the three-word windows at the given positions."""
    return F.aggregate(F.transform(at, lambda p, k: F.least(F.lit(3), F.coalesce(F.get(at, k + 1) - p, F.lit(3)))), F.lit(0).cast("long"), lambda a, n: a + n)


def _once(value: Column) -> Column:
    """``value``, so that the optimizer can neither copy its expression into the places that use it nor push
    a filter on such a place below it: inside a lambda it would be made anew for every element."""
    return F.when(F.spark_partition_id() >= 0, value)


#: How each measure is made, in steps: a step's columns may use those of the steps before it.
_STEPS: list[dict] = [
    {"text": lambda: F.coalesce(F.col("text"), F.lit(""))},
    {"words": lambda: _once(_words(F.col("text")))},
    {"n_words": lambda: F.size("words").cast("long"), "windows": lambda: _once(_sorted_windows(F.col("words")))},
    {"at": lambda: _once(_repeated_at(F.col("windows")))},
    {
        "n_repeat_words": lambda: _covered(F.col("at")),
        "word_chars": lambda: F.char_length(F.array_join("words", "")).cast("long"),
        "n_symbols": lambda: (F.char_length("text") - F.char_length(F.regexp_replace("text", SYMBOLS, ""))).cast("long"),
        "n_upper": lambda: (F.char_length("text") - F.char_length(F.regexp_replace("text", r"\p{Lu}+", ""))).cast("long"),
        "n_lines": lambda: _dup_lines(F.col("text"))[0],
        "n_dup_lines": lambda: _dup_lines(F.col("text"))[1],
    },
]
_NEEDS = {"n_words": ["words"], "windows": ["words"], "at": ["windows"], "n_repeat_words": ["at"], "word_chars": ["words"], "words": ["text"], "n_symbols": ["text"], "n_upper": ["text"], "n_lines": ["text"], "n_dup_lines": ["text"], "text": []}
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_lines")


def _closure(measures: Sequence[str]) -> set[str]:
    """Measures, and what they are made from."""
    need, todo = set(), list(measures)
    while todo:
        need.add(m := todo.pop())
        todo += _NEEDS[m]
    return need


def _made(df: DataFrame, names: set[str], unless: str | None = None) -> DataFrame:
    """``df`` with the named columns; where the column ``unless`` is not null they are null, and not made."""
    for step in _STEPS:
        columns = {n: make() if unless is None else _once(F.when(F.col(unless).isNull(), make())) for n, make in step.items() if n in names}
        df = df.withColumns(columns) if columns else df
    return df


def _source(docs: DataFrame, text_col: str, keep: Sequence[str]) -> tuple[DataFrame, list[Column]]:
    """The text and ``keep`` under names of their own, and the columns that give ``keep`` back."""
    kept = [f"__kept_{i}" for i in range(len(keep))]
    df = docs.select(F.col(f"`{text_col}`").alias("text"), *(F.col(f"`{c}`").alias(k) for c, k in zip(keep, kept, strict=True)))
    return df, [F.col(k).alias(c) for c, k in zip(keep, kept, strict=True)]


def measured(docs: DataFrame, measures: Sequence[str], text_col: str, keep: Sequence[str] = ()) -> DataFrame:
    """``keep`` and the measures of each whole text (null: empty), computing only what they need."""
    df, kept = _source(docs, text_col, keep)
    return _made(df, _closure(measures)).select(*kept, *measures)


@dataclass(frozen=True)
class Rule:
    """A text is rejected where ``rejects`` is true; it is an expression over ``measures``."""

    name: str
    rejects: str
    measures: tuple[str, ...]


#: The production rules; the first two are the base that the report states on its own.
BASE_RULES = (
    Rule("few_words", "n_words < 50", ("n_words",)),
    Rule("repeated_words", "100 * n_repeat_words > 50 * n_words", ("n_words", "n_repeat_words")),
)
RULES = (
    *BASE_RULES,
    Rule("symbols", "100 * n_symbols > 10 * n_words", ("n_words", "n_symbols")),
    Rule("upper_case", "100 * n_upper > 30 * word_chars", ("n_upper", "word_chars")),
    Rule("repeated_lines", "100 * n_dup_lines > 50 * n_lines", ("n_dup_lines", "n_lines")),
    Rule("long_words", "word_chars > 12 * n_words", ("word_chars", "n_words")),
)


@dataclass(frozen=True)
class Estimate:
    """What a rule adds after those before it: seconds for the sample, and the share of it that is rejected."""

    rule: Rule
    seconds: float
    rejected: float

    @property
    def gain(self) -> float:
        """Rejected share per second."""
        return self.rejected / max(self.seconds, 1e-4)


def estimate(docs: DataFrame, rules: Sequence[Rule] = RULES, sample_rows: int = 200, repeats: int = 4, text_col: str = "text", made: Sequence[str] = ()) -> list[Estimate]:
    """The cascade's order, by cost and selectivity on the first ``sample_rows`` texts that Spark finds;
    measures in ``made`` cost nothing, since they are made for every text.

    A documented, bounded sample, which stays on the executors: it sets the order of the rules and nothing
    else. Each text is judged ``repeats`` times, to lift the time over that of starting a job. Times differ
    between runs, and so may the order. An empty table keeps the given order.
    """
    sample = stored(docs.select(F.col(f"`{text_col}`").alias("text")).limit(sample_rows), "quality-sample")
    hits = measured(sample, sorted({m for r in rules for m in r.measures}), "text").select(*(F.coalesce(F.expr(r.rejects), F.lit(False)).alias(f"r{i}") for i, r in enumerate(rules))).collect()
    if not hits:
        return [Estimate(r, 1.0, 0.0) for r in rules]
    many = sample.withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(repeats))))

    def timed(measure: str | None) -> float:
        df = many.agg(F.sum(F.octet_length("text"))) if measure is None else measured(many, [measure], "text").agg(F.sum(measure))
        times = []
        for _ in range(3):
            began = time.perf_counter()
            df.collect()
            times.append(time.perf_counter() - began)
        return min(times)

    floor, words = timed(None), 0.0
    cost = {}
    for m in sorted({m for r in rules for m in r.measures}, key=lambda m: m != "n_words"):
        cost[m] = max(timed(m) - floor - (words if "words" in _closure([m]) else 0.0), 0.0)
        words = cost[m] if m == "n_words" else words
    have, left, todo, out = set(made), list(hits), list(enumerate(rules)), []
    while todo:
        found = []
        for i, r in todo:
            seconds = sum(cost[m] for m in r.measures if m not in have)
            found.append((Estimate(r, seconds * len(left) / len(hits), sum(x[i] for x in left) / len(hits)), i))
        best, i = max(found, key=lambda x: (x[0].gain, -x[1]))
        out.append(best)
        todo = [x for x in todo if x[0] != i]
        have |= set(best.rule.measures)
        left = [x for x in left if not x[i]]
    return out


def _cascade(df: DataFrame, order: Sequence[Rule], made: set[str]) -> DataFrame:
    """``df`` (text, and the columns ``made``) with ``__by``: the first rule that rejects the text, or null.
    A rule's measures are made only for texts that no earlier rule has rejected."""
    df = df.withColumn("__by", F.lit(None).cast("string"))
    for r in order:
        need = _closure(r.measures) - made
        df, made = _made(df, need, "__by"), made | need
        df = df.withColumn("__by", _once(F.when(F.col("__by").isNotNull(), F.col("__by")).when(F.coalesce(F.expr(r.rejects), F.lit(False)), r.name)))
    return df


#: Measures that the report gives for every text; all others are made only where a rule needs them.
REPORTED = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def apply_rules(docs: DataFrame, rules: Sequence[Rule] = RULES, sample_rows: int = 200, text_col: str = "text", keep: Sequence[str] = ("doc_id",), reported: Sequence[str] = REPORTED, order: Sequence[Rule] | None = None) -> DataFrame:
    """``keep``, the reported measures, ``base_failed``, ``rejected_by`` (first rejecting rule in the
    cascade's order) and ``kept``, one row per row of ``docs``, without a shuffle.

    ``order`` fixes the cascade instead of the sample. A null or empty text has no words and is rejected;
    null ids, ties and repeated rows are judged row by row; an empty table gives an empty result; columns
    other than ``keep`` and the text are not read. Equal three-word windows are told by a 64-bit hash.
    """
    every = {*reported, *(m for r in BASE_RULES for m in r.measures)}
    order = order or [e.rule for e in estimate(docs, rules, sample_rows, text_col=text_col, made=tuple(every))]
    df, kept = _source(docs, text_col, keep)
    made = _closure(tuple(every))
    df = _cascade(_made(df, made), order, made)
    base = F.coalesce(F.expr(" OR ".join(f"({r.rejects})" for r in BASE_RULES)), F.lit(False))
    df = df.withColumn("base_failed", base)
    return df.select(*kept, *reported, "base_failed", F.col("__by").alias("rejected_by"), (~F.col("base_failed") & F.col("__by").isNull()).alias("kept"))


def filter_documents(docs: DataFrame, rules: Sequence[Rule] = RULES, sample_rows: int = 200, text_col: str = "text", order: Sequence[Rule] | None = None) -> DataFrame:
    """The rows of ``docs`` that no rule rejects, with all their columns, by the same cascade."""
    order = order or [e.rule for e in estimate(docs, rules, sample_rows, text_col=text_col)]
    df, kept = _source(docs, text_col, docs.columns)
    return _cascade(_made(df, {"text"}), order, {"text"}).where("__by IS NULL").select(*kept)
