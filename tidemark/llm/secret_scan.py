"""Secret scans: fixed patterns, and character Markov models of random strings and of ordinary identifiers.

Two first-order chains are counted from labelled samples. A run of key characters outside the fixed patterns'
spans is a secret where its log-likelihood ratio under the two chains reaches a margin. Only built-in SQL
functions are used; positions are code points, ends exclusive.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import stored


def _any_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


# The base patterns, and the least lengths of what they match. A run of one class of characters
# is found whole or not at all, so its least length can be part of the pattern; for assignments it cannot.
_NAMES = "|".join(map(_any_case, ("password", "passwd", "secret", "token", "api_?key")))
ASSIGN = rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
LEAST_VALUE = 6
KINDS = ("assign", "access", "hex", "markov")
#: What the chains judge: runs of so many key characters.
CANDIDATE = "[A-Za-z0-9+/_=-]{16,}"
#: The chains' characters; place 0 stands for the start and the end of a string.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=.-"
STATES = len(ALPHABET) + 1
#: Strings of each form that stand for random keys beside those that the base patterns find.
RANDOM_SAMPLES = 2_000
#: Thousandths of a natural logarithm: odds of about 150 to 1 for a random string.
MARGIN = 5_000
#: Lists are built in chunks of so many entries, so that the time is in proportion to the list.
_CHUNK = 512
_SPAN = "struct<start:int,ord:int,end:int,kind:string,value:string>"


def _scan(items: Column, begin: Column, step: Callable[[Column, Column], tuple[Column, Column]], entry: str) -> Column:
    """The list of what ``step(state, item)`` gives beside its next state, for the items in order."""
    none = F.array().cast(f"array<{entry}>")
    held = F.struct(begin.alias("s"), none.alias("part"), F.array().cast(f"array<array<{entry}>>").alias("parts"))

    def merge(a: Column, x: Column) -> Column:
        state, out = step(a["s"], x)
        full = F.size(a["part"]) >= _CHUNK
        part = F.when(full, F.array(out)).otherwise(F.concat(a["part"], F.array(out)))
        return F.struct(state.alias("s"), part.alias("part"), F.when(full, F.concat(a["parts"], F.array(a["part"]))).otherwise(a["parts"]).alias("parts"))

    return F.aggregate(items, held, merge, lambda a: F.flatten(F.concat(a["parts"], F.array(a["part"]))))


def _matches(text: Column, pattern: str, kind: str) -> Column:
    """Spans of the leftmost matches, none overlapping, from the lengths of what lies between them."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.zip_with(found, F.slice(F.split(text, pattern), 1, F.size(found)), lambda m, gap: F.struct(m.alias("m"), F.char_length(gap).alias("gap")))

    def step(at: Column, x: Column) -> tuple[Column, Column]:
        start = at + x["gap"]
        end = start + F.char_length(x["m"])
        return end, F.struct(start.alias("start"), F.lit(KINDS.index(kind)).alias("ord"), end.alias("end"), F.lit(kind).alias("kind"), x["m"].alias("value"))

    return F.when(text.rlike(pattern), _scan(pairs, F.lit(0), step, _SPAN)).otherwise(F.array().cast(f"array<{_SPAN}>"))


def _assigned(value: Column) -> Column:
    return F.regexp_extract(value, ASSIGN, 2)


def _outside(candidates: Column, base: Column) -> Column:
    """Candidates that overlap no base span: one pass from the left against the furthest end so far, and one
    from the right against the nearest start."""
    hit = f"struct<x:{_SPAN},hit:boolean>"

    def left(end: Column, x: Column) -> tuple[Column, Column]:
        mine = x["ord"] == 3
        return F.when(mine, end).otherwise(F.greatest(end, x["end"])), F.struct(x.alias("x"), (mine & (end > x["start"])).alias("hit"))

    def right(start: Column, y: Column) -> tuple[Column, Column]:
        x = y["x"]
        mine = x["ord"] == 3
        return F.when(mine, start).otherwise(F.least(start, x["start"])), F.struct(x.alias("x"), (y["hit"] | (mine & (start < x["end"]))).alias("hit"))

    once = _scan(F.array_sort(F.concat(base, candidates)), F.lit(0), left, hit)
    twice = _scan(F.reverse(once), F.lit(2**31 - 1), right, hit)
    free = F.transform(F.filter(twice, lambda y: (y["x"]["ord"] == 3) & ~y["hit"]), lambda y: y["x"])
    return F.when((F.size(base) == 0) | (F.size(candidates) == 0), candidates).otherwise(free)


def base_spans(docs: DataFrame, text_col: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``keep`` under names of its own, ``base`` (spans of the fixed patterns, by start and kind) and ``free``
    (candidates outside them) for every whole text; a null text has none."""
    text = F.col("__text")
    df = docs.select(F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("__text"), *(F.col(f"`{c}`").alias(f"__kept_{i}") for i, c in enumerate(keep)))
    assign = F.filter(_matches(text, ASSIGN, "assign"), lambda x: F.char_length(_assigned(x["value"])) >= LEAST_VALUE)
    df = df.select("*", F.array_sort(F.concat(assign, _matches(text, ACCESS, "access"), _matches(text, HEX, "hex"))).alias("base"), _matches(text, CANDIDATE, "markov").alias("free"))
    return df.drop("__text").withColumn("free", _outside(F.col("free"), F.col("base")))


def random_strings(spark: SparkSession, n: int = RANDOM_SAMPLES) -> DataFrame:
    """(value, label 1): strings that look drawn at random, in hexadecimal, base 64, and letters of one case
    with digits, from digests of numbers."""
    digest = F.sha2(F.col("id").cast("string"), 256)
    plain = F.base64(F.unhex(digest))
    forms = F.array(digest, plain, F.upper(F.translate(plain, "+/=", "")), F.lower(F.translate(plain, "+/=", "")))
    return spark.range(n).select(F.explode(forms).alias("value"), F.lit(1).alias("label"))


def _identifier_forms(value: Column) -> Column:
    """A word in the forms that programs give it: whole, in two parts, in capitals."""
    head, tail = F.substring(value, 1, 8), F.substr(value, F.lit(9))
    forms = F.array(value, F.upper(value), F.concat(head, F.initcap(tail)), *(F.concat(head, F.lit(c), tail) for c in "_-/"), F.upper(F.concat(head, F.lit("_"), tail)))
    return F.when(value.rlike("^[a-z]+$"), forms).otherwise(F.array(value))


def labelled_samples(scanned: DataFrame) -> DataFrame:
    """(value, label): what the fixed patterns find, and random strings, are labelled 1; other candidates of
    the corpus, in lower case also as parts of identifiers, 0. All rows are used."""
    value = F.when(F.col("x.kind") == "assign", _assigned(F.col("x.value"))).otherwise(F.col("x.value"))
    found = scanned.select(F.explode("base").alias("x")).select(value.alias("value"), F.lit(1).alias("label"))
    ordinary = scanned.select(F.explode("free").alias("x")).select(F.explode(_identifier_forms(F.col("x.value"))).alias("value"), F.lit(0).alias("label"))
    return found.unionByName(ordinary).unionByName(random_strings(scanned.sparkSession))


def _characters(value: Column) -> Column:
    return F.filter(F.split(value, ""), lambda c: c != "")


def _place(c: Column) -> Column:
    return F.when(c == "", F.lit(0)).otherwise(F.instr(F.lit(ALPHABET), c))


def train(samples: DataFrame) -> list[int]:
    """Thousandths of the log ratio of each transition, by ``STATES * from + to``, from samples (value, label).

    Transitions are counted over all samples. A transition's share of its state is mixed with its target's share
    of all transitions, which counts as ``STATES`` transitions; so a state that one chain has not seen falls
    back on how common the next character is. Characters outside the alphabet count as the end of a string. The table's size does not depend on the input. Samples of one
    label alone, or none, leave the other chain to the smoothing; null values are left out."""
    chars = _characters(F.col("value"))
    steps = F.arrays_zip(F.concat(F.array(F.lit("")), chars).alias("a"), F.concat(chars, F.array(F.lit(""))).alias("b"))
    seen = samples.where("value IS NOT NULL").select("label", F.explode(steps).alias("s")).groupBy("s.a", "s.b").agg(F.count_if(F.col("label") == 1).alias("r"), F.count_if(F.col("label") == 0).alias("o"))
    seen = seen.groupBy((F.lit(STATES) * _place(F.col("a")) + _place(F.col("b"))).cast("long").alias("id")).agg(F.sum("r").alias("r"), F.sum("o").alias("o"))
    cells = samples.sparkSession.range(STATES * STATES).join(seen, "id", "left").fillna(0, ["r", "o"])
    of = {"from": F.floor(F.col("id") / STATES), "to": F.col("id") % STATES, "all": F.lit(0)}  # over the table of cells alone
    total = {(c, k): F.sum(c).over(Window.partitionBy(by)) for c in "ro" for k, by in of.items()}
    share = {c: F.log((F.col(c) + STATES * ((total[c, "to"] + 1) / (total[c, "all"] + STATES))) / (total[c, "from"] + STATES)) for c in "ro"}
    gains = cells.select("id", F.floor(1000 * (share["r"] - share["o"])).cast("long").alias("gain")).orderBy("id")
    return [x.gain for x in gains.collect()]  # one row a cell


def log_ratio(value: Column, gains: Sequence[int]) -> Column:
    """The log-likelihood ratio of a string in thousandths, start and end included."""
    table = F.split(F.lit(",".join(map(str, gains))), ",").cast("array<bigint>")  # folded into one literal

    def merge(a: Column, c: Column) -> Column:
        place = _place(c)
        return F.struct(place.alias("at"), (a["sum"] + F.get(table, STATES * a["at"] + place)).alias("sum"))

    begin = F.struct(F.lit(0).alias("at"), F.lit(0).cast("long").alias("sum"))
    return F.aggregate(F.concat(_characters(value), F.array(F.lit(""))), begin, merge, lambda a: a["sum"])


def find_secrets(docs: DataFrame, gains: Sequence[int] | None = None, text_col: str = "text", keep: Sequence[str] = ("doc_id",), margin: int = MARGIN) -> DataFrame:
    """``keep``, ``base`` and ``added``: lists of (start, ord, end, kind, value) in the order of start and kind.

    ``gains`` is a model that ``train`` gave; without it one is learned from the corpus's own labelled
    samples and random strings. Null and empty texts have no spans; ids, ties and repeated rows are judged row by
    row; an empty table gives an empty result; other columns are not read. Texts are read once, and only spans
    are written to the scratch folder. No row is shuffled but counts of transitions.
    """
    scanned = stored(base_spans(docs, text_col, keep), "secret-spans")
    gains = train(labelled_samples(scanned)) if gains is None else gains
    added = F.filter("free", lambda x: log_ratio(x["value"], gains) >= margin)
    return scanned.select(*(F.col(f"__kept_{i}").alias(c) for i, c in enumerate(keep)), "base", F.array_sort(added).alias("added"))


def spans_text(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def report(found: DataFrame, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Numbers of base spans by kind, the digest of their places, and the places of all spans."""

    def number(kind: str) -> Column:
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(*(F.col(f"`{c}`") for c in keep), *map(number, KINDS[:3]), F.sha2(spans_text(F.col("base")), 256).alias("base_sha256"), spans_text(F.array_sort(F.concat("base", "added"))).alias("spans"))
