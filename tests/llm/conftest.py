from pathlib import Path
import sys

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))
from llm_helpers import edited, words  # noqa: E402

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def corpus():
    """Plain, copied, nearly copied, passage-sharing, repetitive, empty, null and very long texts."""
    base, passage = [words(i, 60 + 7 * i) for i in range(12)], words(99, 35)
    texts = [" ".join(w) for w in base]
    texts += [" ".join(base[0]), " ".join(base[0]).upper(), texts[3], texts[3]]
    texts += [" ".join(edited(base[5], s, 0.02)) for s in range(6)]
    chain = base[7]
    for s in range(6):  # each near the one before it
        chain = edited(chain, 50 + s, 0.03)
        texts.append(" ".join(chain))
    texts += ["\n".join([" ".join(words(200 + i, 25)), " ".join(passage), " ".join(words(300 + i, 5))]) for i in range(5)]
    texts += ["again and again " * 40, "a", "a b", "A  b", "", "  \n\t ", None, "é" * 50, "one two three", " ".join(words(500, 9000))]
    return [(i, t) for i, t in enumerate(texts)]


@pytest.fixture(scope="session")
def docs(spark):
    rows = [(i, t, "en", "s", 0) for i, t in corpus()]
    return spark.createDataFrame([*rows, (None, "null id " * 30, None, None, None), (2, corpus()[2][1], "en", "s", 0)], DOCS).repartition(3)


@pytest.fixture(scope="session")
def clashing(docs):
    """The same rows with more columns, named like the operators' own."""
    from pyspark.sql import functions as F

    return docs.withColumns({c: F.lit(None).cast("string") for c in ("id", "rep", "component_id", "kept", "start", "length", "age", "fp", "pos", "rest", "score", "label", "words", "at")})
