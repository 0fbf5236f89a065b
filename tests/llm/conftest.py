import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from texts or (doc_id, text, lang, source) tuples, with columns that clash with internal names."""

    def make(rows, clashing=False):
        full = []
        for number, row in enumerate(rows):
            doc_id, text, lang, source = row if isinstance(row, tuple) else (number, row, "en", f"src{number % 3}")
            full.append((doc_id, text, lang, source, None if text is None else len(text)))
        docs = spark.createDataFrame(full, COLUMNS)
        if clashing:
            from pyspark.sql import functions as F

            for name in ("id", "doc", "key", "size", "rep", "shard", "host", "target", "before", "block", "kept", "words", "cell", "old", "copies", "_row", "_id", "_key"):
                docs = docs.withColumn(name, F.lit("x"))
        return docs

    return make


LONG = " ".join(f"word{i % 977} {i}" for i in range(30_000))

ODD = [
    (1, None, "en", "src0"),
    (2, "", "en", None),
    (None, "a b c d e f g h", None, "src1"),
    (3, "   \n\t ", "en", "src0"),
    (4, LONG, "en", "src0"),
    (5, "one two three four five six seven", "en", "src1"),
    (5, "one two three four five six seven", "en", "src1"),
    (6, "one two three four five six seven", "de", "src2"),
    (7, "naïve café 😀 und so weiter \x00 \x1c ß", "de", "src2"),
    (8, "kurz", "de", "src1"),
]


@pytest.fixture(scope="session")
def odd(docs_of):
    """Nulls, empty and long texts, ties, repeated rows and clashing columns."""
    return docs_of(ODD, clashing=True)


@pytest.fixture(scope="session")
def empty(docs_of):
    return docs_of([], clashing=True)
