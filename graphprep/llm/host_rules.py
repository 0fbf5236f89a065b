"""Quality rules with verdicts by host.

Each document is held against a few rules; the failures of each rule are counted by host (here the ``source``). A host's
failure rate is shrunk towards what hosts fail on average by a beta prior fitted to all hosts by moments, so a host with
few documents is not judged by chance; a host whose shrunk rate of any rule passes the limit is rejected with all its
documents. A document also goes if it breaks the base rules itself.

Defined results: a null text has no words (and so fails), a null host is a host of its own, repeated rows count row by
row, an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphprep.llm.common import columns_of, words_of
from graphprep.workspace import stage

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEATED = 50  # percent of words
MAX_SYMBOLS = 20  # symbols per hundred words
MAX_DUP_LINES = 50  # percent of lines with a word
HOST_LIMIT = 0.5
WINDOW = 3
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
RULES = ("short", "repeated", "symbols", "dup_lines")


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words within a run of ``window`` words that occurs twice or more, the first occurrence included."""
    if len(words) <= window:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    n = len(words) - window + 1
    runs = ids[:n].copy()
    for i in range(1, window):
        # Renumbered after each word, so the product stays far below 2^63 for any text.
        runs = np.unique(runs, return_inverse=True)[1] * len(seen) + ids[i : i + n] if i > 1 else runs * len(seen) + ids[i : i + n]
    _, place, count = np.unique(runs, return_inverse=True, return_counts=True)
    covered = np.zeros(len(words) + 1, np.int64)
    starts = np.flatnonzero(count[place] > 1)
    np.add.at(covered, starts, 1)
    np.add.at(covered, starts + window, -1)
    return int(np.count_nonzero(np.cumsum(covered[:-1])))


def measure(text: str | None) -> tuple[int, ...]:
    """The values of ``MEASURES`` for one text."""
    text = text or ""
    words = words_of(text)
    blank = sum(map(text.count, " \t\n\x0b\x0c\r"))
    lines = [line for line in text.encode().split(b"\n") if line.strip()]
    return (
        len(words),
        len(text) - blank,
        sum(map(text.count, SYMBOLS)),
        len(lines),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


def with_measures(docs: DataFrame) -> DataFrame:
    """Adds ``measures``, a struct, to ``docs`` wrapped as ``doc``."""
    source = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"), docs["text"].alias("text"))
    kind = T.StructType([T.StructField(m, T.LongType()) for m in MEASURES])
    schema = T.StructType([source.schema["doc"], T.StructField("measures", kind)])

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (texts,) = columns_of(batch, "text")
            columns = zip(*map(measure, texts)) if texts else [[] for _ in MEASURES]
            found = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], names=list(MEASURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), found], names=["doc", "measures"])

    return source.mapInArrow(measured, schema)


def failures(measures: str = "measures") -> dict[str, F.Column]:
    """The rules, as conditions on a struct of measures."""
    m = F.col(measures)
    return {
        "short": m["n_words"] < MIN_WORDS,
        "repeated": 100 * m["n_repeat_words"] > MAX_REPEATED * m["n_words"],
        "symbols": 100 * m["n_symbols"] > MAX_SYMBOLS * m["n_words"],
        "dup_lines": 100 * m["n_dup_lines"] > MAX_DUP_LINES * m["n_lines"],
    }


def host_verdicts(measured: DataFrame, limit: float = HOST_LIMIT) -> DataFrame:
    """``host, documents, rate_<rule>..., host_rejected`` from rows with ``host`` and ``measures``.

    The prior's moments are sums over hosts, so only four numbers a rule reach the driver.
    """
    counts = measured.groupBy("host").agg(
        F.count("*").alias("documents"), *[F.sum(c.cast("bigint")).alias(r) for r, c in failures().items()]
    )
    hosts = stage(counts, "hosts")
    rates = {r: F.col(r) / F.col("documents") for r in RULES}
    moments = hosts.agg(
        *[F.sum(r).alias(f"f_{r}") for r in RULES],
        *[F.sum(rates[r] * F.col(r)).alias(f"s_{r}") for r in RULES],
        F.sum("documents").alias("n"),
        F.count("*").alias("hosts"),
    ).first()
    shrunk = {r: shrunk_rate(r, moments) for r in RULES}
    judged = hosts.select("host", "documents", *[c.alias(f"rate_{r}") for r, c in shrunk.items()])
    rejected = F.greatest(*[f"rate_{r}" for r in RULES]) > limit
    return stage(judged.withColumn("host_rejected", F.coalesce(rejected, F.lit(False))), "host-verdicts")


def shrunk_rate(rule: str, moments) -> F.Column:
    """Posterior mean of a host's rate under the beta prior with the mean and spread of all hosts, weighted by documents."""
    n, hosts = moments["n"] or 0, moments["hosts"] or 0
    strength = prior_strength(moments[f"f_{rule}"] or 0, moments[f"s_{rule}"] or 0.0, n, hosts)
    mean = (moments[f"f_{rule}"] or 0) / n if n else 0.0
    if strength is None:  # all hosts alike: the prior says it all
        return F.lit(mean)
    return (F.col(rule) + mean * strength) / (F.col("documents") + strength)


def prior_strength(failed: int, squares: float, n: int, hosts: int) -> float | None:
    """The prior's weight in documents; None if hosts differ no more than chance makes them.

    ``squares`` is the sum of documents times squared rate. The variance between hosts is what is left of the weighted
    variance after the share that sampling makes, ``mean (1 - mean) hosts / n``.
    """
    if not n or not 0 < failed < n:
        return None
    mean = failed / n
    noise = mean * (1 - mean) * (hosts - 1) / n
    between = squares / n - mean * mean - noise
    if between <= 1e-9:
        return None
    return max(mean * (1 - mean) / between - 1, 1e-6)


def judge(docs: DataFrame, host: str = "source", limit: float = HOST_LIMIT) -> DataFrame:
    """``doc, measures, base_failed, host_rejected, kept`` for every row of ``docs`` (with ``text`` and the host column).

    The texts are read twice and never stored or shuffled by host: the first pass counts, the second joins the verdicts,
    one row per host, which Spark broadcasts if they are small and else joins by shuffle with its skew handling.
    """
    measured = with_measures(docs)
    counted = with_measures(docs.select("text", F.col(host).alias("host")))
    verdicts = host_verdicts(counted.select(F.col("doc")["host"].alias("host"), "measures"), limit)
    joined = measured.join(verdicts, measured["doc"][host].eqNullSafe(verdicts["host"]), "left")
    rules = failures()
    base_failed = rules["short"] | rules["repeated"]
    rejected = F.coalesce("host_rejected", F.lit(False))
    rows = joined.select("doc", "measures", base_failed.alias("base_failed"), rejected.alias("host_rejected"))
    return rows.withColumn("kept", ~F.col("base_failed") & ~F.col("host_rejected"))
