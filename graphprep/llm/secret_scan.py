"""Secret scans with corpus-wide ownership.

Spans that look like credentials are found by patterns; besides, every token with enough digits and letters in both
cases is a candidate. Candidates are hashed and, over the whole corpus, counted by distinct repositories and owners: a
value that many owners hold is a copied example, one that few hold is live-looking. Bare tokens become spans only if
they are live-looking; spans of the patterns always stay and carry the verdict.

Defined results: a null text has no spans, null owners or repositories count as one value each, repeated rows are scanned
row by row but are one repository, an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphprep.llm.common import columns_of, extended, wrapped
from graphprep.workspace import stage

#: The base patterns and the least lengths of what they match.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN_MIN = 8
KINDS = ("assign", "access", "hex", "bare")
#: A bare token: 20 characters and more of this alphabet, with a digit and letters of both cases.
BARE_MIN = 20
BARE = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % BARE_MIN)
BARE_HAS = (re.compile(r"[0-9]"), re.compile(r"[a-z]"), re.compile(r"[A-Z]"))
#: Held by more owners than this, a value is an example.
MAX_OWNERS = 2
MAX_REPOSITORIES = 3
MASK = "<secret>"


class Span(NamedTuple):
    kind: int
    start: int
    end: int
    key: str


def value_key(value: str) -> str:
    return hashlib.sha256(value.encode()).hexdigest()[:32]


def scan(text: str | None) -> list[Span]:
    """All candidates of a text by start, then kind. Offsets are code points."""
    if not text:
        return []
    found = []
    lowered = text.lower()
    # Python lowers a few letters outside ASCII to these, so this test can only let too many texts through.
    if any(word in lowered for word in WORDS):
        for m in ASSIGN.finditer(text):
            if len(m[2]) >= ASSIGN_MIN:
                found.append(Span(0, m.start(), m.end(), value_key(m[2])))
    if "AKIA" in text:
        found += [Span(1, m.start(), m.end(), value_key(m[0])) for m in ACCESS.finditer(text)]
    if max(map(len, text.split()), default=0) >= BARE_MIN:  # the other patterns match within one word
        found += [Span(2, m.start(), m.end(), value_key(m[0])) for m in HEX.finditer(text)]
        base = list(found)
        for m in BARE.finditer(text):
            if all(has.search(m[0]) for has in BARE_HAS) and not any(s.start < m.end() and m.start() < s.end for s in base):
                found.append(Span(3, m.start(), m.end(), value_key(m[0])))
    return sorted(found, key=lambda s: (s.start, s.kind))


SPANS = "array<struct<kind:int,start:bigint,end:bigint,key:string>>"
_SPANS = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("key", pa.string())]))


def _with_candidates(rows: DataFrame) -> DataFrame:
    """Adds ``candidates`` to rows with a column ``text`` in the last place, which is dropped."""
    schema = extended(rows.drop("text"), f"candidates {SPANS}")
    names = [*rows.columns[:-1], "candidates"]

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (texts,) = columns_of(batch, "text")
            spans = pa.array([[s._asdict() for s in scan(t)] for t in texts], _SPANS)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], spans], names=names)

    return rows.mapInArrow(scanned, schema)


def ownership(candidates: DataFrame) -> DataFrame:
    """``key, repositories, owners, live`` from ``key, owner, repository``.

    Distinct (key, owner, repository) first, with partial aggregation, so a value copied into a third of all documents
    is a handful of rows for each task before anything is grouped by the value.
    """
    held = candidates.select("key", F.coalesce("owner", F.lit("\0")).alias("owner"), F.coalesce("repository", F.lit("\0")).alias("repository")).distinct()
    by_owner = held.groupBy("key", "owner").agg(F.count("*").alias("n"))
    counted = by_owner.groupBy("key").agg(F.sum("n").alias("repositories"), F.count("*").alias("owners"))
    return counted.withColumn("live", (F.col("owners") <= MAX_OWNERS) & (F.col("repositories") <= MAX_REPOSITORIES))


def judged(docs: DataFrame, owner: Column, repository: Column) -> DataFrame:
    """``id, spans`` (with ``live``) of the rows of a stored table ``id, candidates, owner, repository`` that have any."""
    spans = docs.select("id", "owner", "repository", F.explode("candidates").alias("span"))
    verdicts = ownership(spans.select(F.col("span")["key"].alias("key"), "owner", "repository"))
    verdicts = stage(verdicts.select(F.col("key").alias("_key"), "repositories", "owners", "live"), "secret-owners")
    # A value held by a third of all rows is one key here: Spark splits such partitions of the left side.
    joined = spans.join(verdicts, spans["span"]["key"] == verdicts["_key"])
    entry = F.struct(
        F.col("span")["start"].alias("start"),
        F.col("span")["kind"].alias("kind"),
        F.col("span")["end"].alias("end"),
        F.col("span")["key"].alias("key"),
        "live",
    )
    wanted = joined.where((F.col("span")["kind"] < 3) | F.col("live"))
    return wanted.groupBy("id").agg(F.array_sort(F.collect_list(entry)).alias("spans"))


def _owned(rows: DataFrame, doc: str, owner: str, repository: tuple[str, ...]) -> DataFrame:
    d = F.col(doc)
    place = F.concat_ws("/", *[F.coalesce(d[c].cast("string"), F.lit("\0")) for c in repository])
    return rows.withColumns({"owner": d[owner].cast("string"), "repository": place})


def find_secrets(docs: DataFrame, owner: str = "source", repository: tuple[str, ...] = ("source", "lang")) -> DataFrame:
    """``doc, spans`` for every row of ``docs``: ``doc`` holds all columns but the text."""
    columns = [c for c in docs.columns if c != "text"]
    rows = docs.select(F.struct(*[docs[c] for c in columns]).alias("doc"), F.monotonically_increasing_id().alias("id"), docs["text"].alias("text"))
    scanned = stage(_owned(_with_candidates(rows), "doc", owner, repository), "secret-candidates")
    spans = judged(scanned.where(F.size("candidates") > 0), F.col("owner"), F.col("repository"))
    return scanned.join(spans, "id", "left").select("doc", "spans")


def masked(text: str, spans: list[tuple[int, int]]) -> str:
    """The text with the spans replaced; overlapping ones as one."""
    out, at = [], 0
    for start, end in sorted(spans):
        if start >= at:
            out += [text[at:start], MASK]
        elif end <= at:
            continue
        at = max(at, end)
    return "".join([*out, text[at:]])


def mask_secrets(docs: DataFrame, owner: str = "source", repository: tuple[str, ...] = ("source", "lang")) -> DataFrame:
    """``docs`` with live-looking credentials masked (and ``n_chars`` counted anew); examples and all rows stay.

    Only documents with a candidate are stored and joined with the verdicts; all others pass as they are.
    """
    source = wrapped(docs, F.col("text").alias("text"))
    flagged = _with_candidates(source)
    plain = flagged.where(F.size("candidates") == 0).select("doc")
    held = stage(_owned(flagged.where(F.size("candidates") > 0), "doc", owner, repository), "secret-documents")
    spans = judged(held, F.col("owner"), F.col("repository"))
    live = spans.select(F.col("id").alias("_id"), F.filter("spans", lambda s: s["live"]).alias("_live"))
    rows = held.join(live, held["id"] == live["_id"], "left").select("doc", F.col("doc")["text"].alias("text"), "_live")
    names = docs.columns

    def mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, found = columns_of(batch, "text", "_live")
            clean = [t if t is None or not f else masked(t, [(s["start"], s["end"]) for s in f]) for t, f in zip(texts, found)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(clean, pa.string())], names=["doc", "text"])

    out = rows.mapInArrow(mask, rows.select("doc", "text").schema)
    changed = {"text": F.col("text"), "n_chars": F.length("text").cast(dict(docs.dtypes).get("n_chars", "bigint"))}
    rewritten = out.select(*[changed[c].alias(c) if c in changed else F.col("doc")[c].alias(c) for c in names])
    return plain.select(*[F.col("doc")[c].alias(c) for c in names]).unionByName(rewritten)
