"""Fingerprints against sketches made in Python with the same hash, and true likeness."""

import hashlib
import struct

import pytest
import xxhash
from pyspark.sql import functions as F

from graphprep.llm import fingerprints
from graphprep.llm.common import shingle_set

MASK = 2**64 - 1


def hash_of(words):
    """Spark's xxhash64 of the words' hashes, without its lowest bit."""
    values = [xxhash.xxh64_intdigest(w, 42) for w in words]
    if len(words) < 5:
        signed = [v - 2**64 if v >= 2**63 else v for v in values]
        return xxhash.xxh64_intdigest(" ".join(map(str, signed)).encode(), 42) >> 1
    seed = 42
    for v in values:
        seed = xxhash.xxh64_intdigest(struct.pack("<Q", v), seed)
    return seed >> 1


def sketch(text, k=fingerprints.K):
    return sorted({hash_of(s) for s in shingle_set(text)})[:k]


def printed(s):
    return "".join(f"{h:016x}" for h in s)


def likeness(a, b, k=fingerprints.K):
    if not a and not b:
        return 1.0
    union = sorted({*a, *b})[:k]
    return len(set(union) & set(a) & set(b)) / max(1, len(union))


def edited(text, following):
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


TEXTS = [
    "",
    "a",
    "one two three four",
    "one two three four five",
    "cut mid-word somewhere in herexxxxxxxxxxxxxxxxxxxxxxxxxxxx",
    " \n ",
    "ends in spaces             ",
    " ".join(f"w{i % 37}" for i in range(400)),
    " ".join(f"w{i}" for i in range(700)),
    "é 😀 ß " * 30,
    "tab\tand\x0bfeed\x0c and\r\nlines here too okay",
]


def test_every_row_matches_brute_force(docs_of):
    rows = fingerprints.compare_edits(docs_of([(i * 3, t, "en", "s") for i, t in enumerate(TEXTS)], clashing=True)).collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        i = r["doc_id"] // 3
        text, following = TEXTS[i], TEXTS[(i + 1) % len(TEXTS)]
        changed = edited(text, following)
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        assert r["fingerprint"] == printed(sketch(text)), repr(text)
        assert r["edited_fingerprint"] == printed(sketch(changed)), repr(changed)
        assert r["near_edited"] == pytest.approx(likeness(sketch(text), sketch(changed)))
        assert r["near_next"] == pytest.approx(likeness(sketch(text), sketch(following)))


def test_estimates_are_near_the_truth(spark):
    words = [f"w{i}" for i in range(3000)]
    a, b = " ".join(words), " ".join(words[:2400])
    rows = spark.createDataFrame([(a, b)], "a string, b string")
    for name in ("a", "b"):
        rows = fingerprints.with_sketch(rows, name, f"s{name}", 1024)
    s, t = F.col("sa"), F.col("sb")
    found = rows.select(
        fingerprints.resemblance(s, t, 1024).alias("r"), fingerprints.containment(t, s, 1024).alias("c"), fingerprints.distinct_shingles(s, 1024).alias("n")
    ).first()
    true_a, true_b = shingle_set(a), shingle_set(b)
    assert abs(found["r"] - len(true_a & true_b) / len(true_a | true_b)) < 0.05
    assert found["c"] > 0.9
    assert abs(found["n"] / len(true_a) - 1) < 0.1


def test_sketches_of_parts_merge(spark):
    rows = spark.createDataFrame([(i % 2, " ".join(f"w{j}" for j in range(i * 50, i * 50 + 80))) for i in range(12)], "g int, text string")
    merged = fingerprints.merge_rows(fingerprints.with_sketch(rows, "text", "s"), "s", "g").collect()
    for r in merged:
        expected = sorted({hash_of(x) for i in range(12) if i % 2 == r["g"] for x in shingle_set(" ".join(f"w{j}" for j in range(i * 50, i * 50 + 80)))})
        assert r["s"] == expected[: fingerprints.K]


def test_text_form_goes_both_ways(spark):
    rows = fingerprints.with_sketch(spark.createDataFrame([(t,) for t in TEXTS], "text string"), "text", "s")
    back = rows.select("s", fingerprints.from_text(fingerprints.as_text(F.col("s"))).alias("b")).collect()
    assert all(r["s"] == r["b"] for r in back)


def test_odd_documents_have_fingerprints(odd, empty):
    rows = fingerprints.compare_edits(odd).collect()
    assert len(rows) == odd.count()
    same = [r for r in rows if r["doc_id"] == 5]
    assert len(same) == 2 and same[0] == same[1]
    assert [r["fingerprint"] for r in rows if r["doc_id"] in (1, 2, 3)] == [""] * 3
    assert fingerprints.compare_edits(empty).count() == 0


def test_only_jvm_functions(docs_of):
    plan = fingerprints.compare_edits(docs_of(TEXTS))._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
