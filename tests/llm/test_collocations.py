"""Collocations, held against counting every phrase of one to five words."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from compare import connect, difference
from graphprep.llm import collocations as c
from graphprep.llm.collocations import Block, Filter, collocations, frequent_phrases, second, summed
from graphprep.llm.oracle import ORACLE
from graphprep.llm.queries import QUERIES
from graphprep.workspace import stage

DATA = "/root/testdata"
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counted(rows):
    """Counts of all phrases of each language."""
    found = defaultdict(Counter)
    for text, lang in rows:
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(UPPER)):
            words = [w for w in re.split("[ \t]+", piece) if w]
            for size in range(1, 6):
                for i in range(len(words) - size + 1):
                    found["und" if lang is None else lang][tuple(words[i : i + size])] += 1
    return found


def expected(rows, threshold, top=2000):
    out = []
    for lang, f in counted(rows).items():
        n = sum(v for k, v in f.items() if len(k) == 1)
        frequent = {k: v for k, v in f.items() if len(k) > 1 and v >= threshold}
        inside = {k[i:j] for k, v in frequent.items() for i in range(len(k)) for j in range(i + 2, len(k) + 1) if j - i < len(k) and f[k[i:j]] <= v}
        best = []
        for k, a in frequent.items():
            if k not in inside:
                score, _, l, r = min((1000 * a * n // (f[k[:i]] * f[k[i:]]), i, f[k[:i]], f[k[i:]]) for i in range(1, len(k)))
                best.append((-score, -a, " ".join(k).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(best)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n, -score))
    return sorted(out)


def rows_of(result):
    assert result.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(map(tuple, result.collect()))


def test_whole_table(spark):
    problem = difference(QUERIES["op12_phrase_collocations"](spark, f"{DATA}/sf0.01"), connect("sf0.01"), ORACLE["op12_phrase_collocations"])
    assert not problem, problem


@pytest.fixture(scope="module")
def odd_rows():
    draw = random.Random(8)
    words = ["a", "B", "b", "Cc", "dd", "É", "é", "x\x1cy", "\x00", "naïve", "😀"]
    rows = []
    for _ in range(300):
        parts = [draw.choice(words) + draw.choice([" ", " ", "  ", "\t ", ", ", ".", "\n", "\x0b"]) for _ in range(draw.randrange(0, 30))]
        rows.append(("".join(parts), draw.choice(["en", "de", None])))
    rows += [("one two three four five six", "fr")] * 9 + [(None, "en"), ("", "en"), (" \t.", None), ("b a " * 4000, "xx"), ("lonely", "yy")]
    return rows


@pytest.mark.parametrize(("shards", "bits", "block"), [(3, None, 1 << 21), (1, 16, 64), (4, 4, 300)])
def test_any_number_of_shards_and_any_filter_counts_the_same(spark, odd_rows, monkeypatch, shards, bits, block):
    """With 16 bits of filter nearly every phrase passes; blocks of a few bytes cut texts between pieces."""
    monkeypatch.setattr(c, "BLOCK", block)
    monkeypatch.setattr(c.blocks_of, "__defaults__", (block,))
    docs = spark.createDataFrame([(i, t, lang, "x", 1, "y", 2) for i, (t, lang) in enumerate(odd_rows)], "doc_id long, text string, lang string, size string, n int, phrase string, shard int")
    docs = docs.repartition(3)
    assert rows_of(collocations(docs, threshold=7, top=40, shards=shards, bits=bits)) == expected(odd_rows, 7, 40)


def test_counts_are_exact_however_late_a_phrase_begins(spark, odd_rows):
    docs = spark.createDataFrame([(t, lang) for t, lang in odd_rows], "text string, lang string").repartition(5)
    found, sizes = frequent_phrases(docs, threshold=5, shards=3)
    wanted = {(lang, " ".join(k), v) for lang, f in counted(odd_rows).items() for k, v in f.items() if v >= 5}
    rows = [(r["lang"], r["phrase"], r["n"]) for r in found.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == wanted
    assert dict(map(tuple, sizes.collect())) == {lang: sum(v for k, v in f.items() if len(k) == 1) for lang, f in counted(odd_rows).items()}


def scanned(block, step, shards, now, then, longest):
    """``active`` phrases with their counts, and those to be named."""
    found, named = Counter(), set()
    for size, hashes, at, active, fresh in block.scan(step, shards, now, then, longest):
        first, n = summed(hashes[0][active].view(np.int64), second(hashes[1][active]))
        found.update({(block.langs[block.lang[i]], block.text(int(i), size)): int(k) for i, k in zip(at[active][first], n)})
        named |= {block.text(int(i), size) for i in at[fresh]}
    return found, named


def test_a_longer_phrase_is_only_counted_once_both_parts_have_reached_the_threshold():
    block = Block([("en", b"a b c a b c a b c")])
    data = np.zeros(1 << 13, np.uint8)
    for word in (0, 1):
        for probe in range(c.PROBES):
            place = int(Filter.places(block.first[0][word : word + 1], 16, probe)[0])
            data[place // 8] |= 1 << place % 8
    now, none = Filter(16, data), Filter(16)
    assert scanned(block, 0, 3, none, none, 5) == ({("en", b"a"): 3, ("en", b"b"): 3, ("en", b"c"): 3}, set())
    assert scanned(block, 3, 3, now, none, 5) == ({("en", b"a b"): 3}, {b"a", b"b"})
    assert scanned(block, 6, 3, now, now, 5) == ({}, set())


def test_phrases_are_told_apart_by_the_second_hash_too():
    one, two = np.array([5, 5, 7, 5, 5], np.int64), np.array([1, 2, 1, 1, 2], np.int32)
    first, n = summed(one, two)
    assert sorted((int(one[i]), int(two[i]), int(k)) for i, k in zip(first, n)) == [(5, 1, 2), (5, 2, 2), (7, 1, 1)]
    assert [len(x) for x in summed(one[:0], two[:0])] == [0, 0]


def test_hashes_tell_languages_places_and_lengths_apart():
    block = Block([("en", b"a b, ab a b"), ("de", b"a b")])
    at = np.array([0, 3, 5])
    pairs = block.longer([h[at] for h in block.first], at, 2)
    assert pairs[0][0] == pairs[0][1] != pairs[0][2] and pairs[1][0] == pairs[1][1] != pairs[1][2]
    assert len({int(h) for h in block.first[0]}) == 5


def test_odd_and_empty_tables(spark, odd, empty):
    texts = [(r["text"], r["lang"]) for r in odd.select("text", "lang").collect()]
    assert rows_of(collocations(odd, threshold=2, top=100)) == expected(texts, 2, 100)
    assert collocations(empty).count() == 0


def test_words_of_any_length_have_hashes_of_their_own():
    """Each hash alone tells them apart, wherever they are; bytes behind a word do not matter, zeros in it do."""
    words = [b"a" * n for n in range(1, 200)] + [b"a\x00" * n for n in range(1, 40)] + [b"\x00" * n for n in range(1, 80)] + [b"x" * n + b"y" for n in range(150)]
    for order in (words, words[::-1]):
        block = Block([("en", b" ".join(order))])
        assert [block.text(i, 1) for i in range(block.n)] == order
        twice = Block([("en", b"  ".join(order) + b"\t" + b" z,".join(order))])
        for h, again in zip(block.hash, twice.hash):
            assert len(set(h.tolist())) == len(set(order))
            assert (again[: block.n] == h).all() and (again[block.n :: 2] == h).all()


def test_a_step_adds_up_once(spark, odd_rows, monkeypatch):
    """One stored table for each step, besides the shards and the two results."""
    stored = []
    monkeypatch.setattr(c, "stage", lambda table, name, **more: stored.append(name) or stage(table, name, **more))
    docs = spark.createDataFrame([(t, lang) for t, lang in odd_rows], "text string, lang string").repartition(2)
    frequent_phrases(docs, threshold=40, shards=2)
    assert set(stored) == {"phrase-shards", "phrase-step", "phrases", "phrase-words"}


@pytest.mark.parametrize("shards", [1, 3])
def test_counts_go_many_to_a_row_and_a_phrase_is_named_once(spark, odd_rows, monkeypatch, shards):
    """A range of hashes has one row of open counts, however many phrases; no step names what one before it has named."""
    kinds, named = Counter(), []

    def stored(table, name, **more):
        table = stage(table, name, **more)
        if name == "phrase-step":
            rows = table.select("kind", "range", "one", "two").collect()
            kinds.update((r["kind"], r["range"], id(table)) for r in rows if r["kind"] == c.OPEN)
            named.extend((r["one"], r["two"]) for r in rows if r["kind"] == c.NAME)
        return table

    monkeypatch.setattr(c, "stage", stored)
    docs = spark.createDataFrame([(t, lang) for t, lang in odd_rows], "text string, lang string").repartition(3)
    found, _ = frequent_phrases(docs, threshold=7, shards=shards, bits=20)
    assert max(kinds.values(), default=1) == 1
    assert len(named) == len(set(named)) >= found.count() > 0


def test_a_stored_block_is_the_same():
    for parts in ([("en", b"a b, ab a b"), ("de", "é a\x00\x1c. b".encode()), ("en", b"b a")], [("x", b"one")], [("x", b"., ")]):
        block = Block(parts)
        (again,) = Block.all_of(block.stored(0, 9))
        assert again.n == block.n and again.langs == block.langs
        assert [again.text(i, 1) for i in range(block.n)] == [w for _, p in parts for w in p.replace(b".", b" ").replace(b",", b" ").split(b" ") if w]
        for x, y in zip([block.lang, block.last, *block.hash, *block.first], [again.lang, again.last, *again.hash, *again.first]):
            assert x.tolist() == y.tolist()


def test_only_the_unnamed_are_named():
    block = Block([("en", b"a b a b")])
    none, full = Filter(16), Filter(16, np.full(1 << 13, 255, np.uint8))
    fresh = lambda unnamed: [int(f.sum()) for *_, f in block.scan(0, 3, full, none, 3, unnamed)]
    assert fresh(None) == fresh(full) == [4, 3, 2] and fresh(none) == [0, 0, 0]


def test_few_bits_go_to_the_driver_in_few_bytes(spark):
    hashes = np.random.default_rng(3).integers(0, 2**63, 500).astype(np.uint64)
    rows = spark.createDataFrame([(c.REACHED, hashes[:300].tobytes()), (c.REACHED, hashes[300:].tobytes()), (c.UNNAMED, hashes[:1].tobytes())], "kind int, ones binary")
    found = c.filled(rows, 22)
    assert sum(len(data) for kind in found.values() for _, data in kind) < (1 << 22) // 8 // 4
    assert Filter(22).with_segments(found[c.REACHED]).has(hashes).all()
    one = Filter(22).with_segments(found[c.UNNAMED])
    assert one.has(hashes[:1]).all() and one.has(hashes).sum() < 5
