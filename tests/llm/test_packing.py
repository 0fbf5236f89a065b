"""Packing against the tokenizer itself and a brute-force schedule."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from graphprep.llm import packing

TEXTS = [
    "",
    " ",
    "plain words, and more.",
    "two  spaces   three\n\nlines \n mixed\t tabs  ",
    " \nleading",
    "it's they'll don't 've 123 45,6 x_y",
    "naïve café 😀 ß　wide\x1csep\x85nel \xa0nbsp",
    "<|endoftext|> stays text",
    "end \n",
    "a   b c",
]


@pytest.fixture(scope="module")
def tokenizer():
    found = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found.encode_special_tokens = True
    return found


def test_ids_equal_the_tokenizers(tokenizer):
    encode = packing.Encoder(*packing.default_tokenizer())
    random.seed(4)
    parts = [" ", "  ", "\n", "\t", "a", "Wort", "é", "1", "'s", ".", " ", "x-y", "🙂"]
    texts = TEXTS + ["".join(random.choices(parts, k=30)) for _ in range(300)]
    for text in texts * 2:
        ids = np.frombuffer(encode(text), "<u2").tolist()
        assert ids == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def brute(sizes, credits, quantum):
    """Round by round, token by token: queue and number of each token of the output."""
    out, given, deficit_rounds = [], [0] * len(sizes), 0
    while sum(given) < sum(sizes):
        deficit_rounds += 1
        for q, size in enumerate(sizes):
            covered = int(np.floor(deficit_rounds * credits[q] / quantum)) * quantum
            while given[q] < min(size, covered):
                out.append((q, given[q]))
                given[q] += 1
    return out


@pytest.mark.parametrize("sizes, shares, quantum", [([700, 90, 333], None, 8), ([50, 400], [1, 1], 16), ([1], None, 32), ([300, 300, 1, 5], [5, 2, 1, 1], 1)])
def test_schedule_is_deficit_round_robin(sizes, shares, quantum):
    schedule = packing.schedule_of(sizes, shares, 64, quantum)
    expected = brute(sizes, schedule.credits, quantum)
    place = {}
    for q, size in enumerate(sizes):
        step = max(1, size // 3)
        for start in range(0, size, step):
            for first, n, at in schedule.spans(q, start, min(start + step, size)):
                for i in range(n):
                    place[at + i] = (q, first + i)
    assert [place[i] for i in range(len(expected))] == expected
    # Every window is within a quantum of the targets for each queue until one runs dry.
    if shares is None:
        for window in range(sum(sizes) // 64):
            seen = Counter(q for q, _ in expected[: (window + 1) * 64])
            for q, credit in enumerate(schedule.credits):
                assert abs(seen[q] - credit * (window + 1)) <= 2 * quantum * len(sizes)


def check_pieces(rows, docs, tokenizer, length):
    pieces, windows = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        windows[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(pieces) == {d[0] for d in docs}
    for doc_id, text in docs:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        at = 0
        for r in sorted(pieces[doc_id], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids) and r["length"] > 0
            at += r["length"]
            assert r["ids_crc32"] == zlib.crc32(np.array(ids[r["start"] : at], "<u4").tobytes())
        assert at == len(ids)
    total = 0
    for spans in windows.values():
        at = 0
        for offset, n in sorted(spans):
            assert offset == at
            at += n
        assert at == length or (at < length and at & (at - 1) == 0)
        total += at
    assert sorted(windows) == list(range(len(windows)))
    assert sum(n for spans in windows.values() for _, n in spans) == total


@pytest.mark.parametrize("shares", [None, {"s0": 5, "s1": 2, "s2": 1, None: 1}])
def test_every_token_lies_in_one_piece(spark, docs_of, tokenizer, shares):
    random.seed(8)
    docs = [(i, "word " * random.randrange(400) + random.choice(TEXTS), "en", random.choice(["s0", "s0", "s1", "s2", None])) for i in range(120)]
    docs.append((500, None, "en", "s1"))
    rows = packing.pack(docs_of(docs, clashing=True).repartition(3), shares, length=256, quantum=16).collect()
    check_pieces(rows, [(d[0], d[1]) for d in docs], tokenizer, 256)
    if shares is None:
        totals = Counter()
        for r in rows:
            totals[r["source"]] += r["length"]
        share = {s: n / sum(totals.values()) for s, n in totals.items()}
        for window in range(sum(totals.values()) // 256):
            mine = Counter()
            for r in rows:
                if r["sequence_id"] == window:
                    mine[r["source"]] += r["length"]
            assert all(abs(mine[s] - 256 * p) <= 2 * 16 for s, p in share.items())


def test_odd_documents_are_packed(odd, empty, tokenizer):
    rows = packing.pack(odd).collect()
    one = [r for r in rows if r["doc_id"] == 5]
    assert sum(r["length"] for r in one) == 2 * one[0]["doc_tokens"]  # repeated rows are packed both
    assert sum(r["length"] for r in rows if r["doc_id"] == 1) == 1
    assert packing.pack(empty).count() == 0


def covered(rows, length):
    """Every token of every document in one piece, every place of every sequence taken once."""
    spans, places = {}, {}
    for r in rows:
        spans.setdefault((r["doc_id"], r["doc_tokens"]), []).append((r["start"], r["length"]))
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for (_, n), parts in spans.items():
        at = 0
        for start, size in sorted(parts):
            assert start == at
            at += size
        assert at == n
    for parts in places.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at == length or at & (at - 1) == 0


def test_more_sources_than_queues(docs_of, monkeypatch):
    """Sources beyond the queues share some; all of them are packed."""
    docs = [(i, f"text of {i} " * (i % 7), "en", f"s{i % 300}" if i % 11 else None) for i in range(900)]
    monkeypatch.setattr(packing, "OWN_QUEUES", 20)
    monkeypatch.setattr(packing, "GROUPS", 7)
    rows = packing.pack(docs_of(docs).repartition(3), length=64, quantum=8).collect()
    assert {r["doc_id"] for r in rows} == set(range(900))
    covered(rows, 64)
    shares = {f"s{i}": 1.0 + i % 3 for i in range(300)} | {None: 2.0}
    covered(packing.pack(docs_of(docs).repartition(3), shares, length=64, quantum=8).collect(), 64)


def test_twenty_thousand_sources(docs_of):
    docs = [(i, "some words", "en", f"source {i}") for i in range(20_000)]
    rows = packing.pack(docs_of(docs), with_ids=False).collect()
    assert len({r["doc_id"] for r in rows}) == 20_000 and "ids" not in rows[0].asDict()
    covered(rows, packing.LENGTH)


def test_ids_are_the_librarys_on_the_whole_table():
    import public_tokenizers
    import pyarrow.parquet as pq
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    library.encode_special_tokens = True
    encoder = packing.encoder_of(packing.default_tokenizer())
    assert encoder is packing.encoder_of(packing.default_tokenizer())
    texts = [t or "" for t in pq.read_table("/root/testdata/sf0.01/documents.parquet")["text"].to_pylist()]
    for text, found in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(encoder(text), "<u2").tolist() == found.ids


def test_long_texts_are_encoded_in_parts(tokenizer, monkeypatch):
    """Parts of any size give the same ids, and no call gets more than a part and what follows up to a space between words."""
    encode = packing.Encoder(*packing.default_tokenizer())
    draw = random.Random(6)
    parts = [" ", "  ", "\n", "\t", "a", "Wort", "é", "1", "'s", ".", "x-y", "🙂", "\x1c", "\xa0"]
    texts = TEXTS + ["".join(draw.choices(parts, k=40)) for _ in range(200)]
    whole, sizes = encode.encode, []
    monkeypatch.setattr(encode, "encode", lambda text: sizes.append(len(text)) or whole(text))
    monkeypatch.setattr(encode, "part", 3)
    for text in texts:
        assert np.frombuffer(encode(text), "<u2").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)
    sizes.clear()
    encode("word " * 1000)
    assert max(sizes) <= 10


@pytest.mark.parametrize("sizes, quantum, length", [([700, 90, 333], 8, 64), ([5000], 32, 64), ([1], 32, 64), ([300, 300, 1, 5], 1, 16), ([64, 64], 8, 64), ([129, 7], 4, 128)])
def test_pieces_of_many_documents_at_once(sizes, quantum, length):
    """Documents that follow each other in a queue, worked on together, against the schedule token by token."""
    draw = random.Random(7)
    schedule = packing.schedule_of(sizes, None, length, quantum)
    tail = schedule.tail()
    output = {token: i for i, token in enumerate(brute(sizes, schedule.credits, quantum))}
    taken = set()
    for queue, size in enumerate(sizes):
        cuts = sorted({0, *draw.sample(range(size), min(size, 9))})
        starts, n = np.array(cuts), np.diff([*cuts, size])
        document, low, sequence, offset = (x.tolist() for x in schedule.pieces(queue, starts, n, tail))
        ends = [low[i + 1] if i + 1 < len(low) and document[i + 1] == document[i] else n[document[i]] for i in range(len(low))]
        assert sorted(set(document)) == list(range(len(starts)))
        for d, at, end, s, o in zip(document, low, ends, sequence, offset):
            assert end > at
            for i in range(end - at):
                place = output[queue, cuts[d] + at + i]
                if place < tail[0]:
                    assert (s, o + i) == (place // length, place % length)
                else:
                    k = sum(b <= place for b in tail[1]) - 1
                    assert (s, o + i) == (tail[0] // length + k, place - tail[1][k])
                taken.add((s, o + i))
    assert len(taken) == sum(sizes)


def test_batches_have_some_tokens_and_lose_no_row(monkeypatch):
    monkeypatch.setattr(packing, "BATCH", 10)
    slices = list(packing.batches_of(np.array([3, 4, 5, 100, 1, 1, 9, 10])))
    assert [i for s in slices for i in range(s.start, s.stop)] == list(range(8)) and max(s.stop - s.start for s in slices) == 3
    assert list(packing.batches_of(np.array([], np.int64))) == []
