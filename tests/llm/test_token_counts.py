"""Token counts, held against the tokenizer's own library."""

import random
from pathlib import Path

import numpy as np
import pyarrow.parquet as pq
import pytest

from graphprep.llm import token_counts
from graphprep.llm.queries import QUERIES
from graphprep.llm.token_counts import BEGIN, Counter, Cutter, count_tokens, default_tokenizer

DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(default_tokenizer())
    return lambda texts: [len(e.ids) for e in tokenizer.encode_batch(list(texts), add_special_tokens=False)]


@pytest.fixture(scope="module")
def counter():
    return Counter(default_tokenizer())


def test_odd_texts_have_the_librarys_counts(library, counter):
    texts = [
        "", "a", " ", "  ", "\n", " \n a", "it's we've 'll 'rx 're' ''s 's's \"'t  'd", "<|endoftext|>  <|endoftext|>x", "x  <|endoftext|> y",
        " \t\n\x0b x 1 2٣४　  é ﬀ ำa😀 ' 's", "\x00\x1c\x85\xa0a ﻿", "don't 'r", "'v", "'l 'l", "a" * 3001, "ab" * 700 + " ", "-" * 500, " " * 999, "'" * 99 + "s", "1" * 50,
    ]
    draw = random.Random(3)
    alphabet = ["'", *"strevlmd", " ", "  ", "\n", "\t", "1", "٣", "é", "ß", "!", "　", "A", "<|endoftext|>", "😀", "́", "\x00"]
    texts += ["".join(draw.choices(alphabet, k=draw.randrange(1, 60))) for _ in range(5000)]
    points = [c for c in range(0x20, 0x110000) if not 0xD800 <= c < 0xE000]
    texts += ["".join(map(chr, draw.sample(points[: draw.choice([0x60, 0x3000, len(points)])], 40))) for _ in range(2000)]
    assert counter(texts).tolist() == library(texts)


def test_a_forgetful_tokenizer_counts_the_same(library, counter, monkeypatch):
    texts = pq.read_table(f"{DATA}/documents.parquet")["text"].to_pylist()[:60]
    monkeypatch.setattr(counter.merge, "remembered", 500)
    assert counter(texts).tolist() == library(texts)


def test_long_texts_are_counted_block_by_block(library, counter, monkeypatch):
    monkeypatch.setattr(token_counts, "BLOCK", 100)
    texts = ["word's  it'll \n\n next" * 40, "a" * 1000, " " * 450 + "x", "é'" * 300, "x<|endoftext|>" * 50, "x" * 99 + " \n" * 200 + "'re"]
    assert counter(texts).tolist() == library(texts)


def test_chunk_maps_and_their_scan_give_the_states_of_one_sequential_run(counter):
    cut: Cutter = counter.cut
    draw = np.random.default_rng(5)
    # Few classes, so that chunks whose maps do not converge occur: a chunk of padding is the identity.
    lanes = draw.choice([3, 4, 5, 7, 12], size=(3, 40), p=[0.1, 0.1, 0.2, 0.2, 0.4]).astype(np.uint8)
    maps = cut.maps(lanes)
    assert (maps != maps[0]).any(axis=0).sum() > 3
    state, wanted = BEGIN, []
    for chunk in lanes.T:
        wanted.append(state)
        for kind in chunk:
            state = int(cut.next[state * cut.width + kind]) // cut.width
    assert (cut.entries(maps) // cut.width).tolist() == wanted


def test_transitions_add_up_to_the_definition(counter):
    draw = random.Random(9)
    for _ in range(3000):
        piece = bytes(draw.choices(b"aeinstrhlo \xc3\xa9\xa8.-", k=draw.randrange(1, 25)))
        assert counter.merge(piece) == len(counter.merge.encoded(piece)), piece


def test_whole_table(spark, library):
    documents = pq.read_table(f"{DATA}/documents.parquet")
    texts = documents["text"].to_pylist()
    wanted = [(i, len(t.encode()), n, n > 512) for i, t, n in zip(documents["doc_id"].to_pylist(), texts, library(texts))]
    result = QUERIES["op13_token_counts"](spark, DATA)
    assert result.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert sorted(map(tuple, result.collect())) == sorted(wanted)


def test_odd_and_empty_tables(odd, empty, library):
    rows = odd.select("doc_id", "text").collect()
    texts = [r["text"] or "" for r in rows]
    wanted = [(r["doc_id"], len(t.encode()), n, n > 5) for r, t, n in zip(rows, texts, library(texts))]
    assert sorted(map(tuple, count_tokens(odd, limit=5).collect()), key=repr) == sorted(wanted, key=repr)
    assert count_tokens(empty).count() == 0


def test_other_tokenizers_are_refused(tmp_path):
    import public_tokenizers

    with pytest.raises(ValueError, match="byte-level"):
        Counter(str(Path(public_tokenizers.path("word_bpe_49k.json"))))
