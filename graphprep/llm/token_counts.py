"""Token counts by a tokenizer compiled to finite-state transducers.

A byte-level BPE tokenizer works in two steps, and each is compiled to a deterministic transducer:

* ``Cutter``: the automaton of the pre-tokenizer's pattern over classes of characters. Its transitions say where a piece
  begins (before the character read, or before the one before it). Which character has which class is asked of the
  tokenizer itself, so no other library's Unicode tables are mixed in.
* ``Merger``: the automaton of the merges over bytes. Each transition carries the number of tokens it adds, which is 0 or
  less where bytes melt into earlier tokens; the sum over a piece is its number of tokens. The encoding of a text ends with
  token ``t`` if and only if the encoding of what comes before ends with a token that may stand beside ``t``; so a state
  holds, for every suffix that begins a token, the last token before it and how many there are. States are compiled when
  they are first reached, and forgotten when they are too many.

A batch of texts is one stream of characters. It is cut into chunks that are scanned together: from each chunk the map of
all states to the states they lead to is taken (they soon agree, and from there on one lane is enough), the maps are
composed by a parallel prefix scan, and with the states at the chunks' beginnings known, the pieces of all chunks are read
off at once. Texts longer than a block are scanned block by block from the last piece's beginning.

Defined results: a null text is empty and an empty text has no bytes and no tokens; texts of any length are counted whole,
a piece of any length in time proportional to it; the string of a special token counts as that one token, as by the
library's default; repeated rows and ties are counted row by row; an empty table gives an empty one; further columns are
not looked at, whatever their names.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphprep.llm.common import columns_of, extended

VOCABULARY = "byte_bpe_50k.json"
LIMIT = 512
CHUNK = 256
#: Characters that are scanned at once.
BLOCK = 1 << 20
#: Compiled transitions, compared pairs of tokens and remembered pieces of one worker; beyond, all are forgotten.
REMEMBERED = 2_000_000

# The pattern's contractions. A quote counts as their beginning only at the beginning of a piece.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")

CLASSES = ("letter", "number", "other", "space", "blank", "quote", "s/t/m/d", "r", "v", "l", "e", "end", "pad")
LETTER, NUMBER, OTHER, SPACE, BLANK, QUOTE, SHORT, R, V, L, E, END, PAD = range(len(CLASSES))
LETTERS = (LETTER, SHORT, R, V, L, E)
STATES = ("begin", "letters", "numbers", "others", "space", "blank", "spaces, space last", "spaces, blank last", "quote", "'r", "'v", "'l")
BEGIN, IN_LETTERS, IN_NUMBERS, IN_OTHERS, ONE_SPACE, ONE_BLANK, MORE_SPACE, MORE_BLANK, AT_QUOTE, QUOTE_R, QUOTE_V, QUOTE_L = range(len(STATES))
HERE, BEFORE = 1, 2  # a piece begins at the character read, at the one before it


def _fresh(kind: int) -> int:
    """The state after a piece's first character."""
    if kind in LETTERS:
        return IN_LETTERS
    return {NUMBER: IN_NUMBERS, OTHER: IN_OTHERS, SPACE: ONE_SPACE, BLANK: ONE_BLANK, QUOTE: AT_QUOTE, END: BEGIN}[kind]


def _step(state: int, kind: int) -> tuple[int, int]:
    """``(next state, where pieces begin)``."""
    if kind == PAD:
        return state, 0
    new = _fresh(kind), HERE
    if kind == END:
        return BEGIN, HERE | (BEFORE if state in (QUOTE_R, QUOTE_V, QUOTE_L) else 0)
    if state == IN_LETTERS and kind in LETTERS or state == IN_NUMBERS and kind == NUMBER or state == IN_OTHERS and kind in (OTHER, QUOTE):
        return state, 0
    if state in (ONE_SPACE, ONE_BLANK, MORE_SPACE, MORE_BLANK) and kind in (SPACE, BLANK):
        return (MORE_SPACE if kind == SPACE else MORE_BLANK), 0
    if state in (ONE_SPACE, MORE_SPACE):
        # The last space goes with what follows it; the spaces before it are a piece of their own.
        return (IN_OTHERS if kind == QUOTE else _fresh(kind)), BEFORE if state == MORE_SPACE else 0
    if state == MORE_BLANK:
        return new[0], HERE | BEFORE
    if state == AT_QUOTE:
        if kind in (OTHER, QUOTE):
            return IN_OTHERS, 0
        if kind == SHORT:
            return BEGIN, 0
        if kind in (R, V, L):
            return {R: QUOTE_R, V: QUOTE_V, L: QUOTE_L}[kind], 0
    if state in (QUOTE_R, QUOTE_V, QUOTE_L):
        if kind == (L if state == QUOTE_L else E):
            return BEGIN, 0
        # The quote stands alone, and its letter has begun a piece.
        return (IN_LETTERS, BEFORE) if kind in LETTERS else (new[0], HERE | BEFORE)
    return new


def character_classes(pieces_of) -> np.ndarray:
    """The class of each code point, by asking for the pieces of strings (``pieces_of`` gives their lengths)."""
    table = np.full(0x110000, OTHER, np.uint8)

    def kind(character: str) -> int:
        for neighbour, found in (("a", LETTER), ("1", NUMBER), ("!", OTHER)):
            if len(pieces_of(character + neighbour)) == 1:
                return found
        return BLANK

    # Where the class changes a piece ends, so a piece of neighbouring code points has one class.
    points = [c for c in range(0x80, 0x110000) if not 0xD800 <= c < 0xE000]
    at = 0
    for size in pieces_of("".join(map(chr, points))):
        table[points[at] : points[at + size - 1] + 1] = kind(chr(points[at]))
        at += size
    for c in range(0x80):
        table[c] = kind(chr(c))
    table[0x20], table[ord("'")] = SPACE, QUOTE
    for c in "stmd":
        table[ord(c)] = SHORT
    table[ord("r")], table[ord("v")], table[ord("l")], table[ord("e")] = R, V, L, E
    return table


class Cutter:
    """Where the pieces of a stream of character classes begin."""

    def __init__(self, classes: np.ndarray) -> None:
        self.classes = classes
        self.width = len(CLASSES)
        steps = [_step(state, kind) for state in range(len(STATES)) for kind in range(self.width)]
        # States are kept as offsets of their row, so that a step is one addition and one look-up.
        self.next = np.array([state * self.width for state, _ in steps], np.uint8)
        self.begins = np.array([marks for _, marks in steps], np.uint8)
        self.states = np.arange(len(STATES), dtype=np.uint8) * np.uint8(self.width)

    def maps(self, lanes: np.ndarray) -> np.ndarray:
        """For every state (rows) and chunk (columns of ``lanes``) the state at the chunk's end."""
        n = lanes.shape[1]
        open_ = np.arange(n)
        maps = np.repeat(self.states[:, None], n, axis=1)
        single = maps[0].copy()
        for at, kinds in enumerate(lanes):
            if len(open_):
                maps = self.next[maps + kinds[open_]]
            if len(open_) < n:
                single = self.next[single + kinds]
            if at % 4 == 3 and len(open_):
                differs = (maps != maps[0]).any(axis=0)
                single[open_] = maps[0]
                open_, maps = open_[differs], maps[:, differs]
        full = np.repeat(single[None, :], len(self.states), axis=0)
        full[:, open_] = maps
        return full

    def entries(self, maps: np.ndarray) -> np.ndarray:
        """The state in which each chunk begins: a prefix scan of the maps under composition, in doubling steps."""
        n = maps.shape[1]
        done = maps // self.width
        reach = 1
        while reach < n:
            # After this step a column holds the map of the (at most) 2 * reach chunks that end with it.
            done = np.concatenate([done[:, :reach], np.take_along_axis(done[:, reach:], done[:, :-reach], axis=0)], axis=1)
            reach *= 2
        return np.concatenate([[BEGIN], done[BEGIN, :-1]]).astype(np.uint8) * np.uint8(self.width)

    def __call__(self, kinds: np.ndarray) -> np.ndarray:
        """Places, in order, where pieces begin; the stream begins in state ``begin``."""
        n = len(kinds)
        chunks = -(-n // CHUNK)
        padded = np.full(chunks * CHUNK, PAD, np.uint8)
        padded[:n] = kinds
        lanes = np.ascontiguousarray(padded.reshape(chunks, CHUNK).T)
        state = self.entries(self.maps(lanes))
        marks = np.empty_like(lanes)
        for at, kind in enumerate(lanes):
            place = state + kind
            marks[at] = self.begins[place]
            state = self.next[place]
        marks = marks.T.reshape(-1)[:n]
        begins = (marks & HERE).astype(bool)
        begins[:-1] |= (marks[1:] & BEFORE).astype(bool)
        return np.flatnonzero(begins)


def byte_letters() -> dict[str, int]:
    """The characters that stand for bytes in the vocabulary: printable ones for themselves, the others from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Merger:
    """Number of tokens of a piece, byte by byte, by transitions that are compiled when they are first taken."""

    START = -1
    ROOT = 0

    def __init__(self, vocabulary: dict[str, int], merges: list, remembered: int = REMEMBERED) -> None:
        self.remembered = remembered
        letters = byte_letters()
        self.bytes = {i: bytes(letters[c] for c in token) for token, i in vocabulary.items()}
        self.single = {text[0]: i for i, text in self.bytes.items() if len(text) == 1}
        self.ranks: dict[tuple[int, int], tuple[int, int]] = {}
        self.formed: dict[int, int] = dict.fromkeys(self.single.values(), -1)
        self.halves: dict[int, tuple[int, int]] = {}
        for rank, merge in enumerate(merges):
            left, right = merge if isinstance(merge, (list, tuple)) else merge.split(" ")
            a, b, whole = vocabulary[left], vocabulary[right], vocabulary[left + right]
            if whole in self.formed or max(self.formed.get(a, rank), self.formed.get(b, rank)) >= rank:
                raise ValueError("merges must make each token once, after its halves")
            self.ranks[a, b] = rank, whole
            self.formed[whole] = rank
            self.halves[whole] = a, b
        # All tokens as a tree: (node, byte) to node, and the token that ends at a node.
        self.child: dict[int, int] = {}
        self.token: dict[int, int] = {}
        nodes = 1
        for i in self.formed:
            node = self.ROOT
            for byte in self.bytes[i]:
                key = node << 8 | byte
                if key not in self.child:
                    self.child[key] = nodes
                    nodes += 1
                node = self.child[key]
            self.token[node] = i
        self.forget()

    def forget(self) -> None:
        begin = ((self.ROOT, self.START, 0),)
        self.states = [begin]
        self.numbers = {begin: 0}
        self.steps: dict[int, tuple[int, int]] = {}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.pieces: dict[bytes, int] = {}

    def encoded(self, text: bytes) -> list[int]:
        """The ids of a piece by the definition: the earliest merge first, the leftmost of equal ones."""
        ids = [self.single[b] for b in text]
        while len(ids) > 1:
            rank, at = min((self.ranks.get(pair, (len(self.ranks), 0))[0], i) for i, pair in enumerate(zip(ids, ids[1:])))
            if rank == len(self.ranks):
                break
            ids[at : at + 2] = [self.ranks[ids[at], ids[at + 1]][1]]
        return ids

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """The tokens at one edge of a token while it is built, each with the rank of the merge that ends it."""
        edge = [(token, len(self.ranks))]
        while token in self.halves:
            rank = self.formed[token]
            token = self.halves[token][side]
            edge.append((token, rank))
        return edge[::-1]

    def beside(self, left: int, right: int) -> bool:
        """Whether the encoding of two tokens' text is these two tokens: no merge crosses while both are built.

        Merges come in order of rank, since each is ranked after its halves. At equal rank the left one comes first.
        """
        if left == self.START:
            return self.encoded(self.bytes[right]) == [right]
        if not self.stands(self.START, right):
            return False
        lefts, rights = self._edge(left, 1), self._edge(right, 0)
        i = j = 0
        while True:
            (a, a_ends), (b, b_ends) = lefts[i], rights[j]
            rank = self.ranks.get((a, b), (len(self.ranks), 0))[0]
            if rank < a_ends and rank <= b_ends and rank < len(self.ranks):
                return False
            if a_ends <= b_ends and i + 1 < len(lefts):
                i += 1
            elif j + 1 < len(rights):
                j += 1
            elif i + 1 < len(lefts):
                i += 1
            else:
                return True

    def stands(self, left: int, right: int) -> bool:
        found = self.pairs.get((left, right))
        if found is None:
            found = self.pairs[left, right] = self.beside(left, right)
        return found

    def compiled(self, number: int, byte: int) -> tuple[int, int]:
        """The transition of a state by a byte: ``(state, tokens added)``.

        A state lists the places from which a token may still be growing: its node in the tree, the last token before it,
        and how many tokens there are up to it, counted from the place reached.
        """
        grown, last = [], None
        for node, before, count in self.states[number]:
            next_node = self.child.get(node << 8 | byte)
            if next_node is None:
                continue
            grown.append((next_node, before, count))
            token = self.token.get(next_node)
            if last is None and token is not None and self.stands(before, token):
                last = token, count + 1
        token, added = last
        state = (*((node, before, count - added) for node, before, count in grown), (self.ROOT, token, 0))
        if state not in self.numbers:
            self.numbers[state] = len(self.states)
            self.states.append(state)
        self.steps[number << 8 | byte] = found = self.numbers[state], added
        return found

    def __call__(self, piece: bytes) -> int:
        """Tokens of a piece."""
        if len(self.steps) + len(self.pairs) + len(self.pieces) > self.remembered:
            self.forget()
        state = total = 0
        step = self.steps.get
        for byte in piece:
            state, added = step(state << 8 | byte) or self.compiled(state, byte)
            total += added
        if len(piece) <= 64:
            self.pieces[piece] = total
        return total


class Counter:
    """Numbers of tokens of texts, by the two transducers of a byte-level BPE tokenizer's file."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        model, pre = described["model"], described["pre_tokenizer"] or {}
        if model["type"] != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True) or described["normalizer"]:
            raise ValueError("only byte-level BPE without a normalizer or an added first space is compiled")
        if model.get("dropout") or model.get("ignore_merges") or model.get("continuing_subword_prefix") or model.get("end_of_word_suffix"):
            raise ValueError("only plain merges are compiled")
        added = described.get("added_tokens", [])
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added):
            raise ValueError("added tokens that take in their surroundings are not compiled")
        longest = sorted((t["content"] for t in added), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, longest))) if longest else None
        pieces = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        self.cut = Cutter(character_classes(lambda text: [stop - start for _, (start, stop) in pieces(text)]))
        self.merge = Merger(model["vocab"], model["merges"])

    def _pieces(self, text: str, ends: np.ndarray) -> tuple[list[int], np.ndarray, int]:
        """Tokens of the pieces of a stream, the places where they begin, and where the last, open one begins.

        ``ends`` are places of one character each that part the texts; their own pieces are left out.
        """
        points = np.frombuffer(text.encode("utf-32-le"), "<u4")
        kinds = self.cut.classes[points]
        kinds[ends] = END
        begins = self.cut(kinds)
        if len(begins) == 0:
            return [], begins, 0
        wide = np.cumsum(1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000), dtype=np.int64)
        data = text.encode()
        offsets = np.append(0, wide)[begins]
        whole = kinds[begins[:-1]] != END
        start, stop = offsets[:-1][whole].tolist(), offsets[1:][whole].tolist()
        pieces = [data[a:b] for a, b in zip(start, stop)]
        found = list(map(self.merge.pieces.get, pieces))
        if None in found:
            found = [self.merge(piece) if n is None else n for n, piece in zip(found, pieces)]
        return found, begins[:-1][whole], int(begins[-1])

    def _long(self, text: str) -> int:
        """Tokens of one text, block by block; a block is widened while it holds no whole piece."""
        total, rest, size = 0, "", BLOCK
        at = 0
        while at < len(text):
            rest += text[at : at + size]
            at += size
            last = at >= len(text)
            stream = rest + "\0" if last else rest
            counts, _, open_ = self._pieces(stream, np.array([len(rest)] if last else [], np.int64))
            total += sum(counts)
            size = 2 * size if open_ == 0 else BLOCK
            rest = rest[open_:]
        return total

    def __call__(self, texts: list[str]) -> np.ndarray:
        counts = np.zeros(len(texts), np.int64)
        parts: list[str] = []
        owners: list[int] = []
        size = 0

        def flush() -> None:
            nonlocal parts, owners, size
            if parts:
                ends = np.cumsum([len(p) + 1 for p in parts]) - 1
                found, begins, _ = self._pieces("\0".join(parts) + "\0", ends)
                np.add.at(counts, np.array(owners)[np.searchsorted(ends, begins)], found)
            parts, owners, size = [], [], 0

        for row, text in enumerate(texts):
            own = self.special.split(text) if self.special else [text]
            counts[row] += len(own) - 1
            for part in own:
                if len(part) > BLOCK:
                    counts[row] += self._long(part)
                elif part:
                    parts.append(part)
                    owners.append(row)
                    size += len(part) + 1
                    if size > BLOCK:
                        flush()
        flush()
        return counts


_counters: dict[str, Counter] = {}


def counter_of(path: str) -> Counter:
    """The compiled tokenizer of this worker process; it outlives tasks."""
    if path not in _counters:
        _counters[path] = Counter(path)
    return _counters[path]


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def count_tokens(docs: DataFrame, limit: int = LIMIT, tokenizer: str | None = None) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every document; ``tokenizer`` is the path of a byte-level BPE file.

    Rows stay where they are; nothing is shuffled.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    schema = extended(rows.drop("text"), "n_bytes bigint, n_tokens bigint, over_limit boolean")
    names, path = schema.names, tokenizer

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = counter_of(path or default_tokenizer())
        for batch in batches:
            for part in range(0, batch.num_rows, 1024):
                rows_ = batch.slice(part, 1024)
                (texts,) = columns_of(rows_, "text")
                tokens = counter(texts)
                sizes = pa.array([len(t.encode()) for t in texts], pa.int64())
                yield pa.RecordBatch.from_arrays([rows_.column(0), sizes, pa.array(tokens), pa.array(tokens > limit)], names=names)

    return rows.mapInArrow(count, schema)
