"""One large JSON document, read by many tasks.

Spark's text source cuts a file into byte ranges at any separator; here it is the comma. What a range means depends on what is
before it: whether it begins inside a string, and in which of the open arrays and objects. Both are carried over the ranges by
prefix sums, of one small row for each range:

1. Each range tells its number of quotes, odd or even, and its text up to the first quote. The running parity says which
   ranges begin inside a string, and the text up to the quote is the rest of that string.
2. Each range, read from there on, tells what it does to the stack of open arrays and objects: how many it closes, and what it
   leaves open, with keys and places reached. These effects are composed from left to right.
3. With its stack known, each range hands out the entries it holds, with their places in the whole document.

The rest of a string that crosses from one range to the next goes through the driver, as do the rows of 1 and 2; nothing else
does. A malformed document is an error.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A string, a mark, another scalar; or a string that is not closed here.
TOKEN = re.compile(r'"(?:[^"\\]|\\.)*"|[\[\]{}:,]|[^\s"\[\]{}:,]+|(?P<open>".*)', re.DOTALL)
ESCAPED = re.compile(r"\\.", re.DOTALL)
FIRST_QUOTE = re.compile(r'(?:[^"\\]|\\.)*?"', re.DOTALL)
SCALAR = re.compile(r"-?(0|[1-9][0-9]*)(\.[0-9]+)?([eE][+-]?[0-9]+)?|true|false|null")
#: What came last: nothing, an opening bracket, a comma, a colon, a string, another whole value.
BEGIN, OPEN, COMMA, COLON, STRING, VALUE = range(6)
#: The string that an earlier range ended with, as a key.
INHERITED = 0


class Malformed(ValueError):
    pass


class Frame:
    """An open array or object, or (``kind`` is empty) one that an earlier range has opened."""

    __slots__ = ("kind", "commas", "key", "string", "wanted")

    def __init__(self, kind: str = "", commas: int = 0, key=None, string=None):
        self.kind, self.commas, self.key, self.string = kind, commas, key, string
        self.wanted: bool | None = None  # whether its entries are asked for

    def state(self) -> list:
        return [self.kind, self.commas, self.key, self.string]


class Scanner:
    """Reads a range token by token. ``emit(stack, token)`` is called for each scalar value, ``opened(stack)`` for each bracket."""

    def __init__(self, stack: list[Frame], last: int, known: bool, emit: Callable | None = None, opened: Callable | None = None):
        self.stack, self.last, self.known, self.emit, self.opened = stack, last, known, emit, opened
        self.closed = 0  # unknown frames closed
        self.rest = ""

    def _value(self, token: str) -> None:
        """A scalar that is known to be no key."""
        if self.emit:
            self.emit(self.stack, token)
        self.last = VALUE

    def feed(self, text: str) -> None:
        """The next part of the range; parts end at commas of the document."""
        if self.rest:
            text, self.rest = self.rest + text, ""
        for match in TOKEN.finditer(text):
            token = match.group()
            mark = token[0]
            top = self.stack[-1] if self.stack else None
            if mark == '"':
                if match.lastgroup == "open":
                    self.rest = token
                    return
                if self.last in (STRING, VALUE):
                    raise Malformed("two values without a comma")
                if self.last == COLON or top is None or top.kind == "[":
                    self._value(token)
                else:
                    top.string = token
                    self.last = STRING
            elif mark == ",":
                self.comma()
            elif mark == ":":
                if self.last != STRING or top is None or top.kind == "[":
                    raise Malformed("a colon without a key")
                top.key = top.string
                top.kind = top.kind or "{"
                self.last = COLON
            elif mark in "[{":
                if self.last in (STRING, VALUE) or top is not None and top.kind == "{" and self.last != COLON:
                    raise Malformed("an array or object out of place")
                self.stack.append(Frame(mark))
                self.last = OPEN
                if self.opened:
                    self.opened(self.stack)
            elif mark in "]}":
                self._close(mark)
            else:
                if self.last in (STRING, VALUE) or top is not None and top.kind == "{" and self.last != COLON or not SCALAR.fullmatch(token):
                    raise Malformed(f"unexpected {token[:40]!r}")
                self._value(token)

    def comma(self) -> None:
        top = self.stack[-1] if self.stack else None
        if top is None or self.last not in (STRING, VALUE) or self.last == STRING and top.kind == "{":
            raise Malformed("a comma out of place")
        if self.last == STRING and top.string != INHERITED:
            top.kind = "["  # a string without a colon: an array's
        top.commas += 1
        self.last = COMMA

    def _close(self, mark: str) -> None:
        top = self.stack.pop() if self.stack else None
        wanted = "[" if mark == "]" else "{"
        if top is None or top.kind and top.kind != wanted or self.last in (COMMA, COLON) or self.last == STRING and wanted == "{" and top.string != INHERITED:
            raise Malformed(f"unexpected {mark!r}")
        if not self.stack and not self.known:
            self.closed += 1
            self.stack.append(Frame())
        self.last = VALUE

    def end(self, following: str | None) -> None:
        """The range ends; ``following`` is the rest of a string it ends in."""
        if self.rest:
            if following is None:
                raise Malformed("a string is not closed")
            text, self.rest = f"{self.rest},{following}", ""
            self.feed(text)
            if self.rest:
                raise Malformed("a string is not closed")


def _text(token: str | None):
    return None if token is None or token == "null" else json.loads(token) if token[0] == '"' else token


class Range(NamedTuple):
    """What is known of a byte range before it is read for its entries."""

    inside: bool
    following: str | None
    stack: list
    last: int


def _fragments(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.option("lineSep", ",").text(path)
    return rows.select("value", F.col("_metadata.file_path").alias("document"), F.col("_metadata.file_block_start").alias("start"))


def _each_range(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], Iterator[str]]]:
    """The ranges that a task reads, one after the other, each as texts that end at commas of the document."""
    parts = ((key, values) for batch in batches for key, values in _runs(batch))
    held = next(parts, None)
    while held is not None:
        key = held[0]

        def texts() -> Iterator[str]:
            nonlocal held
            while held is not None and held[0] == key:
                values, held = held[1], next(parts, None)
                yield ",".join(values)

        own = texts()
        yield key, own
        for _ in own:  # what was not asked for
            pass


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], list[str]]]:
    values, documents, starts = (batch.column(i).to_pylist() for i in range(3))
    begin = 0
    for at in range(1, len(values) + 1):
        if at == len(values) or (documents[at], starts[at]) != (documents[begin], starts[begin]):
            yield (documents[begin], starts[begin]), values[begin:at]
            begin = at


def _quotes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for (document, start), texts in _each_range(batches):
        odd, head, found = 0, [], False
        for text in texts:
            odd ^= ESCAPED.sub("", text).count('"') & 1
            if not found:
                first = FIRST_QUOTE.match(text)
                head.append(text[: first.end()] if first else text)
                found = first is not None
        yield pa.RecordBatch.from_arrays([pa.array([document]), pa.array([start]), pa.array([odd], pa.int32()), pa.array([",".join(head)]), pa.array([found])], names=["document", "start", "odd", "head", "found"])


def _skipping_head(texts: Iterator[str], inside: bool) -> Iterator[str]:
    """A range's texts without the rest of an earlier range's string."""
    for text in texts:
        if inside:
            first = FIRST_QUOTE.match(text)
            if first is None:
                continue
            text, inside = text[first.end() :], False
        yield text


def _scan(scanner: Scanner, texts: Iterator[str], known: Range) -> Iterator[None]:
    """Feeds a range to a scanner, text by text."""
    fed = False
    for text in _skipping_head(texts, known.inside):
        if fed and scanner.rest:
            scanner.rest += ","
        elif fed:
            scanner.comma()
        scanner.feed(text)
        fed = True
        yield
    scanner.end(known.following)
    yield


def _effects(shared):
    def effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranges: dict[tuple[str, int], Range] = shared.value
        for key, texts in _each_range(batches):
            known = ranges[key]
            arrays: set[str] = set()
            first = known.last == BEGIN
            base = [] if first else [Frame(string=INHERITED)]
            scanner = Scanner(base, BEGIN if first else STRING if known.inside else COMMA, first)
            scanner.opened = lambda stack: arrays.add(stack[-2].key) if len(stack) > 1 and stack[-1].kind == "[" and stack[-2].key else None
            if known.inside and known.stack is None:  # nothing but the middle of a string
                for _ in texts:
                    pass
                effect = None
            else:
                for _ in _scan(scanner, texts, known):
                    pass
                effect = {"closed": scanner.closed, "frames": [f.state() for f in scanner.stack], "last": scanner.last, "first": first, "arrays": sorted(arrays)}
            yield pa.RecordBatch.from_arrays([pa.array([key[0]]), pa.array([key[1]]), pa.array([json.dumps(effect)])], names=["document", "start", "effect"])

    return effects


def _ranges(fragments: DataFrame) -> tuple[dict[tuple[str, int], Range], dict[str, set[str]]]:
    """What each range begins with; and the keys of arrays that each document holds."""
    spark = fragments.sparkSession
    rows = fragments.mapInArrow(_quotes, "document string, start long, odd int, head string, found boolean").collect()
    rows.sort(key=lambda r: (r["document"], r["start"]))
    inside, ranges, previous = False, {}, None
    for at, row in enumerate(rows):
        new = row["document"] != previous
        if new and inside:
            raise Malformed(f"a string in {previous} is not closed")
        inside = inside and not new
        # The rest of a string that the range ends in, over ranges that it fills altogether.
        following = None
        if inside ^ bool(row["odd"]):
            pieces = []
            for later in rows[at + 1 :]:
                if later["document"] != row["document"]:
                    break
                pieces.append(later["head"])
                if later["found"]:
                    following = ",".join(pieces)
                    break
            if following is None:
                raise Malformed(f"a string in {row['document']} is not closed")
        middle = inside and not row["found"]
        ranges[row["document"], row["start"]] = Range(inside, following, None if middle else [], BEGIN if new else COMMA)
        inside ^= bool(row["odd"])
        previous = row["document"]
    effects = fragments.mapInArrow(_effects(spark.sparkContext.broadcast(ranges)), "document string, start long, effect string").collect()
    effects = {(r["document"], r["start"]): json.loads(r["effect"]) for r in effects}
    begin: dict[tuple[str, int], Range] = {}
    arrays: dict[str, set[str]] = {}
    stack: list[list] = []
    last, previous = VALUE, None
    for key, known in ranges.items():
        if key[0] != previous:
            if previous is not None and (stack or last != VALUE):
                raise Malformed(f"{previous} ends too early")
            stack, last, previous = [], BEGIN, key[0]
        begin[key] = known._replace(stack=[list(f) for f in stack] if known.stack is not None else None, last=last if known.inside else BEGIN if last == BEGIN else COMMA)
        effect = effects[key]
        if effect is None:
            continue
        if last != BEGIN and not known.inside:
            if not stack or last not in (STRING, VALUE) or last == STRING and stack[-1][0] == "{":
                raise Malformed(f"a comma out of place in {key[0]}")
            stack[-1][1] += 1
        arrays.setdefault(key[0], set()).update(effect["arrays"])
        frames = effect["frames"]
        if not effect["first"] and len(stack) == effect["closed"] and len(frames) == 1 and frames[0] == Frame().state():
            stack, frames = [], []  # the document ends
        elif not effect["first"]:
            if len(stack) <= effect["closed"]:
                raise Malformed(f"too many closing brackets in {key[0]}")
            below = stack[: len(stack) - effect["closed"]]
            kind, commas, name, string = frames[0]
            top = below[-1]
            if kind and kind != top[0]:
                raise Malformed(f"a list and an object are mixed up in {key[0]}")
            top[1] += commas
            top[2] = top[3] if name == INHERITED else top[2] if name is None else name
            top[3] = top[3] if string == INHERITED else string if string is not None else top[3]
            stack, frames = below, frames[1:]
        stack, last = [*stack, *[list(f) for f in frames]], effect["last"]
    if previous is not None and (stack or last != VALUE):
        raise Malformed(f"{previous} ends too early")
    return begin, arrays


def _entries(shared, keys: list[str] | None):
    """Entries of the array under ``keys``, or (none) of the document itself, an object of strings."""

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranges: dict[tuple[str, int], Range] = shared.value
        depth = 1 if keys is None else len(keys) + 1
        for key, texts in _each_range(batches):
            known = ranges[key]
            if known.stack is None:
                continue
            found: list[tuple[int, str | None, str | None]] = []

            def held(stack: list[Frame]) -> bool:
                """Whether values in the top frame are wanted; asked once a frame."""
                if len(stack) < depth:
                    return False
                frame = stack[depth - 1]
                if frame.wanted is None:
                    kinds = [f.kind for f in stack[:depth]]
                    frame.wanted = kinds == ["{"] if keys is None else kinds == ["{"] * (depth - 1) + ["["] and [_text(f.key) for f in stack[: depth - 1]] == keys
                return frame.wanted

            def emit(stack: list[Frame], token: str) -> None:
                if len(stack) == depth and held(stack):
                    top = stack[-1]
                    found.append((top.commas, _text(top.key) if keys is None else None, _text(token)))

            def opened(stack: list[Frame]) -> None:
                if len(stack) > depth and held(stack):
                    raise Malformed("an entry is not a string")

            scanner = Scanner([Frame(*f) for f in known.stack], known.last, True, emit, opened)
            if known.last == COMMA:  # the comma in front of the range
                scanner.stack[-1].commas += 1

            def batch() -> pa.RecordBatch:
                columns = list(zip(*found)) or [(), (), ()]
                made = [pa.array([key[0]] * len(found), pa.string()), pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.string())]
                found.clear()
                return pa.RecordBatch.from_arrays(made, names=["document", "pos", "key", "value"])

            for _ in _scan(scanner, texts, known):
                if len(found) >= 10_000:
                    yield batch()
            yield batch()

    return entries


ENTRIES = "document string, pos long, key string, value string"


def read_list(spark: SparkSession, path: str, *keys: str) -> DataFrame:
    """``(document, pos, value)`` of the array of strings under ``keys`` in a document."""
    fragments = _fragments(spark, path)
    ranges, arrays = _ranges(fragments)
    if len(arrays) != 1:
        raise ValueError(f"{path} holds {len(arrays)} documents; places are told in one")
    for document, found in arrays.items():
        if keys[-1] not in {_text(k) for k in found}:
            raise Malformed(f"{document} has no such list")
    return fragments.mapInArrow(_entries(spark.sparkContext.broadcast(ranges), list(keys)), ENTRIES).drop("key")


def read_map(spark: SparkSession, path: str) -> DataFrame:
    """``(document, pos, key, value)`` of each file's document, an object of strings."""
    fragments = _fragments(spark, path)
    ranges, _ = _ranges(fragments)
    return fragments.mapInArrow(_entries(spark.sparkContext.broadcast(ranges), None), ENTRIES)
