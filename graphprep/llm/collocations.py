"""Phrase collocations by dynamic itemset counting.

Phrases of one to five words are counted in scans of the corpus' shards, one after the other, round and round. All lengths are
counted in the same scans: a phrase becomes active as soon as both phrases that are one word shorter (without its last word,
without its first) have reached the threshold, in whichever shard the scan then is, and is counted until the scan has come
full circle. So a phrase's count is exact, whenever it began, and no scan waits until all shorter phrases are done.

The phrases that have reached the threshold are sent to the tasks as a Bloom filter of bounded size, to which each step only
adds. Whether a phrase is active is read off the filters alone: it is counted in the steps in which its two parts are in the
filter and were not yet in the filter of one circle ago. These are as many steps as there are shards, each with another shard,
for any phrase at all; a false positive merely counts a phrase that need not be. Nothing is estimated, and the filter's size
decides the work, not the result.

Texts are cut into words once, into blocks in which a word is a number and has its hash and its bytes once. Phrases are known by two
independent hashes of 64 and 32 bits (that any two different phrases among 10^10 agree in both has a chance of about 10^-9), so what is
shuffled and kept is two numbers and a count for each phrase; texts of words follow only for phrases that have reached the threshold,
from the scans that are made anyway. Counts are dealt out by ranges of the first hash, many to a row, and added up range by range.

Defined results: a null text is empty, a null language is ``und``; an empty text and an empty table have no phrases; texts of any
length are counted whole; repeated rows count each time; ties of score and count go to the least phrase by bytes; further columns
are not looked at, whatever their names.
"""

from __future__ import annotations

import functools
import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from graphprep.llm.common import columns_of, mixed
from graphprep.workspace import discard, shuffles_deleted, stage

THRESHOLD = 100
LONGEST = 5
SHARDS = 3
TOP = 2000
#: Bytes of text that a task works on at once; a piece is never cut, so a longer one is a block of its own.
BLOCK = 2 << 20
#: Bits of the filter, as a power of two: by the corpus' size between these.
LEAST_BITS, MOST_BITS = 16, 28
PROBES = 3
SEGMENT = 1 << 16

# Bytes that part pieces, and blanks that part words in them.
PIECES, BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
_KIND = np.zeros(256, np.uint8)
_KIND[list(PIECES)], _KIND[list(BLANKS)] = 2, 1
#: For each of the two hashes: the factor between the eights of bytes of a word, and that between the words of a phrase.
_WITHIN, _NEXT = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)), (np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F))
#: What of eight bytes belongs to a word, by its bytes from there on.
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
#: Bytes of words that are hashed together, eight by eight; longer words are hashed one by one.
SHORT = 64
BLOCKS = "shard int, langs array<string>, form_langs binary, words binary, numbers binary, size bigint"
#: Counts of many phrases of one range of hashes: both hashes, counts, and if they are open the steps in which they were met and reached the threshold.
PACKED = ("ones", "twos", "ns", "sinces", "reached")
COUNTS = f"range int, {', '.join(f'{name} binary' for name in PACKED)}, lang string, sizes binary, phrases binary, n bigint"
STEP = f"kind int, range int, {', '.join(f'{name} binary' for name in PACKED)}, one bigint, two int, n bigint, lang string, size int, phrase string"
#: Kinds of rows of a step: counts of phrases that are still open, texts of phrases, words of languages, counts of phrases that are
#: complete, hashes of phrases that have just reached the threshold, and of those that had before and are not named yet.
OPEN, NAME, WORD, COMPLETE, REACHED, UNNAMED = range(6)
#: Bytes of the corpus for each range of hashes.
RANGE = 16 << 20
#: Places of phrases that a task gathers before it adds them up and deals them out.
GATHERED = 2_000_000
#: Phrases that a task remembers to have named, and whose names it holds at once.
NAMED = 200_000


class Filter:
    """A Bloom filter over hashes; the empty one has no bits at all."""

    def __init__(self, bits: int, data: np.ndarray | None = None) -> None:
        self.bits, self.data = bits, data

    def packed(self) -> bytes | None:
        return None if self.data is None else zlib.compress(self.data.tobytes(), 1)

    @classmethod
    def unpacked(cls, bits: int, packed: bytes | None) -> Filter:
        return cls(bits, None if packed is None else np.frombuffer(zlib.decompress(packed), np.uint8))

    def with_segments(self, segments: list[tuple[int, bytes]]) -> Filter:
        if not segments:
            return self
        data = np.zeros((1 << self.bits) // 8, np.uint8) if self.data is None else self.data.copy()
        for number, set_ in segments:
            bits = np.frombuffer(zlib.decompress(set_), np.uint8)
            data[number * SEGMENT : number * SEGMENT + len(bits)] |= bits
        return Filter(self.bits, data)

    @staticmethod
    def places(hashes: np.ndarray, bits: int, probe: int) -> np.ndarray:
        step = (hashes >> np.uint64(32)) | np.uint64(1)
        return (hashes + np.uint64(probe) * step) & np.uint64((1 << bits) - 1)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        found = np.zeros(len(hashes), bool)
        if self.data is None:
            return found
        left = np.arange(len(hashes))
        for probe in range(PROBES):
            place = self.places(hashes[left], self.bits, probe)
            left = left[(self.data[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1]
        found[left] = True
        return found


def word_hashes(data: bytes, starts: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """Both hashes of the words at these places."""
    eights = np.ndarray((len(data) + 1,), "<u8", data + bytes(8), strides=(1,))
    sizes = ends - starts
    found = [mixed(sizes.astype(np.uint64) * factor) for factor in _WITHIN]
    at, left = np.arange(len(starts)), sizes
    for begin in range(0, SHORT, 8):
        part = eights[starts[at] + begin] & _MASKS[np.minimum(left, 8)]
        for i, factor in enumerate(_WITHIN):
            found[i][at] = mixed((found[i][at] ^ part) * factor)
        at = at[left > 8]
        if not len(at):
            break
        left = sizes[at] - begin - 8
    for word in np.flatnonzero(sizes > SHORT).tolist():
        digest = hashlib.blake2b(data[starts[word] : ends[word]], digest_size=16).digest()
        for i in range(2):
            found[i][word] = int.from_bytes(digest[8 * i : 8 * i + 8], "little")
    return found


_salts: dict[str, tuple[int, int]] = {}


def salt_of(lang: str) -> tuple[int, int]:
    if lang not in _salts:
        if len(_salts) > 100_000:
            _salts.clear()
        digest = hashlib.sha256(lang.encode()).digest()
        _salts[lang] = int.from_bytes(digest[:8], "little"), int.from_bytes(digest[8:16], "little")
    return _salts[lang]


class Block:
    """The words of some texts, and the phrases that begin at each.

    A word of a language, with its hashes, is there once, as a form. What is stored of a place is the number of its form, doubled,
    and one more if it is the last in its piece.
    """

    def __init__(self, parts: list[tuple[str, bytes]]) -> None:
        data = b"\n".join(p for _, p in parts) + b"\n"
        kind = _KIND[np.frombuffer(data, np.uint8)]
        # The last byte is no word's.
        edges = np.flatnonzero(np.diff(kind == 0, prepend=False))
        starts, ends = edges[::2], edges[1::2]
        part = np.searchsorted(np.cumsum([len(p) + 1 for _, p in parts]), starts, "right")
        names = sorted({lang for lang, _ in parts})
        number = {lang: i for i, lang in enumerate(names)}
        lang = np.array([number[lang] for lang, _ in parts], np.int32)[part]
        hashes = self.salted(names, lang, word_hashes(data, starts, ends))
        order, begins = grouped(*hashes)
        forms, numbers = order[begins], np.empty(len(order), np.uint32)
        numbers[order] = np.repeat(np.arange(len(begins)), np.diff(np.append(begins, len(order))))
        piece = np.cumsum(kind == 2, dtype=np.int32)[starts]
        last = np.append(piece[1:] != piece[:-1], True)[: len(starts)]
        words = b"".join([data[i:j] + b" " for i, j in zip(starts[forms].tolist(), ends[forms].tolist())])
        self.fill(names, lang[forms], words, numbers << 1 | last)

    @staticmethod
    def salted(names: list[str], lang: np.ndarray, hashes: list[np.ndarray]) -> list[np.ndarray]:
        salts = np.array([salt_of(name) for name in names], np.uint64).reshape(-1, 2)
        return [mixed(h ^ salts[lang, i]) for i, h in enumerate(hashes)]

    def fill(self, names: list[str], form_lang: np.ndarray, words: bytes, numbers: np.ndarray) -> None:
        """``words`` has the forms' words in order, with a blank after each."""
        self.langs, self.form_lang, self.words, self.numbers = names, form_lang, words, numbers
        self.form, self.last = (numbers >> 1).astype(np.int64), numbers & 1 == 1
        self.n = len(numbers)
        self.ends = np.flatnonzero(np.frombuffer(words, np.uint8) == 32)
        self.starts = np.append(0, self.ends + 1)[:-1]
        self.form_hash = word_hashes(words, self.starts, self.ends)
        self.form_first = self.salted(names, form_lang, self.form_hash)

    def stored(self, shard: int, size: int) -> pa.RecordBatch:
        columns = [[shard], [self.langs], [self.form_lang.astype("<i4").tobytes()], [self.words], [self.numbers.astype("<u4").tobytes()], [size]]
        kinds = pa.schema([("shard", pa.int32()), ("langs", pa.list_(pa.string())), *[(c, pa.binary()) for c in ("form_langs", "words", "numbers")], ("size", pa.int64())])
        return pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(columns, kinds.types)], schema=kinds)

    @classmethod
    def all_of(cls, batch: pa.RecordBatch) -> Iterator[Block]:
        """The stored blocks, one by one."""
        for row in range(batch.num_rows):
            langs, form_langs, words, numbers = (batch.column(batch.schema.get_field_index(c))[row] for c in ("langs", "form_langs", "words", "numbers"))
            block = cls.__new__(cls)
            block.fill(langs.as_py(), np.frombuffer(form_langs.as_buffer(), "<i4"), words.as_py(), np.frombuffer(numbers.as_buffer(), "<u4"))
            yield block

    @property
    def lang(self) -> np.ndarray:
        return self.form_lang[self.form]

    @property
    def hash(self) -> list[np.ndarray]:
        return [h[self.form] for h in self.form_hash]

    @property
    def first(self) -> list[np.ndarray]:
        return [h[self.form] for h in self.form_first]

    def longer(self, hashes: list[np.ndarray], at: np.ndarray, size: int) -> list[np.ndarray]:
        """Hashes of the phrases of ``size`` words at places ``at``, from those of one word less."""
        word = self.form[at + (size - 1)]
        return [mixed(h * factor + own[word]) for h, factor, own in zip(hashes, _NEXT, self.form_hash)]

    def text(self, at: int, size: int) -> bytes:
        forms = self.form[at : at + size]
        return b" ".join([self.words[i:j] for i, j in zip(self.starts[forms].tolist(), self.ends[forms].tolist())])

    def scan(
        self, step: int, shards: int, now: Filter, then: Filter, longest: int, unnamed: Filter | None = None
    ) -> Iterator[tuple[int, list[np.ndarray | SecondHashes], np.ndarray, np.ndarray, np.ndarray]]:
        """``size``, both hashes and places of the phrases that may be active; which of them are active in this step; which are
        to be named: those in the filter of the unnamed, or if none is given those in the filter since less than a circle."""
        if not self.n:
            return
        # Of the forms first, then of the places.
        has = now.has(self.form_first[0])
        had = np.zeros(len(has), bool)
        had[has] = then.has(self.form_first[0][has])
        reached, before = np.append(has[self.form], False), np.append(had[self.form], False)
        at, one = np.arange(self.n), self.form_first[0][self.form]
        yield 1, [one, SecondHashes(self, at, 1)], at, np.full(self.n, step < shards), (reached[:-1] & ~before[:-1]) if unnamed is None else unnamed.has(self.form_first[0])[self.form]
        # Both parts end within their piece; the second of two words may be in the next one.
        both = reached[:-1] & reached[1:] & ~self.last
        for size in range(2, longest + 1):
            at, one = at[both], one[both]
            if not len(at):
                return
            (one,) = self.longer([one], at, size)
            active = ~(before[at] & before[at + 1])
            there = now.has(one)
            reached, before = np.zeros(self.n + 1, bool), np.zeros(self.n + 1, bool)
            reached[at] = there
            before[at[there]] = then.has(one[there])
            yield size, [one, SecondHashes(self, at, size)], at, active, (there & ~before[at]) if unnamed is None else unnamed.has(one)
            both = there & reached[at + 1]


class SecondHashes:
    """The second hashes of phrases, worked out for those that are asked for."""

    def __init__(self, block: Block, at: np.ndarray, size: int) -> None:
        self.block, self.at, self.size = block, at, size

    def __getitem__(self, where: np.ndarray) -> np.ndarray:
        at = self.at[where]
        found = self.block.form_first[1][self.block.form[at]]
        for word in range(1, self.size):
            found = mixed(found * _NEXT[1] + self.block.form_hash[1][self.block.form[at + word]])
        return found


def second(hashes: np.ndarray) -> np.ndarray:
    """What is kept of the second hash."""
    return (hashes >> np.uint64(32)).astype(np.uint32).view(np.int32)


def grouped(one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order in which equal pairs of hashes are together and the first hashes ascend, and where in it another pair begins."""
    order = np.argsort(one)
    first, other = one[order], two[order]
    new = np.append(True, first[1:] != first[:-1])[: len(order)]
    if (~new[1:] & (other[1:] != other[:-1])).any():
        order = np.lexsort((two, one))
        first, other = one[order], two[order]
        new = np.append(True, (first[1:] != first[:-1]) | (other[1:] != other[:-1]))
    return order, np.flatnonzero(new)


def summed(one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of one of each pair of hashes, and how often it is there."""
    order, begins = grouped(one, two)
    return order[begins], np.diff(np.append(begins, len(order)))


def blocks_of(langs: list[str], texts: list[str], size: int = BLOCK) -> Iterator[list[tuple[str, bytes]]]:
    """Texts, lower-cased, in blocks of about ``size`` bytes; long ones are cut between pieces."""
    block: list[tuple[str, bytes]] = []
    held = 0
    for lang, text in zip(langs, texts):
        data = text.encode().lower()  # A to Z only
        at = 0
        while at < len(data):
            stop = len(data)
            if stop - at > size:
                cut = max(data.rfind(p, at, at + size) for p in (PIECES[i : i + 1] for i in range(len(PIECES))))
                if cut < 0:
                    later = [c for p in PIECES if (c := data.find(p, at + size)) >= 0]
                    cut = min(later, default=stop - 1)
                stop = cut + 1
            block.append((lang, data[at:stop]))
            held += stop - at
            at = stop
            if held >= size:
                yield block
                block, held = [], 0
    if block:
        yield block


def cut_up(docs: DataFrame, shards: int) -> DataFrame:
    """Blocks of the rows of ``lang, text``; rows go to the shards in turn."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId()
        for batch in batches:
            langs, texts = columns_of(batch, "lang", "text")
            for shard in range(shards):
                own = slice((shard - at) % shards, None, shards)
                for parts in blocks_of(langs[own], texts[own]):
                    block = Block(parts)
                    if block.n:
                        yield block.stored(shard, sum(len(p) for _, p in parts))
            at += batch.num_rows

    return docs.mapInArrow(cut, BLOCKS)


def range_of(one: np.ndarray, ranges: int) -> np.ndarray:
    return ((one.view(np.uint64) >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int32)


def rows_of(length: int, schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(length, f.type) for f in schema], schema=schema)


def narrow(numbers: np.ndarray) -> np.ndarray:
    """In as few bytes as the largest one needs."""
    return numbers.astype(np.min_scalar_type(int(numbers.max())).newbyteorder("<"))


_KINDS = {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}
_COUNTED, _STEP = (pa.schema([(name, _KINDS[kind]) for name, kind in (column.split() for column in ddl.split(", "))]) for ddl in (COUNTS, STEP))


def by_range(one: np.ndarray, ranges: int) -> tuple[np.ndarray, list[slice]]:
    """The ranges that some ascending hashes are in, and which of them are in each."""
    number = range_of(one, ranges)
    begins = np.flatnonzero(np.diff(number, prepend=-1))
    return number[begins], [slice(x, y) for x, y in zip(begins.tolist(), [*begins[1:].tolist(), len(one)])]


def dealt_out(one: np.ndarray, two: np.ndarray, ranges: int) -> pa.RecordBatch:
    """The counts of the phrases at some places, a row for each range of hashes."""
    first, n = summed(one, two)
    one, two, n = one[first], two[first], narrow(n)
    number, parts = by_range(one, ranges)
    return rows_of(len(parts), _COUNTED, range=number, **{name: [x[part].tobytes() for part in parts] for name, x in zip(PACKED, (one, two, n))})


class Names:
    """Texts of phrases, until they are dealt out."""

    def __init__(self) -> None:
        self.known: set[int] = set()
        self.found: dict[str, list[tuple[int, int, int, bytes]]] = {}
        self.held = 0

    def add(self, block: Block, size: int, one: np.ndarray, two: np.ndarray, at: np.ndarray) -> None:
        where = summed(one, two)[0]
        where = where[[h not in self.known for h in one[where].tolist()]]
        if not len(where):
            return
        keys = one[where].tolist()
        self.known.update(keys)
        langs = [block.langs[i] for i in block.form_lang[block.form[at[where]]].tolist()]
        for lang, key, second_, place in zip(langs, keys, two[where].tolist(), at[where].tolist()):
            self.found.setdefault(lang, []).append((key, second_, size, block.text(place, size)))
        self.held += len(where)

    def dealt_out(self, ranges: int) -> Iterator[pa.RecordBatch]:
        """A row for each language and range of hashes."""
        for lang, found in self.found.items():
            found.sort()
            ones, twos, sizes, phrases = zip(*found)
            one, two, size = np.array(ones, np.uint64), np.array(twos, np.int32), np.array(sizes, np.uint8)
            number, parts = by_range(one, ranges)
            columns = {"ones": one, "twos": two, "sizes": size}
            packed = {name: [x[part].tobytes() for part in parts] for name, x in columns.items()}
            # No phrase has a line break.
            yield rows_of(len(parts), _COUNTED, range=number, lang=[lang] * len(parts), phrases=[b"\n".join(phrases[part]) for part in parts], **packed)
        self.found, self.held = {}, 0
        if len(self.known) > NAMED:
            self.known.clear()


def count_shard(shard: DataFrame, step: int, shards: int, filters: tuple[Filter, Filter, Filter], longest: int, ranges: int) -> tuple[DataFrame, Broadcast]:
    """Rows of three kinds: packed counts of the phrases that are active in this step; packed names of those that are in the
    last filter; and ``lang, n``, words. All with the range that they are added up in.

    The filters are of the phrases that have reached the threshold, of those that had a circle ago, and of those without a name.
    Also what the rows need until they are stored."""
    # Few of the bits are set, so they are sent compressed.
    sent = shard.sparkSession.sparkContext.broadcast([(f.bits, f.packed()) for f in filters])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, earlier, unnamed = (Filter.unpacked(*f) for f in sent.value)
        names = Names()
        one: list[np.ndarray] = []
        two: list[np.ndarray] = []
        for block in (block for batch in batches for block in Block.all_of(batch)):
            if step < shards:
                n = np.bincount(block.lang, minlength=len(block.langs))
                yield rows_of(len(n), _COUNTED, range=[zlib.crc32(lang.encode()) % ranges for lang in block.langs], lang=block.langs, n=n)
            for size, hashes, at, active, fresh in block.scan(step, shards, current, earlier, longest, unnamed):
                where = np.flatnonzero(active)
                if len(where):
                    one.append(hashes[0][where])
                    two.append(second(hashes[1][where]))
                where = np.flatnonzero(fresh)
                if len(where):
                    names.add(block, size, hashes[0][where], second(hashes[1][where]), at[where])
            if names.held >= NAMED:
                yield from names.dealt_out(ranges)
            if sum(map(len, one)) >= GATHERED:
                yield dealt_out(np.concatenate(one), np.concatenate(two), ranges)
                one, two = [], []
        if one:
            yield dealt_out(np.concatenate(one), np.concatenate(two), ranges)
        yield from names.dealt_out(ranges)

    return shard.select("langs", "form_langs", "words", "numbers").mapInArrow(count, COUNTS), sent


def pairs_of(rows: list[dict]) -> tuple[np.ndarray, np.ndarray]:
    """Both hashes of all phrases of packed rows."""
    return tuple(np.concatenate([np.frombuffer(b"", kind), *[np.frombuffer(r[name], kind) for r in rows]]) for name, kind in (("ones", "<u8"), ("twos", "<i4")))


def added_up(batches: Iterator[pa.RecordBatch], step: int, shards: int, threshold: int) -> Iterator[pa.RecordBatch]:
    """The rows of a step, of some ranges as a whole: counts added up, phrases named once, words added up."""
    parts: dict[int, tuple[list, list, list]] = {}
    words: dict[str, int] = {}
    for batch in batches:
        for row in batch.to_pylist():
            if row["ones"] is None:
                words[row["lang"]] = words.get(row["lang"], 0) + row["n"]
            else:
                kind = 0 if row["ns"] is not None else 1 if row["phrases"] is not None else 2
                parts.setdefault(row["range"], ([], [], []))[kind].append(row)
    if words:
        yield rows_of(len(words), _STEP, kind=[WORD] * len(words), lang=list(words), n=list(words.values()))
    for number in list(parts):
        counts, names, unnamed = parts.pop(number)
        given = pairs_of(names)
        if names:
            first = summed(*given)[0]
            phrases = pa.array([p for r in names for p in r["phrases"].split(b"\n")], pa.binary()).cast(pa.string())
            langs = pa.array([r["lang"] for r in names]).take(pa.array(np.repeat(np.arange(len(names)), [len(r["sizes"]) for r in names])))
            columns = {"one": given[0].view(np.int64)[first], "two": given[1][first], "size": np.frombuffer(b"".join(r["sizes"] for r in names), np.uint8)[first]}
            yield rows_of(len(first), _STEP, kind=np.full(len(first), NAME), lang=langs.take(pa.array(first)), phrase=phrases.take(pa.array(first)), **columns)
        if counts:
            one, two = pairs_of(counts)
            sizes = [len(r["ones"]) // 8 for r in counts]
            n = np.concatenate([np.frombuffer(r["ns"], f"<u{len(r['ns']) // size}").astype(np.int64) for r, size in zip(counts, sizes)])
            since, reached = (
                np.concatenate([np.full(size, new, "<i2") if r[name] is None else np.frombuffer(r[name], "<i2") for r, size in zip(counts, sizes)])
                for name, new in (("sinces", step), ("reached", -1))
            )
            del counts
            order, begins = grouped(one, two)
            one, two = one[order[begins]], two[order[begins]]
            n = np.add.reduceat(n[order], begins)
            since = np.minimum.reduceat(since[order], begins)
            reached = np.maximum.reduceat(reached[order], begins)
            reached[(reached < 0) & (n >= threshold)] = step
            # A phrase seen a full circle ago is counted through: it is kept if frequent, or dropped.
            complete = since <= step - shards + 1
            now = np.flatnonzero(reached == step)
            if len(now):
                yield rows_of(1, _STEP, kind=[REACHED], range=[number], ones=[one[now].tobytes()], twos=[two[now].tobytes()])
            done = np.flatnonzero(complete & (n >= threshold))
            if len(done):
                yield rows_of(len(done), _STEP, kind=np.full(len(done), COMPLETE), one=one[done].view(np.int64), two=two[done], n=n[done])
            left = np.flatnonzero(~complete)
            if len(left):
                columns = (one[left], two[left], narrow(n[left]), since[left], reached[left])
                yield rows_of(1, _STEP, kind=[OPEN], range=[number], **{name: [x.tobytes()] for name, x in zip(PACKED, columns)})
        if unnamed:
            one, two = map(np.concatenate, zip(pairs_of(unnamed), given))
            has_name = np.arange(len(one)) >= len(one) - len(given[0])
            order, begins = grouped(one, two)
            left = order[begins[~np.maximum.reduceat(has_name[order], begins)]]
            if len(left):
                yield rows_of(1, _STEP, kind=[UNNAMED], range=[number], ones=[one[left].tobytes()], twos=[two[left].tobytes()])


def filled(found: DataFrame, bits: int) -> dict[int, list[tuple[int, bytes]]]:
    """The bits of phrases, of which ``ones`` has many first hashes in a row, as segments of at most ``SEGMENT`` bytes for each kind:
    together no more than the filter's size. Few of the bits are set, so they go to the driver compressed."""

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for kind, ones in zip(*columns_of(batch, "kind", "ones")):
                hashes = np.frombuffer(ones, "<u8")
                set_ = np.unique(np.concatenate([Filter.places(hashes, bits, probe) for probe in range(PROBES)])).astype(np.int64)
                segment = set_ // (8 * SEGMENT)
                yield pa.RecordBatch.from_arrays([pa.array(segment.astype(np.int32) + (kind << 24)), pa.array(set_ % (8 * SEGMENT))], names=["segment", "bit"])

    size = min(SEGMENT, (1 << bits) // 8)

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_, data = None, None
        for batch in batches:
            numbers, set_ = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            done: list[tuple[int, bytes]] = []
            for number in np.unique(numbers):
                if number != open_:
                    if data is not None:
                        done.append((open_, zlib.compress(data.tobytes(), 1)))
                    open_, data = number, np.zeros(size, np.uint8)
                bit = set_[numbers == number]
                np.bitwise_or.at(data, bit // 8, (1 << (bit % 8)).astype(np.uint8))
            yield pa.RecordBatch.from_arrays([pa.array([n for n, _ in done], pa.int32()), pa.array([d for _, d in done], pa.binary())], names=["segment", "data"])
        if data is not None:
            yield pa.RecordBatch.from_arrays([pa.array([open_], pa.int32()), pa.array([zlib.compress(data.tobytes(), 1)], pa.binary())], names=["segment", "data"])

    marked = found.select("kind", "ones").mapInArrow(places, "segment int, bit bigint")
    dealt = marked.repartition("segment").sortWithinPartitions("segment")
    by_kind: dict[int, list[tuple[int, bytes]]] = {}
    for row in dealt.mapInArrow(segments, "segment int, data binary").collect():
        by_kind.setdefault(row["segment"] >> 24, []).append((row["segment"] & (1 << 24) - 1, row["data"]))
    return by_kind


def frequent_phrases(
    docs: DataFrame, threshold: int = THRESHOLD, longest: int = LONGEST, shards: int = SHARDS, bits: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """``lang, size, phrase, n`` of all phrases that occur ``threshold`` times; and ``lang, n``, all words of a language."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), text.alias("text"))
    stored = stage(cut_up(rows.where(F.length("text") > 0), shards), "phrase-shards", partition_by=("shard",))
    spark = docs.sparkSession
    corpus = stored.agg(F.sum("size")).first()[0] or 0
    if bits is None:
        bits = min(MOST_BITS, max(LEAST_BITS, math.ceil(math.log2(corpus / 16 + 1))))
    ranges = max(spark.sparkContext.defaultParallelism, -(-corpus // RANGE))
    filters: list[Filter | None] = [Filter(bits)]  # before each step
    done, names, words = [], [], []
    kept, unnamed = None, Filter(bits)
    step, last_reached = 0, -1
    while step < max(shards, last_reached + 1 + shards):
        then = filters[step - shards] if step >= shards else Filter(bits)
        rows, sent = count_shard(stored.where(F.col("shard") == step % shards), step, shards, (filters[step], then, unnamed), longest, ranges)
        # Three kinds of rows from one scan, and those of open and of unnamed phrases, added up together.
        if kept is not None:
            rows = rows.unionByName(kept.where(F.col("kind").isin(OPEN, REACHED, UNNAMED)).select("range", *PACKED), allowMissingColumns=True)
        dealt = rows.repartitionById(ranges, F.col("range"))
        table = dealt.mapInArrow(lambda batches, step=step: added_up(batches, step, shards, threshold), STEP)
        with shuffles_deleted(spark):
            table = stage(table, "phrase-step", partition_by=("kind",))
        sent.destroy()
        names.append(table.where(F.col("kind") == NAME).select("one", "two", "lang", "size", "phrase"))
        words.append(table.where(F.col("kind") == WORD).select("lang", "n"))
        # Added up into the new table, and not read again.
        if kept is not None:
            discard(spark, kept, f"kind={OPEN}")
        kept = table
        done.append(table.where(F.col("kind") == COMPLETE).select("one", "two", "n"))
        segments = filled(table.where(F.col("kind").isin(REACHED, UNNAMED)), bits)
        if REACHED in segments:
            last_reached = step
        now = filters[step].with_segments(segments.get(REACHED, []))
        unnamed = Filter(bits).with_segments(segments.get(REACHED, []) + segments.get(UNNAMED, []))
        filters.append(now)
        if step >= shards:
            filters[step - shards] = None  # not looked at any more
        step += 1
    # None of the phrases that are open yet is frequent: these were all met by the last step in which one reached the threshold.
    union = lambda tables: functools.reduce(DataFrame.unionByName, tables)
    # Every phrase that reached the threshold has been met, and named, in the circle after that.
    discard(spark, stored)
    found = union(done).join(union(names).dropDuplicates(["one", "two"]), ["one", "two"]).select("lang", "size", "phrase", "n")
    return stage(found, "phrases"), stage(union(words).groupBy("lang").agg(F.sum("n").alias("n")), "phrase-words")


def collocations(docs: DataFrame, threshold: int = THRESHOLD, longest: int = LONGEST, top: int = TOP, shards: int = SHARDS, bits: int | None = None) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` phrases of each language by their weakest cut's lift.

    A phrase goes if a longer one that holds it occurs as often.
    """
    found, sizes = frequent_phrases(docs, threshold, longest, shards, bits)
    words = F.split("phrase", " ")
    part = lambda start, length: F.array_join(F.slice("words", start, length), " ")
    phrases = found.where("size > 1").select("lang", "phrase", "size", F.col("n").alias("a"), words.alias("words"))
    cuts = phrases.select("lang", "phrase", "a", "size", "words", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("cut"))
    cuts = cuts.select("lang", "phrase", "a", "cut", part(F.lit(1), F.col("cut")).alias("left"), part(F.col("cut") + 1, F.col("size") - F.col("cut")).alias("right"))
    counts = lambda name, n: found.select("lang", F.col("phrase").alias(name), F.col("n").alias(n))
    cuts = cuts.join(counts("left", "l"), ["lang", "left"]).join(counts("right", "r"), ["lang", "right"]).join(sizes, "lang")
    wide = lambda c: F.col(c).cast("decimal(18,0)")
    # 1000 * a * n has up to 38 digits, and a is at most l and r, so the quotient is at most 1000 * n.
    cuts = cuts.withColumns({"_up": (wide("a") * wide("n")).cast("decimal(35,0)") * F.lit(1000).cast("decimal(4,0)"), "_down": wide("l") * wide("r")})
    scored = cuts.select("lang", "phrase", "a", "n", F.struct(F.expr("_up div _down").alias("score"), "cut", "l", "r").alias("weakest"))
    scored = scored.groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.first("n").alias("n"), F.min("weakest").alias("weakest"))

    spans = F.flatten(F.transform(F.sequence(F.lit(2), F.col("size") - 1), lambda k: F.transform(F.sequence(F.lit(1), F.col("size") - k + 1), lambda i: F.array_join(F.slice("words", i, k), " "))))
    inner = phrases.where("size > 2").select("lang", F.explode(spans).alias("phrase"), F.col("a").alias("around"))
    inner = inner.groupBy("lang", "phrase").agg(F.max("around").alias("around"))
    kept = scored.join(inner, ["lang", "phrase"], "left").where(F.col("around").isNull() | (F.col("around") < F.col("a")))
    order = Window.partitionBy("lang").orderBy(F.desc("weakest.score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "weakest.l", "weakest.r", "n", "weakest.score")
