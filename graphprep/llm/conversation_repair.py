"""Repair of the turn structure of conversations at least cost, by a rank-convergence parallel Viterbi search.

A conversation's roles are to read ``(s?(ua)+)?``. Rows may be kept (0), given the other role (2) or deleted (3), and empty
user or assistant rows inserted anywhere (2); blank and repeated rows must go, and a truncated row that stays costs 1. The
cheapest edits are found from the end to the beginning, as the least cost still to come from each of the four states (nothing
yet, after system, after user, after assistant). Step by step that is a product of matrices over (min, +), in which vectors
soon differ by a constant only, wherever they began. So conversations need no task of their own:

* Rows are dealt out by ranges of (conversation, place) and cut into chunks of bounded size. Every chunk is worked off at
  once, from a speculative vector at its end: as if the conversation ended there.
* Fix-up passes give a chunk the vector its successor begins with. It is worked off again only until its vectors differ by
  a constant from those of the pass before; passes go on until no vector changes. A pass carries a changed vector on through
  a span of neighbouring chunks, eight times as wide in each pass, so even vectors that never converge are done soon.
* With the costs stitched together, each chunk's edits lead from each state to a state. These maps are composed by a
  parallel prefix scan, and every chunk then traces its cheapest edits, of equal ones the least in ASCII order.

Conversations that begin and end within one chunk, nearly all as a rule, are finished in the first pass.

Defined results: a null role or text is one space; rows of one turn (null turns first) are ordered by the digest of role and
text, so the layout of the table does not matter; a repeated row is a duplicate; an empty text is blank; a role that begins with
none of s, u, a (or is empty) can only be replaced or deleted; texts of any length are kept whole; a null conversation is one of
its own; an empty table gives an empty one; further columns are not looked at, whatever their names.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphprep.llm.common import columns_of
from graphprep.workspace import stage

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
CHUNK_ROWS = 1024
CHUNK_CHARS = 1 << 18
SPAN = 8

SPACE = " \t\n\x0b\f\r"
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
INITIALS = "sua"
#: The state after keeping a row with an initial, where that is allowed; after a row of another role; after an insertion.
KEPT = {(EMPTY, "s"): SYSTEM, (EMPTY, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
NEXT = (USER, USER, ASSISTANT, USER)
ROLES = {USER: "user", ASSISTANT: "assistant"}
#: Least cost to come at the end of a conversation.
FINAL = (0, 2 * INSERT, INSERT, 0)
Vector = tuple[int, int, int, int]


def code_of(initial: str, must_go: bool, truncated: bool) -> int:
    """A row as a byte: its initial's place (3 for any other), 4 if truncated, 8 if it must be deleted."""
    place = INITIALS.find(initial) if initial else -1
    return (place if place >= 0 else 3) + 4 * truncated + 8 * must_go


def before(vector: Vector, code: int) -> Vector:
    """Costs to come before a row (insertions in front of it included), from those after it."""
    initial = "sua-"[code & 3]
    stays = bool(code & 4) * TRUNCATED
    best = []
    for state in range(4):
        cost = DELETE + vector[state]
        if not code & 8:
            if (state, initial) in KEPT:
                cost = min(cost, KEEP + stays + vector[KEPT[state, initial]])
            cost = min(cost, REROLE + stays + vector[NEXT[state]])
        best.append(cost)
    user = min(best[USER], INSERT + best[ASSISTANT])
    assistant = min(best[ASSISTANT], INSERT + best[USER])
    return min(best[EMPTY], INSERT + user), min(best[SYSTEM], INSERT + user), user, assistant


class Steps:
    """Normalised vectors (least entry 0), their steps and moves; there are few of them, and each is worked out once."""

    def __init__(self) -> None:
        self.known: dict[tuple[Vector, int], tuple[Vector, int]] = {}
        self.moves: dict[tuple[Vector, int, int], tuple[str, int]] = {}

    def back(self, vector: Vector, code: int) -> tuple[Vector, int]:
        """The normalised vector before a row, and what was taken off."""
        found = self.known.get((vector, code))
        if found is None:
            full = before(vector, code)
            least = min(full)
            found = self.known[vector, code] = tuple(x - least for x in full), least
        return found

    def run(self, tape: bytes, end: Vector) -> list[Vector]:
        """The vectors before each row and at the end, each normalised."""
        vectors = [end]
        for code in reversed(tape):
            vectors.append(self.back(vectors[-1], code)[0])
        return vectors[::-1]

    def taken(self, tape: bytes, end: Vector) -> tuple[Vector, int]:
        """The normalised vector before a chunk and what was taken off on the way."""
        total = 0
        for code in reversed(tape):
            end, least = self.back(end, code)
            total += least
        return end, total

    def repaired(self, tape: bytes, used: Vector, end: Vector, start: Vector, total: int) -> tuple[Vector, int, int]:
        """What ``taken(tape, end)`` gives, from what it gave for ``used``; and the rows that were worked off.

        Both runs go back together until their vectors differ by a constant only, so are equal when normalised: from there
        on the earlier run holds, and only the constant changes.
        """
        old, new, change = used, end, 0
        for done, code in enumerate(reversed(tape)):
            if old == new:
                return start, total + change, done
            old, old_least = self.back(old, code)
            new, new_least = self.back(new, code)
            change += new_least - old_least
        return (start if old == new else new), total + change, len(tape)

    def move(self, vector: Vector, code: int, state: int) -> tuple[str, int]:
        """The least of the cheapest edits up to and with a row, from a state; ``vector`` holds after the row."""
        found = self.moves.get((vector, code, state))
        if found is None:
            costs, edits, at = before(vector, code), "", state
            initial, stays = "sua-"[code & 3], bool(code & 4) * TRUNCATED
            while True:  # D, I, K, R in ASCII order
                if DELETE + vector[at] == costs[at]:
                    edits += "D"
                elif INSERT + costs[NEXT[at]] == costs[at]:
                    edits, at = edits + "I", NEXT[at]
                    continue
                elif (at, initial) in KEPT and KEEP + stays + vector[KEPT[at, initial]] == costs[at]:
                    edits, at = edits + "K", KEPT[at, initial]
                else:
                    edits, at = edits + "R", NEXT[at]
                break
            found = self.moves[vector, code, state] = edits, at
        return found

    def trace(self, tape: bytes, end: Vector, state: int, last: bool) -> tuple[list[str], int]:
        """The edits at each row of a chunk (and behind the last one of a conversation), and the state they lead to."""
        edits = []
        for code, vector in zip(tape, self.run(tape, end)[1:]):
            edit, state = self.move(vector, code, state)
            edits.append(edit)
        if last:
            behind = ""
            while state not in (EMPTY, ASSISTANT):
                behind, state = behind + "I", NEXT[state]
            edits.append(behind)
        return edits, state


def edited(edits: list[str], lines: list[dict], state: int) -> list[dict]:
    """The rows that edits leave, with the initial of the edit each."""
    out = []
    for at, edit in enumerate(edits):
        for e in edit:
            if e == "D":
                continue
            if e == "K":
                line = lines[at]
                state = KEPT[state, line["role"][:1]]
                out.append({"edit": e, "role": line["role"], "text": line["text"]})
            else:
                state = NEXT[state]
                out.append({"edit": e, "role": ROLES[state], "text": "" if e == "I" else lines[at]["text"]})
    return out


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with faults put in, by crc32 of ``conv_id:turn``; nulls are one space."""
    blank = F.lit(" ")
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    role, text = F.coalesce("role", blank), F.coalesce("text", blank)
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.crc32(F.encode(name, "UTF-8")) % 20).alias("_fault"))
    fault = F.col("_fault")
    text = F.when(fault == 1, "").when(fault == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.explode(F.when(fault == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    rows = rows.where(fault != 0).select("conv_id", "turn", F.when(fault == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), copies.alias("_copy"))
    return rows.drop("_copy")


LINES = "array<struct<edit:string,role:string,text:string>>"
CHUNK = (
    "rng int, chunk int, closed boolean, tape binary, lines " + LINES + ", audit string, cost bigint, blank bigint, duplicate bigint, truncated bigint,"
    " illegal bigint, first_initial string, last_initial string, turns bigint, used array<bigint>, start array<bigint>, total bigint"
)
VECTOR = pa.list_(pa.int64())
KINDS = {
    "rng": pa.int32(), "chunk": pa.int32(), "closed": pa.bool_(), "tape": pa.binary(),
    "lines": pa.list_(pa.struct([("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])),
    "audit": pa.string(), "first_initial": pa.string(), "last_initial": pa.string(), "used": VECTOR, "start": VECTOR,
}
TURNS = ("first_turn", "last_turn", "least_turn", "most_turn")


def _schema(rows: DataFrame) -> T.StructType:
    conv, turn = rows.schema["conv_id"], rows.schema["turn"].dataType
    turns = [T.StructField(name, turn) for name in TURNS]
    return T.StructType([T.StructField("conv_id", conv.dataType), *turns, *T.StructType.fromDDL(CHUNK).fields])


class _Chunk:
    """The rows of a chunk and what is counted over them."""

    def __init__(self) -> None:
        self.codes, self.lines, self.chars = bytearray(), [], 0
        self.counts = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "turns": 0}
        self.initials: list[str] = []
        self.seen: list = []  # first, last, least and greatest turn
        self.last_initial = None

    def add(self, turn, role: str, text: str, blank: bool, cut: bool, first: bool) -> None:
        fault = "blank" if blank else "duplicate" if not first else "truncated" if cut else None
        if fault:
            self.counts[fault] += 1
        initial = role[:1]
        if self.codes:
            self.counts["illegal"] += self.last_initial + initial not in ("su", "ua", "au")
        else:
            self.first_initial, self.seen = initial, [turn, turn, turn, turn]
        if turn is not None:
            self.counts["turns"] += not self.codes or turn != self.seen[1]
            # Nulls come first, so turns only grow from here.
            self.seen[2] = turn if self.seen[2] is None else self.seen[2]
        self.seen[1] = self.seen[3] = turn
        self.last_initial = initial
        self.codes.append(code_of(initial, fault in ("blank", "duplicate"), fault == "truncated"))
        self.lines.append({"edit": None, "role": role, "text": text})
        self.chars += len(role) + len(text)


def _cut_and_solve(schema: T.StructType):
    """Rows in order to chunks, each with the vector before it from the speculative one at its end."""
    names = schema.names

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps, rng = Steps(), TaskContext.get().partitionId()
        out: list[dict] = []
        kinds: list[pa.DataType] = []
        size = 0
        conv = chunk = None
        number, begins, marker = 0, False, None

        def done(ends: bool) -> None:
            nonlocal size
            tape = bytes(chunk.codes)
            start, total = steps.taken(tape, FINAL)
            closed = begins and ends and number == 0
            row = dict(zip(TURNS, chunk.seen)) | chunk.counts | {"conv_id": conv, "rng": rng, "chunk": number, "closed": closed, "tape": None, "lines": chunk.lines}
            row |= {"first_initial": chunk.first_initial, "last_initial": chunk.last_initial, "used": list(FINAL), "start": list(start), "total": total}
            if closed:
                edits, _ = steps.trace(tape, FINAL, EMPTY, True)
                row |= {"lines": edited(edits, chunk.lines, EMPTY), "audit": "".join(edits), "cost": total + start[EMPTY]}
            else:
                row["tape"] = tape
            out.append(row)
            size += chunk.chars + 200

        def batch_of_chunks() -> pa.RecordBatch:
            nonlocal out, size
            made = [pa.array([row.get(n) for row in out], kinds[0] if n == "conv_id" else kinds[1] if n in TURNS else KINDS.get(n, pa.int64())) for n in names]
            out, size = [], 0
            return pa.RecordBatch.from_arrays(made, names=names)

        fresh = object()
        conv = fresh
        for batch in batches:
            kinds = [batch.schema.field("conv_id").type, batch.schema.field("turn").type]
            for conv_id, turn, id_, row, role, text, blank, cut in zip(*columns_of(batch, "conv_id", "turn", "id", "row", "role", "text", "blank", "cut")):
                if not row:  # marks the row with this id, which comes next, as the first of its role and text
                    marker = id_
                    continue
                if conv is fresh or conv_id != conv:
                    if chunk is not None:
                        done(True)
                        begins = True
                    conv, number, chunk = conv_id, 0, _Chunk()
                elif len(chunk.codes) >= CHUNK_ROWS or chunk.chars >= CHUNK_CHARS:
                    done(False)
                    number, chunk = number + 1, _Chunk()
                chunk.add(turn, role, text, blank, cut, marker == id_)
                if size > 1 << 23 or len(out) >= 5000:
                    yield batch_of_chunks()
        if chunk is not None:
            done(False)
        if out:
            yield batch_of_chunks()

    return work


def cut_rows(rows: DataFrame) -> DataFrame:
    """Chunks of all conversations (one row each, see ``CHUNK``), stored. ``rows`` must be a stored table or made from one
    row by row: row numbers, which only tell copies of one row apart, are taken while it is read."""
    mark = F.sha2(F.encode(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), "UTF-8"), 256)
    rows = rows.select("conv_id", "turn", "role", "text", F.unhex(mark).alias("mark"), F.monotonically_increasing_id().alias("id"))
    solid = F.rtrim("text", F.lit(SPACE))
    flags = (F.length(solid) == 0).alias("blank"), (~F.right(solid, F.lit(1)).isin(".", "!", "?")).alias("cut")
    # The first row of each role and text: found by a combining aggregate, and sent along as a mark in front of its row, so
    # that no join has to gather the copies.
    firsts = rows.groupBy("conv_id", "mark").agg(F.min(F.struct("turn", "id")).alias("first"))
    nothing = [F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"), F.lit(None).cast("boolean").alias("blank"), F.lit(None).cast("boolean").alias("cut")]
    marks = firsts.select("conv_id", "first.turn", "mark", "first.id", F.lit(0).alias("row"), *nothing)
    table = rows.select("conv_id", "turn", "mark", "id", F.lit(1).alias("row"), "role", "text", *flags).unionByName(marks)
    # The range holds a mark and its row together, as they agree in all of its columns.
    dealt = table.repartitionByRange("conv_id", "turn", "mark", "id").sortWithinPartitions("conv_id", "turn", "mark", "id", "row")
    schema = _schema(rows)
    return stage(dealt.drop("mark").mapInArrow(_cut_and_solve(schema), schema), "repair-chunks")


def _fix_up(names: list[str]):
    """Chunks by falling number: those whose successor now begins with another vector are worked off again."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps = Steps()
        conv = number = carried = None
        for batch in batches:
            out: dict[str, list] = {n: [] for n in ("used", "start", "total", "changed")}
            for name, n, tape, used, start, total, after in zip(*columns_of(batch, "conv", "number", "tape", "used", "start", "total", "after")):
                end = carried if (name, n + 1) == (conv, number) else FINAL if after is None else tuple(after)
                used, start = tuple(used), tuple(start)
                changed = end != used
                if changed:
                    start, total, _ = steps.repaired(tape, used, end, start, total)
                conv, number, carried = name, n, start
                for key, value in (("used", end), ("start", start), ("total", total), ("changed", changed)):
                    out[key].append(list(value) if key in ("used", "start") else value)
            made = [pa.array(out["used"], VECTOR), pa.array(out["start"], VECTOR), pa.array(out["total"], pa.int64()), pa.array(out["changed"], pa.bool_())]
            kept = [batch.column(batch.schema.get_field_index(n)) for n in names[: -len(made)]]
            yield pa.RecordBatch.from_arrays([*kept, *made], names=names)

    return work


def converged(chunks: DataFrame) -> DataFrame:
    """``conv, number, tape, used, start, total`` with true vectors, from ``chunks`` with speculative ones."""
    schema = T.StructType.fromDDL("conv string, number bigint, tape binary, used array<bigint>, start array<bigint>, total bigint, changed boolean")
    state = chunks
    for turn in itertools.count(1):
        after = state.select("conv", (F.col("number") - 1).alias("number"), F.col("start").alias("after"))
        met = state.select("conv", "number", "tape", "used", "start", "total").join(after, ["conv", "number"], "left")
        spans = met.repartition("conv", F.floor(F.col("number") / SPAN**turn)).sortWithinPartitions("conv", F.desc("number"))
        state = stage(spans.mapInArrow(_fix_up(schema.names), schema), "repair-vectors")
        if state.where("changed").isEmpty():
            return state


def _exits(names: list[str]):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps = Steps()
        for batch in batches:
            tapes, ends = columns_of(batch, "tape", "used")
            maps = [[steps.trace(tape, tuple(end), state, False)[1] for state in range(4)] for tape, end in zip(tapes, ends)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(maps, pa.list_(pa.int32()))], names=names)

    return work


def entry_states(state: DataFrame) -> DataFrame:
    """``conv, number, entry``: the state in which each chunk is entered, by a prefix scan of the chunks' maps."""
    schema = T.StructType.fromDDL("conv string, number bigint, exits array<int>")
    maps = stage(state.select("conv", "number", "tape", "used").mapInArrow(_exits(schema.names), schema), "repair-maps")
    chunks, reach = (maps.agg(F.max("number")).first()[0] or 0) + 1, 1
    while reach < chunks:
        earlier = maps.select("conv", (F.col("number") + reach).alias("number"), F.col("exits").alias("earlier"))
        both = F.transform("earlier", lambda s: F.get("exits", s))
        maps = stage(maps.join(earlier, ["conv", "number"], "left").select("conv", "number", F.coalesce(both, "exits").alias("exits")), "repair-maps")
        reach *= 2
    left = maps.select("conv", (F.col("number") + 1).alias("number"), F.get("exits", F.lit(EMPTY)).alias("entry"))
    return state.select("conv", "number").join(left, ["conv", "number"], "left").fillna(EMPTY, ["entry"])


def _traced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    steps = Steps()
    for batch in batches:
        audits, made = [], []
        for tape, end, entry, last, lines in zip(*columns_of(batch, "tape", "used", "entry", "last", "lines")):
            edits, _ = steps.trace(tape, tuple(end), entry, last)
            audits.append("".join(edits))
            made.append(edited(edits, lines, entry))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(audits, pa.string()), pa.array(made, KINDS["lines"])], names=["conv", "number", "audit", "lines"])


def _key(conv_id: str = "conv_id") -> Column:
    """A conversation as text; null has a text of its own."""
    return F.coalesce(F.concat(F.lit("="), F.col(conv_id).cast("string")), F.lit(""))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of each conversation's lines; pieces come in order and only one digest is open at a time."""
    open_ = digest = None
    empty = True
    for batch in batches:
        names, found = [], []
        for conv, piece in zip(*columns_of(batch, "conv", "piece")):
            if conv != open_:
                if digest is not None:
                    names.append(open_)
                    found.append(digest.hexdigest())
                open_, digest, empty = conv, hashlib.sha256(), True
            if piece is not None:
                digest.update(("" if empty else "\n").encode() + piece.encode())
                empty = False
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(found, pa.string())], names=["conv", "digest"])
    if digest is not None:
        yield pa.RecordBatch.from_arrays([pa.array([open_], pa.string()), pa.array([digest.hexdigest()], pa.string())], names=["conv", "digest"])


class Repaired(NamedTuple):
    """``report``: one row for each conversation, with ``repaired_sha256`` of its repaired rows, as ``role:text`` joined by newlines.
    ``chunks``: ``conv_id, number, lines``, the repaired rows themselves in order, each with the edit it comes from."""

    report: DataFrame
    chunks: DataFrame

    @property
    def rows(self) -> DataFrame:
        """``conv_id, number, place, edit, role, text``."""
        return self.chunks.select("conv_id", "number", F.posexplode("lines").alias("place", "line")).select("conv_id", "number", "place", "line.*")


REPORT = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def repair(rows: DataFrame) -> Repaired:
    """Repairs ``rows(conv_id, turn, role, text)``, a stored table or one made from it row by row."""
    chunks = cut_rows(rows)
    line = lambda x: F.concat(x["role"], F.lit(":"), x["text"])
    piece = F.array_join(F.transform("lines", line), "\n")
    gaps = F.when(F.col("turns") > 0, F.col("most_turn") - F.col("least_turn") + 1 - F.col("turns")).otherwise(0).cast("bigint")
    closed = chunks.where("closed")
    done = closed.select("conv_id", gaps.alias("gaps"), *REPORT[1:7], F.sha2(F.encode(piece, "UTF-8"), 256).alias("repaired_sha256"))

    # What spans chunks or ranges. Chunks are numbered through from the ranges' counts: a row for each range of a conversation.
    parts = chunks.where(~F.col("closed")).withColumn("conv", _key())
    ranges = parts.groupBy("conv", "rng").count()
    all_ = Window.partitionBy("conv")
    earlier = all_.orderBy("rng").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.select("conv", "rng", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("_start"), F.sum("count").over(all_).alias("_all"))
    number = F.col("_start") + F.col("chunk")
    parts = parts.join(starts, ["conv", "rng"]).withColumn("number", number).withColumn("last", number + 1 == F.col("_all"))
    light = stage(parts.drop("lines", "audit", "cost", "_start", "_all"), "repair-open")
    state = converged(light.select("conv", "number", "tape", "used", "start", "total"))
    solved = state.select("conv", "number", "used", "start", "total").join(entry_states(state), ["conv", "number"])
    solved = stage(solved, "repair-solved")
    heavy = parts.select("conv", "number", "last", "tape", "lines").join(solved.select("conv", "number", "used", "entry"), ["conv", "number"])
    traced = heavy.select("conv", "number", "last", "tape", "lines", "used", "entry").mapInArrow(_traced, f"conv string, number bigint, audit string, lines {LINES}")
    traced = stage(traced, "repair-traced")

    by_chunk = Window.partitionBy("conv").orderBy("number")
    facts = light.drop("used", "start", "total", "tape").join(solved.select("conv", "number", "start", "total"), ["conv", "number"])
    # Neighbours meet by number, so a conversation of many chunks is not gathered for it.
    next_ = facts.select("conv", (F.col("number") - 1).alias("number"), F.col("first_initial").alias("next_initial"), F.col("first_turn").alias("next_turn"))
    facts = facts.join(next_, ["conv", "number"], "left")
    odd = F.coalesce((~F.concat("last_initial", "next_initial").isin("su", "ua", "au")).cast("int"), F.lit(0))
    same_turn = F.coalesce((F.col("last_turn") == F.col("next_turn")).cast("int"), F.lit(0))
    cost = F.col("total") + F.when(F.col("number") == 0, F.get("start", F.lit(EMPTY))).otherwise(0)
    sums = facts.groupBy("conv").agg(
        F.first("conv_id").alias("conv_id"), F.min("least_turn").alias("least_turn"), F.max("most_turn").alias("most_turn"),
        F.sum(F.col("turns") - same_turn).alias("turns"), *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")],
        F.sum(F.col("illegal") + odd).alias("illegal"), F.sum(cost).alias("cost"),
    )
    # The audit is one value of the result, and its digest one of a running kind: both go through a conversation in order.
    audits = traced.groupBy("conv").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("number", "audit"))), lambda x: x["audit"]), "").alias("audit"))
    pieces = traced.select("conv", "number", F.when(F.size("lines") > 0, piece).alias("piece"))
    digests = pieces.repartition("conv").sortWithinPartitions("conv", "number").mapInArrow(_digests, "conv string, digest string")
    rest = sums.join(audits, "conv").join(digests, "conv").withColumn("repaired_sha256", F.col("digest"))
    rest = rest.select("conv_id", gaps.alias("gaps"), *REPORT[1:])
    whole = traced.join(light.select("conv", "number", "conv_id"), ["conv", "number"]).select("conv_id", "number", "lines")
    return Repaired(done.unionByName(rest), closed.select("conv_id", F.lit(0).cast("bigint").alias("number"), "lines").unionByName(whole))


def repair_report(conversations: DataFrame) -> DataFrame:
    """One row for every conversation of ``conversations``, as it is repaired after ``damaged``."""
    found = repair(damaged(conversations)).report
    every = conversations.select("conv_id").distinct()
    met = every.join(found.withColumnRenamed("conv_id", "_conv"), every["conv_id"].eqNullSafe(F.col("_conv")), "left")
    zeros = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in REPORT[:6]]
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    return met.select("conv_id", *zeros, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", nothing).alias("repaired_sha256"))
