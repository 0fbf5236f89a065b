"""Conversation repair, held against an exhaustive search over one conversation at a time."""

import functools
import hashlib
import random
import zlib

import pyarrow.parquet as pq
import pytest

from graphprep.llm import conversation_repair as repair_
from graphprep.llm.conversation_repair import FINAL, Steps, code_of, damaged, repair, repair_report
from graphprep.llm.queries import QUERIES

DATA = "/root/testdata/sf0.01"
SPACE = " \t\n\x0b\f\r"
DDL = "conv_id bigint, turn bigint, role string, text string"


def digest(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(name.encode()) % 20
        if fault == 0:
            continue
        if fault == 1:
            text = ""
        if fault == 2:
            text = "".join(c for c in text if c not in ".!?")
        if fault == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if fault == 3 else 1)
    return out


def cheapest(rows):
    """Least ``(cost, audit, lines)``; ``rows`` are ``(role, text, must go, truncated)``."""

    def follow(done, initial):  # "" or "s" or the last of u, a
        return {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}.get((done, initial))

    @functools.lru_cache(None)
    def best(at, done, inserted):
        options = []
        if at == len(rows) and done in ("", "a"):
            options.append((0, "", ()))
        if inserted < 4:
            for role in ("user", "assistant"):
                if after := follow(done, role[0]):
                    cost, audit, lines = best(at, after, inserted + 1)
                    options.append((cost + 2, "I" + audit, ((role + ":"), *lines)))
        if at < len(rows):
            role, text, must_go, truncated = rows[at]
            cost, audit, lines = best(at + 1, done, 0)
            options.append((cost + 3, "D" + audit, lines))
            if not must_go:
                if after := follow(done, role[:1]):
                    cost, audit, lines = best(at + 1, after, 0)
                    options.append((cost + truncated, "K" + audit, (f"{role}:{text}", *lines)))
                for other in ("user", "assistant"):
                    if after := follow(done, other[0]):
                        cost, audit, lines = best(at + 1, after, 0)
                        options.append((cost + truncated + 2, "R" + audit, (f"{other}:{text}", *lines)))
        return min(options) if options else (10**9, "", ())

    for at in range(len(rows), 0, -50):  # from the end, so that the search never goes deep
        for done in ("", "s", "u", "a"):
            best(at, done, 0)
    return best(0, "", 0)


def expected(conv, rows):
    """The report of one conversation from its rows after damage."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, digest(r[2], r[3])))
    seen, counts, coded = set(), {"blank": 0, "duplicate": 0, "truncated": 0}, []
    for _, _, role, text in rows:
        solid = text.strip(SPACE)
        fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else None
        seen.add((role, text))
        if fault:
            counts[fault] += 1
        coded.append((role, text, fault in ("blank", "duplicate"), int(fault == "truncated")))
    initials = [r[0][:1] for r in coded]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    turns = [t for _, t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    cost, audit, lines = cheapest(tuple(coded))
    return conv, gaps, *counts.values(), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()


def reports(rows, broken=True):
    after = {}
    for row in damage(rows) if broken else rows:
        after.setdefault(row[0], []).append(row)
    return sorted((expected(conv, after.get(conv, [])) for conv in {r[0] for r in rows}), key=repr)


def table(spark, rows):
    return spark.createDataFrame(rows, DDL)


def test_whole_table(spark):
    rows = [tuple(r.values()) for r in pq.read_table(f"{DATA}/conversations.parquet").to_pylist()]
    result = QUERIES["op11_conversation_repair"](spark, DATA)
    assert result.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert sorted(map(tuple, result.collect()), key=repr) == reports(rows)


def odd_rows():
    draw = random.Random(4)
    roles = ["user", "assistant", "system", "tool", "", None, "User", "u", "a:x"]
    texts = ["Yes.", "No", "", " \n", None, "x\x1c", "Ends!\t", "é😀?", "long " * 5000, "a:b", "."]
    rows = []
    for conv in [*range(40), None]:
        for _ in range(draw.randrange(1, 12)):
            rows.append((conv, draw.choice([None, 0, 1, 2, 3, 5, 9, 9, -4]), draw.choice(roles), draw.choice(texts)))
    return rows + rows[:9]


def test_odd_conversations(spark):
    rows = odd_rows()
    clashing = table(spark, rows).selectExpr("*", "'x' id", "1 number", "'y' conv", "2 chunk", "3 row", "true closed")
    assert sorted(map(tuple, repair_report(clashing).collect()), key=repr) == reports(rows)


def test_empty_table(spark):
    assert repair_report(table(spark, [])).count() == 0


def test_a_conversation_of_which_nothing_is_left(spark):
    conv = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    nothing = hashlib.sha256(b"").hexdigest()
    assert [tuple(r) for r in repair_report(table(spark, [(conv, 0, "user", "x")])).collect()] == [(conv, 0, 0, 0, 0, 0, 0, "", nothing)]


def long_conversation(n, seed, same=0.0):
    draw = random.Random(seed)
    return [(7, t, draw.choice(["user", "assistant", "system"]), "Same." if draw.random() < same else draw.choice(["Yes", "No."]) + str(t) + draw.choice([".", ""])) for t in range(n)]


@pytest.mark.parametrize("same", [0.3, 1.0])
def test_a_conversation_of_many_chunks_and_ranges(spark, monkeypatch, same):
    """With one text for all rows hardly a vector converges, as every row must be deleted."""
    monkeypatch.setattr(repair_, "CHUNK_ROWS", 7)
    rows = long_conversation(400, 2, same) + [(c, t, "user", "Hm.") for c in (1, 9) for t in range(3)]
    stored = table(spark, rows).repartition(5)
    found = repair(stored)
    columns = ["conv_id", *repair_.REPORT]
    assert sorted(map(tuple, found.report.select(columns).collect()), key=repr) == reports(rows, broken=False)
    lines = found.rows.where("conv_id = 7").orderBy("number", "place").collect()
    text = "\n".join(f"{r['role']}:{r['text']}" for r in lines)
    report = found.report.where("conv_id = 7").first()
    assert hashlib.sha256(text.encode()).hexdigest() == report["repaired_sha256"]
    assert "".join(r["edit"] for r in lines) == report["audit"].replace("D", "")


def test_fix_up_stops_where_vectors_differ_by_a_constant():
    draw = random.Random(1)
    steps, saved = Steps(), 0
    for _ in range(300):
        tape = bytes(code_of(draw.choice("suax"), draw.random() < 0.2, draw.random() < 0.3) for _ in range(60))
        end = (0, 4, 2, draw.randrange(4))
        end = tuple(x - min(end) for x in end)
        start, total = steps.taken(tape, FINAL)
        found, sum_, worked = steps.repaired(tape, FINAL, end, start, total)
        assert (found, sum_) == steps.taken(tape, end)
        saved += len(tape) - worked
    assert saved > 300 * 40


def test_damage_is_as_stated(spark):
    rows = [(c, t, "assistant", "A. b! c?") for c in (1, None) for t in [None, *range(40)]]
    found = damaged(table(spark, rows)).select("conv_id", "turn", "role", "text").collect()
    assert sorted(map(tuple, found), key=repr) == sorted(damage(rows), key=repr)
