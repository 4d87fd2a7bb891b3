"""Conversation repair against a plain search for the cheapest edits."""

from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib

import pytest

from millrace.llm.conversations import CLASSES, KEEP, STATES, TAIL, WRITE, damaged, digest, edits, forward, repair_conversations, start

SCHEMA = "conv_id long, turn long, role string, text string, at long, edits string, line string, n int, part string, none string, copies_ int"


def cheapest(rows):
    """(cost, audit, lines) of rows (role, text, fault), by Dijkstra's search over cost and audit."""
    heap, done = [(0, "", 0, 0, ())], set()
    while heap:
        cost, audit, i, s, lines = heapq.heappop(heap)
        if i == len(rows) and s in (0, 3):
            return cost, audit, lines
        if (i, s) in done:
            continue
        done.add((i, s))
        name = "assistant" if s == 2 else "user"
        heapq.heappush(heap, (cost + 2, audit + "I", i, WRITE[s], (*lines, f"{name}:")))
        if i < len(rows):
            role, text, fault = rows[i]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, s, lines))
            if fault not in ("blank", "duplicate"):
                more = fault == "truncated"
                heapq.heappush(heap, (cost + 2 + more, audit + "R", i + 1, WRITE[s], (*lines, f"{name}:{text}")))
                to = KEEP.get(role[:1], {}).get(s) if role[:1] != "o" else None
                if to is not None:
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, to, (*lines, f"{role}:{text}")))


def expected(table):
    """The contract's rows, from plain rows (conv_id, turn, role, text)."""
    after = {}
    for conv, turn, role, text in table:
        space = [" " if v is None else str(v) for v in (conv, turn, role, text)]
        rule, role, text = zlib.crc32(f"{space[0]}:{space[1]}".encode()) % 20, space[2], space[3]
        rows = after.setdefault(conv, [])
        text = "" if rule == 1 else re.sub("[.!?]", "", text) if rule == 2 else text
        rows += [(turn, "user" if rule == 4 else role, text)] * {0: 0, 3: 2}.get(rule, 1)
    found = {}
    for conv, rows in after.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, hashlib.md5(f"{len(r[1])}:{r[1]}{r[2]}".encode()).hexdigest()))
        seen, judged, counts = set(), [], dict.fromkeys(("blank", "duplicate", "truncated", "none"), 0)
        for _, role, text in rows:
            solid = text.strip(" \t\n\x0b\x0c\r")
            fault = ("blank" if not solid else "duplicate" if (role, text) in seen
                     else "truncated" if solid[-1] not in ".!?" else "none")
            seen.add((role, text))
            counts[fault] += 1
            judged.append((role, text, fault))
        turns = [t for t, *_ in rows if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        odd = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(judged, judged[1:]))
        cost, audit, lines = cheapest(judged) if judged else (0, "", ())
        sha = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        found[conv] = (gaps, counts["blank"], counts["duplicate"], counts["truncated"], odd, cost, audit, sha)
    return found


def frame(spark, table, parts=3):
    rows = [(*r, 1, "K", "x", 1, "p", "n", 2) for r in table]
    df = spark.createDataFrame(rows, SCHEMA)
    return df.repartition(parts) if rows else df


def repaired(spark, table):
    turns, report = repair_conversations(damaged(frame(spark, table)), copies_col="copies")
    audits = {r.conv_id: (r.audit, r.repaired_sha256) for r in digest(turns).collect()}
    none = ("", hashlib.sha256(b"").hexdigest())
    rows = report.collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, *audits.get(r.conv_id, none)) for r in rows}


def table(seed, count, length, texts):
    rnd, rows = random.Random(seed), []
    for conv in [*range(count), None]:
        for turn in range(rnd.randrange(1, length)):
            rows.append((conv, rnd.choice([turn, turn, turn * 2, turn // 2, None]),
                         rnd.choice(["user", "assistant", "system", "user", "assistant", "tool", "", None, "ass", "o"]), rnd.choice(texts)))
    return rows


TEXTS = ["Good.", "Yes!", "Why?  ", "no end", "", " \t\n", None, "ü.", "中文", "A. \n", "x" * 50_000, "🙂"] + [f"Turn {i}." for i in range(40)]


@pytest.mark.parametrize("seed", [1, 2])
def test_repair_equals_a_plain_search(spark, seed):
    rows = table(seed, 60, 14, TEXTS)
    rows += rows[:30] + [(7, 3, "user", "Good.")] * 40 + [(None, None, None, None)] * 25
    assert repaired(spark, rows) == expected(rows)


def test_a_conversation_may_lie_in_many_parts(spark):
    rnd = random.Random(3)
    rows = [(1, t, rnd.choice(["user", "assistant", "system", "tool"]), rnd.choice(TEXTS[:10]) if t % 3 else f"Said {t}.")
            for t in range(1500)] + [(2, t, "user", "Same.") for t in range(300)] + [(3, 5, "user", "Hi.")]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert repaired(spark, rows) == expected(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_halves_meet_at_the_least_audit():
    rnd = random.Random(4)
    for _ in range(400):
        symbols = bytes(rnd.randrange(12) for _ in range(rnd.randrange(1, 25)))
        rows = [(CLASSES[s // 3] if s // 3 < 3 else "tool", str(i), ("none", "truncated", "blank")[s % 3]) for i, s in enumerate(symbols)]
        total, vector = forward(symbols, start(0))
        end = min(STATES, key=lambda t: (vector[t][0] + TAIL[t][1], vector[t][1]))
        audit = "".join(edits(symbols, 0, end)) + TAIL[end][0]
        assert (total + vector[end][0] + TAIL[end][1], audit) == cheapest(rows)[:2]


def test_turns_hold_the_written_rows(spark):
    turns, report = repair_conversations(frame(spark, [(1, 0, "assistant", "Hello."), (1, 1, "user", "Why?"), (2, 0, "user", None)]))
    found = {(r.conv_id, r.edits): [(x.role, x.text) for x in r.lines] for r in turns.collect()}
    assert found == {(1, "IK"): [("user", ""), ("assistant", "Hello.")], (1, "KI"): [("user", "Why?"), ("assistant", "")], (2, "D"): []}
    assert {(r.conv_id, r.n, r.cost) for r in report.collect()} == {(1, 2, 4), (2, 1, 3)}


def test_an_empty_table_gives_empty_frames(spark):
    turns, report = repair_conversations(frame(spark, []))
    assert turns.count() == report.count() == digest(turns).count() == 0
