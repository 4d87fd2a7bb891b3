"""Repair of conversation structure: least edits by four-state cost vectors that meet in the middle (Hirschberg).

What has been written so far is in one of four states: nothing (0), a system turn (1), a user turn last (2), an
assistant turn last (3). An edit of a row moves on by fixed steps, so a stretch of rows is a 4 x 4 table of least
costs. Tables of stretches are joined along a conversation, and a stretch whose two ends are known is solved alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.frames import saved

BLANKS = " \t\n\x0b\x0c\r"
STATES = range(4)
#: Edits: I insert, D delete, K keep, R give another role. Next state of what is written, by letter and state.
WRITE = {0: 2, 1: 2, 3: 2, 2: 3}
KEEP = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}, "o": {}}
CLASSES = "suao"
PLAIN, CUT, FORCED = range(3)
#: What ends a conversation from each state: inserts and their cost.
TAIL = {0: ("", 0), 1: ("II", 4), 2: ("I", 2), 3: ("", 0)}
ROLE = {2: "user", 3: "assistant"}
FAR = 1 << 60

Vector = tuple[tuple[int, int], ...]

#: What has been worked out in a process. Vectors hold costs above their least, so there are few; edits are of short stretches.
_ahead: dict = {}
_behind: dict = {}
_short: dict = {}
SHORT, SHORT_ROWS = 1 << 15, 16


def _steps(symbol: int) -> list[dict[int, tuple[int, str]]]:
    """By state: the states that one row can lead to, each with the least (cost, word); a word is inserts and one letter."""
    kept, kind = KEEP[CLASSES[symbol // 3]], symbol % 3
    table = []
    for state in STATES:
        found: dict[int, tuple[int, str]] = {}
        at = state
        for inserts in range(3):
            choices = [("D", at, 3)]
            if kind != FORCED:
                choices.append(("R", WRITE[at], 2 + kind))
                if at in kept:
                    choices.append(("K", kept[at], kind))
            for letter, to, cost in choices:
                new = (2 * inserts + cost, "I" * inserts + letter)
                found[to] = min(found.get(to, new), new)
            at = WRITE[at]
        table.append(found)
    return table


STEPS = [_steps(symbol) for symbol in range(3 * len(CLASSES))]


def _advance(vector: Vector, symbol: int) -> tuple[int, Vector]:
    """One row on: (cost, rank) by state, costs above their least, and that least.

    Ranks order the audits of the states. Audits that end after the same row never begin one another, as each ends with
    a letter of that row, so their order stays whatever follows.
    """
    if (known := _ahead.get((vector, symbol))) is not None:
        return known
    best: dict[int, tuple] = {}
    for state, (cost, rank) in enumerate(vector):
        if cost < FAR:
            for to, (more, word) in STEPS[symbol][state].items():
                new = (cost + more, rank, word)
                best[to] = min(best.get(to, new), new)
    least = min(b[0] for b in best.values())
    order = sorted(best, key=lambda to: best[to][1:])
    new = tuple((best[t][0] - least, order.index(t)) if t in best else (FAR, 9) for t in STATES)
    return _ahead.setdefault((vector, symbol), (least, new))


def _retreat(costs: tuple[int, ...], symbol: int) -> tuple[int, tuple[int, ...]]:
    """One row back: cost to the end by state, above their least, and that least."""
    if (known := _behind.get((costs, symbol))) is not None:
        return known
    new = [min(more + costs[to] for to, (more, _) in STEPS[symbol][state].items()) for state in STATES]
    least = min(new)
    return _behind.setdefault((costs, symbol), (least, tuple(c - least if c < FAR else FAR for c in new)))


def forward(symbols: bytes, vector: Vector) -> tuple[int, Vector]:
    total = 0
    for symbol in symbols:
        least, vector = _advance(vector, symbol)
        total += least
    return total, vector


def start(state: int) -> Vector:
    return tuple((0, 0) if s == state else (FAR, 9) for s in STATES)


def backward(symbols: bytes, end: int) -> tuple[int, ...]:
    costs = tuple(0 if s == end else FAR for s in STATES)
    for symbol in reversed(symbols):
        _, costs = _retreat(costs, symbol)
    return costs


def edits(symbols: bytes, begin: int, end: int) -> list[str]:
    """The audit-least of the cheapest edits of a stretch between two states, a word per row, in linear space."""
    out = [""] * len(symbols)
    todo = [(0, len(symbols), begin, end)]
    while todo:
        lo, hi, s, e = todo.pop()
        if hi - lo == 1:
            out[lo] = STEPS[symbols[lo]][s][e][1]
        elif hi > lo:
            mid = (lo + hi) // 2
            _, ahead = forward(symbols[lo:mid], start(s))
            behind = backward(symbols[mid:hi], e)
            cross = min((t for t in STATES if ahead[t][0] < FAR and behind[t] < FAR),
                        key=lambda t: (ahead[t][0] + behind[t], ahead[t][1]))
            todo += [(lo, mid, s, cross), (mid, hi, cross, e)]
    return out


def _edits(symbols: bytes, begin: int, end: int) -> list[str]:
    """The same, short stretches looked up, as most conversations are alike."""
    if len(symbols) > SHORT_ROWS:
        return edits(symbols, begin, end)
    if len(_short) > SHORT:
        _short.clear()
    if (symbols, begin, end) not in _short:
        _short[symbols, begin, end] = edits(symbols, begin, end)
    return _short[symbols, begin, end]


def _written(word: str, state: int, symbol: int) -> tuple[list[str], int]:
    """Roles of the rows that a word writes, "" for the row's own, and the state after them."""
    roles = []
    for letter in word:
        if letter == "K":
            state = KEEP[CLASSES[symbol // 3]][state]
            roles.append("")
        elif letter != "D":
            state = WRITE[state]
            roles.append(ROLE[state])
    return roles, state


KEYS = {"conv": pa.int64(), "none": pa.bool_(), "part": pa.int64()}
COUNTS = ["n", "blank", "duplicate", "truncated", "illegal"]
STRETCH = pa.schema({**KEYS, **dict.fromkeys([*COUNTS, "spare", "low", "high", "turns", "first", "last"], pa.int64()),
                     "costs": pa.list_(pa.int64()), "ranks": pa.list_(pa.int64())})
PLAN = pa.schema({**KEYS, "enter": pa.int32(), "leave": pa.int32(), "tail": pa.string(), "head": pa.bool_(),
                  **dict.fromkeys([*COUNTS, "gaps", "cost"], pa.int64())})
SOLVED = pa.schema({"at": pa.int64(), "edits": pa.string(), "before": pa.list_(pa.string()), "own": pa.string(),
                    "after": pa.list_(pa.string())})


def _by_group(keys: tuple[str, ...], solve: Callable[[dict[str, list]], list[dict]], schema: pa.Schema):
    """A function for ``mapInArrow`` over rows sorted by keys: the rows that ``solve`` gives for each whole group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, {}
        for batch in batches:
            out, columns = [], batch.to_pydict()
            ids = list(zip(*(columns[k] for k in keys), strict=True))
            starts = [i for i in range(len(ids)) if i == 0 or ids[i] != ids[i - 1]]
            for i, j in zip(starts, [*starts[1:], len(ids)], strict=True):
                part = {c: values[i:j] for c, values in columns.items()}
                if ids[i] == key:
                    for c, values in part.items():
                        held[c] += values
                    continue
                if key is not None:
                    out += solve(held)
                key, held = ids[i], part
            yield pa.RecordBatch.from_pylist(out, schema=schema)
        if key is not None:
            yield pa.RecordBatch.from_pylist(solve(held), schema=schema)

    return run


def _stretch(rows: dict[str, list]) -> list[dict]:
    """Counts of one part of a conversation, and its table of costs and ranks."""
    real = [i for i, c in enumerate(rows["copies"]) if c]
    copies, symbols, blank = ([rows[c][i] for i in real] for c in ("copies", "symbol", "blank"))
    spare = sum(copies) - len(real)
    again = sum(c if s % 3 == FORCED else c - 1 for c, s, b in zip(copies, symbols, blank, strict=True) if not b)
    known = [rows["turn"][i] for i in real if rows["turn"][i] is not None]
    kinds = [s // 3 for s in symbols]
    tables = [forward(bytes(symbols), start(s)) for s in STATES]
    return [{
        **{c: rows[c][0] for c in KEYS}, "n": sum(copies), "blank": sum(c for c, b in zip(copies, blank, strict=True) if b),
        "duplicate": again, "truncated": sum(s % 3 == CUT for s in symbols), "spare": spare,
        "illegal": sum(not _legal(a, b) for a, b in zip(kinds, kinds[1:])) + spare,
        "low": min(known, default=None), "high": max(known, default=None), "turns": len(set(known)),
        "first": kinds[0] if kinds else None, "last": kinds[-1] if kinds else None,
        "costs": [total + c if c < FAR else FAR for total, v in tables for c, _ in v],
        "ranks": [r for _, v in tables for _, r in v],
    }]


def _legal(a: int, b: int) -> bool:
    return CLASSES[a] + CLASSES[b] in ("su", "ua", "au")


def _joined(rows: dict[str, list]) -> list[dict]:
    """The parts of one conversation joined: the states between them, and on the first part the report."""
    every = [dict(zip(rows, values, strict=True)) for values in zip(*rows.values(), strict=True)]
    parts = [p for p in every if p["n"]]
    vector, came = start(0), []
    for p in parts:
        best: dict[int, tuple] = {}
        for s, (cost, rank) in enumerate(vector):
            for t in STATES:
                if cost < FAR and p["costs"][4 * s + t] < FAR:
                    new = (cost + p["costs"][4 * s + t], rank, p["ranks"][4 * s + t], s)
                    best[t] = min(best.get(t, new), new)
        order = sorted(best, key=lambda t: best[t][1:3])
        came.append({t: best[t][3] for t in best})
        vector = tuple((best[t][0], order.index(t)) if t in best else (FAR, 9) for t in STATES)
    end = min(STATES, key=lambda t: (vector[t][0] + TAIL[t][1], vector[t][1]))
    states = [end]
    for step in reversed(came):
        states.append(step[states[-1]])
    states.reverse()
    known = [p for p in parts if p["low"] is not None]
    turns = sum(p["turns"] for p in known) - sum(a["high"] == b["low"] for a, b in zip(known, known[1:]))
    told = {c: sum(p[c] for p in parts) for c in COUNTS}
    told["illegal"] += sum(not _legal(a["last"], b["first"]) for a, b in zip(parts, parts[1:]))
    told["gaps"] = min(2**63 - 1, known[-1]["high"] - known[0]["low"] + 1 - turns) if known else 0
    told["cost"] = vector[end][0] + TAIL[end][1] + 3 * sum(p["spare"] for p in parts) if parts else 0
    shown = parts or every[:1]
    return [{**{c: p[c] for c in KEYS}, "enter": states[i], "leave": states[min(i + 1, len(states) - 1)],
             "tail": TAIL[end][0] if p is shown[-1] else "", "head": i == 0, **told} for i, p in enumerate(shown)]


def _solved(rows: dict[str, list]) -> list[dict]:
    """Of each row of one part its edits, and the roles that it writes: before its own, its own ("" as it is), after."""
    state, tail = rows["enter"][0], rows["tail"][0]
    out = []
    for at, symbol, times, word in zip(rows["at"], rows["symbol"], rows["copies"],
                                       _edits(bytes(rows["symbol"]), state, rows["leave"][0]), strict=True):
        written, state = _written(word, state, symbol)
        own = written.pop() if word[-1] in "KR" else None
        out.append({"at": at, "edits": word + "D" * (times - 1), "before": written, "own": own, "after": []})
    out[-1]["edits"] += tail
    out[-1]["after"] = _written(tail, state, 0)[0]
    return out


def _names(schema: pa.Schema) -> str:
    """The schema as Spark writes it."""
    kinds = {pa.int64(): "long", pa.int32(): "int", pa.bool_(): "boolean", pa.string(): "string",
             pa.list_(pa.int64()): "array<long>", pa.list_(pa.string()): "array<string>"}
    return ", ".join(f"{f.name} {kinds[f.type]}" for f in schema)


def repair_conversations(
    rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
    copies_col: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The cheapest edits that give each conversation the roles (system)? (user assistant)+, or nothing; (turns, report).

    Rows are taken by turn, nulls first, then by the MD5 of role and text. Keep costs 0, another role (user or assistant) 2,
    delete 3, an inserted empty turn 2; a row that stays truncated adds 1. Blank rows and repeats of an earlier row of
    the conversation (role and text) must go. A role counts by its first letter: s, u, a or another. Of the cheapest edits
    those whose letters (D, I, K, R) are least in ASCII order are taken.
    ``copies_col`` says how often a row occurs; a row of none keeps its conversation in the report.

    Rows are put in one order of (conversation, turn, hash), dealt by range, so one conversation may lie in many
    parts. Each part of a conversation gives a table of costs between states; the tables are joined, which fixes
    the states between parts; each part is then solved alone, halving it where forward and backward costs meet.
    Equal rows are counted before, so they are one row however many.

    turns: conv_id, at (place in the order), edits (letters of the row, with inserts), lines (array of role, text that it
    leaves). report: conv_id, n, gaps, blank, duplicate, truncated, illegal, cost; a row per conversation.
    Null roles and texts are one space; null conversations are one; other columns are left aside; empty tables give
    empty frames.
    """
    given = rows.select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col), F.lit(" ")).alias("role"), F.coalesce(F.col(text_col), F.lit(" ")).alias("text"),
        (F.col(copies_col) if copies_col else F.lit(1)).cast("long").alias("copies"))
    lines = given.groupBy("conv", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    trimmed = F.rtrim("text", F.lit(BLANKS))
    initial = F.substring("role", 1, 1)
    lines = lines.select(
        F.coalesce("conv", F.lit(0)).alias("conv"), F.col("conv").isNull().alias("none"), "turn", "role", "text", "copies",
        F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary")).alias("line"),
        (trimmed == "").alias("blank"), (~F.substring(trimmed, -1, 1).isin(".", "!", "?")).alias("cut"),
        F.when(initial.isin(*CLASSES[:3]), F.instr(F.lit(CLASSES), initial) - 1).otherwise(3).cast("int").alias("class"))
    order = ["conv", "none", F.col("turn").asc_nulls_first(), "line"]
    dealt = lines.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    dealt = saved(dealt, "turns")

    narrow = dealt.select("conv", "none", "at", "turn", "copies", "blank", "cut", "class", "line")
    seen = narrow.where("copies > 0 AND NOT blank").groupBy("conv", "none", "line").agg(
        F.min("at").alias("earliest"), F.count(F.lit(1)).alias("times")).where("times > 1").drop("times")
    kind = F.when(F.col("blank") | (F.col("at") > F.col("earliest")), FORCED).when(F.col("cut"), CUT).otherwise(PLAIN)
    coded = narrow.join(seen, ["conv", "none", "line"], "left").select(
        "conv", "none", F.shiftright("at", 33).alias("part"), "at", "turn", "copies", "blank",
        (3 * F.col("class") + F.coalesce(kind, F.lit(PLAIN))).cast("int").alias("symbol"))
    coded = saved(coded, "turn-codes")

    keys = ["conv", "none", "part"]
    spread = coded.repartition(*keys).sortWithinPartitions(*keys, "at")
    stretches = spread.mapInArrow(_by_group(tuple(keys), _stretch, STRETCH), _names(STRETCH))
    plans = stretches.repartition("conv", "none").sortWithinPartitions(*keys).mapInArrow(
        _by_group(("conv", "none"), _joined, PLAN), _names(PLAN))
    plans = saved(plans, "turn-plans")
    placed = coded.where("copies > 0").join(plans.select(*keys, "enter", "leave", "tail"), keys)
    placed = placed.repartition(*keys).sortWithinPartitions(*keys, "at")
    solved = placed.mapInArrow(_by_group(tuple(keys), _solved, SOLVED), _names(SOLVED))

    def empty(roles: str) -> Column:
        return F.transform(roles, lambda r: F.struct(r.alias("role"), F.lit("").alias("text")))

    own = F.when(F.col("own").isNotNull(), F.array(F.struct(
        F.when(F.col("own") == "", F.col("role")).otherwise(F.col("own")).alias("role"), F.col("text").alias("text"))))
    none = F.array().cast("array<struct<role: string, text: string>>")
    conv_id = F.when(~F.col("none"), F.col("conv")).alias("conv_id")
    turns = dealt.join(solved, "at").select(
        conv_id, "at", "edits", F.concat(empty("before"), F.coalesce(own, none), empty("after")).alias("lines"))
    report = plans.where("head").select(conv_id, "n", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return turns, report


def digest(turns: DataFrame) -> DataFrame:
    """conv_id, audit and repaired_sha256 of each conversation with rows: its edits, and the hash of its lines role:text.

    Lines are hashed one after the other, so a task holds one row at a time; the letters of a conversation are one value.
    """
    text = F.array_join(F.transform("lines", lambda x: F.concat(x.role, F.lit(":"), x.text)), "\n")
    rows = turns.select(
        F.coalesce("conv_id", F.lit(0)).alias("conv"), F.col("conv_id").isNull().alias("none"), "at", "edits",
        F.when(F.size("lines") > 0, text).alias("text"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, audit, sha, any_line = None, [], hashlib.sha256(), False
        for batch in batches:
            out = []
            columns = [batch.column(c).to_pylist() for c in ("conv", "none", "edits", "text")]
            for conv, none, letters, text in zip(*columns, strict=True):
                if (conv, none) != key:
                    if key is not None:
                        out.append((*key, "".join(audit), sha.hexdigest()))
                    key, audit, sha, any_line = (conv, none), [], hashlib.sha256(), False
                audit.append(letters)
                if text is not None:
                    sha.update((b"\n" if any_line else b"") + text.encode())
                    any_line = True
            yield _digests(out)
        if key is not None:
            yield _digests([(*key, "".join(audit), sha.hexdigest())])

    found = rows.repartition("conv", "none").sortWithinPartitions("conv", "none", "at").mapInArrow(
        hashed, "conv long, none boolean, audit string, repaired_sha256 string")
    return found.select(F.when(~F.col("none"), F.col("conv")).alias("conv_id"), "audit", "repaired_sha256")


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    schema = pa.schema([("conv", pa.int64()), ("none", pa.bool_()), ("audit", pa.string()), ("repaired_sha256", pa.string())])
    return pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows], schema=schema)


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with faults put in by the CRC-32 of ``conv_id:turn`` modulo 20 (nulls: one space), and how often each row
    occurs (copies): 0 drops it, 1 empties its text, 2 takes its full stops, 3 repeats it, 4 makes the role user."""
    def spaced(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    rule = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")) % 20
    rows = rows.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), spaced("role").alias("role"),
                       spaced("text").alias("text"), rule.alias("rule"))
    gone = F.col("rule") == 0
    text = F.when(gone | (F.col("rule") == 1), "").when(F.col("rule") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return rows.select(
        "conv_id", F.when(~gone, F.col("turn")).alias("turn"),
        F.when(gone, "").when(F.col("rule") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        F.when(gone, 0).when(F.col("rule") == 3, 2).otherwise(1).alias("copies"))
