"""Secret scans: fixed forms, and tokens that a battery of randomness tests cannot tell from random keys.

A token is read in the smallest encoding that holds it. Its symbols are tested for uniformity (chi-squared, over symbols and
over letters of a kind), runs and serial correlation. How natural text of the same alphabet and length fares in
these tests is counted over the whole corpus outside such tokens, and sets which scores are discoveries at a stated
false-discovery rate, apart for each length.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.frames import saved
from millrace.llm.tokens import LOWER, pieces, text_bytes

#: The base forms. Their order is that of spans with equal start; found tokens come last.
KINDS = ["assign", "access", "hex", "random"]
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]{32,}")
NAMES = [b"passw", b"secret", b"token", b"apikey", b"api_key"]

UPPER, LOW, DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
#: Encodings, the smallest first: symbols in order of value (alternatives share one), and the case that natural text is put in.
ENCODINGS = [
    ([DIGITS + LOW[:6]], "lower"),
    ([DIGITS + UPPER[:6]], "upper"),
    ([UPPER + "234567"], "upper"),
    ([DIGITS + LOW], "lower"),
    ([UPPER + LOW + DIGITS + "+/", UPPER + LOW + DIGITS + "-_"], "as is"),
]
#: Least lengths of the classes of length; natural text is cut to these.
LENGTHS = np.array([16, 24, 32, 48, 64, 96])
CYCLE = np.concatenate([[0], np.cumsum(LENGTHS)])
#: Fixed value: 0.1 % point of chi-squared with 4 degrees, beyond which a token is not taken for random at all. Scores go by quarters.
PLAUSIBLE, STEP = 18.47, 0.25
BINS = int(np.ceil(PLAUSIBLE / STEP)) + 1


def _values() -> np.ndarray:
    table = np.full((len(ENCODINGS), 256), -1, dtype=np.int8)
    for e, (alphabets, _) in enumerate(ENCODINGS):
        for alphabet in alphabets:
            table[e, np.frombuffer(alphabet.encode(), np.uint8)] = np.arange(len(alphabet))
    return table


def _classes() -> np.ndarray:
    """Upper case, lower case, digit or mark of each symbol of an encoding."""
    table = np.zeros((len(ENCODINGS), 64), dtype=np.int64)
    for e, (alphabets, _) in enumerate(ENCODINGS):
        for i, c in enumerate(alphabets[0]):
            table[e, i] = 0 if c in UPPER else 1 if c in LOW else 2 if c in DIGITS else 3
    return table


VALUES, CLASSES = _values(), _classes()
SIZES = [len(alphabets[0]) for alphabets, _ in ENCODINGS]
#: Bit e of a byte: encoding e has it.
MEMBER = ((VALUES >= 0) << np.arange(len(ENCODINGS))[:, None]).sum(axis=0).astype(np.uint8)
RAISED = np.arange(256, dtype=np.uint8)
RAISED[97:123] -= 32


def scores(symbols: np.ndarray, encoding: int) -> np.ndarray:
    """Sums of squared standard scores of four tests, for each row of symbols.

    About chi-squared with 4 degrees or less where symbols are random; larger the less they are. The chi-squared tests count on
    their upper side only.
    """
    size, (many, n) = SIZES[encoding], symbols.shape
    at = symbols + size * np.arange(many)[:, None]
    each = np.bincount(at.ravel(), minlength=many * size).reshape(many, size).astype(np.float32)
    uniform = np.einsum("ij,ij->i", each, each) * size / n - n
    uniform = (uniform - (size - 1)) / np.sqrt(2 * (size - 1) * (n - 1) / n)

    kind = CLASSES[encoding][:size]
    some = np.unique(kind)
    shares = (kind[:, None] == some).astype(np.float32)
    alike = ((each @ shares) ** 2 / (n * shares.mean(axis=0))).sum(axis=1) - n
    alike = (alike - (len(some) - 1)) / np.sqrt(2 * (len(some) - 1))

    half = symbols >= size // 2
    changes = np.count_nonzero(half[:, 1:] != half[:, :-1], axis=1)
    runs = (changes - (n - 1) / 2) / np.sqrt((n - 1) / 4)
    value = ((np.arange(size) - (size - 1) / 2) / np.sqrt((size**2 - 1) / 12)).astype(np.float32)[symbols]
    serial = np.einsum("ij,ij->i", value[:, 1:], value[:, :-1]) / np.sqrt(n - 1)
    return np.maximum(uniform, 0) ** 2 + np.maximum(alike, 0) ** 2 + runs**2 + serial**2


def _cells(score: np.ndarray, length_class: np.ndarray | int, encoding: int) -> np.ndarray:
    """One number for encoding, class of length and step of the score."""
    step = np.where(score <= PLAUSIBLE, np.floor(score / STEP), BINS - 1).astype(np.int64)
    return (encoding * len(LENGTHS) + length_class) * BINS + np.minimum(step, BINS - 1)


def _natural(data: np.ndarray, offsets: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Counts by cell of the texts without their tokens, written in each alphabet and cut to the lengths in turn."""
    token = np.zeros(len(data) + 1, dtype=np.int8)
    token[starts] += 1
    token[ends] -= 1
    plain = np.cumsum(token[:-1]) == 0
    total = np.zeros((len(ENCODINGS), len(LENGTHS) * BINS), dtype=np.int64)
    for e, (_, case) in enumerate(ENCODINGS):
        if e == 1:  # digits and A to F, from the same letters as digits and a to f
            total[e] = total[0]
            continue
        value = VALUES[e][{"lower": LOWER, "upper": RAISED}[case][data] if case != "as is" else data]
        at = np.flatnonzero((value >= 0) & plain)
        value, firsts = value[at].astype(np.int64), np.searchsorted(at, offsets)
        size = np.diff(firsts)
        for k, length in enumerate(LENGTHS):
            some = np.where(size >= CYCLE[k + 1], (size - CYCLE[k + 1]) // CYCLE[-1] + 1, 0)
            turn = np.arange(some.sum()) - np.repeat(np.cumsum(some) - some, some)
            first = np.repeat(firsts[:-1], some) + turn * CYCLE[-1] + CYCLE[k]
            if len(first):
                score = scores(value[first[:, None] + np.arange(length)], e)
                total[e] += np.bincount(_cells(score, k, 0), minlength=total.shape[1])
    return total.ravel()


def _tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and past byte of the runs of token characters of the least length or more; none spans two texts."""
    inside = np.zeros(len(data) + 2, dtype=np.int8)
    inside[1:-1] = MEMBER[data] > 0
    edge = np.diff(inside)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    cuts = offsets[1:-1]
    cuts = np.unique(cuts[(cuts > 0) & (cuts < len(data))])
    cuts = cuts[(inside[cuts] > 0) & (inside[cuts + 1] > 0)]  # between two token characters
    starts, ends = np.union1d(starts, cuts), np.union1d(ends, cuts)
    long = ends - starts >= LENGTHS[0]
    return starts[long], ends[long]


def _graded(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The cell of each token."""
    cell = np.full(len(starts), -1, dtype=np.int64)
    if not len(starts):
        return cell
    counts = ends - starts
    at = np.repeat(starts - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
    fits = np.bitwise_and.reduceat(MEMBER[data[at]], np.cumsum(counts) - counts)
    least = np.where(fits > 0, np.log2(np.maximum(fits & -fits.astype(np.int16), 1)).astype(int), -1)
    kind = np.searchsorted(LENGTHS, counts, "right") - 1
    for e, length in sorted(set(zip(least.tolist(), counts.tolist(), strict=True))):
        mine = np.flatnonzero((least == e) & (counts == length))
        if e >= 0:
            symbols = VALUES[e][data[starts[mine][:, None] + np.arange(length)]].astype(np.int64)
            cell[mine] = _cells(scores(symbols, e), kind[mine], e)
    return cell


SCANNED = ("rid long, base array<struct<first: int, kind: int, past: int>>, tokens array<struct<first: int, past: int, cell: int>>, "
           "cell long, n long")


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per text with its base spans and graded tokens, then the counts of the task's natural text."""
    span = pa.list_(pa.struct([("first", pa.int32()), ("kind", pa.int32()), ("past", pa.int32())]))
    token = pa.list_(pa.struct([("first", pa.int32()), ("past", pa.int32()), ("cell", pa.int32())]))
    schema = pa.schema([("rid", pa.int64()), ("base", span), ("tokens", token), ("cell", pa.int64()), ("n", pa.int64())])
    total = np.zeros(len(ENCODINGS) * len(LENGTHS) * BINS, dtype=np.int64)
    for batch in batches:
        for part in pieces(batch):
            data, offsets = text_bytes(part.column("text"))
            data, offsets = data[offsets[0] : offsets[-1]], offsets - offsets[0]
            base: list[list] = [[] for _ in range(part.num_rows)]
            tokens: list[list] = [[] for _ in range(part.num_rows)]
            starts, ends = _tokens(data, offsets)
            total += _natural(data, offsets, starts, ends)
            if len(starts):
                # Places in code points: bytes that begin one, before each place and before its text.
                before = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
                docs = np.searchsorted(offsets, starts, "right") - 1
                shift = before[offsets[docs]]
                cells = _graded(data, starts, ends)
                for i, (doc, first, past) in enumerate(zip(docs, before[starts] - shift, before[ends] - shift, strict=True)):
                    tokens[doc].append({"first": first, "past": past, "cell": cells[i]})
                    held = data[starts[i] : ends[i]].tobytes()
                    for kind, form in ((1, ACCESS), (2, HEX)):
                        base[doc] += [{"first": first + m.start(), "kind": kind, "past": first + m.end()}
                                      for m in form.finditer(held) if len(m[0]) >= 16]
            for doc in _naming(data, offsets):
                text = data[offsets[doc] : offsets[doc + 1]].tobytes().decode()
                base[doc] += [{"first": m.start(), "kind": 0, "past": m.end()} for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
            none = pa.nulls(part.num_rows, pa.int64())
            yield pa.RecordBatch.from_arrays([part.column("rid"), pa.array(base, span), pa.array(tokens, token), none, none], schema=schema)
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.nulls(len(some), pa.int64()), pa.nulls(len(some), span), pa.nulls(len(some), token),
                                      pa.array(some), pa.array(total[some])], schema=schema)


def _naming(data: np.ndarray, offsets: np.ndarray) -> list[int]:
    """The texts that hold one of the names of secrets, in any case."""
    folded, found = LOWER[data].tobytes(), set()
    for name in NAMES:
        at = folded.find(name)
        while at >= 0:
            doc = int(np.searchsorted(offsets, at, "right")) - 1
            found.add(doc)
            at = folded.find(name, int(offsets[doc + 1]))
    return sorted(found)


def discoveries(tested: dict[int, int], natural: dict[int, int], rate: float) -> list[int]:
    """The cells whose tokens are discoveries: Benjamini and Hochberg's procedure in each alphabet and class of length.

    The p-value of a token is the share of natural text of its alphabet and length that looks as random or more, one added
    to both counts; so a short token, whose tests say little, needs a better score than a long one.
    """
    found = []
    for stratum in range(len(ENCODINGS) * len(LENGTHS)):
        cells = range(stratum * BINS, (stratum + 1) * BINS)
        tests, everything = sum(tested.get(c, 0) for c in cells), sum(natural.get(c, 0) for c in cells)
        below, seen, last = 0, 0, -1
        for cell in cells[:-1]:
            below, seen = below + natural.get(cell, 0), seen + tested.get(cell, 0)
            if seen and (below + 1) * tests <= rate * seen * (everything + 1):
                last = cell
        found += [c for c in cells if c <= last and tested.get(c)]
    return found


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rate: float = 0.01) -> DataFrame:
    """Every row with its spans of secrets.

    Base spans are the leftmost, non-overlapping matches of each form that are long enough: assignments to a name of a secret
    (8 characters of value), access keys (16), hexadecimal digits (32). They always stay. Added are tokens of 16 characters
    or more (letters, digits, ``+ / - _``) that pass the battery and are discoveries at the false-discovery ``rate``, unless they
    overlap a base span. Whole texts are read, and all texts count as natural text.
    Returns rid, base (array of first, kind, past, kind a place in KINDS) and spans (the same with those added), in order of place,
    then kind, in code points, past exclusive. Null texts are empty; repeated rows and null ids are rows like
    others; other columns are left aside; an empty table gives an empty frame.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("rid"), F.col(text_col).cast("string").alias("text"))
    found = saved(rows.mapInArrow(_scan, SCANNED), "secrets")
    natural = {r.cell: r.n for r in found.where("cell IS NOT NULL").groupBy("cell").agg(F.sum("n").alias("n")).collect()}
    texts = found.where("cell IS NULL")
    tested = texts.select(F.explode("tokens.cell").alias("cell")).groupBy("cell").count()
    cells = discoveries({r.cell: r["count"] for r in tested.collect()}, natural, rate)
    taken = F.array(*[F.lit(c) for c in sorted(cells)]).cast("array<int>")
    more = F.filter("tokens", lambda t: F.array_contains(taken, t.cell) & ~F.exists(
        "base", lambda b: (b.first < t.past) & (t.first < b.past)))
    spans = F.concat("base", F.transform(more, lambda t: F.struct(
        t.first.alias("first"), F.lit(KINDS.index("random")).alias("kind"), t.past.alias("past"))))
    return texts.select("rid", F.array_sort("base").alias("base"), F.array_sort(spans).alias("spans"))


def secret_text(spans: str) -> Column:
    """Spans as kind:first:past, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s.kind), s.first, s.past)), ",")
