"""Equi-depth splits of a scan: a histogram of an expression inside the source, and the conditions of parts of even size.

The histogram begins with even widths. Buckets that hold too much are cut again within their own smallest and largest value, so a
skewed key is narrowed down by a factor each time; a value that alone holds too much is dealt by the place of its rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, replace
from datetime import date, datetime, time, timedelta
from decimal import Decimal

from pyspark.sql import Row

# Names of the columns that a split scan adds and drops again: the expression, and the place of a row.
SPLIT_COLUMN = "MILLRACE_SPLIT"
ROW_COLUMN = "MILLRACE_ROW"
#: Cuts of a query, buckets of a part, rounds of refining, and the numbers that rows of one value are dealt to.
CUTS, FINENESS, ROUNDS, DEALT = 255, 6, 10, 5040

Value = int | float | Decimal | datetime


@dataclass(frozen=True)
class Bucket:
    """Rows from a bound (none: from the smallest) up to the next bucket's, with the smallest and largest value among them."""

    bound: Value | None
    rows: int
    lo: Value | None
    hi: Value | None


def _plain(value) -> Value:
    """A value as it comes from a source: whole decimals as int, dates as the start of the day."""
    if isinstance(value, Decimal) and value == value.to_integral_value():
        return int(value)
    if isinstance(value, date) and not isinstance(value, datetime):
        return datetime.combine(value, time())
    return value


def cuts_between(lo: Value, hi: Value, count: int) -> list[Value]:
    """At most ``count`` bounds above ``lo`` and up to ``hi``, evenly apart: whole numbers, seconds, or fractions."""
    if count < 1 or not lo < hi:
        return []
    if isinstance(lo, datetime):
        seconds = math.ceil((hi - lo).total_seconds())
        start = lo.replace(microsecond=0)
        found = [start + timedelta(seconds=s) for s in cuts_between(0, seconds, count)]
    elif isinstance(lo, int) and isinstance(hi, int):
        steps = min(count, hi - lo)
        found = [lo + (hi - lo) * i // steps for i in range(1, steps + 1)]
    elif isinstance(lo, float) or isinstance(hi, float):
        lo, hi = float(lo), float(hi)
        found = [lo * (1 - i / count) + hi * (i / count) for i in range(1, count + 1)]
    else:
        lo, hi = Decimal(lo), Decimal(hi)
        found = [lo + (hi - lo) * i / count for i in range(1, count + 1)]
    return sorted({c for c in found if lo < c <= hi})


class Histogram:
    """Counts of an expression over a relation of the source, by queries that ``run`` gives to it."""

    def __init__(self, run: Callable[[str], list[Row]], literal: Callable[[Value], str], relation: str, expression: str):
        self.run, self.literal = run, literal
        self.inner = f"(SELECT {expression} AS K FROM {relation}) h"

    def ends(self) -> tuple[int, int, Value | None, Value | None]:
        """Rows, rows without a value, smallest and largest value."""
        row = self.run(f"SELECT COUNT(*) AS N, COUNT(K) AS M, MIN(K) AS LO, MAX(K) AS HI FROM {self.inner}")[0]
        return int(row.N), int(row.N) - int(row.M), _plain(row.LO), _plain(row.HI)

    def _number(self, bounds: list[Value], first: int = 0) -> str:
        """The number of a row's bucket among the bounds, by halving, so a row costs few comparisons."""
        if not bounds:
            return str(first)
        mid = len(bounds) // 2
        below, above = self._number(bounds[:mid], first), self._number(bounds[mid + 1 :], first + mid + 1)
        return f"CASE WHEN K < {self.literal(bounds[mid])} THEN {below} ELSE {above} END"

    def between(self, lo: Value | None, hi: Value | None) -> str:
        parts = [f"K >= {self.literal(lo)}"] if lo is not None else []
        parts += [f"K < {self.literal(hi)}"] if hi is not None else []
        return " AND ".join(["K IS NOT NULL", *parts])

    def counted(self, bounds: list[Value], within: list[str]) -> list[Bucket]:
        """The buckets that the bounds make of the rows within the given ranges; empty ones are left out."""
        numbered = f"(SELECT K, {self._number(bounds)} AS B FROM {self.inner} WHERE {' OR '.join(f'({w})' for w in within)}) g"
        rows = self.run(f"SELECT B, COUNT(*) AS N, MIN(K) AS LO, MAX(K) AS HI FROM {numbered} GROUP BY B")
        starts = [None, *bounds]
        return [Bucket(starts[int(r.B)], int(r.N), _plain(r.LO), _plain(r.HI)) for r in sorted(rows, key=lambda r: int(r.B))]

    def buckets(self, lo: Value, hi: Value, most: float) -> list[Bucket]:
        """Buckets in order, none of more than ``most`` rows but those that cannot be cut."""
        found = self.counted(cuts_between(lo, hi, CUTS), [self.between(None, None)])
        for _ in range(ROUNDS):
            heavy = [i for i, b in enumerate(found) if b.rows > most and cuts_between(b.lo, b.hi, 1)]
            if not heavy:
                break
            total = sum(found[i].rows for i in heavy)
            bounds, within = [], []
            for i in heavy:
                bucket, after = found[i], found[i + 1].bound if i + 1 < len(found) else None
                share = max(2, round(CUTS * bucket.rows / total))
                bounds += [c for c in [bucket.bound] if c is not None] + cuts_between(bucket.lo, bucket.hi, share)
                within.append(self.between(bucket.bound, after))
            fresh = self.counted(sorted(set(bounds)), within)
            found = sorted([b for i, b in enumerate(found) if i not in heavy] + fresh,
                           key=lambda b: (b.bound is not None, b.bound if b.bound is not None else 0))
        return found


@dataclass(frozen=True)
class Parts:
    """A split of a scan: conditions on SPLIT_COLUMN, and on ROW_COLUMN where ``dealt`` says so."""

    expression: str
    predicates: tuple[str, ...]
    dealt: bool


def even_parts(histogram: Histogram, expression: str, parts: int, by_row: bool) -> Parts | None:
    """About even parts, at most ``parts`` of them unless single values must be dealt; None where there is nothing to split.

    Every row is in one part: the first takes whatever is smaller, the last whatever is larger, and rows without a value
    have their own or go with the first. ``by_row`` says that rows of one value can be dealt by their place.
    """
    total, nulls, lo, hi = histogram.ends()
    if total == 0 or parts < 2 or isinstance(lo, str):
        return None
    parts = min(parts, total)
    found = [] if lo is None else histogram.buckets(lo, hi, total / parts / FINENESS)
    size = total / parts
    groups = _grouped(found, nulls, size)
    while sum(len(_dealt(rows, size, by_row)) for _, rows in groups) > parts and size < total:
        size *= 1.05
        groups = _grouped(found, nulls, size)
    literal, out, any_dealt = histogram.literal, [], False
    bounds = [bound for bound, _ in groups]
    for i, (bound, rows) in enumerate(groups):
        if bound is _NULLS:
            condition = f"{SPLIT_COLUMN} IS NULL"
        else:
            after = next((b for b in bounds[i + 1 :] if b is not _NULLS), None)
            sides = [f"{SPLIT_COLUMN} >= {literal(bound)}"] if bound is not None else []
            sides += [f"{SPLIT_COLUMN} < {literal(after)}"] if after is not None else []
            condition = " AND ".join(sides) or f"{SPLIT_COLUMN} IS NOT NULL"
            if bound is None and _NULLS not in bounds:
                condition = f"({condition}) OR {SPLIT_COLUMN} IS NULL"
        ranges = _dealt(rows, size, by_row)
        any_dealt |= len(ranges) > 1
        out += [condition if len(ranges) == 1 else f"({condition}) AND {ROW_COLUMN} >= {a} AND {ROW_COLUMN} < {b}" for a, b in ranges]
    return Parts(expression, tuple(out), any_dealt) if len(out) > 1 else None


_NULLS = object()


def _grouped(found: list[Bucket], nulls: int, size: float) -> list[tuple[object, int]]:
    """(bound, rows) of runs of buckets of about ``size`` rows; a large bucket stays alone; rows without value come first."""
    groups: list[tuple[object, int]] = [(_NULLS, nulls)] if nulls > size / FINENESS else []
    spare = 0 if groups else nulls
    run: Bucket | None = None
    for bucket in found:
        if run is None:
            run = replace(bucket, bound=None, rows=bucket.rows + spare)
        elif run.rows + bucket.rows > size * 1.1:
            groups.append((run.bound, run.rows))
            run = bucket
        else:
            run = replace(run, rows=run.rows + bucket.rows)
    return groups + ([(run.bound, run.rows)] if run else [])


def _dealt(rows: int, size: float, by_row: bool) -> list[tuple[int, int]]:
    """Ranges of ROW_COLUMN that deal the rows of one group evenly."""
    ways = max(1, math.ceil(rows / (size * 1.2))) if by_row else 1
    return [(DEALT * i // ways, DEALT * (i + 1) // ways) for i in range(ways)]
