"""Personal data: generators propose spans, boosted trees weigh their format and context, thresholds select.

All work on texts is SQL functions; the trees, learned from a bounded table of counts, are applied as SQL too.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.llm.frames import identified, saved

KINDS = ["email", "ip", "card", "phone"]

# Base patterns. Possessive repeats and the look-behinds (or the end of the match before, \G) match the same spans
# as the plain patterns, in time that follows the text's length, and without recursion.
LOCAL, LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
BASE = {
    "email": rf"(?:(?<!{LOCAL})|\G){LOCAL}++@{LABEL}++(?:\.{LABEL}++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Further generators: forms that the base patterns miss, or swallow together with a neighbour.
MORE = {
    "email": rf"(?<!{LOCAL}){LOCAL}++ ?(?:\(at\)|\[at\]) ?{LABEL}++(?: ?(?:\.|\(dot\)|\[dot\]) ?{LABEL}++)++",
    "ip": r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9])",
    "card": r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?:[\x20-][0-9]{4}){3})(?![0-9])",
    "phone": r"\+[0-9]{1,3}[\x20.-]?\(?[0-9]{2,4}\)?[\x20.-]?[0-9]{3}[\x20.-]?[0-9]{4}(?![0-9])",
}
#: What a text must hold for a pattern to be tried on it.
GUARD = {
    "email": "(contains(text, '@') OR contains(text, '(at)') OR contains(text, '[at]'))",
    "ip": r"rlike(text, r'[0-9]\.[0-9]')",
    "card": "rlike(text, r'[0-9][ -]?[0-9]')",
    "phone": "contains(text, '+')",
}
FEATURES = {  # small whole numbers, so that the table of all their combinations is bounded
    "digits": "least(20, length(digits))",
    "luhn": """IF(length(digits) BETWEEN 13 AND 19, aggregate(sequence(1, length(digits)), 0, (s, i) -> s + IF(i % 2 = 1,
        CAST(substr(digits, -i, 1) AS INT), CAST(substr(digits, -i, 1) AS INT) * 2
        - IF(CAST(substr(digits, -i, 1) AS INT) > 4, 9, 0))) % 10, 10)""",
    "parts": "CASE WHEN kind <> 'ip' THEN 2 WHEN forall(split(match, '[.]'), p -> CAST(p AS DOUBLE) <= 255) THEN 1 ELSE 0 END",
    "marks": "least(7, length(regexp_replace(match, '[A-Za-z0-9]', '')))",
    "ahead": "CASE WHEN before = '' OR rlike(before, r'\\s$') THEN 0 WHEN rlike(before, '[0-9]$') THEN 1 "
             "WHEN rlike(before, '[A-Za-z]$') THEN 2 ELSE 3 END",
    "behind": "CASE WHEN after = '' OR rlike(after, r'^\\s') THEN 0 WHEN rlike(after, '^[0-9]') THEN 1 "
              "WHEN rlike(after, '^[A-Za-z]') THEN 2 ELSE 3 END",
    "cue": "CASE WHEN rlike(before, '(?i)(token|key|hash|sha|id|version|isbn|secret)[^a-z0-9]*$') THEN 0 "
           "WHEN rlike(before, '(?i)(mail|phone|tel|call|fax|card|visa|ip|host|contact)[^a-z0-9]*$') THEN 2 ELSE 1 END",
}


def _bound(value: Column, body) -> Column:
    """``body`` of a value that is worked out once."""
    return F.transform(F.array(value), body)[0]


def _running(values: Column, start: Column) -> Column:
    """The sums of an array up to each of its values, the array itself copied as often as it is long."""
    none = F.struct(start.cast("int").alias("at"), F.array().cast("array<int>").alias("out"))
    return F.aggregate(values, none, lambda s, x: F.struct(
        (s.at + x).alias("at"), F.concat(s.out, F.array(s.at + x)).alias("out")), lambda s: s.out)


def running_sums(values: Column) -> Column:
    """The sums of an array of whole numbers up to each of its values, in blocks of the root of its length.

    An array is built by copying, so sums within blocks, and over the sums of blocks, cost the length times its root at most.
    """
    width = F.ceil(F.sqrt(F.size(values))).cast("int")
    cut = F.transform(F.sequence(F.lit(0), (F.size(values) / width - 0.0001).cast("int")),
                      lambda b: F.slice(values, b * width + 1, width))

    def joined(blocks: Column) -> Column:
        totals = F.transform(blocks, lambda block: F.aggregate(block, F.lit(0), lambda s, x: s + x))
        return _bound(_running(totals, F.lit(0)), lambda ends: F.flatten(F.transform(
            blocks, lambda block, b: _running(block, F.when(b > 0, F.get(ends, b - 1)).otherwise(0)))))

    return F.when(F.size(values) > 0, _bound(cut, joined)).otherwise(F.array().cast("array<int>"))


def _spans(pattern: str, kind: str, form: str) -> Column:
    """Matches with their places in code points, from the lengths of the matches and of the texts between them."""
    text, pattern = F.col("text"), F.lit(pattern)

    def span(match: Column, past: Column, before: Column, after: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("kind"), F.lit(form).alias("form"), (past - F.length(match)).alias("first"), past.alias("past"),
            match.alias("match"), before.alias("before"), after.alias("after"))

    def placed(matches: Column, gaps: Column) -> Column:
        steps = F.transform(matches, lambda match, i: F.length(F.get(gaps, i)) + F.length(match))

        def one(match: Column, i: Column, ends: Column) -> Column:
            # Up to 20 characters before, of the match before and the text between; the character after.
            ahead = F.concat(F.coalesce(F.right(F.get(matches, i - 1), F.lit(20)), F.lit("")), F.get(gaps, i))
            behind = F.concat(F.left(F.get(gaps, i + 1), F.lit(1)), F.coalesce(F.left(F.get(matches, i + 1), F.lit(1)), F.lit("")))
            return span(match, F.get(ends, i), F.right(ahead, F.lit(20)), F.left(behind, F.lit(1)))

        return _bound(running_sums(steps), lambda ends: F.transform(matches, lambda match, i: one(match, i, ends)))

    found = _bound(F.regexp_extract_all(text, pattern, F.lit(0)),
                   lambda matches: _bound(F.split(text, pattern, -1), lambda gaps: placed(matches, gaps)))
    return F.when(F.expr(GUARD[kind]) & F.rlike(text, pattern), found).otherwise(F.array())


@dataclass
class Trees:
    """Boosted trees of two levels over whole-number features, as (feature, bound, left, right), leaves as numbers."""

    base: float
    trees: list

    def score(self, row: dict) -> float:
        return self.base + sum(_leaf(tree, row) for tree in self.trees)

    def sql(self) -> str:
        return " + ".join([repr(self.base), *(_tree_sql(t) for t in self.trees)])


def _leaf(tree, row: dict) -> float:
    while isinstance(tree, tuple):
        name, bound, left, right = tree
        tree = left if row[name] <= bound else right
    return tree


def _tree_sql(tree) -> str:
    if not isinstance(tree, tuple):
        return f"({tree!r}D)"
    name, bound, left, right = tree
    return f"IF({name} <= {bound}, {_tree_sql(left)}, {_tree_sql(right)})"


def boosted(cells: list[dict], rounds: int = 24, rate: float = 0.5, names: tuple[str, ...] = tuple(FEATURES)) -> Trees:
    """Gradient boosting of the logistic loss over cells of equal features with n rows, of them ``good`` positive."""
    good, n = sum(c["good"] for c in cells), sum(c["n"] for c in cells)
    model = Trees(math.log((good + 1) / (n - good + 1)), [])

    def grow(part: list[tuple[dict, float, float]], depth: int):
        grads, weights = sum(g for _, g, _ in part), sum(h for *_, h in part)
        leaf = rate * grads / (weights + 1)
        if depth == 0 or len(part) < 2:
            return round(leaf, 6)
        best, at = 1e-6, None
        for name in names:
            for bound in sorted({c[name] for c, *_ in part})[:-1]:
                g = sum(g for c, g, _ in part if c[name] <= bound)
                h = sum(h for c, _, h in part if c[name] <= bound)
                gain = g * g / (h + 1) + (grads - g) ** 2 / (weights - h + 1) - grads**2 / (weights + 1)
                if gain > best:
                    best, at = gain, (name, bound)
        if at is None:
            return round(leaf, 6)
        sides = ([p for p in part if p[0][at[0]] <= at[1]], [p for p in part if p[0][at[0]] > at[1]])
        return (*at, *(grow(side, depth - 1) for side in sides))

    for _ in range(rounds):
        part = []
        for c in cells:
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, model.score(c)))))
            part.append((c, c["good"] - c["n"] * p, c["n"] * p * (1 - p)))
        model.trees.append(grow(part, 2))
    return model


def _threshold(model: Trees, cells: list[dict], precision: float) -> float:
    """The least score above which cells not learned from hold this share of positives, smoothed; none without any."""
    best, good, n = math.inf, 0, 0
    for c in sorted(cells, key=model.score, reverse=True):
        good, n = good + c["good"], n + c["n"]
        if (good + 1) / (n + 1) >= precision and good:
            best = model.score(c)
    return best


def personal_data(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", precision: float = 0.95
) -> DataFrame:
    """Every row with its spans of personal data.

    Base spans are the leftmost, non-overlapping matches of a kind's pattern that pass its check (parts of an ip, digits
    of a card and its Luhn sum, digits of a phone). These always stay. The matches that pass or fail teach
    the trees, a model per kind, from counts over all documents by combination of features; a fifth of the documents,
    by id, is held out and sets a kind's threshold at ``precision``. Spans of the further generators that
    score above it and overlap no span of their kind before them are added.
    Returns rid, base (array of kind, first, past) and spans (the same with those added), in order of kind, then
    place, in code points, past exclusive. Null texts are empty; repeated rows are returned each, with null ids too; an
    empty table gives an empty frame.
    """
    rows = identified(docs, id_col, text_col).withColumn("text", F.coalesce("text", F.lit("")))
    found = F.concat(*[_spans(p, kind, form) for form, kinds in (("base", BASE), ("more", MORE)) for kind, p in kinds.items()])
    marker = F.expr("array(named_struct('kind', '', 'form', '', 'first', 0, 'past', 0, 'match', '', 'before', '', 'after', ''))")
    spans = rows.select("rid", "t1", "t2", F.explode(F.concat(marker, found)).alias("s")).select("rid", "t1", "t2", "s.*")
    spans = spans.withColumn("digits", F.regexp_replace("match", "[^0-9]", ""))
    values = {name: F.expr(f"CAST({sql} AS INT)") for name, sql in FEATURES.items()}
    spans = spans.select("rid", "t1", "t2", "kind", "form", "first", "past", *[v.alias(n) for n, v in values.items()])
    spans = saved(spans, "spans")
    passes = F.expr("""CASE kind WHEN 'email' THEN true WHEN 'ip' THEN parts = 1
        WHEN 'card' THEN luhn = 0 WHEN 'phone' THEN digits BETWEEN 9 AND 15 END""")
    spans = spans.withColumns({"passes": passes, "held": F.pmod(F.xxhash64("rid"), F.lit(5)) == 0})

    cells = spans.where("form = 'base'").groupBy("kind", "held", *FEATURES).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("passes").cast("int")).alias("good"))
    cells = [r.asDict() for r in cells.collect()]
    accepted = F.lit(False)
    for kind in KINDS:
        learn = [c for c in cells if c["kind"] == kind and not c["held"]]
        check = [c for c in cells if c["kind"] == kind and c["held"]] or learn
        if learn:
            model = boosted(learn)
            bound = _threshold(model, check, precision)
            if bound < math.inf:
                accepted = accepted | ((F.col("kind") == kind) & (F.expr(model.sql()) >= bound))
    kept = spans.withColumn("order", F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind")).cast("int"))
    kept = kept.where((F.col("form") == "") | ((F.col("form") == "base") & F.col("passes")) | ((F.col("form") == "more") & accepted))
    # An added span must overlap no base span of its kind: neither one that begins before it nor the next.
    own = W.partitionBy("rid", "t1", "t2", "kind").orderBy("first")
    is_base = F.col("form") == "base"
    ahead = F.max(F.when(is_base, F.col("past"))).over(own.rangeBetween(W.unboundedPreceding, W.currentRow))
    behind = F.min(F.when(is_base, F.col("first"))).over(own.rangeBetween(W.currentRow, W.unboundedFollowing))
    clear = F.coalesce(ahead <= F.col("first"), F.lit(True)) & F.coalesce(behind >= F.col("past"), F.lit(True))
    kept = kept.withColumn("clear", clear).where((F.col("form") != "more") | F.col("clear"))
    span = F.struct("order", "first", "past", "kind")
    per_row = kept.groupBy("rid", "t1", "t2").agg(
        F.count_if(F.col("form") == "").alias("copies"),
        F.array_sort(F.collect_set(F.when(F.col("form") == "base", span))).alias("base"),
        F.array_sort(F.collect_set(F.when(F.col("form") == "more", span))).alias("more"))
    per_row = per_row.select("rid", "base", F.array_sort(F.concat("base", "more")).alias("spans"), F.explode(F.expr("sequence(1, copies)")).alias("copy"))
    return per_row.drop("copy")


def span_text(spans: str) -> Column:
    """Spans as kind:first:past, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.first, s.past)), ",")
