"""Error messages: scrubbing and classes."""

from __future__ import annotations

import re
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.model import PATTERN_SCHEMA

# Patterns in order of priority, with their type and description.
ERROR_PATTERNS = [
    (1, "ORA-01017|invalid username/password|Login failed", "CRITICAL", "Invalid Credentials"),
    (2, "ORA-12541|no listener|connection refused", "CRITICAL", "Connection refused"),
    (3, "timeout|connection reset|network error", "CRITICAL", "Network Connectivity issue"),
    (4, "ORA-01031|insufficient privileges", "CRITICAL", "Insufficient permissions"),
    (5, "ORA-00942|table or view does not exist|table not found", "NON_CRITICAL", "Table or view does not exist"),
    (6, "ORA-00904|invalid column", "NON_CRITICAL", "Invalid column"),
]
DEFAULT_CLASS = ("NON_CRITICAL", "Error occurred")

# Text without any character that a regular expression reads otherwise.
PLAIN_TEXT = re.compile("[A-Za-z0-9 _/,:-]+")


def scrubbed(message: Column | str) -> Column:
    """Single quotes removed, line ends turned into spaces."""
    col = F.col(message) if isinstance(message, str) else message
    return F.replace(F.replace(col, F.lit("'"), F.lit("")), F.lit("\n"), F.lit(" "))


def occurs(message: Column, pattern: str) -> Column:
    """Whether the pattern matches somewhere in the message.

    Alternatives of plain text are searched as text, which is much cheaper than a regular expression.
    """
    texts = pattern.split("|")
    if all(PLAIN_TEXT.fullmatch(text) for text in texts):
        return reduce(or_, (F.contains(message, F.lit(text)) for text in texts))
    return message.rlike(pattern)


def error_class(message: Column, patterns: list[tuple] = ERROR_PATTERNS) -> Column:
    """The class of the first pattern that occurs in the message, as (error_type, description).

    One CASE over the patterns, so neither a join nor a shuffle is needed.
    """
    def entry(error_type: str | None, description: str | None) -> Column:
        given = [DEFAULT_CLASS[0] if error_type is None else error_type,
                 DEFAULT_CLASS[1] if description is None else description]
        return F.struct(F.lit(given[0]).alias("error_type"), F.lit(given[1]).alias("description"))

    default = entry(*DEFAULT_CLASS)
    chain = F.when(message.isNull(), default)
    for _, pattern, error_type, description in sorted(patterns):
        chain = chain.when(occurs(message, pattern), entry(error_type, description))
    return chain.otherwise(default)


def classify(df: DataFrame, message: str, patterns: list[tuple] = ERROR_PATTERNS) -> DataFrame:
    """Adds ``error_type`` and ``description``."""
    return df.withColumn("_class", error_class(F.col(message), patterns)).select(
        *df.columns, "_class.error_type", "_class.description"
    )


#: Characters of the grams that patterns are filed under.
GRAM = 3
#: Filed patterns go to every task up to about so many bytes; beyond it they and the messages' grams are shuffled.
BROADCAST_BYTES = 32 << 20
# What ``necessary_literals`` does not read: escapes that take more than one letter, and a bracket right after another.
UNREAD = re.compile(r"\\[^dDwWsSbBhHvVRAZzGntrfae\W_]|\[\^?\]")
CLOSES = {"(": ")", "[": "]"}


def necessary_literals(pattern: str) -> list[list[str]] | None:
    """For each alternative of a regular expression the texts that every match of it holds; None where that cannot be told.

    Read with care: whatever is not plainly a character ends a text. Texts shorter than a gram are left out, and an
    alternative without any makes the whole pattern one that cannot be looked up.
    """
    if "(?" in pattern.replace("(?:", "") or UNREAD.search(pattern):
        return None  # flags, quotes, numbered characters and the like
    alternatives, runs, run, i = [], [], "", 0
    while i <= len(pattern):
        char = pattern[i : i + 1]
        literal = ""
        if char in CLOSES:
            i = _closing(pattern, i)
        elif char == "\\":
            i += 1
            following = pattern[i : i + 1]
            literal = "" if following.isalnum() else following
        elif char and char not in ".^$|*+?{":
            literal = char
        i += 1
        many = pattern[i : i + 1] if char not in ("", "|") else ""
        if literal and many not in ("*", "?", "{"):
            run += literal
        if not literal or many in ("*", "?", "{", "+"):
            runs, run = [*runs, run], ""
        if many and many in "*+?{":
            i = pattern.find("}", i) + 1 if many == "{" and "}" in pattern[i:] else i + 1
            i += pattern[i : i + 1] in ("?", "+") and many != ""
        if char in ("", "|"):
            alternatives.append([r for r in runs if len(r) >= GRAM])
            runs = []
    return alternatives if alternatives and all(alternatives) else None


def _closing(pattern: str, i: int) -> int:
    """The place of the bracket that closes the one at ``i``; the end where there is none."""
    opened = [pattern[i]]
    while opened and i + 1 < len(pattern):
        i += 1
        if pattern[i] == "\\":
            i += 1
        elif pattern[i] == CLOSES[opened[-1]]:
            opened.pop()
        elif pattern[i] == "[" or (pattern[i] == "(" and opened[-1] == "("):
            opened.append(pattern[i])
    return i


def _grams(text: Column) -> Column:
    """The distinct runs of GRAM characters of a text."""
    places = F.sequence(F.lit(1), F.length(text) - (GRAM - 1))
    grams = F.transform(places, lambda i: F.substring(text, i, F.lit(GRAM)))
    return F.when(F.length(text) >= GRAM, F.array_distinct(grams)).otherwise(F.array().cast("array<string>"))


def classify_by_table(df: DataFrame, message: str, patterns: DataFrame) -> DataFrame:
    """``classify`` with the patterns of a config table (prio, pattern, error_type, description).

    Patterns are looked up: each alternative of a pattern is filed under the rarest gram of the texts that it must hold, and a
    message meets only the patterns filed under its own grams, whose match is then verified. Patterns that need
    no text at all are tried on every message. Each distinct message takes its first match. Priority and pattern must be
    given; a pattern without type or description takes the default's.

    The sides of the joins are told, as Spark takes the grams of the messages for no larger than their files and would broadcast
    them: the filed patterns are broadcast up to BROADCAST_BYTES, the grams of messages never.
    """
    table = patterns.select(*PATTERN_SCHEMA.fieldNames())
    alternatives = F.regexp_count("pattern", F.lit(r"\|")).cast("long") + 1
    width = 64 + sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in table.columns[1:]), F.octet_length("pattern"))
    missing = F.col("prio").isNull() | F.col("pattern").isNull()
    told = table.agg(F.count_if(missing).alias("bad"), F.sum(alternatives * width).alias("bytes")).first()
    if told.bad:
        raise ValueError("an error pattern needs both a priority and a pattern")
    texts = df.select(F.col(message).alias("_message")).where("_message IS NOT NULL").distinct()
    literals = F.udf(necessary_literals, "array<array<string>>", useArrow=True)
    read = table.distinct().select(F.struct(*table.columns).alias("_pattern"), literals("pattern").alias("_literals"))

    found = texts.select("_message", F.explode(_grams(F.col("_message"))).alias("_gram"))
    filed = read.select("_pattern", F.posexplode("_literals").alias("_alternative", "_texts"))
    filed = filed.select("_pattern", "_alternative", F.explode("_texts").alias("_text"))
    filed = filed.select("_pattern", "_alternative", "_text", F.explode(_grams(F.col("_text"))).alias("_gram"))
    counts = found.groupBy("_gram").agg(F.count(F.lit(1)).alias("_n"))
    rarest = filed.join(counts.hint("merge"), "_gram").groupBy("_pattern", "_alternative").agg(
        F.min(F.struct("_n", "_gram", "_text")).alias("_rarest"))
    rarest = rarest.select("_pattern", "_rarest._gram", "_rarest._text")
    met = found.join(rarest.hint("broadcast" if (told.bytes or 0) <= BROADCAST_BYTES else "merge"), "_gram").where(F.contains("_message", "_text") & F.expr("_message RLIKE _pattern.pattern"))
    best = met.select("_message", "_pattern")

    rest = read.where("_literals IS NULL").agg(F.array_sort(F.collect_list("_pattern")).alias("patterns"))
    tried = texts.withColumn("_patterns", rest.scalar()).select(
        "_message", F.expr("get(filter(_patterns, p -> _message RLIKE p.pattern), 0)").alias("_pattern"))
    best = best.unionAll(tried.where("_pattern IS NOT NULL"))
    best = best.groupBy("_message").agg(F.min("_pattern").alias("_class"))
    return df.join(best, F.col(message) == F.col("_message"), "left").select(
        *[df[c] for c in df.columns],
        F.coalesce("_class.error_type", F.lit(DEFAULT_CLASS[0])).alias("error_type"),
        F.coalesce("_class.description", F.lit(DEFAULT_CLASS[1])).alias("description"),
    )
