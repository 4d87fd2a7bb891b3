"""Column names that are safe in every target table."""

from __future__ import annotations

import re
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNSAFE = "[^A-Za-z0-9]+"
# Used where nothing of a name survives.
NAMELESS = "col"


def sanitized(name: Column | str) -> Column:
    """Runs of anything but ASCII letters and digits become one ``_``; the ends are trimmed."""
    col = F.col(name) if isinstance(name, str) else name
    return F.btrim(F.regexp_replace(col, UNSAFE, "_"), F.lit("_"))


def sanitize_name(name: str) -> str:
    """``sanitized`` for a single name."""
    return re.sub(UNSAFE, "_", name).strip("_")


def safe_names(names: list[str]) -> list[str]:
    """Safe names for the columns of one table, in order and without duplicates.

    The first column keeps the plain name. A later one that collides, ignoring case, gets its ordinal
    after two underscores, which no sanitised name can hold, so the result cannot collide again.
    """
    taken: set[str] = set()
    safe = []
    for ordinal, name in enumerate(names, start=1):
        plain = sanitize_name(name) or NAMELESS
        safe.append(f"{plain}__{ordinal}" if plain.lower() in taken else plain)
        taken.add(plain.lower())
    return safe


def with_safe_names(catalogue: DataFrame, table_keys: list[str]) -> DataFrame:
    """``safe_names`` over a catalogue of many tables; adds ``safe_name``.

    The first ordinal of each name is an aggregate with a map-side part, not a window, so a name that
    recurs very often is never gathered in one task.
    """
    plain = F.coalesce(F.nullif(sanitized("column_name"), F.lit("")), F.lit(NAMELESS))
    named = catalogue.withColumn("_plain", plain).withColumn("_key", F.lower("_plain"))
    keys = [*table_keys, "_key"]
    first = named.groupBy(*[F.col(k).alias(f"_first_{k}") for k in keys]).agg(F.min("ordinal_position").alias("_first"))
    same = reduce(and_, (named[k].eqNullSafe(first[f"_first_{k}"]) for k in keys))
    return (
        named.join(first, same)
        .withColumn(
            "safe_name",
            F.when(F.col("ordinal_position") == F.col("_first"), F.col("_plain")).otherwise(
                F.concat("_plain", F.lit("__"), F.col("ordinal_position").cast("string"))
            ),
        )
        .drop("_plain", "_key", "_first", *[f"_first_{k}" for k in keys])
    )


def with_select_items(catalogue: DataFrame, table_keys: list[str]) -> DataFrame:
    """Adds ``select_item``, the T-SQL text ``[raw] as safe`` of each column."""
    raw = F.replace(F.col("column_name"), F.lit("]"), F.lit("]]"))
    return with_safe_names(catalogue, table_keys).withColumn(
        "select_item", F.concat(F.lit("["), raw, F.lit("] as "), F.col("safe_name"))
    )


def select_lists(catalogue: DataFrame, table_keys: list[str]) -> DataFrame:
    """One joined ``select_list`` per table, in ordinal order; a table has few columns."""
    items = F.array_sort(F.collect_list(F.struct("ordinal_position", "select_item")))
    return with_select_items(catalogue, table_keys).groupBy(*table_keys).agg(
        F.array_join(F.transform(items, lambda x: x.select_item), ",").alias("select_list")
    )


def select_list(names: list[str]) -> str:
    """The T-SQL select list of one table; empty where it has no columns."""
    pairs = zip(names, safe_names(names))
    return ",".join(f"[{raw.replace(']', ']]')}] as {safe}" for raw, safe in pairs)


def rename_safe(df: DataFrame) -> DataFrame:
    """Every column under its safe name."""
    return df.toDF(*safe_names(df.columns))
