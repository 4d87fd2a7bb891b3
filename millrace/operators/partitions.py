"""The partition column of a landing: snapshot stamp, existing column, expression or scalar query."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SNAPSHOT_COLUMN = "SNAPSHOT_DATE"


@dataclass(frozen=True)
class Partitioned:
    """A frame that holds its partition column; ``constant`` where all rows share one value."""

    df: DataFrame
    column: str | None
    constant: bool
    load_date: str | None = None


def inside_parentheses(text: str) -> str:
    """The text without one pair of parentheses that encloses all of it."""
    text = text.strip()
    if not (text.startswith("(") and text.endswith(")")):
        return text
    depth = 0
    for i, char in enumerate(text):
        depth += (char == "(") - (char == ")")
        if depth == 0 and i < len(text) - 1:
            return text
    return text[1:-1].strip()


def is_query(expression: str) -> bool:
    first = inside_parentheses(expression).split(None, 1)[:1]
    return first != [] and first[0].upper() in ("SELECT", "WITH")


def with_scalar(df: DataFrame, column: str, query: str) -> DataFrame:
    """A column with the first value of a query, null where it has no rows.

    It stays in the plan as a scalar subquery, which Spark runs once.
    """
    try:
        found = df.sparkSession.sql(query)
        first = found.toDF(*[f"c{i}" for i in range(len(found.columns))]).select("c0").limit(1)
        return df.withColumn(column, first.scalar())
    except (AnalysisException, ParseException) as error:
        raise ValueError(f"Invalid SELECT query in the partition expression: {query}") from error


def partitioned(df: DataFrame, spec: str | None, load_date: str) -> Partitioned:
    """Applies ``SNAPSHOT_DATE``, ``COL``, ``COL=expression`` or ``COL=(SELECT ...)``.

    The column is derived before the writer is made, so that it is written.
    """
    text = (spec or "").strip()
    if not text:
        return Partitioned(df, None, False)
    if text.upper() == SNAPSHOT_COLUMN:
        return Partitioned(df.withColumn(SNAPSHOT_COLUMN, F.lit(load_date)), SNAPSHOT_COLUMN, True, load_date)
    column, found, expression = (part.strip() for part in text.partition("="))
    if not found or not expression:
        return Partitioned(df, column, False)
    if is_query(expression):
        return Partitioned(with_scalar(df, column, inside_parentheses(expression)), column, True)
    return Partitioned(df.withColumn(column, F.expr(expression)), column, False)
