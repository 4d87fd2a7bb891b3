"""Source column types as Spark types, and the profile of numbers that decides between them."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Source type -> Spark type. NUMBER depends on the data, anything else is STRING.
TYPE_MAP = {
    "VARCHAR2": "STRING",
    "DATE": "TIMESTAMP",
    "TIMESTAMP": "TIMESTAMP",
    "TIMESTAMP(6)": "TIMESTAMP",
    "TIMESTAMP(6) WITH TIME ZONE": "TIMESTAMP",
    "BLOB": "BINARY",
}
FALLBACK_TYPE = "STRING"
LONG_MAX = 2**63 - 1
LONG_DIGITS = 18
# Short fractions of doubles are found by arithmetic, which is exact up to 15 digits in all.
SHORT_DIGITS = 4
SHORT_LIMIT = 1e10

#: The columns of a profile of numbers.
PROFILE_COLUMNS = "column_name string, fractional_rows bigint, scale int, max_abs double"


def _text_digits(column: Column) -> Column:
    """Fraction digits of a double's shortest decimal text, which may have an exponent."""
    text = column.cast("string")
    mantissa = F.substring_index(text, "E", 1)
    fraction = F.rtrim(F.substring_index(mantissa, ".", -1), F.lit("0"))
    exponent = F.when(F.contains(text, F.lit("E")), F.substring_index(text, "E", -1).cast("int")).otherwise(0)
    return F.greatest(F.length(fraction) - exponent, F.lit(0))


def _fraction_digits(column: Column, dtype: T.DataType) -> Column:
    """Length of the fraction without trailing zeros, null where the value is null or no number."""
    if isinstance(dtype, T.IntegralType) or (isinstance(dtype, T.DecimalType) and dtype.scale == 0):
        return F.when(column.isNotNull(), F.lit(0))
    whole = F.when(column % 1 == 0, F.lit(0))
    if isinstance(dtype, T.DecimalType):
        digits = F.length(F.rtrim(F.substring_index(column.cast("string"), ".", -1), F.lit("0")))
        return whole.when(column.isNotNull(), digits)
    if isinstance(dtype, T.FloatType):
        # A float means its shortest decimal, not the nearest double.
        column = column.cast("string").cast("double")
    chain = whole.when(F.abs(column) >= float("inf"), F.lit(None).cast("int"))
    for n in range(1, SHORT_DIGITS + 1):
        power = F.lit(10.0**n)
        short = (F.abs(column) < SHORT_LIMIT) & (F.rint(column * power) / power == column)
        chain = chain.when(short, F.lit(n))
    return chain.otherwise(_text_digits(column))


def numeric_scale_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Per numeric column: rows with a fraction, the longest fraction, the largest magnitude.

    One aggregate over one scan for all columns together; one output row per column.
    """
    numeric = {f.name: f.dataType for f in df.schema.fields if isinstance(f.dataType, T.NumericType)}
    chosen = [c for c in (columns or numeric) if c in numeric]
    if not chosen:
        return df.sparkSession.createDataFrame([], PROFILE_COLUMNS)
    digits = df.select(
        *[_fraction_digits(F.col(f"`{c}`"), numeric[c]).alias(f"d{i}") for i, c in enumerate(chosen)],
        *[F.abs(F.col(f"`{c}`").cast("double")).alias(f"a{i}") for i, c in enumerate(chosen)],
    )
    totals = digits.agg(
        *[F.count_if(F.col(f"d{i}") > 0).alias(f"n{i}") for i in range(len(chosen))],
        *[F.coalesce(F.max(f"d{i}"), F.lit(0)).alias(f"s{i}") for i in range(len(chosen))],
        *[F.max(f"a{i}").alias(f"m{i}") for i in range(len(chosen))],
    )
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col(f"n{i}").alias("fractional_rows"),
            F.col(f"s{i}").alias("scale"),
            F.col(f"m{i}").alias("max_abs"),
        )
        for i, c in enumerate(chosen)
    ]
    return totals.select(F.inline(F.array(*rows)))


def merged_profiles(states: DataFrame, by: list[str] | None = None) -> DataFrame:
    """One profile from those of several sets of rows: a row per column, and per value of ``by``."""
    return states.groupBy(*(by or []), "column_name").agg(
        F.sum("fractional_rows").alias("fractional_rows"), F.max("scale").alias("scale"), F.max("max_abs").alias("max_abs")
    )


def declared_type(precision: Column, scale: Column) -> Column:
    """The Spark type text of a NUMBER with declared digits, null where they are not declared or do not fit."""
    whole = (F.coalesce(scale, F.lit(0)) <= 0) & (precision - F.coalesce(scale, F.lit(0)) <= 38)
    return (
        F.when(precision.isNull(), F.lit(None).cast("string"))
        .when(whole & (precision - F.coalesce(scale, F.lit(0)) <= LONG_DIGITS), F.lit("LONG"))
        .when(whole, F.lit("DECIMAL(38, 0)"))
        .when((scale > 0) & (scale <= 38), F.concat(F.lit("DECIMAL(38, "), scale.cast("int").cast("string"), F.lit(")")))
    )


def spark_type(data_type: Column, fractional_rows: Column, scale: Column, max_abs: Column,
               declared: Column | None = None) -> Column:
    """The Spark type text of a source column. A NUMBER takes its declared digits before those of the profile.

    A NUMBER with fractions takes the longest one as scale; beyond what a decimal holds it stays text.
    One without is LONG, or a wide decimal where a value does not fit.
    """
    number = (
        F.when((fractional_rows > 0) & (scale > 38), F.lit(FALLBACK_TYPE))
        .when(fractional_rows > 0, F.concat(F.lit("DECIMAL(38, "), scale.cast("string"), F.lit(")")))
        .when(max_abs >= float(LONG_MAX), F.lit("DECIMAL(38, 0)"))
        .otherwise(F.lit("LONG"))
    )
    chain = F.when(data_type == "NUMBER", number if declared is None else F.coalesce(declared, number))
    for source, target in TYPE_MAP.items():
        chain = chain.when(data_type == source, F.lit(target))
    return chain.otherwise(F.lit(FALLBACK_TYPE))


def schema_map(catalogue: DataFrame, profile: DataFrame) -> DataFrame:
    """The column catalogue with ``spark_type`` and whether the fallback was taken.

    The catalogue and the profile both have one row per column; the catalogue may have declared digits.
    """
    known = [*TYPE_MAP, "NUMBER"]
    declared = None
    if {"data_precision", "data_scale"} <= set(catalogue.columns):
        declared = declared_type(F.col("data_precision"), F.col("data_scale"))
    return catalogue.join(profile, "column_name", "left").select(
        "column_name",
        "data_type",
        "ordinal_position",
        spark_type(
            F.col("data_type"),
            F.coalesce("fractional_rows", F.lit(0)),
            F.coalesce("scale", F.lit(0)),
            F.coalesce("max_abs", F.lit(0.0)),
            declared,
        ).alias("spark_type"),
        (~F.col("data_type").isin(known)).alias("is_fallback"),
    )


def schema_ddl(mapped: DataFrame) -> str:
    """The columns of one table as DDL text, in ordinal order."""
    def quoted(name: str) -> str:
        return name if re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", name) else f"`{name.replace('`', '``')}`"

    rows = mapped.orderBy("ordinal_position").select("column_name", "spark_type").collect()
    return ", ".join(f"{quoted(row.column_name)} {row.spark_type}" for row in rows)
