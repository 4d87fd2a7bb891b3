from __future__ import annotations

import random
from decimal import Decimal

import pytest

from millrace.functions import typemap
from millrace.functions.typemap import numeric_scale_profile, schema_ddl, schema_map
from millrace.model import CATALOGUE_SCHEMA, DECLARED_SCHEMA
from millrace.sources.extract import typed

PROFILE = "column_name string, fractional_rows bigint, scale int, max_abs double"

GOLDEN = [
    ("C1", "NUMBER", (1, 3, 9.5), "DECIMAL(38, 3)"),
    ("C2", "VARCHAR2", None, "STRING"),
    ("C3", "DATE", None, "TIMESTAMP"),
    ("C4", "TIMESTAMP", None, "TIMESTAMP"),
    ("C5", "BLOB", None, "BINARY"),
    ("C6", "TIMESTAMP(6) WITH TIME ZONE", None, "TIMESTAMP"),
    ("C7", "TIMESTAMP(6)", None, "TIMESTAMP"),
    ("C8", "UNKNOWN", None, "STRING"),
    ("C9", "NUMBER", (0, 0, 5.0), "LONG"),
    ("C10", "NUMBER", (0, 0, 1e19), "DECIMAL(38, 0)"),
    ("C11", "NUMBER", (4, 60, 1.0), "STRING"),
    ("C12", "NUMBER", None, "LONG"),
]


def mapped(spark):
    catalogue = [(name, kind, i) for i, (name, kind, _, _) in enumerate(GOLDEN, start=1)]
    profile = [(name, *numbers) for name, _, numbers, _ in GOLDEN if numbers]
    return schema_map(
        spark.createDataFrame(catalogue, CATALOGUE_SCHEMA), spark.createDataFrame(profile, PROFILE)
    )


def test_type_map(spark):
    found = {row.column_name: row for row in mapped(spark).collect()}
    for name, _, _, expected in GOLDEN:
        assert found[name].spark_type == expected
        assert found[name].is_fallback == (name == "C8")


def test_ddl_in_ordinal_order(spark):
    ddl = schema_ddl(mapped(spark))
    assert ddl == ", ".join(f"{name} {kind}" for name, _, _, kind in GOLDEN)
    odd = spark.createDataFrame([("a b", "STRING", 1)], "column_name string, spark_type string, ordinal_position int")
    assert schema_ddl(odd) == "`a b` STRING"


def fraction(value: float) -> int:
    return max(0, -Decimal(repr(value)).normalize().as_tuple().exponent)


def test_profile_against_brute_force(spark):
    rnd = random.Random(7)
    kinds = [lambda: float(rnd.randint(-10**6, 10**6)),
             lambda: round(rnd.uniform(-1e5, 1e5), rnd.randint(0, 8)),
             lambda: round(rnd.uniform(0, 1), 2),
             lambda: rnd.uniform(-1, 1) * 10.0 ** rnd.randint(-20, 12),
             lambda: float(f"{rnd.randint(1, 999)}e{rnd.randint(-15, 15)}"),
             lambda: rnd.randint(0, 10**12) / 4]
    for pick in kinds:
        values = [pick() for _ in range(400)]
        df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double")
        row = numeric_scale_profile(df).first()
        digits = [fraction(v) for v in values]
        assert (row.fractional_rows, row.scale) == (sum(d > 0 for d in digits), max(digits))
        assert row.max_abs == max(map(abs, values))


@pytest.mark.parametrize(
    ("kind", "values", "expected"),
    [
        ("int", [1, 2, None], (0, 0)),
        ("decimal(20,6)", [Decimal("1.500000"), Decimal("2.120000"), None], (2, 2)),
        ("decimal(38,0)", [Decimal(10**30)], (0, 0)),
        ("float", [0.1, 2.25], (2, 2)),
        ("double", [float("nan"), float("-inf"), 1.5], (1, 1)),
        ("double", [1e-12, 1.5e-7, 12.5], (3, 12)),
        ("double", [None], (0, 0)),
        ("double", [1e300, 1e22, -0.0], (0, 0)),
    ],
)
def test_profile_of_other_types(spark, kind, values, expected):
    row = numeric_scale_profile(spark.createDataFrame([(v,) for v in values], f"x {kind}")).first()
    assert (row.fractional_rows, row.scale) == expected


def test_profile_without_numbers_is_empty(spark):
    assert numeric_scale_profile(spark.createDataFrame([("a",)], "x string")).count() == 0


def test_typed_reads_named_columns(spark):
    df = spark.createDataFrame([(1.25, "x")], "Price double, name string")
    read = typed(df, "price DECIMAL(38, 2), other LONG")
    assert read.dtypes == [("Price", "decimal(38,2)"), ("name", "string")]
    assert read.first().Price == Decimal("1.25")


def test_digits_by_arithmetic_are_those_of_the_text(spark, monkeypatch):
    """Short fractions take the arithmetic; without it every double takes its text, with the same result."""
    rnd = random.Random(11)
    values = [round(rnd.uniform(-1, 1) * 10 ** rnd.randrange(12), rnd.randrange(8)) for _ in range(3000)]
    values += [rnd.uniform(-1, 1) * 10 ** rnd.randrange(-8, 12) for _ in range(1000)] + [0.1 + 0.2, 1e10 + 0.5, -0.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")

    def digits():
        return [r.d for r in df.select(typemap._fraction_digits(df.v, df.schema["v"].dataType).alias("d")).collect()]

    short = digits()
    monkeypatch.setattr(typemap, "SHORT_LIMIT", 0.0)
    assert short == digits()


@pytest.mark.parametrize(
    ("precision", "scale", "expected"),
    [(12, 0, "LONG"), (18, None, "LONG"), (19, 0, "DECIMAL(38, 0)"), (38, 0, "DECIMAL(38, 0)"), (10, 2, "DECIMAL(38, 2)"),
     (None, None, "DECIMAL(38, 3)"), (None, 0, "DECIMAL(38, 3)"), (5, -2, "LONG"), (18, -3, "DECIMAL(38, 0)")],
)
def test_declared_digits_come_before_the_profile(spark, precision, scale, expected):
    catalogue = spark.createDataFrame([("C", "NUMBER", 1, precision, scale)], DECLARED_SCHEMA)
    profile = spark.createDataFrame([("C", 1, 3, 9.5)], PROFILE)
    assert schema_map(catalogue, profile).first().spark_type == expected
