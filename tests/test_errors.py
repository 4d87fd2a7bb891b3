from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from millrace.functions.errors import ERROR_PATTERNS, classify, classify_by_table, necessary_literals, occurs, scrubbed
from millrace.model import PATTERN_SCHEMA

MESSAGES = {
    "ORA-01017: invalid username/password": ("CRITICAL", "Invalid Credentials"),
    "Login failed, then timeout": ("CRITICAL", "Invalid Credentials"),
    "timeout, then Login failed": ("CRITICAL", "Invalid Credentials"),
    "ORA-12541: no listener": ("CRITICAL", "Connection refused"),
    "network error": ("CRITICAL", "Network Connectivity issue"),
    "Network Error": ("NON_CRITICAL", "Error occurred"),
    "insufficient privileges": ("CRITICAL", "Insufficient permissions"),
    "table not found": ("NON_CRITICAL", "Table or view does not exist"),
    "ORA-00904": ("NON_CRITICAL", "Invalid column"),
    "random error": ("NON_CRITICAL", "Error occurred"),
    "": ("NON_CRITICAL", "Error occurred"),
}


def frame(spark):
    rows = [(i, text) for i, text in enumerate([*MESSAGES, None])] * 3
    return spark.createDataFrame(rows, "id int, message string")


def check(found):
    rows = found.collect()
    assert len(rows) == 3 * (len(MESSAGES) + 1)
    for row in rows:
        assert (row.error_type, row.description) == MESSAGES.get(row.message, ("NON_CRITICAL", "Error occurred"))


def test_classify_first_pattern_wins(spark):
    check(classify(frame(spark), "message"))


@pytest.mark.parametrize("more", [0, 1000])
def test_pattern_table_of_any_size(spark, more):
    """Patterns that match nothing change neither the classes nor the plan."""
    others = [(-i, f"no such text {i}", None, None) for i in range(1, more + 1)]
    patterns = spark.createDataFrame(ERROR_PATTERNS[::-1] + others, PATTERN_SCHEMA)
    found = classify_by_table(frame(spark), "message", patterns)
    check(found)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_pattern_without_type_takes_the_default(spark):
    given = [(1, "timeout", None, "slow"), (2, "disk", "CRITICAL", None)]
    patterns = spark.createDataFrame(given, PATTERN_SCHEMA)
    texts = spark.createDataFrame([("timeout",), ("disk full",)], "message string")
    expected = {("NON_CRITICAL", "slow"), ("CRITICAL", "Error occurred")}
    for found in (classify_by_table(texts, "message", patterns), classify(texts, "message", given)):
        assert {(row.error_type, row.description) for row in found.collect()} == expected


@pytest.mark.parametrize("row", [(None, "x", "A", "B"), (1, None, "A", "B")])
def test_pattern_needs_priority_and_pattern(spark, row):
    with pytest.raises(ValueError, match="both a priority and a pattern"):
        classify_by_table(frame(spark), "message", spark.createDataFrame([row], PATTERN_SCHEMA))


@pytest.mark.parametrize("pattern", ["a|b c", "a.c", "x+|ORA-1", "^a", "a||b", "(?i)ora-1", "a/b", "", "a|b$"])
def test_plain_text_search_equals_the_regular_expression(spark, pattern):
    texts = ["a", "b c", "abc", "a.c", "xx", "ORA-1", "ora-1", "za", "a/b", "a|b c", "", "a||b", "ab\n", "b"]
    df = spark.createDataFrame([(t,) for t in texts] + [(None,)], "m string")
    found = df.select(occurs(F.col("m"), pattern).alias("ours"), F.col("m").rlike(pattern).alias("regex"))
    assert all(row.ours == row.regex for row in found.collect())


def test_empty_pattern_table(spark):
    found = classify_by_table(frame(spark), "message", spark.createDataFrame([], PATTERN_SCHEMA))
    assert {row.description for row in found.collect()} == {"Error occurred"}


def test_classes_need_no_shuffle(spark):
    plan = classify(frame(spark), "message")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_scrubbed(spark):
    df = spark.createDataFrame([("can't\nread 'x'",)], "m string")
    assert df.select(scrubbed("m").alias("m")).first().m == "cant read x"


PIECES = ["abc", "de", "ORA-01", "x", "[a-c]", "[^]x]", "(foo|bar)", "(?:ab|cd)e", "\\d+", "\\.", ".*", "z?", "q+", "w{2}", "|", "^", "$", " ", "é中"]


def test_necessary_literals_are_necessary():
    rnd = random.Random(1)
    for _ in range(3000):
        pattern = "".join(rnd.choice(PIECES) for _ in range(rnd.randrange(1, 7)))
        try:
            compiled = re.compile(pattern)
        except re.error:
            continue
        found = necessary_literals(pattern)
        for _ in range(15):
            text = "".join(rnd.choice(["abc", "de", "ORA-01", "x", "foo", "bar", "abe", "cde", "7", ".", "z", "qq", "ww", " ", "é中"])
                           for _ in range(rnd.randrange(1, 9)))
            if found is not None and compiled.search(text):
                assert any(all(literal in text for literal in alternative) for alternative in found), (pattern, text, found)


@pytest.mark.parametrize("pattern", ["", "abc|", "a.c", "(?i)abcd", r"\x41BCD", r"\p{Lu}bcd", r"\Qa.c\E", "[]abc]", r"(abc)\1", "abc\\"])
def test_patterns_that_cannot_be_looked_up(pattern):
    assert necessary_literals(pattern) is None


def test_looked_up_patterns_equal_trying_all(spark):
    rnd = random.Random(2)
    patterns = [(rnd.randrange(6), p, rnd.choice(["A", "B", None]), rnd.choice(["d", "e", None]))
                for p in ("abc|ORA-0", "ORA-01.*de", "de", "x+abc", "(foo|bar) abc", "[a-c]{3}x", "^ORA", "(?i)FOO BAR", "", "barbar", "é中é中")]
    texts = ["".join(rnd.choice(["abc", "de", "ORA-01", "x", "foo", "bar", " ", "é中"]) for _ in range(rnd.randrange(0, 7))) for _ in range(300)]
    texts += [None, "", "ab", "a" * 50_000] + texts[:50]
    table = spark.createDataFrame(patterns, "prio int, pattern string, error_type string, description string")
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, message string")
    got = {r.id: (r.error_type, r.description) for r in classify_by_table(df, "message", table).collect()}
    order = sorted(patterns, key=lambda p: tuple((v is not None, v) if v is not None else (False,) for v in p))
    for i, text in enumerate(texts):
        first = next((p for p in order if text is not None and re.search(p[1], text)), None)
        kind, told = first[2:] if first else (None, None)
        assert got[i] == (kind or "NON_CRITICAL", told or "Error occurred")
    none = classify_by_table(df, "message", table.where("false"))
    assert {r.error_type for r in none.collect()} == {"NON_CRITICAL"} and none.count() == len(texts)


def test_no_pattern_meets_every_message(spark):
    table = spark.createDataFrame([(1, "ORA-01", "A", "d")], "prio int, pattern string, error_type string, description string")
    df = spark.createDataFrame([("ORA-01 x",)], "message string")
    plan = classify_by_table(df, "message", table)._jdf.queryExecution().optimizedPlan().toString()
    assert "Cross" not in plan and "Join Inner, (_gram" in plan


@pytest.mark.parametrize("most", [None, 0])
def test_messages_are_never_broadcast(spark, tmp_path, monkeypatch, most):
    """Their files are small, as they compress well; their grams are not."""
    if most is not None:
        monkeypatch.setattr("millrace.functions.errors.BROADCAST_BYTES", most)
    spark.range(3000).selectExpr("id", "concat('ORA-', id % 50, ': order ', id) AS message").write.parquet(f"{tmp_path}/m")
    table = spark.range(50).selectExpr("CAST(id AS INT) AS prio", "concat('ORA-', id, ': order') AS pattern", "'A' AS error_type", "'d' AS description")
    table.write.parquet(f"{tmp_path}/p")
    found = classify_by_table(spark.read.parquet(f"{tmp_path}/m"), "message", spark.read.parquet(f"{tmp_path}/p"))
    plan = found._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    sent = re.findall(r"BroadcastExchange\nInput \[\d+\]: \[(.*?)\]", plan)
    assert len(sent) == (most is None) and not any("_message" in columns for columns in sent)
    assert found.where("error_type = 'A'").count() == 3000
