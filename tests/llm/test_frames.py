from __future__ import annotations

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.llm.frames import ascii_lower, min_labels, running_total, saved, without


def smallest(edges):
    label = {}

    def root(x):
        label.setdefault(x, x)
        while label[x] != x:
            x = label[x]
        return x

    for a, b in edges:
        x, y = root(a), root(b)
        label[max(x, y)] = min(x, y)
    return {x: root(x) for x in label}


RANDOM = random.Random(8)
GRAPHS = {
    "none": [],
    "loops": [(1, 1), (2, 2)],
    "chain": [(i + 1, i) for i in range(300)],
    "shuffled chain": [(a * 7919 % 401, (a + 1) * 7919 % 401) for a in range(400)],
    "star": [(1000, i) for i in range(300)],
    "sparse": [(RANDOM.randrange(500), RANDOM.randrange(500)) for _ in range(300)],
    "twice": [(1, 2), (2, 1), (1, 2), (-5, 2)],
}


@pytest.mark.parametrize("name", list(GRAPHS))
def test_min_labels(spark, name):
    found = {r.node: r.label for r in min_labels(spark.createDataFrame(GRAPHS[name], "a long, b long")).collect()}
    expected = smallest(GRAPHS[name])
    assert all(found.get(x, x) == low for x, low in expected.items())
    assert set(found) <= set(expected)


def test_running_total(spark):
    rows = [(RANDOM.choice(["hot", "hot", "hot", "a", "b"]), i, RANDOM.randrange(9)) for i in range(2000)]
    df = spark.createDataFrame(rows, "g string, i int, v long").repartition(6)
    found = {(r.g, r.i): r.before for r in running_total(df, "g", ["i"], "v", "totals").collect()}
    seen = {}
    for g, i, v in rows:
        assert found[g, i] == seen.get(g, 0)
        seen[g] = seen.get(g, 0) + v
    assert running_total(df.limit(0), "g", ["i"], "v", "totals").count() == 0


def test_ascii_lower(spark):
    df = spark.createDataFrame([("ABCxyz",), ("ÉAβΣÄz",), ("",), (None,)], "t string")
    assert [r.x for r in df.select(ascii_lower(F.col("t")).alias("x")).collect()] == ["abcxyz", "Éaβ" + "ΣÄz", "", None]


def test_without(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, None), (1, ""), (None, "a")], "doc_id long, text string")
    rows = df.select(F.col("doc_id").alias("rid"), F.xxhash64(F.lit("ta")).alias("t1"), F.xxhash64(F.lit(17), F.lit("ta")).alias("t2"))
    left = without(df, rows.where("rid = 1")).collect()
    assert {(r.doc_id, r.text) for r in left} >= {(None, "a"), (1, None), (1, "")}
    assert len(left) == 3


def test_python_is_given_long_texts_in_small_batches(spark):
    def told(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"rows": [batch.num_rows], "bytes": [batch.nbytes]})

    texts = spark.range(0, 1500, 1, 1).selectExpr("repeat('word ', 4000) AS text")
    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    found = saved(texts.mapInArrow(told, "rows long, bytes long"), "batches").collect()
    assert sum(r["rows"] for r in found) == 1500
    assert max(r["bytes"] for r in found) < 5 << 20
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == before
