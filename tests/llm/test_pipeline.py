"""The stages of the pipeline on their own and as a whole."""

from __future__ import annotations

from collections import Counter

import pytest
from conftest import documents
from pyspark.sql import DataFrameWriter
from test_mixing import shared_out
from test_text_operators import components, split

import corpus_pipeline
from corpus_pipeline import STAGES
from millrace.llm.frames import BATCH_BYTES

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
STAGE = dict(STAGES)


def test_order():
    assert [name for name, _ in STAGES] == ["quality", "near_duplicates", "decontamination", "mixing", "sharding"]


@pytest.mark.parametrize("name", list(STAGE))
def test_awkward_rows_and_nothing(spark, sf_dir, awkward, name):
    docs = documents(spark, awkward)
    out = STAGE[name](spark, docs, sf_dir)
    names = [c for c in docs.columns if c not in ("shard", "slot")] + ["shard", "slot"] if name == "sharding" else docs.columns
    assert out.columns == names
    rows = [(r.doc_id, r.text) for r in out.collect()]
    assert set(rows) <= set(awkward)
    if name == "sharding":
        assert Counter(rows) == Counter(awkward)
    assert STAGE[name](spark, documents(spark, []), sf_dir).count() == 0


def test_one_document_of_each_group_stays(spark, sf_dir, awkward):
    rows = STAGE["near_duplicates"](spark, documents(spark, awkward), sf_dir).collect()
    first = components(awkward, 5, 4, 5)
    expected = Counter({(i, t) for i, t in awkward if i is not None and first[i] == i and split(t)})
    expected += Counter((i, t) for i, t in awkward if i is None or not split(t))
    assert Counter((r.doc_id, r.text) for r in rows) == expected


def test_mix_takes_documents_as_often_as_their_words(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = STAGE["mixing"](spark, docs, sf_dir).collect()
    given = {r.doc_id: r for r in docs.collect()}
    sizes, taken = Counter(), Counter()
    for r in given.values():
        sizes[r.source] += len(split(r.text))
    for r in out:
        assert given[r.doc_id].text == r.text
        taken[r.source] += len(split(r.text))
    assert max(Counter(r.doc_id for r in out).values()) <= 2
    goal = shared_out(sizes)
    assert sum(abs(taken[s] - goal[s]) for s in sizes) < 0.15 * sum(goal.values())


def test_mix_keeps_the_share_of_long_documents(spark, sf_dir):
    rows = [(i, f"a{i} " * 1950, f"s{i % 3 * 3}") for i in range(300)]
    rows += [(1000 + i, "b", f"s{s}") for i, s in enumerate((1, 4, 5, 7, 8))]
    rows += [(2000 + i, f"l{i} " * 2600, "s2") for i in range(80)] + [(3000 + i, f"k{i} " * 50, "s2") for i in range(400)]
    sizes, words, taken, long = Counter(), {i: len(t.split()) for i, t, _ in rows}, Counter(), 0
    for _, t, s in rows:
        sizes[s] += len(t.split())
    for r in STAGE["mixing"](spark, documents(spark, rows), sf_dir).select("doc_id", "source").collect():
        taken[r.source] += words[r.doc_id]
        long += words[r.doc_id] if 2000 <= r.doc_id < 3000 else 0
    goal = shared_out(sizes)
    ratio = goal["s2"] / sizes["s2"]
    assert ratio < 0.5
    assert long == pytest.approx(ratio * 80 * 2600, rel=0.3)
    assert [taken[s] for s in ("s0", "s2", "s3", "s6")] == pytest.approx([goal[s] for s in ("s0", "s2", "s3", "s6")], rel=0.3)


def test_run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*COLUMNS)
    for _, stage in STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert sorted((r.doc_id, r.text) for r in rows) == sorted((r.doc_id, r.text) for r in docs.collect())
    for shard in range(24):
        slots = sorted(r.slot for r in rows if r.shard == shard)
        assert slots == list(range(len(slots)))


def test_python_stays_small_beside_the_jvm(spark, sf_dir, monkeypatch):
    """Python runs only on bounded Arrow batches, and none is started to unpickle rows that the driver sends."""
    kind, seen = type(spark.range(1)), []

    def note(df):
        plan = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")
        limit = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch").removesuffix("b")
        seen.append((any(x in plan for x in ("InArrow", "InPandas", "EvalPython")), int(limit), "ExistingRDD" in plan))

    def noted(owner, name, frame):
        real = getattr(owner, name)
        monkeypatch.setattr(owner, name, lambda self, *a, **b: (note(frame(self)), real(self, *a, **b))[1])

    for name in ("collect", "toPandas", "count", "first", "isEmpty"):
        noted(kind, name, lambda df: df)
    noted(DataFrameWriter, "parquet", lambda writer: writer._df)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name in ("quality", "near_duplicates", "mixing", "sharding"):
        note(STAGE[name](spark, docs, sf_dir))
        assert not seen[-1][0], "the stage's own frame, which its caller runs, needs no Python"
    assert sum(python for python, _, _ in seen) > 5
    assert all(limit <= BATCH_BYTES for python, limit, _ in seen if python)
    assert not any(unpickled for _, _, unpickled in seen)
