from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pytest
from conftest import documents
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.llm import frames, mixing
from millrace.llm.frames import text_key
from millrace.llm.mixing import mix_sources, permuted, targets


def shared_out(sizes: dict, weights=(5, 2, 1), share=1.5, most=2.0) -> dict:
    """By rounds: shares by weight, those above their limit stop there, and the rest is shared again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, out = share * sum(sizes.values()), set(names), {}
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total > most * sizes[s]}
        if not over:
            return out | {s: left * weight[s] / total for s in open_}
        for s in over:
            out[s] = most * sizes[s]
            left -= out[s]
        open_ -= over
    return out


@settings(max_examples=4, deadline=None)
@given(st.dictionaries(st.one_of(st.none(), st.text("abé🙂", max_size=3)), st.integers(0, 1000), min_size=1, max_size=9))
def test_targets(spark, sizes):
    rows = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    found = {r.source: r.target for r in targets(rows, (5, 2, 1), 1.5, 2.0).collect()}
    assert found == pytest.approx(shared_out(sizes))


@pytest.mark.parametrize("size", [1, 2, 3, 4, 5, 16, 17, 1000, 4097])
def test_permutation(size):
    n = np.full(size, size)
    for source, epoch in ((0, 0), (3, 1)):
        same = np.full(size, source), np.full(size, epoch)
        out = permuted(np.arange(size), n, *same, seed=1)
        assert sorted(out) == list(range(size))
        assert (permuted(out, n, *same, seed=1, back=True) == np.arange(size)).all()
    if size > 100:
        assert np.abs(np.corrcoef(out, np.arange(size))[0, 1]) < 0.2


@pytest.mark.parametrize("block", [7, 256])
def test_mix(spark, awkward, monkeypatch, block):
    monkeypatch.setattr(mixing, "CHUNK", 50)
    rows = [(i, t, None if (i or 0) % 11 == 0 else f"s{(i or 0) % 4 if (i or 0) != 62 else 0}") for i, t in awkward]
    docs = documents(spark, rows)
    found, slots = mix_sources(docs, block_words=block)
    found = found.collect()
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").encode().split())
    goal = shared_out(sizes)
    assert sorted(r["size"] for r in found) == sorted(len((t or "").encode().split()) for _, t, _ in rows)
    for s in sizes:
        own = [r for r in found if r.source == s]
        assert {r.source_size for r in own} == {sizes[s]}
        assert own[0].target == pytest.approx(goal[s])
        assert abs(sum(r.taken for r in own) - goal[s]) <= 1
    assert all(0 <= r.taken <= 2 * r["size"] for r in found)
    again = mix_sources(documents(spark, rows, 5), block_words=block)[0].collect()
    key = lambda r: (r.rid or -1, r.t1, r["size"], r.before, r.taken)
    assert sorted(map(key, again)) == sorted(map(key, found))
    assert slots.agg({"words": "sum"}).first()[0] == sum(r.taken for r in found)


@pytest.mark.parametrize("block", [7, 256])
def test_slots_hold_the_words_of_their_blocks(spark, awkward, block):
    docs = documents(spark, [(i, t, f"s{(i or 0) % 3}") for i, t in awkward])
    rows, slots = mix_sources(docs, block_words=block)
    texts = {(r.t1, r.t2): r.text for r in docs.select("text", *text_key(docs.text)).collect()}
    rows = rows.collect()
    streams = {}
    for r in sorted(rows, key=lambda r: (r.number, r.before)):
        words = (texts[r.t1, r.t2] or "").encode().split()
        streams.setdefault(r.number, []).extend((w, r.row) for w in words)
    taken, slots = Counter(), slots.collect()
    for s in slots:
        expected = streams[s.number][s.block * block : s.block * block + s.words]
        assert s.text.encode().split() == [w for w, _ in expected] and len(expected) == s.words
        assert [p.row for p in s.pieces for _ in range(p.n)] == [row for _, row in expected]
        taken.update(row for _, row in expected)
    assert len({(s.number, s.epoch, s.slot) for s in slots}) == len(slots)
    assert {r.row: r.taken for r in rows if r.taken} == taken
    lean, bare = mix_sources(docs, block_words=block, pack=False)
    key = lambda r: (r.rid or -1, r.t1, r.before, r.taken)
    assert sorted(map(key, lean.collect())) == sorted(map(key, rows))
    assert bare.count() == len(slots) and "text" not in bare.columns


def test_no_text_is_dealt_as_it_stands(spark, awkward, monkeypatch):
    """Only cuts go to the texts, and only packed words to the shards, several bundles for each; nothing else changes."""
    docs = documents(spark, [(i, t, f"s{(i or 0) % 3}") for i, t in awkward])
    key = lambda s: (s.number, s.epoch, s.slot)
    value = lambda s: (*key(s), s.shard, s.block, s.words, s.text, [(p.row, p.n) for p in s.pieces])
    docs = frames.saved(docs, "given")
    monkeypatch.setattr(mixing, "SLOTS_PER_SHARD", 512)
    at_once = [value(s) for s in sorted(mix_sources(docs, block_words=7)[1].collect(), key=key)]
    plans, real = [], mixing.saved

    def noted(df, purpose, *args, **options):
        plan = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
        plans.append(plan) if purpose == "mixed" else None
        return real(df, purpose, *args, **options)

    monkeypatch.setattr(mixing, "saved", noted)
    monkeypatch.setattr(frames, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(mixing, "BROADCAST_ROWS", 0, raising=False)
    monkeypatch.setattr(mixing, "HELD", 1000, raising=False)
    monkeypatch.setattr(mixing, "BUNDLES", 1, raising=False)
    slots = mix_sources(docs, block_words=7)[1]
    dealt = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[(.*)\]", plans[0])
    assert len(dealt) == 2 and not any("text#" in columns for columns in dealt)
    assert [value(s) for s in sorted(slots.collect(), key=key)] == at_once
    files = [r[0] for r in slots.select("shard", F.input_file_name()).distinct().collect()]
    assert len(files) == len(set(files)) > 8
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"


def test_shards_hold_all_sources(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SLOTS_PER_SHARD", 100)
    rows = [(i, "a b c d " * 10, f"s{i % 3}") for i in range(600)]
    _, slots = mix_sources(documents(spark, rows), block_words=8)
    shares = slots.groupBy("shard").pivot("number", [0, 1, 2]).sum("words").toPandas().set_index("shard")
    whole = shares.sum() / shares.sum().sum()
    assert len(shares) in (45, 46)
    assert ((shares.div(shares.sum(axis=1), axis=0) - whole).abs() < 0.25).all().all()


def test_mix_of_nothing(spark):
    rows, slots = mix_sources(documents(spark, []))
    assert rows.count() == slots.count() == 0
    blank, slots = mix_sources(documents(spark, [(1, None), (2, " ")]))
    assert {(r["size"], r.taken, r.target) for r in blank.collect()} == {(0, 0, 0.0)} and slots.count() == 0
