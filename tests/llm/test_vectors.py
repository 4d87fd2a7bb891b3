from __future__ import annotations

import numpy as np
import pytest

from millrace.llm import vectors
from millrace.llm.vectors import near_vectors

SCHEMA = "vec_id long, embedding array<float>, label int, key string, unit int, near int, vid string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "k", 1, 1, "v") for i, v in rows], SCHEMA).repartition(3)


def brute(rows, least=0.95):
    sound = {}
    for at, (i, v) in enumerate(rows):
        if i is None or not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        x = np.array(v, dtype=np.float32).astype(np.float64)
        sound[at] = x / np.linalg.norm(x)
    links = {at: [o for o in sound if o != at and len(sound[o]) == len(sound[at]) and sound[o] @ sound[at] >= least] for at in sound}
    label = {at: rows[at][0] for at in range(len(rows))}
    changed = True
    while changed:
        changed = False
        for at, others in links.items():
            low = min([label[at], *(label[o] for o in others)])
            changed |= low != label[at]
            label[at] = low
    return sorted((rows[at][0] or -1, len(links.get(at, ())), label[at] or -1) for at in range(len(rows)))


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(2)
    out = [(i, rng.normal(size=64).tolist()) for i in range(300)]
    for c in range(40):  # groups about a centre, at all distances near the bound
        centre = rng.normal(size=64)
        out += [(1000 + 10 * c + j, (centre + rng.normal(size=64) * 0.02 * j).tolist()) for j in range(8)]
    same = rng.normal(size=64)
    out += [(2000 + j, (same * (1 + j)).tolist()) for j in range(3)] + [(2010 + j, same.tolist()) for j in range(30)]
    out += [(3000, None), (3001, []), (3002, [0.0] * 64), (3003, [float("nan")] + [1.0] * 63), (None, same.tolist()),
            (3004, [float("inf")] + [1.0] * 63), (3005, [None] + [1.0] * 63), (3006, [1.0, 0.0]), (3007, [2.0, 0.0]),
            (3008, [1e38] * 64), (3009, [1e-38] * 64)]
    return out


@pytest.mark.parametrize("block", [1024, 5])
def test_near_vectors(spark, rows, monkeypatch, block):
    monkeypatch.setattr(vectors, "BLOCK", block)
    found = near_vectors(frame(spark, rows), pivots=64).collect()
    expected = brute(rows)
    got = sorted((r.vid or -1, r.n_links, r.component_id or -1) for r in found)
    assert [g[0] for g in got] == [e[0] for e in expected]
    linked = sum(e[1] for e in expected)
    assert sum(g[1] for g in got) >= 0.97 * linked
    assert all(g[1] <= e[1] and g[2] >= e[2] for g, e in zip(got, expected, strict=True))
    assert sum(g[2] == e[2] for g, e in zip(got, expected, strict=True)) >= 0.99 * len(got)


def test_recall_of_the_given_vectors(spark):
    given = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    expected = brute([(r.vec_id, r.embedding) for r in given.collect()])
    found = near_vectors(given).collect()
    assert sum(r.n_links for r in found) >= 0.99 * sum(e[1] for e in expected)


def test_nothing_and_no_links(spark):
    assert near_vectors(frame(spark, [])).count() == 0
    lone = near_vectors(frame(spark, [(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, None)])).collect()
    assert {(r.vid, r.n_links, r.component_id) for r in lone} == {(1, 0, 1), (2, 0, 2), (3, 0, 3)}
