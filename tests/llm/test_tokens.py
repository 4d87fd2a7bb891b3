from __future__ import annotations

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import tokens
from millrace.llm.tokens import doc_words, groups, pieces, runs_of, shingle_sets


def words(text):
    return (text or "").encode().split()


TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet=" \t\n\x0b\x0c\r\x1cabAB1éΣ🙂 ", max_size=30)), max_size=12)


@settings(max_examples=150, deadline=None)
@given(TEXTS, st.booleans(), st.integers(0, 3))
def test_words_are_those_of_python(texts, lower, skip):
    column = pa.array(texts, pa.string()).slice(min(skip, len(texts)))
    given = texts[min(skip, len(texts)):]
    hashes, firsts = doc_words(column, lower)
    expected = [w.lower() if lower else w for t in given for w in words(t)]
    assert np.diff(firsts).tolist() == [len(words(t)) for t in given]
    assert len(hashes) == len(expected)
    assert len(set(hashes.tolist())) == len(set(expected))
    assert len(set(zip(hashes.tolist(), expected, strict=True))) == len(set(expected))


def test_hashes_do_not_hang_on_blocks(monkeypatch):
    text = " ".join(["word", "x" * 5000, "y", "word", "z" * 700, "word"] * 50)
    one, _ = doc_words(pa.array([text]))
    monkeypatch.setattr(tokens, "BLOCK", 64)
    assert (doc_words(pa.array(["", text]))[0] == one).all()


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="ab ", max_size=14), max_size=8), st.integers(1, 4))
def test_shingle_sets(texts, k):
    docs, hashes = shingle_sets(pa.array(texts, pa.string()), k)
    for i, text in enumerate(texts):
        w = words(text)
        expected = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} or ({tuple(w)} if w else set())
        assert (docs == i).sum() == len(expected)
    assert len(set(zip(docs.tolist(), hashes.tolist(), strict=True))) == len(docs)


def test_runs_stay_inside_a_text():
    hashes, firsts = doc_words(pa.array(["a b", "c", "a b c", "b c"]))
    runs, at = runs_of(hashes, firsts, 2)
    assert at.tolist() == [0, 3, 4, 6]
    assert runs[0] == runs[1] and runs[2] == runs[3] and runs[0] != runs[2]


def test_pieces_and_groups_keep_all_rows():
    batch = pa.RecordBatch.from_pydict({"text": ["x" * n for n in (5, 0, 900, 3, 3, 3)], "k": [1, 1, 2, 2, 2, 3]})
    assert [p.num_rows for p in pieces(batch, 10)] == [2, 1, 3]
    parts = [batch.slice(0, 1), batch.slice(1, 3), batch.slice(4, 0), batch.slice(4, 2)]
    assert [g.column("k").to_pylist() for g in groups(parts, ("k",))] == [[1, 1], [2, 2, 2], [3]]
