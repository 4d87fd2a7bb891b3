"""Secret scans: base spans against plain regular expressions, the battery on random and natural tokens."""

from __future__ import annotations

import base64
import hashlib
import random
import re

import numpy as np
import pytest

from conftest import documents
from millrace.llm.queries import QUERIES
from millrace.llm.secrets import BINS, ENCODINGS, KINDS, LENGTHS, PLAUSIBLE, VALUES, discoveries, scan_secrets, scores, secret_text

ASSIGN = r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|""" \
    r"""[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""


def base_spans(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in re.finditer(ASSIGN, text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(found)


def text_of(spans):
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def prose(rnd, words=60):
    parts = ["the", "quick", "brown", "Über", "naïve", "state-of-the-art", "internationalization", "中文", "transportation", "user_name",
             "https", "and", "Morning", "of", "were", "mountain", "in 1987", "Paris", "children", "looked", "behind", "every", "responsibilities", "key", "token", "electroencephalographically"]
    return " ".join(rnd.choice(parts) for _ in range(words))


def test_base_spans_equal_plain_matches(spark, awkward):
    rnd = random.Random(1)
    bits = ["token=", "TOKEN : ", 'api_key="', "ApiKey'= ", "passwd:", "ſecret=", "toKen=", "password ==", "secret:: ", "AKIA", "AKIAAKIA",
            "abcdef0123456789", "0" * 31, "f" * 32, "A" * 12, "x.y-z_=", "é", "中", "🙂", " ", "\n", '"', "12345678", "1234567", "g", "AKI"]
    rows = [r[:2] for r in awkward] + [(1000 + i, "".join(rnd.choice(bits) for _ in range(rnd.randrange(1, 25)))) for i in range(600)]
    rows += [(2000, "token " * 30_000), (2001, "token" + " " * 100_000), (2002, "a" * 100_000), (2003, "AKIA" * 20_000)]
    found = scan_secrets(documents(spark, rows)).select("rid", secret_text("base").alias("b"), secret_text("spans").alias("s")).collect()
    assert sorted((str(r.rid), r.b) for r in found) == sorted((str(i), text_of(base_spans(t))) for i, t in rows)
    for r in found:
        assert set(filter(None, r.b.split(","))) <= set(r.s.split(","))


def test_random_tokens_are_found_and_words_are_not(spark):
    rnd = random.Random(2)
    forms = {
        "base64": lambda: base64.b64encode(rnd.randbytes(36)).decode(),
        "url": lambda: base64.urlsafe_b64encode(rnd.randbytes(30)).decode(),
        "base32": lambda: base64.b32encode(rnd.randbytes(50)).decode(),
        "short hex": lambda: rnd.randbytes(12).hex(),
        "letters and digits": lambda: "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(48)),
    }
    rows, planted = [], {}
    for i in range(400):
        text = prose(rnd) + " "
        if i % 8 == 0:
            form = list(forms)[i // 8 % len(forms)]
            token = forms[form]().rstrip("=")
            planted[i] = (form, f"random:{len(text)}:{len(text) + len(token)}")
            text += token + " "
        rows.append((i, text + prose(rnd)))
    rows += [(1000, "zb12" * 12), (1001, "0123456789abcdefABCDEFGHIJKLMNOP"), (1002, "z" * 64), (1003, "20240101202401022024")]
    found = {r.rid: r.s.split(",") if r.s else [] for r in scan_secrets(documents(spark, rows)).select("rid", secret_text("spans").alias("s")).collect()}
    caught = {form: [found[i] == [span] for i, (f, span) in planted.items() if f == form] for form in forms}
    assert all(sum(hits) >= 0.9 * len(hits) for hits in caught.values()), caught
    assert not [i for i, spans in found.items() if spans and i not in planted]


@pytest.mark.parametrize("encoding", range(len(ENCODINGS)))
def test_scores_follow_their_law_on_random_symbols(encoding):
    rng, size = np.random.default_rng(encoding), len(ENCODINGS[encoding][0][0])
    for length in LENGTHS:
        many = scores(rng.integers(0, size, (4000, length)), encoding)
        assert many.mean() < 4.2 and (many > PLAUSIBLE).mean() < 0.03
    assert scores(np.tile(np.arange(4), 12)[None, :], encoding)[0] > PLAUSIBLE


def test_scores_equal_plain_sums():
    text = "q9Zx0LmB7+vvPd3tKw1r"
    symbols = VALUES[4][np.frombuffer(text.encode(), np.uint8)].astype(int)
    n, counts = len(text), np.bincount(symbols, minlength=64)
    uniform = sum((c - n / 64) ** 2 / (n / 64) for c in counts)
    kinds = [sum(f(c) for c in text) for f in (str.isupper, str.islower, str.isdigit, lambda c: c in "+/")]
    alike = sum((k - n * p / 64) ** 2 / (n * p / 64) for k, p in zip(kinds, (26, 26, 10, 2), strict=True))
    changes = sum((a >= 32) != (b >= 32) for a, b in zip(symbols, symbols[1:]))
    value = (symbols - 31.5) / np.sqrt((64**2 - 1) / 12)
    parts = [max(0, (uniform - 63) / np.sqrt(2 * 63 * (n - 1) / n)), max(0, (alike - 3) / np.sqrt(6)),
             (changes - (n - 1) / 2) / np.sqrt((n - 1) / 4), (value[1:] @ value[:-1]) / np.sqrt(n - 1)]
    assert scores(symbols[None, :], 4)[0] == pytest.approx(sum(p * p for p in parts), rel=1e-5)


def test_short_tokens_need_better_scores():
    """With the same natural text and scores, a class that natural text often reaches has no discoveries."""
    short, long = 0 * BINS, 5 * BINS
    natural = {short + 10: 50, short + BINS - 1: 950, long + BINS - 1: 1000}
    tested = {short + 10: 5, long + 10: 5, short + BINS - 1: 10, long + BINS - 1: 10}
    assert discoveries(tested, natural, 0.01) == [long + 10]
    assert discoveries({}, natural, 0.01) == []


def test_query_covers_every_document(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    found = QUERIES["op12_secrets"](spark, sf_dir).collect()
    assert len(found) == len(texts)
    for r in found:
        base = base_spans(texts[r.doc_id])
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == i for _, k, _ in base) for i in range(3))
        assert r.base_sha256 == hashlib.sha256(text_of(base).encode()).hexdigest()


def test_query_counts_each_kind(spark, tmp_path):
    texts = {1: "token=12345678 AKIA0123456789AB " + "0f" * 16 + " secret: abcdefgh", 2: "AKIA0123456789AB", 3: "0f" * 16 + " " + "a1" * 20, 4: None}
    documents(spark, list(texts.items())).write.parquet(f"{tmp_path}/documents.parquet")
    found = {r.doc_id: r for r in QUERIES["op12_secrets"](spark, str(tmp_path)).collect()}
    counts = {i: (r.n_assign, r.n_access, r.n_hex) for i, r in found.items()}
    assert counts == {1: (2, 1, 1), 2: (0, 1, 0), 3: (0, 0, 2), 4: (0, 0, 0)}
    assert all(r.base_sha256 == hashlib.sha256(text_of(base_spans(texts[i])).encode()).hexdigest() for i, r in found.items())


def test_an_empty_table_gives_an_empty_frame(spark):
    assert scan_secrets(documents(spark, [])).count() == 0
    assert [list(r) for r in scan_secrets(documents(spark, [(1, None)])).collect()] == [[1, [], []]]
