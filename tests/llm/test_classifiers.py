"""Toxicity, quality and personal data: held-out accuracy, brute force, awkward rows."""

from __future__ import annotations

import itertools
import random
import re
import time
import zlib

import numpy as np
import pytest
from conftest import documents
from pyspark.sql import functions as F

from millrace.llm.pii import BASE, KINDS, Trees, boosted, personal_data, running_sums
from millrace.llm.quality import classify_quality
from millrace.llm.toxicity import EXCEPTIONS, Lexicon, _outside, evidence, folded, learn_lexicon, score_toxicity, training_rows

LABELS = "doc_id long, quality int, toxic int, text string"
SF = "/root/testdata/sf0.1"


def given(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


def area(scores, labels):
    """Share of pairs of unlike labels in the right order."""
    order = sorted(zip(scores, labels, strict=True))
    ranks, i = 0.0, 0
    while i < len(order):
        j = i
        while j < len(order) and order[j][0] == order[i][0]:
            j += 1
        ranks += sum(y for _, y in order[i:j]) * (i + j + 1) / 2
        i = j
    good = sum(labels)
    return (ranks - good * (good + 1) / 2) / (good * (len(labels) - good))


def test_folding():
    assert folded("1d1ot Sh0w 2024 іdiоt, id!ot a$s!! $$$") == ["idiot", "show", "2024", "idiot", "idiot", "ass"]
    assert folded(None) == folded("") == []


def test_exceptions_and_length():
    found = Lexicon({" trash ": 3.0, " idio": 2.0, " idiot ": 5.0}, ("trash can",)).automaton()
    assert evidence("put it in the trash can", found)[0] == 0
    assert evidence("you are trash", found)[2] == 3.0
    assert evidence("1d1ot", found)[2] == 5.0 and evidence("idiotic", found)[2] == 2.0
    short, long = evidence("trash", found), evidence("trash " + "word " * 500, found)
    assert short[0] == long[0] and short[1] > long[1]
    assert evidence(None, found) == evidence("", found) == (0.0, 0.0, 0.0)


def test_toxicity_on_held_out_rows(spark):
    scored = score_toxicity(given(spark, "documents"), given(spark, "labels"))
    rows = scored.join(given(spark, "labels"), F.col("rid") == F.col("doc_id")).collect()
    held = [(r.score, r.toxic) for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.rid).encode()) % 5 == 0) for r in rows)
    assert area(*zip(*held, strict=True)) > 0.95
    assert sum((s >= 0.5) == bool(y) for s, y in held) > 0.97 * len(held)
    assert sum(s >= 0.5 for s, y in held if not y) < 0.01 * len(held)


def test_toxicity_of_awkward_rows(spark, awkward):
    labels = spark.createDataFrame([(i, None, i % 2, "x") for i in range(1, 60)] + [(None, 1, 1, "x"), (5, 1, None, "x")], LABELS)
    for known in (labels, labels.where("toxic = 1")):
        rows = score_toxicity(documents(spark, awkward), known).collect()
        assert len(rows) == len(awkward) and all(0 <= r.score <= 1 for r in rows)
    assert score_toxicity(documents(spark, []), labels).count() == 0


def test_quality_of_rows_not_learned_from(spark):
    labels = given(spark, "labels")
    learned = labels.where("doc_id % 3 <> 0")
    rows = classify_quality(given(spark, "documents"), learned).join(
        labels.where("doc_id % 3 = 0"), F.col("rid") == F.col("doc_id")).collect()
    assert area([r.score for r in rows], [r.quality for r in rows]) > 0.99
    assert sum(r.good for r in rows if r.quality) > 0.99 * sum(r.quality for r in rows)


def test_sites_shrink_and_shift(spark):
    """A host whose many documents are bad pulls its own down; a host with one document stays at the global rate."""
    good, bad = "A plain sentence of some words, written for a reader who has time. ", "$$$ ### %%% BUY!! BUY!! BUY!! "
    rows = [(i, good * (2 + i % 3), "fine") for i in range(300)] + [(1000 + i, bad * (2 + i % 3), "spam") for i in range(300)]
    rows += [(2000, good, "lone")]
    labels = spark.createDataFrame([(r[0], int(r[2] == "fine"), 0, "x") for r in rows[:600]], LABELS)
    found = {r.rid: r for r in classify_quality(documents(spark, rows), labels).collect()}
    assert found[1].host_rate > 0.9 and found[1001].host_rate < 0.1
    assert abs(found[2000].path_rate - 0.5) < 0.3
    assert found[1].good and found[2000].good and not found[1001].good


def test_quality_of_awkward_rows(spark, awkward):
    labels = spark.createDataFrame([(i, i % 2, 0, "x") for i in range(1, 60)] + [(None, 1, 1, "x"), (5, None, 1, "x")], LABELS)
    for known in (labels, labels.limit(0)):
        rows = classify_quality(documents(spark, awkward), known).collect()
        assert len(rows) == len(awkward) and all(0 <= r.score <= 1 for r in rows)
    assert classify_quality(documents(spark, []), labels).count() == 0


PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def base_spans(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                    "card": 13 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]:
                out.append((kind, m.start(), m.end()))
    return out


TEXTS = [
    "a@b.c_d@e.f.g, x@y, @z.w a@@b.c a@b..c A.B+c%d@mail-1.example.com.", "é🙂 jo@x.de 🙂 1.2.3.4 é 256.1.1.1 1.2.3.4.5.6.7.8 001.02.3.255",
    "4111 1111 1111 1111 and 4111-1111-1111-1112, 4111111111111111 4111111111111111", "+1 (136) 555-7479 248.167.124.71",
    "+49 30 1234567, +12, +1-2, ++4412345678901234, +1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6", "1" * 5000 + " " + "1.1.1.1" * 9,
    "1-" * 6000 + "1", "a" * 20000 + "@b.c", "jo (at) example (dot) org, jo[at]example.com", "\n1.2.3.4\n", "0.0.0.0", "9" * 40,
]


def test_base_spans_of_plain_patterns(spark, awkward):
    rows = awkward + [(900 + i, t) for i, t in enumerate(TEXTS)]
    found = personal_data(documents(spark, rows)).collect()
    got = sorted((r.rid or -1, [(s.kind, s.first, s.past) for s in r.base]) for r in found)
    assert got == sorted((i or -1, base_spans(t)) for i, t in rows)
    for r in found:
        added = [s for s in r.spans if s not in r.base]
        assert all(b in r.spans for b in r.base)
        assert not any(a.kind == b.kind and a.first < b.past and b.first < a.past for a in added for b in r.base)
    assert personal_data(documents(spark, [])).count() == 0


@pytest.mark.parametrize("length", [0, 1, 2, 3, 10, 99, 100, 101, 1000])
def test_running_sums(spark, length):
    values = [(7 * i) % 11 for i in range(length)]
    df = spark.createDataFrame([(values,)], "v array<int>")
    assert df.select(running_sums(F.col("v")).alias("s")).first().s == list(itertools.accumulate(values))


def test_texts_of_many_spans_take_time_by_their_length(spark):
    """Some tens of thousands of addresses, or of exception phrases, in one text."""
    many = [(1, "a.b@c.de 1.2.3.4 " * 20_000), (2, "4111 1111 1111 1111, " * 3000)]
    began = time.monotonic()
    found = {r.rid: len(r.base) for r in personal_data(documents(spark, many)).collect()}
    assert found == {1: 40_000, 2: 3000} and time.monotonic() - began < 120
    automaton = Lexicon({" trash ": 4.0, " scum ": 4.0}, EXCEPTIONS).automaton()
    began = time.monotonic()
    total, rate, largest = evidence("trash can pond scum " * 50_000 + "scum", automaton)
    assert largest == 4.0 and total == pytest.approx(np.log1p(4.0)) and time.monotonic() - began < 20


def test_exceptions_equal_dropping_each_place():
    rnd = random.Random(5)
    for _ in range(500):
        best = {rnd.randrange(60): 1.0 for _ in range(rnd.randrange(12))}
        spans = [(low, low + rnd.randrange(1, 15)) for low in (rnd.randrange(60) for _ in range(rnd.randrange(6)))]
        assert _outside(best, spans) == {at: w for at, w in best.items() if not any(low <= at < high for low, high in spans)}


def test_spans_are_added_where_a_base_match_swallowed_them(spark):
    docs = given(spark, "documents")
    found = {r.rid: r for r in personal_data(docs).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    added = [(s.kind, texts[i][s.first : s.past]) for i, r in found.items() for s in r.spans if s not in r.base]
    assert added and all(kind != "card" or luhn(text) for kind, text in added)
    assert all([(s.kind, s.first, s.past) for s in found[i].base] == base_spans(t) for i, t in texts.items())


def test_boosted_trees_learn_and_are_sql(spark):
    cells = [{"x": x, "y": y, "n": 10, "good": 10 if (x > 3) or (x > 1 and y > 1) else 0} for x in range(6) for y in range(4)]
    model = boosted(cells, names=("x", "y"))
    assert all((model.score(c) > 0) == (c["good"] > 0) for c in cells)
    df = spark.createDataFrame([(c["x"], c["y"], model.score(c)) for c in cells], "x int, y int, score double")
    assert all(abs(r.s - r.score) < 1e-9 for r in df.withColumn("s", F.expr(model.sql())).collect())
    assert Trees(0.5, []).score({}) == 0.5


@pytest.mark.parametrize("kind", KINDS)
def test_generators_have_a_pattern_of_every_kind(kind):
    assert kind in BASE


def plain_evidence(text, weights, exceptions):
    """Every term tried at every word, without an automaton; words inside an exception phrase are left out."""
    words = folded(text)
    line = f" {' '.join(words)} "
    inside = set()
    for phrase in exceptions:
        wanted = f" {' '.join(folded(phrase))} "
        inside |= {at for i in range(len(line)) if line.startswith(wanted, i) for at in range(i, i + len(wanted) - 1)}
    best = [max((w for term, w in weights.items() if line.startswith(term, i)), default=0.0)
            for i in range(len(line)) if line[i] == " " and i not in inside]
    if not words:
        return 0.0, 0.0, 0.0
    return np.log1p(sum(best)), np.log1p(100 * sum(best) / len(words)), max(best, default=0.0)


def test_scores_equal_a_plain_search_for_the_terms(spark):
    rnd = random.Random(6)
    mild, harsh = ["day", "house", "trash", "can", "river", "green", "Scum", "line"], ["tr4sh", "scum", "idiot", "IDIOTIC", "worthl3ss", "trash"]
    rows = []
    for i in range(500):
        bad = i % 3 == 0
        words = [rnd.choice(harsh if bad and rnd.random() < 0.4 else mild) for _ in range(rnd.randrange(0, 25))]
        rows.append((i, " ".join(words)))
    docs = documents(spark, rows)
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0), "") for i in range(500)], LABELS)
    learnt = learn_lexicon(training_rows(docs, labels, "toxic", 20_000, 5, 0, "doc_id", "text"))
    assert learnt.weights
    found = {r.rid: r.score for r in score_toxicity(docs, labels).collect()}
    for i, text in rows:
        logit = learnt.curve[0] + sum(c * x for c, x in zip(learnt.curve[1:], plain_evidence(text, learnt.weights, EXCEPTIONS), strict=True))
        assert found[i] == pytest.approx(1 / (1 + np.exp(-np.clip(logit, -30, 30))), abs=1e-9)


def test_site_rates_equal_plain_shrinkage(spark):
    """Rates of hosts and paths, and scores, from the documents' own evidence by plain sums."""
    rnd = random.Random(7)
    rows = [(i, " ".join(rnd.choice(["fine", "prose", "!!", "$$", "words", "1234", "Xx"]) for _ in range(rnd.randrange(1, 30))),
             rnd.choice("aaaabbc") if i else None) for i in range(300)]
    docs = documents(spark, rows).withColumn("lang", F.concat(F.lit("p"), (F.col("doc_id") % 3).cast("string")))
    labels = spark.createDataFrame([(i, int("!!" not in rows[i][1]), 0, "") for i in range(0, 300, 2)], LABELS)
    found = {r.rid: r for r in classify_quality(docs, labels).collect()}
    site = {i: (source, f"p{i % 3}") for i, _, source in rows}
    own = {i: 1 / (1 + np.exp(-r.logit)) for i, r in found.items()}
    mean = sum(own.values()) / len(own)

    def shrunk(keys, parent):
        """The rate of each key, pulled to its parent's by moments."""
        good = {k: sum(own[i] for i in own if keys(i) == k) for k in map(keys, own)}
        n = {k: sum(keys(i) == k for i in own) for k in good}
        noise = {k: parent(k) * (1 - parent(k)) for k in good}
        total = sum(n.values())
        between = (sum(n[k] * (good[k] / n[k] - parent(k)) ** 2 for k in good) - sum(noise.values())) / total
        within = sum(n[k] * noise[k] for k in good) / total
        pull = max(within / between - 1, 1.0) if between > within / 1e6 else 1e6
        return {k: (good[k] + pull * parent(k)) / (n[k] + pull) for k in good}

    hosts = shrunk(lambda i: site[i][0], lambda k: mean)
    paths = shrunk(lambda i: site[i], lambda k: hosts[k[0]])
    logit = lambda p: np.log(p / (1 - p))
    for i, r in found.items():
        assert r.host_rate == pytest.approx(hosts[site[i][0]], abs=1e-9) and r.path_rate == pytest.approx(paths[site[i]], abs=1e-9)
        score = 1 / (1 + np.exp(-(r.logit + logit(paths[site[i]]) - logit(mean))))
        assert r.score == pytest.approx(score, abs=1e-9) and r.good == (r.score >= 0.5)
