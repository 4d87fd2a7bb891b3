"""Operators on documents against brute force, over awkward rows and an empty table."""

from __future__ import annotations

import hashlib
import random
import re

import pytest
from conftest import documents
from pyspark.sql import functions as F

from millrace.llm import ngram_join, substring_dedup
from millrace.llm.decontaminate import benchmark_hits
from millrace.llm.line_dedup import drop_repeated_lines
from millrace.llm.ngram_join import jaccard_join
from millrace.llm.sharding import shard_documents
from millrace.llm.substring_dedup import drop_repeated_windows

ABC = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
LAST = 2**63 - 1


def split(text, lower=False):
    data = (text or "").encode()
    return (data.lower() if lower else data).split()


def shingles(text, k):
    w = split(text, True)
    return {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} or ({tuple(w)} if w else set())


def components(rows, k, num, den):
    """Smallest id reachable by links between ids; rows without id or words link with nothing."""
    sets = [(i, s) for i, t in {(i, t) for i, t in rows if i is not None} if (s := shingles(t, k))]
    label = {i: i for i, _ in rows if i is not None}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for x, (i, s) in enumerate(sets):
        for j, t in sets[x + 1 :]:
            if min(len(s), len(t)) * den >= max(len(s), len(t)) * num and den * len(s & t) >= num * len(s | t):
                a, b = root(i), root(j)
                label[max(a, b)] = min(a, b)
    return {i: root(i) for i in label}


@pytest.mark.parametrize(("hot", "block", "k", "num", "den"), [(64, 512, 5, 4, 5), (2, 4, 4, 85, 100)])
def test_jaccard_join(spark, awkward, monkeypatch, hot, block, k, num, den):
    monkeypatch.setattr(ngram_join, "HOT", hot)
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    members, links = jaccard_join(documents(spark, awkward), k, num, den)
    expected = components(awkward, k, num, den)
    found = members.collect()
    assert len(found) == len(awkward)
    assert {(r.rid, r.component_id) for r in found} == {(i, expected.get(i)) for i, _ in awkward}
    assert sorted(r.n_shingles for r in found) == sorted(len(shingles(t, k)) for _, t in awkward)
    texts = {i: t for i, t in awkward}
    for a, b in links.collect():
        s, t = shingles(texts[a], k), shingles(texts[b], k)
        assert a < b and (a == 10 or den * len(s & t) >= num * len(s | t))


@pytest.mark.parametrize("block", [16, 512])
def test_all_links_of_a_large_group(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    rnd = random.Random(2)
    base = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(150):
        near = list(base)
        for _ in range(i % 4):
            near[rnd.randrange(300)] = f"x{rnd.randrange(9)}"
        rows.append((i, " ".join(near)))
    rows += [(200 + i, " ".join(f"v{i}{j}" for j in range(40)) + " tail" * (i % 2)) for i in range(5)]
    classes = {}
    for i, t in rows:
        classes.setdefault(frozenset(shingles(t, 5)), i)
    expected = {(i, j) for s, i in classes.items() for t, j in classes.items() if i < j and 5 * len(s & t) >= 4 * len(s | t)}
    members, links = jaccard_join(documents(spark, rows))
    assert len(classes) > ngram_join.HOT and len(expected) > 2000
    found = sorted(map(tuple, links.collect()))
    assert len(found) == len(expected) and found == sorted(expected)
    lean, none = jaccard_join(documents(spark, rows), with_links=False)
    assert none is None and sorted(lean.collect()) == sorted(members.collect())


def test_jaccard_join_of_nothing(spark):
    members, links = jaccard_join(documents(spark, []))
    assert members.count() == links.count() == 0


@pytest.mark.parametrize("batches", [1, 4])
def test_line_dedup(spark, awkward, batches):
    lines = [(LAST if i is None else i, (t or "").split("\n")) for i, t in awkward]
    holder = {}
    for i, parts in lines:
        for line in parts:
            key = line.strip(" \t\n\r\x0b\x0c").translate(ABC)
            holder[key] = min(holder.get(key, LAST), i)

    def kept(i, parts):
        keys = [line.strip(" \t\n\r\x0b\x0c").translate(ABC) for line in parts]
        return [line for line, key in zip(parts, keys, strict=True) if len(key) < 10 or holder[key] == i]

    expected = sorted((i, len(p), len(p) - len(kept(i, p)), "\n".join(kept(i, p))) for i, p in lines)
    found = drop_repeated_lines(documents(spark, awkward), batches=batches).collect()
    assert sorted((LAST if r.rid is None else r.rid, r.n_lines, r.n_dropped, r.kept) for r in found) == expected
    assert drop_repeated_lines(documents(spark, [])).count() == 0


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def test_decontamination(spark, awkward):
    def words(text):
        return WORD.findall((text or "").translate(ABC))

    long = awkward[20][1]
    items = [("1", " ".join(split(long)[5].decode() for _ in range(1))), ("2", " ".join(w.decode() for w in split(long)[3:30])),
             ("3", None), ("4", ""), ("5", "ΣΑΣ STRASSE"), ("6", "One"), ("7", "two WORDS"), ("8", "de " * 15), ("9", "de de"),
             (None, "one"), ("10", "the same text of every copy which is long enough to have words"), ("2", "w1 w2 w3")]
    spans = {}
    for item, text in items:
        w = words(text)
        if item is not None and w:
            spans.setdefault(item, set()).update(tuple(w[s : s + 13]) for s in range(max(1, len(w) - 12)))

    def hits(text):
        w, hit, seen = words(text), set(), set()
        for item, windows in spans.items():
            for window in windows:
                m = len(window)
                for s in range(len(w) - m + 1):
                    if w[s] == window[0] and tuple(w[s : s + m]) == window:
                        hit.update(range(s, s + m))
                        seen.add(item)
        return len(w), len(hit), sorted(seen)

    benchmark = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id string, text string, words string")
    found = benchmark_hits(documents(spark, awkward), benchmark).collect()
    expected = sorted((i or -1, *hits(t)) for i, t in awkward)
    assert sorted((r.rid or -1, r.n_words, r.n_hit, list(r["items"])) for r in found) == expected
    assert benchmark_hits(documents(spark, []), benchmark).count() == 0
    clean = benchmark_hits(documents(spark, awkward), benchmark.limit(0)).collect()
    assert len(clean) == len(awkward) and not any(r.n_hit for r in clean)


@pytest.mark.parametrize("group", [4096, 1])
def test_substring_dedup(spark, awkward, monkeypatch, group):
    monkeypatch.setattr(substring_dedup, "GROUP", group)
    found = drop_repeated_windows(documents(spark, awkward)).collect()
    assert len(found) == len(awkward)
    once = {(LAST if i is None else i, t) for i, t in awkward}
    ids = [i for i, _ in once]
    unique = [(i, t) for i, t in once if ids.count(i) == 1]  # the order of texts of one id is by hash
    assert len(once) - len(unique) == 4
    twice = [t for i, t in once if ids.count(i) > 1]
    seen, expected = {}, {}
    for i, t in sorted(once, key=lambda r: (r[0], r[1] or "")):
        w = split(t)
        gone = set()
        for s in range(len(w) - 19):
            window = tuple(w[s : s + 20])
            if window in seen:
                gone.update(range(s, s + 20))
            seen.setdefault(window, i)
        expected[i, hashlib.md5((t or "").encode()).hexdigest()] = (
            len(w), len(gone), b" ".join(x for p, x in enumerate(w) if p not in gone).decode())
    assert twice
    got = sorted((LAST if r.rid is None else r.rid, r.n_words, r.n_removed, r.kept) for r in found)
    whole = sorted((i, *expected[i, hashlib.md5((t or "").encode()).hexdigest()])
                   for i, t in ((LAST if i is None else i, t) for i, t in awkward))
    assert got == whole
    assert drop_repeated_windows(documents(spark, [])).count() == 0


def test_sharding(spark, awkward):
    placed = shard_documents(documents(spark, awkward), shards=5).collect()
    assert sorted(r["size"] for r in placed) == sorted(len((t or "").encode()) + 8 for _, t in awkward)
    for shard in {r.shard for r in placed}:
        slots = sorted(r.slot for r in placed if r.shard == shard)
        assert slots == list(range(len(slots)))
    assert {r.shard for r in placed} <= set(range(5))
    again = shard_documents(documents(spark, awkward, 7), shards=5).collect()
    order = lambda rows: sorted((r.rid or -1, r["size"], r.shard) for r in rows)
    assert order(placed) == order(again)
    assert shard_documents(documents(spark, [])).count() == 0


def test_shards_are_even_and_keep_equal_texts_together(spark):
    rows = [(i, f"text {i % 700} " * (1 + i % 7)) for i in range(4000)] + [(5000 + i, "hot " * 20) for i in range(2000)]
    placed = shard_documents(documents(spark, rows), shards=8).toPandas()
    sizes = placed.groupby("shard")["size"].sum()
    assert len(sizes) == 8 and sizes.max() < 1.1 * sizes.mean() and sizes.min() > 0.9 * sizes.mean()
    shards = placed[placed["rid"] < 5000].groupby(["t1", "t2"])["shard"].nunique()
    assert (shards > 1).mean() < 0.05  # those that a boundary cuts
    assert placed[placed["rid"] >= 5000]["shard"].nunique() > 1  # a text larger than a shard is divided


@pytest.mark.parametrize("same_id", [3, None])
def test_rows_equal_in_all_are_split_too(spark, same_id):
    """A third of all bytes in rows of one text and one id, or none: the law holds, and slots have no gap."""
    rows = [(i, f"text {i % 5900} " * 3) for i in range(6000)] + [(same_id, "one text for all of them")] * 5000
    placed = shard_documents(documents(spark, rows, 5), shards=8)
    found = placed.toPandas()
    sizes = found.groupby("shard")["size"].sum()
    assert len(sizes) == 8 and sizes.max() < 1.1 * sizes.mean() and sizes.min() > 0.9 * sizes.mean()
    for _, slots in found.groupby("shard")["slot"]:
        assert sorted(slots) == list(range(len(slots)))
    assert found["ordinal"].is_unique and len(found) == 11000
    again = shard_documents(documents(spark, rows, 9), shards=8).toPandas()
    key = ["rid", "size", "shard"]
    assert (found[key].fillna(-1).sort_values(key).values == again[key].fillna(-1).sort_values(key).values).all()


def test_shards_follow_the_ranges_of_a_plain_sort(spark):
    """Each shard is a run of the order by (k1, k2, copy), and slots go by range: against a sort on the driver."""
    rows = [(i, f"t{i % 700}") for i in range(3000)] + [(9, "t9")] * 40
    found = shard_documents(documents(spark, rows, 4), shards=6)
    keyed = found.withColumn("text", F.expr("concat('t', CASE WHEN rid IS NULL THEN '' ELSE CAST(rid % 700 AS STRING) END)"))
    keyed = keyed.withColumns({"k1": F.xxhash64("text"), "k2": F.xxhash64(F.lit(1), "text", "rid")}).toPandas()
    ordered = keyed.sort_values(["k1", "k2", "shard"], kind="stable")
    assert ordered["shard"].is_monotonic_increasing  # no shard begins before the one below has ended
    slots = keyed.sort_values(["shard", "slot"])
    assert (slots.groupby("shard")["part"].apply(lambda parts: parts.is_monotonic_increasing)).all()
