"""N-gram Jaccard join: rare-first prefix filtering with length, positional and suffix filters."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.frames import identified, min_labels, same_row, saved, small, small_batches
from millrace.llm.tokens import groups, mixed, pieces, shingle_sets

BUCKETS, CHUNK = 1 << 20, 1 << 10
#: Parts of the token space whose sizes bound an overlap (the suffix filter).
PARTS = 64
#: A gram in more prefixes than this is first joined with one document of it, and what that leaves is filtered in blocks.
HOT = 64
BLOCK = 512


@dataclass(frozen=True)
class Jaccard:
    """|x ∩ y| * den >= num * |x ∪ y| over sets of ``k`` words."""

    k: int
    num: int
    den: int

    def prefix(self, n: np.ndarray) -> np.ndarray:
        return n - -(-self.num * n // self.den) + 1

    def enough(self, overlap: Column, n: Column, m: Column) -> Column:
        return overlap * (self.num + self.den) >= self.num * (n + m)

    def near_sizes(self, n: Column, m: Column) -> Column:
        return F.least(n, m) * self.den >= F.greatest(n, m) * self.num


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(44)).astype(np.int64)


def gram_counts(docs: DataFrame, k: int) -> np.ndarray:
    """How often grams of each of 2**20 hash buckets occur, over all documents.

    The table has this size at any input, so it may go to the driver and to every task.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, waiting = np.zeros(BUCKETS, dtype=np.int64), []
        for batch in batches:
            for piece in pieces(batch):
                waiting.append(_bucket(shingle_sets(piece.column("text"), k)[1]).astype(np.int32))
                if sum(map(len, waiting)) >= BUCKETS:
                    total += np.bincount(np.concatenate(waiting), minlength=BUCKETS)
                    waiting = []
        if waiting:
            total += np.bincount(np.concatenate(waiting), minlength=BUCKETS)
        yield rows({i: total[i * CHUNK : (i + 1) * CHUNK] for i in range(BUCKETS // CHUNK)})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, part in zip(batch.column("chunk").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                sums[i] = sums.get(i, 0) + np.frombuffer(part, dtype=np.uint32).astype(np.int64)
        yield rows(sums)

    def rows(sums: dict[int, np.ndarray]) -> pa.RecordBatch:
        held = {i: np.minimum(part, 2**32 - 1).astype(np.uint32).tobytes() for i, part in sums.items() if part.any()}
        return pa.RecordBatch.from_pydict({"chunk": pa.array(held.keys(), pa.int32()),
                                           "counts": pa.array(held.values(), pa.binary())})

    schema = "chunk int, counts binary"
    counted = docs.select("text").mapInArrow(count, schema).repartition("chunk").mapInArrow(add, schema)
    table = np.zeros(BUCKETS, dtype=np.uint32)
    with small_batches(docs.sparkSession):
        found = counted.collect()
    for r in found:
        table[r.chunk * CHUNK : (r.chunk + 1) * CHUNK] = np.frombuffer(r.counts, dtype=np.uint32)
    return table


def _described(docs: DataFrame, rule: Jaccard) -> DataFrame:
    """Per row: n, a 128-bit hash of its set (s1, s2), its rare-first prefix and the sizes of the set's parts."""
    spark = docs.sparkSession
    counts = spark.sparkContext.broadcast(gram_counts(docs, rule.k))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                docs, hashes = shingle_sets(piece.column("text"), rule.k)
                order = np.lexsort((hashes, counts.value[_bucket(hashes)], docs))
                hashes = hashes[order]
                n = np.bincount(docs, minlength=piece.num_rows)
                first = np.concatenate([[0], np.cumsum(n)])
                place = np.arange(len(docs)) - first[docs]
                in_prefix = place < rule.prefix(n)[docs]
                sums = []
                for salt in (0x51ED270B7F3A91C5, 0xA3DA4E16FE75238A):
                    upto = np.concatenate([[np.uint64(0)], np.cumsum(mixed(hashes + np.uint64(salt)), dtype=np.uint64)])
                    sums.append(upto[first[1:]] - upto[first[:-1]])
                parts = np.bincount(docs * PARTS + (hashes % np.uint64(PARTS)).astype(np.int64),
                                    minlength=piece.num_rows * PARTS).astype(np.int32)
                taken = np.bincount(docs[in_prefix], minlength=piece.num_rows)
                yield pa.RecordBatch.from_pydict({
                    "rid": piece.column("rid"), "t1": piece.column("t1"), "t2": piece.column("t2"),
                    "n": pa.array(n, pa.int64()), "s1": pa.array(sums[0].view(np.int64)),
                    "s2": pa.array(sums[1].view(np.int64)),
                    "prefix": pa.ListArray.from_arrays(
                        pa.array(np.concatenate([[0], np.cumsum(taken)]), pa.int32()),
                        pa.array(hashes[in_prefix].view(np.int64))),
                    "parts": pa.ListArray.from_arrays(
                        pa.array(np.arange(piece.num_rows + 1) * PARTS, pa.int32()), pa.array(parts)),
                })

    schema = "rid long, t1 long, t2 long, n long, s1 long, s2 long, prefix array<long>, parts array<int>"
    return saved(docs.mapInArrow(describe, schema), "sets")


def _links(pairs: DataFrame, sets: DataFrame, texts: DataFrame, rule: Jaccard) -> DataFrame:
    """Of distinct candidates (a, b): the suffix filter on the sets' parts, then the sets themselves, once per pair."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, texts=("left", "right")):
                x, left = shingle_sets(piece.column("left"), rule.k)
                y, right = shingle_sets(piece.column("right"), rule.k)
                rows, hashes = np.concatenate([x, y]), np.concatenate([left, right])
                order = np.lexsort((hashes, rows))
                rows, hashes = rows[order], hashes[order]
                both = (rows[1:] == rows[:-1]) & (hashes[1:] == hashes[:-1])
                size = lambda r: np.bincount(r, minlength=piece.num_rows)  # noqa: E731, B023
                shared = size(rows[1:][both])
                linked = rule.den * shared >= rule.num * (size(x) + size(y) - shared)
                yield pa.RecordBatch.from_pydict({k: piece.column(k).filter(pa.array(linked)) for k in ("a", "b")})

    sizes = sets.select("rid", "n", "parts")
    left = sizes.toDF("a", "n", "parts")
    right = sizes.toDF("b", "m", "others")
    overlap = F.aggregate(F.zip_with("parts", "others", lambda x, y: F.least(x, y)), F.lit(0), lambda s, x: s + x)
    kept = saved(pairs.join(left, "a").join(right, "b").where(rule.enough(overlap, F.col("n"), F.col("m")))
                 .select("a", "b"), "pairs")
    n = kept.count()
    nodes = kept.select(F.col("a").alias("rid")).union(kept.select("b")).distinct()
    wanted = sets.select("rid", "t1", "t2").join(small(nodes, 2 * n), "rid", "left_semi")
    wanted = saved(wanted, "wanted")
    told = small(wanted.toDF("r", "u1", "u2"), 2 * n)
    held = texts.join(told, texts.rid.eqNullSafe(told.r) & (texts.t1 == told.u1) & (texts.t2 == told.u2))
    held = saved(held.select("rid", "text").distinct(), "texts")
    both = kept.join(held.toDF("a", "left"), "a").join(held.toDF("b", "right"), "b")
    return saved(both.mapInArrow(verify, "a long, b long").distinct(), "links")


def _candidates(one: DataFrame, other: DataFrame, rule: Jaccard, more: Column) -> DataFrame:
    """Distinct pairs of rows o (one) and p (other) that share a prefix gram and pass length and positional filters.

    The shorter set of a pair needs a shorter prefix, as it must overlap by more of itself.
    """
    o_first = F.struct("o.n", "o.rid") < F.struct("p.n", "p.rid")
    n, at = F.when(o_first, F.col("o.n")).otherwise(F.col("p.n")), F.when(o_first, F.col("o.pos")).otherwise(F.col("p.pos"))
    short_prefix = (n - at) * (rule.num + rule.den) >= 2 * rule.num * n
    bound = F.least("o.pos", "p.pos") + 1 + F.least(F.expr("o.n - o.pos - 1"), F.expr("p.n - p.pos - 1"))
    joined = one.alias("o").join(
        other.alias("p"),
        (F.col("o.gram") == F.col("p.gram")) & more & rule.near_sizes(F.col("o.n"), F.col("p.n")) & short_prefix
        & rule.enough(bound, F.col("o.n"), F.col("p.n")))
    return joined.select(F.least("o.rid", "p.rid").alias("a"), F.greatest("o.rid", "p.rid").alias("b")).distinct()


def _block_candidates(rows: DataFrame, sets: DataFrame, rule: Jaccard, texts: DataFrame | None = None) -> DataFrame:
    """Pairs of different components in one frequent gram that pass every filter, at the first gram that they share.

    A gram's rows are dealt to blocks, and each pair of blocks is compared in a task, so that only pairs that pass leave it.
    With ``texts``, pairs of one component are compared too, and each is verified on its whole sets in the block.
    """
    whole = texts is not None

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, ("gram", "i", "j")):
            column = lambda c: group.column(c).to_numpy()  # noqa: E731, B023
            rid, n, pos, comp, own = (column(c) for c in ("rid", "n", "pos", "comp", "own"))
            parts = group.column("parts").chunk(0).flatten().to_numpy().reshape(-1, PARTS)
            before = [frozenset(p[:k]) for p, k in zip(group.column("prefix").to_pylist(), pos.tolist(), strict=True)]
            within = column("i")[0] == column("j")[0]
            first = np.lexsort((rid, n))
            if whole:
                owner, hashes = shingle_sets(group.column("text").chunk(0), rule.k)
                bounds, grams = np.searchsorted(owner, np.arange(len(rid) + 1)), np.unique(hashes, return_inverse=True)[1]
            found = []
            for at, x in enumerate(first):  # x is the shorter set
                y = first[at + 1 :]
                y = y[((rid[y] != rid[x]) if whole else (comp[y] != comp[x])) & (within | (own[y] != own[x]))]
                total = rule.num * (n[x] + n[y])
                rest = 1 + np.minimum(n[x] - pos[x] - 1, n[y] - pos[y] - 1)
                y = y[(n[x] * rule.den >= n[y] * rule.num) & (rest * (rule.num + rule.den) >= total)]
                if not len(y) or (n[x] - pos[x]) * (rule.num + rule.den) < 2 * rule.num * n[x]:
                    continue
                overlap = np.minimum(parts[x], parts[y]).sum(axis=1)
                y = y[overlap * (rule.num + rule.den) >= rule.num * (n[x] + n[y])]
                if whole and len(y):
                    held = np.zeros(len(grams), dtype=bool)
                    held[grams[bounds[x] : bounds[x + 1]]] = True
                    upto = np.concatenate([[0], np.cumsum(held[grams])])
                    shared = upto[bounds[y + 1]] - upto[bounds[y]]
                    y = y[rule.den * shared >= rule.num * (n[x] + n[y] - shared)]
                found += [(min(rid[x], rid[j]), max(rid[x], rid[j])) for j in y if before[x].isdisjoint(before[j])]
            if found:
                a, b = zip(*found, strict=True)
                yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    dealt = rows.withColumn("blocks", F.ceil(F.col("cnt") / BLOCK))
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64(F.lit(2), "rid"), F.col("blocks")))
    key = ["rid", "t1", "t2"] if whole else ["rid"]
    dealt = dealt.withColumn("other", F.explode(F.expr("sequence(0L, blocks - 1)"))).select(
        "gram", *key, "n", "pos", "comp", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    full = dealt.join(sets.select(*key, "prefix", "parts"), key)
    if whole:
        wanted = texts.join(rows.select(*key).distinct(), key, "left_semi").dropDuplicates(key)
        full = full.join(saved(wanted.select(*key, "text"), "block-texts"), key)
    full = full.repartition("gram", "i", "j")
    return full.sortWithinPartitions("gram", "i", "j").mapInArrow(compare, "a long, b long").distinct()


def _all_links(sets: DataFrame, texts: DataFrame, rule: Jaccard) -> DataFrame:
    """All pairs of classes that link, also within a component: as many as there are, which a large group squares."""
    grams = sets.select(F.posexplode("prefix").alias("pos", "gram"), "rid", "t1", "t2", "n")
    shared = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("cnt")).where("cnt > 1")
    grams = saved(grams.join(shared, "gram").withColumn("comp", F.col("rid")), "all-grams")
    rare = grams.where(F.col("cnt") <= HOT)
    pairs = saved(_candidates(rare, rare, rule, F.col("o.rid") < F.col("p.rid")), "all-candidates")
    links = _links(pairs, sets, texts, rule)
    many = grams.where(F.col("cnt") > HOT)
    if many.isEmpty():
        return links
    return saved(links.unionAll(_block_candidates(many, sets, rule, texts)).distinct(), "all-links")


def jaccard_join(
    docs: DataFrame, k: int = 5, num: int = 4, den: int = 5, id_col: str = "doc_id", text_col: str = "text",
    star_rounds: int = 2, with_links: bool = True,
) -> tuple[DataFrame, DataFrame | None]:
    """Documents whose sets of k-word shingles have a Jaccard similarity of num / den or more.

    Returns (members, links). members has every row's rid, t1, t2 (the text's key), n_shingles, class_id (the smallest
    id of its equal set) and component_id (the smallest id reachable by links). links (a, b) are all pairs of different classes that link, by their class ids; a large group
    has as many as its square. Without ``with_links`` they are None, and only pairs that components need are looked at.

    Words are runs without ASCII blanks, A-Z lower-cased; a text of fewer than k words is one shingle. Shingles are
    compared by 64-bit hash: two sets of n shingles differ from the truth with a chance of about n * n / 2**64. Equal sets are one
    class. Grams are ordered rare first by counts over all documents. Grams in more than HOT prefixes are first
    joined with one of their documents (a star), so a large group of near copies is found in about as many pairs as
    it has members; then every pair that shares a prefix gram and is not in one component yet is looked at, those of
    frequent grams in blocks. That short cut holds for components; for links, pairs of all frequent grams are verified in blocks.
    Null and empty texts have no shingles and link with nothing; null ids link with nothing and have null ids of class and
    component; rows of equal id are one node; repeated rows repeat; an empty table gives empty frames.
    """
    rule = Jaccard(k, num, den)
    texts = identified(docs, id_col, text_col)
    described = _described(texts, rule)
    real = described.where("n > 0 AND rid IS NOT NULL")
    classes = real.groupBy("s1", "s2", "n").agg(F.min(F.struct("rid", "t1", "t2")).alias("first"))
    classes = saved(classes.select("s1", "s2", "n", "first.*"), "classes")
    sets = real.join(classes.select("rid", "t1", "t2"), ["rid", "t1", "t2"], "left_semi").dropDuplicates(["rid", "t1", "t2"])
    sets = saved(sets.select("rid", "t1", "t2", "n", "prefix", "parts"), "class-sets")
    grams = sets.select(F.posexplode("prefix").alias("pos", "gram"), "rid", "n")
    shared = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("cnt")).where("cnt > 1")
    grams = saved(grams.join(shared, "gram").select("gram", "rid", "n", "pos", "cnt", F.col("rid").alias("comp")), "grams")

    links = []
    hot = grams.where(F.col("cnt") > HOT)
    for _ in range(star_rounds):
        if hot.isEmpty():
            break
        ends = hot.groupBy("gram").agg(F.min(F.struct("comp", "rid", "n", "pos")).alias("low"), F.max("comp").alias("high"))
        ends = ends.where("low.comp <> high").select("gram", "low.*")
        pairs = _candidates(hot, ends, rule, F.col("o.comp") != F.col("p.comp"))
        links.append(_links(saved(pairs, "stars"), sets, texts, rule))
        labels = min_labels(_union(links)).toDF("rid", "label")
        labelled = grams.drop("comp").join(labels, "rid", "left")
        grams = saved(labelled.select("gram", "rid", "n", "pos", "cnt", F.coalesce("label", "rid").alias("comp")), "grams")
        hot = grams.where(F.col("cnt") > HOT)
    mixed_grams = grams.groupBy("gram").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low <> high")
    rows = saved(grams.join(mixed_grams.select("gram", "low"), "gram"), "mixed")
    once = (F.col("o.comp") != F.col("p.comp")) & ((F.col("p.comp") == F.col("p.low")) | (F.col("o.rid") < F.col("p.rid")))
    rare = rows.where(F.col("cnt") <= HOT)
    pairs = _candidates(rare.where("comp <> low"), rare, rule, once)
    many = rows.where(F.col("cnt") > HOT)
    if not many.isEmpty():
        pairs = pairs.unionAll(_block_candidates(many, sets, rule)).distinct()
    links.append(_links(saved(pairs, "candidates"), sets, texts, rule))
    links = _union(links).distinct()
    labels = min_labels(links)
    named = classes.join(labels, classes.rid == labels.node, "left").select(
        "s1", "s2", "n", F.col("rid").alias("class_id"), F.coalesce("label", "rid").alias("component_id"))
    found = described.select("rid", "t1", "t2", "s1", "s2", F.col("n").alias("n_shingles"))
    linkable = F.col("rid").isNotNull()
    members = found.join(named, linkable & (found.s1 == named.s1) & (found.s2 == named.s2) & (found.n_shingles == named.n), "left")
    # Rows of one id are one node, also where their texts are of two classes.
    return members.select(
        "rid", "t1", "t2", "n_shingles", F.coalesce("class_id", "rid").alias("class_id"),
        F.coalesce("component_id", "rid").alias("component_id")), _all_links(sets, texts, rule) if with_links else None


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionAll(frame)
    return out
