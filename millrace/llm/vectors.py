"""Embedding near-dedup with a pivot-permutation index."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.frames import min_labels, saved, small
from millrace.llm.tokens import groups

#: Members of a list that are compared as one block; a longer list is compared block by block.
BLOCK = 1024


def _pivots(vectors: DataFrame, count: int) -> np.ndarray:
    """``count`` reference points: vectors of a sample of at most four times as many, none close to another."""
    drawn = vectors.orderBy(F.xxhash64(F.lit(3), "unit")).select("unit").limit(4 * count).collect()
    chosen: list[np.ndarray] = []
    for unit in (np.array(r.unit) for r in drawn):
        if len(chosen) < count and (not chosen or np.max(np.stack(chosen) @ unit) < 0.8):
            chosen.append(unit)
    return np.stack(chosen)


def near_vectors(
    vectors: DataFrame, min_cos: float = 0.95, pivots: int = 512, prefix: int = 7, shared: int = 3,
    id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """Every row with the links of its vector: pairs of cosine ``min_cos`` or more, in double precision.

    A vector is described by its ``prefix`` nearest of at most ``pivots`` reference points, as a set: their order is not used.
    Lists are kept by each combination of ``shared`` pivots, in place of one list per pivot with counts, so a list holds exactly those that share them, and a pair is counted once, in the
    list of the smallest pivots that it shares. Lists of any length are compared in blocks of BLOCK.
    Pairs that share fewer pivots are missed (the index is approximate); no pair below ``min_cos`` links.
    Returns vid, n_links (other rows linked directly) and component_id (smallest id reachable). Vectors that
    are null, empty, zero, or hold null or non-finite components link with nothing, nor do vectors of unlike lengths, or
    null ids; equal vectors are one class, linked with each other; rows of one id count as a row each; an
    empty table gives an empty frame.
    """
    raw = vectors.select(F.col(id_col).cast("long").alias("vid"), F.col(vector_col).cast("array<double>").alias("v"))
    raw = raw.withColumn("top", F.array_max(F.transform("v", F.abs)))
    sound = F.coalesce(
        F.col("vid").isNotNull() & (F.size("v") > 0) & F.forall("v", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
        & (F.col("top") > 0), F.lit(False))
    # Scaled by the largest component first, so that squares neither overflow nor vanish.
    scaled = F.transform("v", lambda x: x / F.col("top"))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    units = raw.where(sound).select("vid", scaled.alias("v")).withColumn("norm", norm).select(
        "vid", F.transform("v", lambda x: x / F.col("norm") + 0.0).alias("unit"))
    rows = saved(units.withColumns({"k1": F.xxhash64("unit"), "k2": F.xxhash64(F.lit(9), "unit")}), "vectors")
    classes = rows.groupBy("k1", "k2").agg(F.min("vid").alias("vid"), F.count(F.lit(1)).alias("copies"))
    classes = saved(classes, "classes")
    firsts = rows.join(classes.select("k1", "k2", "vid", "copies"), ["k1", "k2", "vid"]).dropDuplicates(["k1", "k2"])
    firsts = saved(firsts.select(F.xxhash64("k1", "k2").alias("key"), "vid", "unit", "copies"), "class-vectors")
    keyed = rows.select("vid", F.xxhash64("k1", "k2").alias("key"))
    classes = classes.select(F.xxhash64("k1", "k2").alias("key"), F.col("vid").alias("first"), "copies")

    found, edges = None, None
    for (length,) in firsts.select(F.size("unit")).distinct().collect():
        same = firsts.where(F.size("unit") == length)
        counts = _link_counts(same, _pivots(same, pivots), min_cos, prefix, shared)
        found = counts if found is None else found.unionAll(counts)
    if found is not None:
        edges = found.select(F.col("vid").alias("a"), F.col("low").alias("b"))
        labels = min_labels(edges)
        links = found.groupBy("key").agg(F.sum("links").alias("links"))
        classes = classes.join(links, "key", "left").join(labels, F.col("first") == F.col("node"), "left").select(
            "key", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("label", "first").alias("component_id"))
        known = keyed.join(small(classes, classes.count()), "key").select("vid", "n_links", "component_id")
    else:
        known = keyed.select("vid", F.lit(0).cast("long").alias("n_links"), F.col("vid").alias("component_id"))
    rest = raw.where(~sound).select("vid", F.lit(0).cast("long").alias("n_links"), F.col("vid").alias("component_id"))
    return known.unionAll(rest)


def _link_counts(vectors: DataFrame, points: np.ndarray, min_cos: float, prefix: int, shared: int) -> DataFrame:
    """(key, vid, links, low): links of a vector counted in one list, and the smallest id it is joined with there."""
    prefix = min(prefix, len(points))
    shared = min(shared, prefix)
    combos = np.array(list(combinations(range(prefix), shared)))
    reference = vectors.sparkSession.sparkContext.broadcast(points)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            unit = batch.column("unit").flatten().to_numpy().reshape(batch.num_rows, -1)
            nearness = unit @ reference.value.T
            near = np.argsort(-nearness, axis=1, kind="stable")[:, :prefix]
            near.sort(axis=1)
            key = np.zeros((len(near), len(combos)), dtype=np.int64)
            for i in range(shared):
                key = key * len(points) + near[:, combos[:, i]]
            yield pa.RecordBatch.from_pydict({
                "list": key.ravel(), "key": np.repeat(batch.column("key").to_numpy(), len(combos)),
                "near": pa.FixedSizeListArray.from_arrays(pa.array(np.repeat(near, len(combos), axis=0).ravel().astype(np.int32)),
                                                          prefix).cast(pa.list_(pa.int32()))})

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, ("list", "i", "j")):
            yield from block(group)

    def block(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        if rows.num_rows < 2:
            return
        column = lambda c: rows.column(c).to_numpy()
        unit = rows.column("unit").chunk(0).flatten().to_numpy().reshape(rows.num_rows, -1)
        near = rows.column("near").chunk(0).flatten().to_numpy().reshape(rows.num_rows, -1)
        i, j, mine, vid, copies = column("i")[0], column("j")[0], column("own"), column("vid"), column("copies")
        linked = unit @ unit.T >= min_cos
        np.fill_diagonal(linked, False)
        if i != j:  # between two blocks of one list
            linked &= (mine[:, None] != mine[None, :])
        # The pair's own list: no other shared pivot below this list's largest one.
        largest = column("list")[0] % len(points)
        has = np.zeros((rows.num_rows, largest + 1), dtype=np.float32)
        row, at = np.nonzero(near <= largest)
        has[row, near[row, at]] = 1
        own = linked & (has @ has.T == shared)
        label = vid.copy()
        while own.any():
            least = np.minimum(label, np.where(own, label[None, :], np.iinfo(np.int64).max).min(axis=1))
            if (least == label).all():
                break
            label = least
        links = own @ copies
        some = np.flatnonzero(links)
        if len(some):
            yield pa.RecordBatch.from_pydict({"key": column("key")[some], "vid": vid[some],
                                              "links": links[some].astype(np.int64), "low": label[some]})

    lists = saved(vectors.select("key", "unit").mapInArrow(describe, "list long, key long, near array<int>"), "lists")
    sizes = lists.groupBy("list").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = lists.join(sizes, "list").withColumn("blocks", F.ceil(F.col("n") / BLOCK))
    members = members.withColumn("own", F.pmod(F.xxhash64(F.lit(2), "key"), F.col("blocks")))
    members = members.withColumn("other", F.explode(F.expr("sequence(0L, blocks - 1)"))).select(
        "list", "key", "near", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    full = members.join(vectors, "key").repartition("list", "i", "j").sortWithinPartitions("list", "i", "j")
    return saved(full.mapInArrow(compare, "key long, vid long, links long, low long"), "vector-links")
