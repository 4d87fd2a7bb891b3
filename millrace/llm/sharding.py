"""Sharding by sampled splitters: size-weighted key samples, quantile boundaries, overfull ranges subdivided."""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.llm.frames import running_total, saved, small, text_key

LOWEST = -(2**63) + 1
#: Rows that one task puts in order when slots are numbered.
ROWS_PER_RUN = 100_000


def _range_of(bounds: list[tuple[int, int, int]]) -> Column:
    """The number of bounds at or below the key (k1, k2, k3), by binary search in three literal arrays."""
    if not bounds:
        return F.lit(0)
    steps = ", ".join(str(2**i) for i in range(len(bounds).bit_length() - 1, -1, -1))
    lists = [F.expr("array(" + ", ".join(f"{b[i]}L" for b in bounds) + ")") for i in range(3)]

    def reached(at: Column) -> Column:
        first, second, third = (F.get(values, at - 1) for values in lists)
        within = (second < F.col("k2")) | ((second == F.col("k2")) & (third <= F.col("k3")))
        return (at <= len(bounds)) & ((first < F.col("k1")) | ((first == F.col("k1")) & within))

    return F.aggregate(
        F.expr(f"array({steps})"), F.lit(0), lambda at, step: F.when(reached(at + step), at + step).otherwise(at))


def _sample(rows: DataFrame, rate: float, seed: int) -> dict[int, list]:
    """By part, keys drawn with a chance in proportion to their size; one beyond a whole share counts for its shares."""
    chance = F.pmod(F.xxhash64(F.lit(seed), "k1", "k2", "k3", "rid"), F.lit(2**40)) / float(2**40)
    weight = F.col("size") * F.lit(rate)
    drawn: dict[int, list] = {}
    for r in rows.where(chance < weight).select("part", "k1", "k2", "k3", F.greatest(weight, F.lit(1.0)).alias("w")).collect():
        drawn.setdefault(r.part, []).append((r.k1, r.k2, r.k3, r.w))
    return drawn


def _quantiles(sample: list, parts: int) -> list[tuple[int, int, int]]:
    """Keys at the weighted quantiles; the first boundary of a text covers all its copies, later ones split them."""
    total, seen, at, bounds = sum(w for *_, w in sample), 0.0, 1, []
    for *key, w in sorted(sample):
        seen += w
        if at < parts and seen >= at * total / parts:
            at = int(seen * parts / total) + 1
            bounds.append(tuple(key) if bounds and bounds[-1][0] == key[0] else (key[0], LOWEST, LOWEST))
    return bounds


def _numbered_copies(rows: DataFrame) -> DataFrame:
    """The rows with k3: 0, 1, ... among those of equal text and id, which are equal, so any order of them does."""
    again = saved(rows.groupBy("k2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("k2"), "shard-copies")
    again = small(again, again.count())
    single = rows.join(again, "k2", "left_anti").withColumn("k3", F.lit(0).cast("long"))
    copies = rows.join(again, "k2").withColumn("one", F.lit(1).cast("long"))
    copies = running_total(copies, "k2", ["ordinal"], "one", "shard-ranks").withColumnRenamed("before", "k3")
    return saved(single.unionByName(copies.drop("one")), "shard-keys")


def shard_documents(
    docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text", ranges_per_shard: int = 64,
    samples_per_range: int = 8, rounds: int = 3, ordinal_col: str | None = None,
) -> DataFrame:
    """Every row with its shard; shards hold nearly equal bytes (law ``bytes``).

    Rows are ordered by a key of their text, then by one of text and id, then by their number among equal rows, so equal
    texts share a shard unless they outgrow a range; rows equal in all, with null ids too, are split like others. The sample has about ``shards * ranges_per_shard * samples_per_range`` keys at any
    input size; ranges of over twice the mean are sampled again, alone, and split, up to ``rounds`` times.
    Returns rid, t1, t2 (the text's key), ordinal (that of ``ordinal_col``, else any number of the row), size (UTF-8 bytes plus 8), text_crc32, part (its range), shard and slot (0, 1, ... in
    each shard). Null texts count as empty, null ids as a value of their own; repeated rows each take a slot; an empty
    table gives an empty frame.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = saved(
        docs.select(
            F.col(id_col).cast("long").alias("rid"),
            *text_key(F.col(text_col)),
            (F.octet_length(text).cast("long") + 8).alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.xxhash64(text).alias("k1"),
            F.xxhash64(F.lit(1), text, F.col(id_col)).alias("k2"),
            (F.col(ordinal_col) if ordinal_col else F.monotonically_increasing_id()).alias("ordinal"),
        ),
        "shard-rows",
    )
    rows = _numbered_copies(rows)
    total = rows.agg(F.sum("size")).first()[0] or 1
    count = shards * ranges_per_shard
    rate = samples_per_range * count / total
    bounds = _quantiles(_sample(rows.withColumn("part", F.lit(0)), rate, 0).get(0, []), count)
    for turn in range(rounds):
        sums = rows.groupBy(_range_of(bounds).alias("part")).agg(
            F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"),
            F.min(F.struct("k1", "k2", "k3")).alias("low"), F.max(F.struct("k1", "k2", "k3")).alias("high"))
        parts = sums.collect()
        overfull = {p.part: p.bytes for p in parts if p.bytes > 2 * total / count and p.low != p.high}
        if not overfull or turn == rounds - 1:
            break
        inner = rows.withColumn("part", _range_of(bounds)).where(F.col("part").isin(*overfull))
        for part, drawn in _sample(inner, 2 * rate, turn + 1).items():
            bounds = sorted({*bounds, *_quantiles(drawn, math.ceil(2 * overfull[part] * count / total))})
    placed, seen = [], 0
    for p in sorted(parts, key=lambda p: p.part):
        placed.append((p.part, min(shards - 1, int((seen + p.bytes / 2) * shards / total)), -(-p.rows // ROWS_PER_RUN)))
        seen += p.bytes
    spark = docs.sparkSession
    # As an Arrow table, which the JVM reads itself: rows of a list would start Python processes on the executors.
    columns = zip(*placed, strict=True) if placed else [[], [], []]
    places = spark.createDataFrame(pa.table([pa.array(c, pa.int32()) for c in columns], ["part", "shard", "runs"]))
    rows = rows.withColumn("part", _range_of(bounds)).join(small(places, len(placed)), "part")
    rows = rows.withColumn("run", F.pmod(F.xxhash64("k2", "k3", "rid"), F.col("runs")).cast("int"))
    counts = rows.groupBy("shard", "part", "run").agg(F.count(F.lit(1)).alias("n"))
    earlier = W.partitionBy("shard").orderBy("part", "run").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select(F.col("part").alias("p"), F.col("run").alias("r"),
                           F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    number = F.row_number().over(W.partitionBy("part", "run").orderBy("k1", "k2", "k3", "rid"))
    numbered = rows.withColumn("number", number)
    return numbered.join(starts, (numbered.part == starts.p) & (numbered.run == starts.r)).select(
        "rid", "t1", "t2", "ordinal", "size", "text_crc32", "part", "shard",
        (F.col("start") + F.col("number") - 1).cast("long").alias("slot"))
