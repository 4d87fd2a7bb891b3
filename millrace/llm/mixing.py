"""Mixing sources to target weights: fixed-length token blocks, drawn shards, permuted slots, joined by index."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from millrace.llm.frames import BROADCAST_ROWS, co_partitioned, running_total, saved, saved_in_place, small, text_key
from millrace.llm.tokens import groups, mixed, pieces, text_bytes, word_bounds

BLOCK_WORDS = 256
SLOTS_PER_SHARD = 4096
#: Slots that one row unfolds to before they are dealt out again.
CHUNK = 1 << 14
#: Bytes of cut words that a task holds before it packs them, shard by shard.
HELD = 1 << 25
ZSTD_LEVEL = 6
#: Neighbouring shards share their bundles, up to so many, once there are this many bundles without it.
SHARED, BUNDLES = 8, 128
ROUNDS = 4


def _round_key(seed: int, source: np.ndarray, epoch: np.ndarray, turn: int) -> np.ndarray:
    return mixed(mixed(mixed(source.astype(np.uint64) + np.uint64(seed)) + epoch.astype(np.uint64)) + np.uint64(turn))


def permuted(index: np.ndarray, size: np.ndarray, source: np.ndarray, epoch: np.ndarray, seed: int,
             back: bool = False) -> np.ndarray:
    """A pseudorandom permutation of 0 .. size - 1 for each source and epoch, or its inverse.

    A Feistel network over the next power of four, applied again until the value falls below size.
    """
    size = size.astype(np.uint64)
    bits = np.ceil(np.log2(np.maximum(size, 2).astype(np.float64)) / 2 + 1e-9).astype(np.uint64)
    low = (np.uint64(1) << bits) - np.uint64(1)
    out, todo = index.astype(np.uint64), np.arange(len(index))
    while len(todo):
        b, m = bits[todo], low[todo]
        left, right = out[todo] >> b, out[todo] & m
        for turn in reversed(range(ROUNDS)) if back else range(ROUNDS):
            key = _round_key(seed, source[todo], epoch[todo], turn)
            if back:
                left, right = right ^ (mixed(left + key) & m), left
            else:
                left, right = right, left ^ (mixed(right + key) & m)
        out[todo] = (left << b) | right
        todo = todo[out[todo] >= size[todo]]
    return out.astype(np.int64)


def targets(sources: DataFrame, weights: tuple[int, ...], share: float, most: float) -> DataFrame:
    """For (source, source_size): number, weight and target.

    Targets share ``share`` times all sizes by weight; one stops at ``most`` times its source's size, and what it
    leaves is shared again. Sorted by the level at which each stops, that is one pass over the sources.
    """
    everything = W.partitionBy()
    by_name = everything.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(w) for w in weights])
    rows = sources.withColumn("number", F.row_number().over(by_name) - 1).withColumns({
        "weight": F.get(cycle, F.col("number") % len(weights)),
        "cap": F.col("source_size") * float(most),
        "all": F.sum("source_size").over(everything) * share,
    })
    by_level = everything.orderBy(F.col("cap") / F.col("weight"), "number")
    before = by_level.rowsBetween(W.unboundedPreceding, -1)
    after = by_level.rowsBetween(0, W.unboundedFollowing)
    left = F.col("all") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    rows = rows.withColumn("level", left / F.sum("weight").over(after))
    level = F.max("level").over(everything)
    return rows.withColumn("target", F.least("cap", level * F.col("weight"))).drop("cap", "all", "level")


def mix_sources(
    docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0, seed: int = 0,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", block_words: int = BLOCK_WORDS,
    pack: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """Takes words of all sources so that each source's come to its target, and packs them in the slots of shards.

    A source's documents, in order of id, form one stream of words cut into blocks. A source has as many slots
    as its target has blocks. Each slot draws its output shard, so a shard's counts of sources are multinomial
    about the target weights; slot j of an epoch takes the block at place j of that epoch's own permutation, and the last
    slot is cut where the target is met. So no block, and no document, comes up more often than ``most`` times.

    Returns (rows, slots). rows has every row of documents: row (a number of its own), rid, t1, t2 (the text's key),
    number (its source's), source, size, before (its place in the source's stream), source_size, target, taken (its words
    in all slots). slots is the mix, written with all of a shard in one file and the shard's slots in a drawn order: shard,
    number, epoch, slot, block, words (their number), text (the words, as they stand in the documents; a newline
    between two documents), pieces (row and n, the words of each document, in order). Without ``pack`` no text
    is written, slots ends at words, and taken is counted from the same cuts.

    Null and empty texts have size 0; null sources are one source, the last; null ids come first;
    repeated rows are rows of their own; an empty table gives empty frames.
    """
    text = F.col(text_col)
    docs = docs.select(
        F.monotonically_increasing_id().alias("row"), F.spark_partition_id().alias("part"),
        F.col(id_col).cast("long").alias("rid"), *text_key(text), F.col(source_col).cast("string").alias("source"),
        F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("size"),
        *([text.alias("text")] if pack else []))
    docs = saved_in_place(docs, "sizes", "part", ZSTD_LEVEL) if pack else saved(docs, "sizes", codec="zstd")
    texts, docs = docs, docs.drop("text")
    plan = targets(docs.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most)
    plan = saved(plan.withColumns({
        "take": F.round("target").cast("long"),
        "blocks": F.ceil(F.col("source_size") / block_words).cast("long")}), "plan")
    n = plan.count()
    told = small(plan.select(F.col("source").alias("s"), "number", "source_size", "target"), n)
    numbered = docs.join(told, docs.source.eqNullSafe(told.s)).drop("s")
    rows = saved(running_total(numbered, "number", ["rid", "t1", "t2"], "size", "streams"), "placed")

    slots = saved(_slots(plan, seed, block_words), "slots")
    cuts = saved(_cuts(rows, slots, block_words), "cuts")
    held = cuts
    if pack:
        with co_partitioned(texts.sparkSession):
            slots = saved(_packed(texts, cuts, seed), "mixed", codec="zstd", level=ZSTD_LEVEL)
        held = slots.select(F.inline("pieces"))
    taken = held.groupBy(F.col("row").alias("r")).agg(F.sum("n").alias("taken"))
    joined = rows.join(taken, rows["row"] == taken.r, "left")
    return joined.select(
        "row", "rid", "t1", "t2", "number", "source", "size", "before", "source_size", "target",
        F.coalesce("taken", F.lit(0)).cast("long").alias("taken")), slots


def _cuts(rows: DataFrame, slots: DataFrame, block_words: int) -> DataFrame:
    """What each slot takes of each document: ``n`` words after its first ``skip``, put at place ``at`` of the slot."""
    first, last = F.expr(f"before div {block_words}"), F.expr(f"(before + size - 1) div {block_words}")
    spans = rows.where("size > 0").select(
        "row", "part", "number", "before", "size", F.explode(F.sequence(first, last)).alias("block"))
    start = F.greatest(F.lit(0), F.col("before") - F.col("block") * block_words)
    end = F.least(F.lit(block_words), F.col("before") + F.col("size") - F.col("block") * block_words)
    used = spans.join(slots, ["number", "block"]).withColumns({
        "at": start, "skip": F.col("block") * block_words + start - F.col("before"),
        "n": F.least(end, F.col("words")) - start})
    return used.where("n > 0").select(*slots.columns, "row", "part", "at", "skip", "n")


def _packed(texts: DataFrame, cuts: DataFrame, seed: int) -> DataFrame:
    """The slots with their words: each text is cut once, where it lies, and the cuts meet in their shard.

    Only the cuts are dealt to the texts' parts, and only packed words to the shards: each row holds what a task
    has cut for a shard, as a compressed batch of Arrow. Of many shards a task cuts little for each, which would
    compress badly, so up to ``SHARED`` neighbours go together. A shard is about ``SLOTS_PER_SHARD`` blocks, however
    large the table, so what a task puts in order at once does not grow.
    """
    slot = ["shard", "number", "epoch", "slot", "block", "words"]
    numbers = [*slot, "at", "n", "row"]
    layout = pa.schema([*[(c, pa.int64()) for c in numbers], ("text", pa.large_binary())])
    kinds = dict(cuts.dtypes)
    made_of = pa.schema([
        *[(c, pa.int32() if kinds[c] == "int" else pa.int64()) for c in slot], ("text", pa.string()),
        ("pieces", pa.list_(pa.struct([("row", pa.int64()), ("n", pa.int64())])))])

    def bundles(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        held.clear()
        table = table.take(pa.array(np.argsort(table.column("shard").to_numpy(), kind="stable"))).combine_chunks()
        deals = table.column("shard").to_numpy() // together
        starts = np.flatnonzero(np.concatenate([[True], deals[1:] != deals[:-1]]))
        batch, zstd, sizes, whole = table.to_batches()[0], pa.Codec("zstd", ZSTD_LEVEL), [], []
        for i, j in zip(starts.tolist(), [*starts[1:].tolist(), len(deals)], strict=True):
            raw = batch.slice(i, j - i).serialize()
            sizes.append(raw.size)
            whole.append(zstd.compress(raw, asbytes=True))
        return pa.RecordBatch.from_pydict({
            "deal": pa.array(deals[starts]), "size": pa.array(sizes, pa.int64()), "bundle": pa.array(whole, pa.binary())})

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for piece in pieces(batch):
                data, offsets = text_bytes(piece.column("text"))
                starts, ends, firsts = word_bounds(data, offsets)
                lists = piece.column("cuts")
                owner = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
                fields = dict(zip([f.name for f in lists.type.value_type], lists.flatten().flatten(), strict=True))
                low = firsts[owner] + fields["skip"].to_numpy()
                begin, stop = starts[low], ends[low + fields["n"].to_numpy() - 1]
                words = [data[i:j].tobytes() for i, j in zip(begin.tolist(), stop.tolist(), strict=True)]
                found = fields | {"row": piece.column("row").take(pa.array(owner)), "text": pa.array(words, pa.large_binary())}
                # Copies, as a slice would keep its whole batch.
                copied = {c: pa.array(np.array(found[c]).astype(np.int64)) for c in numbers}
                held.append(pa.RecordBatch.from_pydict(copied | {"text": found["text"]}, layout))
                size += int((stop - begin).sum())
                if size >= HELD:
                    yield bundles(held)
                    size = 0
        if held:
            yield bundles(held)

    def whole_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zstd = pa.Codec("zstd")
        for group in groups(batches, ("deal",)):
            parts = pa.Table.from_batches([
                pa.ipc.read_record_batch(zstd.decompress(b.as_buffer(), decompressed_size=n.as_py()), layout)
                for b, n in zip(group.column("bundle"), group.column("size"), strict=True)])
            key = {c: parts.column(c).to_numpy() for c in ("shard", "number", "epoch", "slot", "at")}
            drawn = _round_key(seed + 1, key["number"], key["epoch"], key["slot"])
            order = np.lexsort((key["at"], key["slot"], key["epoch"], key["number"], drawn, key["shard"]))
            parts = parts.take(pa.array(order)).combine_chunks()
            same = np.ones(len(order), dtype=bool)
            same[0] = False
            for c in ("number", "epoch", "slot"):
                same[1:] &= key[c][order][1:] == key[c][order][:-1]
            starts = np.flatnonzero(~same)
            column = {c: parts.column(c).combine_chunks() for c in layout.names}
            ends = pa.array(np.append(starts, len(order)), pa.int64())
            text = pc.binary_join(pa.LargeListArray.from_arrays(ends, column["text"]), pa.scalar(b"\n", pa.large_binary()))
            held = pa.StructArray.from_arrays([column["row"], column["n"]], ["row", "n"])
            made = pa.RecordBatch.from_pydict({
                **{c: column[c].take(pa.array(starts)) for c in slot}, "text": text.view(pa.large_string()),
                "pieces": pa.LargeListArray.from_arrays(ends, held)})
            for run in pieces(made):
                yield run.cast(made_of)

    wanted = cuts.repartition("part").groupBy("part", F.col("row").alias("r")).agg(
        F.collect_list(F.struct(*slot, "at", "skip", "n")).alias("cuts"))
    n, last = cuts.agg(F.count(F.lit(1)), F.coalesce(F.max("shard"), F.lit(0))).first()
    together = max(1, min(SHARED, (last + 1) // BUNDLES))
    wanted = small(wanted, n) if n <= BROADCAST_ROWS else wanted.hint("shuffle_hash")
    held = texts.select("part", "row", "text").join(wanted.withColumnRenamed("part", "p"), (F.col("part") == F.col("p")) & (
        F.col("row") == F.col("r"))).select("row", "text", "cuts")
    dealt = held.mapInArrow(cut, "deal long, size long, bundle binary").repartition("deal").sortWithinPartitions("deal")
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in slot) + ", text string, pieces array<struct<row: long, n: long>>"
    return dealt.mapInArrow(whole_shards, schema)


def _slots(plan: DataFrame, seed: int, block_words: int) -> DataFrame:
    @pandas_udf("long")
    def place(parts: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for j, blocks, number, epoch in parts:
            yield pd.Series(permuted(j.to_numpy(), blocks.to_numpy(), number.to_numpy(), epoch.to_numpy(), seed))

    @pandas_udf("long")
    def place_of(parts: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for i, blocks, number, epoch in parts:
            yield pd.Series(permuted(i.to_numpy(), blocks.to_numpy(), number.to_numpy(), epoch.to_numpy(), seed, True))

    def cut(i: Column) -> Column:
        """Words of a block: all blocks are full but a source's last one."""
        return F.least(F.lit(block_words), F.col("source_size") - i * block_words)

    all_slots = F.sum(F.ceil(F.col("take") / block_words)).over(W.partitionBy())
    epochs = plan.where("take > 0").withColumn("shards", F.ceil(all_slots / SLOTS_PER_SHARD)).withColumn(
        "epoch", F.explode(F.expr("sequence(0L, (take - 1) div source_size)"))).withColumn(
        "quota", F.least("source_size", F.col("take") - F.col("epoch") * F.col("source_size")))
    epochs = epochs.withColumn("short_at", place_of(F.col("blocks") - 1, "blocks", "number", "epoch"))
    # A slot more may be needed where the short block comes up before the quota is met.
    count = F.least("blocks", F.ceil(F.col("quota") / block_words) + 1)
    chunks = epochs.withColumn("count", count).withColumn("chunk", F.explode(F.expr(f"sequence(0L, (count - 1) div {CHUNK})")))
    chunks = chunks.repartition("number", "epoch", "chunk")
    slots = chunks.withColumn("slot", F.explode(F.expr(
        f"sequence(chunk * {CHUNK}, least(count, (chunk + 1) * {CHUNK}) - 1)")))
    offset = F.col("slot") * block_words - F.when(
        F.col("short_at") < F.col("slot"), block_words - cut(F.col("blocks") - 1)).otherwise(0)
    slots = slots.withColumn("block", place("slot", "blocks", "number", "epoch")).withColumn(
        "words", F.least(cut(F.col("block")), F.col("quota") - offset)).where("words > 0")
    shard = F.pmod(F.xxhash64(F.lit(seed), "number", "epoch", "slot"), F.col("shards"))
    return slots.select(shard.alias("shard"), "number", "epoch", "slot", "block", "words")
