"""Substring dedup: windows of words that start earlier too, found by anchors and hashes.

Windows of ``window`` words are grouped by a k-gram anchor (the least hash of their k-grams), so that equal windows always
meet; a group beyond GROUP windows is grouped by whole windows and reduced before it is shuffled. In a group the hashes of
whole windows are sorted, and equal neighbours are a repeat. This is the cut at one depth of what suffix trees by
prefix would give: suffixes are not sorted by their words, no tree is built, and longer repeats are not told as such.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.frames import identified, saved, small
from millrace.llm.tokens import doc_words, mixed, pieces, runs_of

ANCHOR = 5
#: Suffixes that one subtree may hold; above, a longer prefix splits it.
GROUP = 4096
#: Windows that follow each other under one anchor travel as one row, marked by the bits of an int.
SPAN = 31


def _windows(column: pa.Array, window: int) -> tuple[np.ndarray, ...]:
    """For each window of a text: text number, start in the text, hash, anchor and the anchor's place."""
    words, firsts = doc_words(column)
    hashes, at = runs_of(words, firsts, window)
    if not len(at):
        empty = np.zeros(0, np.int64)
        return empty, empty, hashes, hashes, empty
    n = len(words) - ANCHOR + 1
    grams = np.zeros(n, dtype=np.uint64)
    for j in range(ANCHOR):
        grams = mixed(grams * np.uint64(0xC2B2AE3D27D4EB4F) + words[j : j + n])
    place = at + sliding_window_view(grams, window - ANCHOR + 1)[at].argmin(axis=1)
    docs = np.searchsorted(firsts, at, "right") - 1
    return docs, at - firsts[docs], hashes, grams[place], place


def _anchors(window: int):
    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                docs, _, _, anchor, place = _windows(piece.column("text"), window)
                new = np.ones(len(place), dtype=bool)
                new[1:] = place[1:] != place[:-1]
                docs, anchor = docs[new], anchor[new]
                order = np.lexsort((anchor, docs))
                docs, anchor = docs[order], anchor[order]
                first = np.ones(len(docs), dtype=bool)
                first[1:] = (docs[1:] != docs[:-1]) | (anchor[1:] != anchor[:-1])
                at = np.flatnonzero(first)
                times = np.diff(np.append(at, len(docs)))
                keys = piece.column("dk").to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_pydict({"anchor": anchor[at].view(np.int64), "dk": keys[docs[at]],
                                                  "times": times.astype(np.int32)})

    return anchors


def _suffixes(window: int):
    def suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                docs, starts, hashes, anchor, _ = _windows(piece.column("text"), window)
                repeated = piece.column("repeated")
                owner = np.repeat(np.arange(piece.num_rows), np.diff(repeated.offsets.to_numpy()))
                salted = lambda d, a: mixed(a + mixed(d.astype(np.uint64) + np.uint64(1)))
                known = salted(owner, repeated.flatten().to_numpy().view(np.uint64))
                keep = np.isin(salted(docs, anchor), known)
                docs, starts, hashes, anchor = (x[keep] for x in (docs, starts, hashes, anchor))
                new = np.ones(len(anchor), dtype=bool)
                new[1:] = (anchor[1:] != anchor[:-1]) | (starts[1:] != starts[:-1] + 1) | (docs[1:] != docs[:-1])
                begin = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
                new |= (np.arange(len(new)) - begin) % SPAN == 0
                at = np.flatnonzero(new)
                column = lambda name: piece.column(name).to_numpy(zero_copy_only=False)[docs[at]]  # noqa: E731, B023
                yield pa.RecordBatch.from_pydict({
                    "anchor": anchor[at].view(np.int64), "dk": column("dk"),
                    "owner": column("owner"), "t1": column("t1"), "start": starts[at].astype(np.int32),
                    "hashes": pa.ListArray.from_arrays(pa.array(np.append(at, len(anchor)), pa.int32()),
                                                       pa.array(hashes.view(np.int64)))})

    return suffixes


def _subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by anchor: whole groups at a time, the windows that also start earlier, as a bit mask per row.

    Small groups go together, as many as came with a batch.
    """
    rest: pa.Table | None = None

    def repeats(rows: pa.Table) -> pa.RecordBatch:
        rows = rows.combine_chunks()
        held = rows.column("hashes").chunk(0)
        sizes = np.diff(held.offsets.to_numpy())
        row = np.repeat(np.arange(rows.num_rows), sizes)
        offset = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        value = {c: rows.column(c).to_numpy()[row] for c in ("anchor", "owner", "t1", "start")}
        leaf = held.flatten().to_numpy()
        order = np.lexsort((value["start"] + offset, value["t1"], value["owner"], leaf, value["anchor"]))
        leaf, anchor = leaf[order], value["anchor"][order]
        below = np.zeros(len(order), dtype=bool)
        below[1:] = (leaf[1:] == leaf[:-1]) & (anchor[1:] == anchor[:-1])
        # Leaves at the first one's own place are rows that the table repeats.
        head = np.maximum.accumulate(np.where(below, 0, np.arange(len(order))))
        place = [value["owner"][order], value["t1"][order], (value["start"] + offset)[order]]
        below &= np.logical_or.reduce([p != p[head] for p in place])
        gone = order[below]
        mask = np.zeros(rows.num_rows, dtype=np.int64)
        np.bitwise_or.at(mask, row[gone], 1 << offset[gone])
        some = np.flatnonzero(mask)
        return pa.RecordBatch.from_pydict({"dk": rows.column("dk").to_numpy()[some],
                                           "start": rows.column("start").to_numpy()[some],
                                           "mask": mask[some].astype(np.int32)})

    for batch in batches:
        table = pa.Table.from_batches([batch])
        rest = table if rest is None else pa.concat_tables([rest, table])
        anchors = rest.column("anchor").to_numpy()
        if not len(anchors):
            continue
        done = int(np.searchsorted(anchors, anchors[-1]))
        if done:
            yield repeats(rest.slice(0, done))
            rest = rest.slice(done)
    if rest is not None and rest.num_rows:
        yield repeats(rest)


def _large_groups(suffixes: DataFrame) -> DataFrame:
    """Marks of the groups that are too large for one task: rows of equal windows are reduced to one before they meet.

    Of the rows of one shape only the first can hold a window's first place; the others lose all of their windows.
    """
    rows = suffixes.select("anchor", F.xxhash64("hashes").alias("shape"), "hashes", "dk", "start",
                           F.struct("owner", "t1", "start").alias("place"))
    shapes = rows.groupBy("anchor", "shape").agg(F.min("place").alias("first"), F.max("hashes").alias("hashes"))
    shapes = saved(shapes, "shapes")
    leaves = shapes.select("anchor", "shape", F.posexplode("hashes").alias("i", "leaf"), F.struct(
        "first.owner", "first.t1", (F.col("first.start") + F.col("i")).alias("start")).alias("place"))
    heads = leaves.groupBy("anchor", "leaf").agg(F.min("place").alias("head"))
    below = leaves.join(heads, ["anchor", "leaf"]).groupBy("anchor", "shape").agg(
        F.sum(F.when(F.col("place") != F.col("head"), F.expr("shiftleft(1L, i)")).otherwise(0)).alias("first_mask"))
    known = shapes.select("anchor", "shape", "first", F.expr("shiftleft(1L, size(hashes)) - 1").alias("whole"))
    marked = rows.drop("hashes").join(known.join(below, ["anchor", "shape"]), ["anchor", "shape"])
    mask = F.when(F.col("place") == F.col("first"), F.col("first_mask")).otherwise(F.col("whole"))
    return marked.select("dk", "start", mask.cast("int").alias("mask")).where("mask <> 0")


def _kept(window: int):
    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, removed, texts = [], [], []
            for text, marks in zip(batch.column("text"), batch.column("marks").to_pylist(), strict=True):
                words = (text.as_py() or "").encode().split()
                edges = np.zeros(len(words) + 1, dtype=np.int64)
                for mark in marks or ():
                    for j in range(mark["mask"].bit_length()):
                        if mark["mask"] >> j & 1:
                            edges[mark["start"] + j] += 1
                            edges[mark["start"] + j + window] -= 1
                gone = np.cumsum(edges[:-1]) > 0
                counts.append(len(words))
                removed.append(int(gone.sum()))
                texts.append(b" ".join(w for w, g in zip(words, gone.tolist(), strict=True) if not g) if gone.any()
                             else b" ".join(words))
            yield pa.RecordBatch.from_pydict({
                "rid": batch.column("rid"), "n_words": pa.array(counts, pa.int64()),
                "n_removed": pa.array(removed, pa.int64()), "kept": pa.array(texts, pa.binary()).cast(pa.string())})

    return kept


def drop_repeated_windows(
    docs: DataFrame, window: int = 20, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Every row without the words of windows that start earlier too (smaller id, or same text, earlier place).

    Exact copies of a text are settled without their words: all but the smallest id's lose every window. Of the others
    only windows whose anchor occurs twice anywhere are grouped. Windows are compared by hash below equal anchors: 128 bits.
    Returns rid, n_words, n_removed, kept (the words left, by one blank). Null texts have no words; null ids come last;
    rows of equal id are ordered by the hash of their text; rows equal in both are one document, each returned; texts
    under ``window`` words stay whole; an empty table gives an empty frame.
    """
    rows = identified(docs, id_col, text_col).withColumn("owner", F.coalesce("rid", F.lit(2**63 - 1)))
    texts = rows.groupBy("t1", "t2").agg(F.min("owner").alias("first"), F.max("owner").alias("last"))
    copied = saved(texts.where("first < last").select("t1", "t2", "first"), "copied")
    marked = rows.join(small(copied, copied.count()), ["t1", "t2"], "left")
    firsts = marked.where("first IS NULL OR owner = first").select(
        "rid", "owner", "t1", F.xxhash64("rid", "t1", "t2").alias("dk"), "text")
    copies = marked.where("owner > first").select(
        "rid", "text", F.expr("CAST(array() AS array<struct<start: int, mask: int>>)").alias("marks"))

    anchors = firsts.select("dk", "text").mapInArrow(_anchors(window), "anchor long, dk long, times int")
    counts = anchors.groupBy("anchor").agg(F.sum("times").alias("n")).where("n > 1")
    counts = saved(counts.select("anchor", (F.col("n") > GROUP).alias("hot")), "repeated")
    per_doc = anchors.join(counts, "anchor").groupBy("dk").agg(F.collect_set(F.struct("anchor", "hot")).alias("repeated"))
    per_doc = saved(per_doc, "anchors")

    # Both joins deal the texts by the same key, so Spark shuffles them once.
    schema = "anchor long, dk long, owner long, t1 long, start int, hashes array<long>"
    cold = per_doc.select("dk", F.expr("transform(filter(repeated, x -> NOT x.hot), x -> x.anchor)").alias("repeated"))
    suffixes = firsts.join(cold.hint("merge"), "dk").mapInArrow(_suffixes(window), schema)
    grouped = suffixes.repartition("anchor").sortWithinPartitions("anchor")
    marks = grouped.mapInArrow(_subtrees, "dk long, start int, mask int")
    hot = per_doc.select("dk", F.expr("transform(filter(repeated, x -> x.hot), x -> x.anchor)").alias("repeated"))
    hot = hot.where(F.size("repeated") > 0)
    held = hot.agg(F.sum(F.size("repeated"))).first()[0]
    if held:
        marks = marks.unionAll(_large_groups(firsts.join(small(hot, held), "dk").mapInArrow(_suffixes(window), schema)))
    by_doc = marks.groupBy("dk").agg(F.collect_list(F.struct("start", "mask")).alias("marks"))
    cleaned = firsts.join(by_doc.hint("merge"), "dk", "left").select("rid", "text", "marks")
    schema = "rid long, n_words long, n_removed long, kept string"
    whole = copies.mapInArrow(_kept(window), schema).withColumns({
        "n_removed": F.when(F.col("n_words") >= window, F.col("n_words")).otherwise(F.col("n_removed")),
        "kept": F.when(F.col("n_words") >= window, F.lit("")).otherwise(F.col("kept"))})
    return cleaned.mapInArrow(_kept(window), schema).unionAll(whole)
