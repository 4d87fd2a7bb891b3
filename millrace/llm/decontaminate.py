"""Benchmark decontamination as a prefix-filtered set join of word shingles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.llm.frames import ascii_lower, identified, saved, small

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SHINGLE = 3


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS), "")


def _shingles(size: int) -> Column:
    """Runs of ``size`` words of the array ``words``, each as one text; words hold no blanks, so it stays exact."""
    parts = ", ".join(f"words[i + {j}]" for j in range(size))
    one = f"concat_ws(' ', {parts})" if size > 1 else "words[i]"
    return F.expr(f"IF(size(words) >= {size}, transform(sequence(0, size(words) - {size}), i -> {one}), array())")


def benchmark_hits(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id",
    item_text: str = "text", window: int = 13,
) -> DataFrame:
    """Every row with the words inside any occurrence of a benchmark window.

    A window is ``window`` consecutive words of an item, or the whole of a shorter one. Documents give their
    shingles, joined with those of the benchmark; the counts of all matches order shingles by rarity. Each
    window's rarest shingle is a necessary one: only where it matches, at its place in the item, is the rest
    looked up, and a window holds where all its shingles follow each other. Matching is on the words themselves.
    Returns rid, t1, t2 (the text's key), n_words, n_hit and items (array of the item ids, as sorted strings).
    Null texts and items have no words; items of equal id are one item's parts; null item ids are left out; repeated
    rows give repeated rows; empty tables give no hits.
    """
    items = saved(
        benchmark.where(F.col(item_id).isNotNull()).select(
            F.col(item_id).cast("string").alias("item"), words_of(F.col(item_text)).alias("words")
        ).distinct().where(F.size("words") > 0).select(
            "item", "words", F.size("words").alias("m"), F.xxhash64("item", "words").alias("part")), "items")
    shortest = items.agg(F.min("m")).first()[0] or SHINGLE
    sizes = sorted({min(SHINGLE, window), *range(shortest, min(SHINGLE, window))})
    rows = identified(docs, id_col, text_col).select("rid", "t1", "t2", words_of(F.col("text")).alias("words"))
    rows = rows.withColumn("n_words", F.size("words").cast("long"))
    hits, counted = None, None
    for size in sizes:  # one size, but for items of fewer words than a shingle
        whole = items.where(F.col("m") == size) if size < sizes[-1] else items.where(F.col("m") >= size)
        tokens = saved(whole.select("item", "part", "m", F.posexplode(_shingles(size)).alias("at", "shingle")), "tokens")
        known = tokens.select(F.col("shingle").alias("known")).distinct()
        known = small(known, known.count())
        # The first element marks the row itself, so that one pass also counts the words of all rows.
        spots = rows.select("rid", "t1", "t2", "n_words",
                            F.posexplode(F.concat(F.array(F.lit("")), _shingles(size))).alias("pos", "shingle"))
        matched = saved(spots.join(known, spots.shingle == known.known, "left").where("known IS NOT NULL OR pos = 0"),
                        "matches")
        if size == sizes[-1]:
            counted = matched.where("pos = 0").select("rid", "t1", "t2", "n_words")
        matched = matched.where("pos > 0").select("rid", "t1", "t2", F.col("pos") - 1, "shingle").toDF(
            "rid", "t1", "t2", "pos", "shingle").distinct()
        found = _whole_windows(matched, tokens, size, window)
        hits = found if hits is None else hits.unionAll(found)
    spans = hits.groupBy("rid", "t1", "t2").agg(
        F.collect_set(F.struct("first", "past")).alias("spans"), F.array_sort(F.collect_set("item")).alias("items"))
    places = F.expr("size(array_distinct(flatten(transform(spans, s -> sequence(s.first, s.past - 1)))))")
    spans = spans.select(F.col("rid").alias("r"), F.col("t1").alias("u1"), F.col("t2").alias("u2"),
                         places.cast("long").alias("n_hit"), "items")
    matching = counted.rid.eqNullSafe(spans.r) & (counted.t1 == spans.u1) & (counted.t2 == spans.u2)
    return counted.join(spans, matching, "left").select(
        "rid", "t1", "t2", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.expr("CAST(array() AS array<string>)")).alias("items"))


def _whole_windows(matched: DataFrame, tokens: DataFrame, size: int, window: int) -> DataFrame:
    """Spans (first, past) of words where whole windows of an item stand."""
    need = F.least(F.col("m"), F.lit(window)) - size + 1  # shingles of a window
    counts = matched.groupBy("shingle").agg(F.count(F.lit(1)).alias("freq"))
    ranked = tokens.join(counts, "shingle", "left").withColumn("freq", F.coalesce("freq", F.lit(0)))
    # Windows start at 0 .. m - window; a shingle with no match rules out every window over it.
    starts = ranked.withColumn("first", F.explode(F.sequence(
        F.greatest(F.lit(0), F.col("at") - need + 1), F.least(F.col("at"), F.col("m") - size + 1 - need))))
    prefix = starts.groupBy("item", "part", "first").agg(F.min(F.struct("freq", "at", "shingle")).alias("rarest"))
    prefix = prefix.where("rarest.freq > 0").select("item", "part", "rarest.at", "rarest.shingle").distinct()
    prefix, n = saved(prefix, "prefix"), tokens.count()
    line = ["rid", "t1", "t2", "item", "part", "diagonal"]
    rare = matched.join(small(prefix, n), "shingle").select(
        "rid", "t1", "t2", "item", "part", (F.col("pos") - F.col("at")).alias("diagonal")).distinct()
    where = tokens.select("item", "part", "m", "at", "shingle")
    rare_docs = rare.select("rid", "t1", "t2").distinct()
    pick = lambda a, b, more: a.rid.eqNullSafe(b.rid) & (a.t1 == b.t1) & (a.t2 == b.t2) & more
    near = matched.alias("a").join(rare_docs, pick(matched, rare_docs, F.lit(True)), "left_semi")
    spots = near.join(small(where, n), "shingle").withColumn("diagonal", F.col("pos") - F.col("at"))
    follows = pick(spots, rare, (spots["item"] == rare["item"]) & (spots["part"] == rare["part"])
                   & (spots.diagonal == rare.diagonal))
    spots = spots.join(rare, follows, "left_semi")
    islands = spots.withColumn("island", F.col("at") - F.row_number().over(W.partitionBy(*line).orderBy("at")))
    runs = islands.groupBy(*line, "island", "m").agg(F.min("at").alias("low"), F.count(F.lit(1)).alias("n"))
    return runs.where(F.col("n") >= need).select(
        "rid", "t1", "t2", "item", (F.col("diagonal") + F.col("low")).alias("first"),
        (F.col("diagonal") + F.col("low") + F.col("n") + size - 1).cast("int").alias("past"))
