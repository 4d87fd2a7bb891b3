"""Quality classifier: document evidence combined with host and path posteriors by hierarchical empirical Bayes."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.frames import saved, small, small_batches, text_key
from millrace.llm.tokens import doc_words, pieces, text_bytes, word_bounds
from millrace.llm.toxicity import fit_curve

EDGE = 1e-4


def _shares(column: pa.Array) -> np.ndarray:
    """Per text, shares and rates that tell prose from junk; zeros for a text without words."""
    data, offsets = text_bytes(column)
    starts, ends, firsts = word_bounds(data, offsets)
    words, _ = doc_words(column)
    n, size = np.diff(firsts).astype(float), np.diff(offsets).astype(float)

    def per_text(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
        upto = np.concatenate([[0], np.cumsum(flags)])
        return (upto[at[1:]] - upto[at[:-1]]).astype(float)

    letter = np.zeros(256, dtype=bool)
    letter[65:91] = letter[97:123] = letter[128:] = True
    sign = np.zeros(256, dtype=bool)
    sign[33:48] = sign[58:65] = sign[91:97] = sign[123:127] = True
    sign[[44, 46]] = False  # comma and full stop belong to prose
    ended = letter[data[ends - 1]] if len(ends) else np.zeros(0, dtype=bool)
    alone = np.zeros(len(words), dtype=bool) if not len(words) else sign[data[starts]] & (ends - starts == 1)
    again = np.zeros(len(words), dtype=bool)
    again[1:] = words[1:] == words[:-1]
    again[firsts[:-1][np.diff(firsts) > 0]] = False
    # A whole text is in one piece, so its distinct words can be counted by sorting.
    owner = np.repeat(np.arange(len(n)), np.diff(firsts))
    order = np.lexsort((words, owner))
    new = np.ones(len(words), dtype=bool)
    new[1:] = (words[order][1:] != words[order][:-1]) | (owner[order][1:] != owner[order][:-1])
    distinct = np.bincount(owner[order][new], minlength=len(n)) if len(words) else np.zeros(len(n))
    upper, digit = (data >= 65) & (data < 91), (data >= 48) & (data < 58)
    w, s = np.maximum(n, 1), np.maximum(size, 1)
    found = np.column_stack([
        per_text(sign[data], offsets) / w, per_text(upper, offsets) / s, per_text(digit, offsets) / s,
        per_text(alone, firsts) / w, per_text(again, firsts) / w, distinct / np.sqrt(w) / 10, distinct / w,
        (w - per_text(ended, firsts)) / w, (size / w) / 10, np.log1p(n) / 10, (n == 0).astype(float)])
    return np.minimum(found, 10.0)


def _scored(docs: DataFrame, curve: np.ndarray, keep: list[str], types: str) -> DataFrame:
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                logit = np.clip(curve[0] + _shares(piece.column("text")) @ curve[1:], -20, 20)
                yield pa.RecordBatch.from_pydict({**{k: piece.column(k) for k in keep}, "logit": logit})

    return docs.mapInArrow(score, f"{types}, logit double")


def fit_documents(docs: DataFrame, labels: DataFrame, label_col: str, fit_rows: int, id_col: str, text_col: str) -> np.ndarray:
    """The curve over a text's shares, fitted on about ``fit_rows`` labelled rows; flat without both kinds of label."""
    known = labels.where(F.col(label_col).isNotNull() & F.col("doc_id").isNotNull())
    known = known.groupBy("doc_id").agg(F.min(label_col).cast("int").alias("y"))
    share = min(1.0, fit_rows / max(1, known.count()))
    known = saved(known.where(F.pmod(F.xxhash64(F.lit(13), "doc_id"), F.lit(2**30)) < share * 2**30), "labels")
    texts = docs.select(F.col(id_col).cast("long").alias("rid"), F.col(text_col).alias("text"))
    rows = texts.join(small(known, known.count()), texts.rid == known.doc_id).select("text", "y")

    def shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                found = _shares(piece.column("text"))
                lists = pa.FixedSizeListArray.from_arrays(pa.array(found.ravel()), found.shape[1])
                yield pa.RecordBatch.from_pydict({"x": lists.cast(pa.list_(pa.float64())), "y": piece.column("y")})

    with small_batches(docs.sparkSession):
        seen = rows.mapInArrow(shares, "x array<double>, y int").toPandas()
    width = _shares(pa.array([""])).shape[1]
    good = int(seen["y"].sum()) if len(seen) else 0
    if good in (0, len(seen)):
        return np.array([math.log((good + 0.5) / (len(seen) - good + 0.5)), *np.zeros(width)])
    return fit_curve(np.stack(seen["x"].to_numpy()), seen["y"].to_numpy().astype(float), ridge=1e-3, steps=60)


def _pull(sites: DataFrame) -> float:
    """By moments, how many documents' worth of its parent's rate (column ``parent``) a site's rate is given.

    Rates that spread no more than those of documents drawn alike are pulled by very many.
    """
    noise = F.col("parent") * (1 - F.col("parent"))
    seen = sites.agg(
        F.sum(F.col("n") * (F.col("good") / F.col("n") - F.col("parent")) ** 2).alias("spread"),
        F.sum(noise).alias("alike"), F.sum(F.col("n") * noise).alias("noise"), F.sum("n").alias("n")).first()
    if not seen.n:
        return 1.0
    between, within = (seen.spread - seen.alike) / seen.n, seen.noise / seen.n
    return max(within / between - 1, 1.0) if between > within / 1e6 else 1e6


def _logit(p: Column) -> Column:
    p = F.least(F.greatest(p, F.lit(EDGE)), F.lit(1 - EDGE))
    return F.log(p / (1 - p))


def classify_quality(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
    path_col: str = "lang", label_col: str = "quality", fit_rows: int = 20_000, threshold: float = 0.5,
) -> DataFrame:
    """Every row with the posterior chance that it is of good quality.

    A curve over shares of the text's bytes and words, fitted on about ``fit_rows`` labelled rows, gives each document
    its own evidence. Hosts' rates of good documents (sums of that evidence over all documents) are shrunk towards
    the global rate, and those of the paths of a host towards the host's; how far follows from how much the rates
    spread, so sparse sites hardly move. A document's log odds are its own plus its path's beyond the global ones.
    Returns rid, t1, t2 (the text's key), logit (own evidence), host_rate, path_rate, score and good (score >=
    ``threshold``). Null and empty texts are scored as texts without words; null hosts and paths are sites of their own; null labels teach
    nothing, of several labels of one id the smallest holds; null ids and repeated rows are scored like any; an empty
    table gives an empty frame.
    """
    curve = fit_documents(docs, labels, label_col, fit_rows, id_col, text_col)
    rows = docs.select(
        F.col(id_col).cast("long").alias("rid"), F.col(text_col).alias("text"), *text_key(F.col(text_col)),
        F.coalesce(F.concat(F.lit("h"), F.col(host_col).cast("string")), F.lit("")).alias("host"),
        F.coalesce(F.concat(F.lit("p"), F.col(path_col).cast("string")), F.lit("")).alias("path"))
    keep = ["rid", "t1", "t2", "host", "path"]
    scored = saved(_scored(rows, curve, keep, "rid long, t1 long, t2 long, host string, path string"), "evidence")
    own = F.lit(1.0) / (1 + F.exp(-F.col("logit")))
    paths = saved(scored.groupBy("host", "path").agg(F.sum(own).alias("good"), F.count(F.lit(1)).alias("n")), "paths")
    hosts = paths.groupBy("host").agg(F.sum("good").alias("good"), F.sum("n").alias("n"))
    everything = hosts.agg(F.sum("good").alias("g"), F.sum("n").alias("m")).first()
    mean = (everything.g or 0.0) / (everything.m or 1)
    hosts = hosts.withColumn("parent", F.lit(mean))
    pull = _pull(hosts)
    shrunk = (F.col("good") + pull * F.col("parent")) / (F.col("n") + pull)
    hosts = hosts.select("host", shrunk.alias("host_rate"))
    nested = paths.join(hosts, "host").withColumn("parent", F.col("host_rate"))
    pull = _pull(nested)
    shrunk = (F.col("good") + pull * F.col("parent")) / (F.col("n") + pull)
    sites = nested.select("host", "path", "host_rate", shrunk.alias("path_rate"))
    sites = saved(sites, "sites")
    joined = scored.join(small(sites, sites.count()), ["host", "path"])
    beyond = _logit(F.col("path_rate")) - _logit(F.lit(mean))
    joined = joined.withColumn("score", F.lit(1.0) / (1 + F.exp(-(F.col("logit") + beyond))))
    return joined.select("rid", "t1", "t2", "logit", "host_rate", "path_rate", "score",
                         (F.col("score") >= threshold).alias("good"))
