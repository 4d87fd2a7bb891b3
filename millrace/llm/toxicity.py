"""Toxicity: a weighted lexicon, learned from labels, matched by Aho-Corasick on folded text."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.frames import identified, saved, small

# Letters of other scripts that look like Latin ones, and digits and signs written for letters.
HOMOGLYPHS = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "ӏ": "l", "м": "m", "о": "o",
    "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x", "ѵ": "v", "ԝ": "w", "α": "a", "β": "b", "ε": "e", "ι": "i", "κ": "k",
    "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
}
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}
#: Phrases whose words are no insult; their matches do not count.
EXCEPTIONS = ("trash can", "trash bin", "clown fish", "sore loser", "worthless check", "scum line", "pond scum")

FOLD = str.maketrans(HOMOGLYPHS | {k: v for k, v in SUBSTITUTES.items() if k.isdigit()})
SIGNS = re.compile(r"(?<=\w)[@$!](?=\w)")
WORD = re.compile(r"[^\W_]+")
PREFIXES = (4, 5, 6)


def folded(text: str | None) -> list[str]:
    """Lower-case words; look-alike letters, and digits and signs inside words, become the letters meant.

    A word of digits alone stays a number.
    """
    text = (text or "").lower()
    if "@" in text or "$" in text or "!" in text:
        text = SIGNS.sub(lambda m: SUBSTITUTES[m[0]], text)
    words = WORD.findall(text)
    return [w if w.isascii() and (w.isalpha() or w.isdigit()) else w.translate(FOLD) for w in words]


def _features(words: set[str]) -> set[str]:
    """Whole words as " word ", and beginnings of words as " begin"."""
    found = {f" {w} " for w in words}
    for n in PREFIXES:
        found |= {f" {w[:n]}" for w in words if len(w) >= n}
    return found


@dataclass
class Lexicon:
    weights: dict[str, float]
    exceptions: tuple[str, ...]
    #: Of the logistic curve over what ``evidence`` gives, and a constant first.
    curve: tuple[float, ...] = ()

    def automaton(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton()
        for term, weight in self.weights.items():
            found.add_word(term, (len(term), weight))
        for phrase in self.exceptions:
            found.add_word(f" {' '.join(folded(phrase))} ", (len(" ".join(folded(phrase))) + 2, None))
        if len(found):
            found.make_automaton()
        return found


def evidence(text: str | None, automaton: ahocorasick.Automaton) -> tuple[float, float, float]:
    """Weight of all words matched, the same per word of text (as logarithms), and the largest weight.

    Of the terms that begin at one word the heaviest counts; words inside an exception phrase do not.
    """
    words = folded(text)
    if not words or not len(automaton):
        return 0.0, 0.0, 0.0
    line = f" {' '.join(words)} "
    best: dict[int, float] = {}
    clear: list[tuple[int, int]] = []
    for end, (length, weight) in automaton.iter(line):
        start = end - length + 1
        if weight is None:
            clear.append((start, end))
        elif weight > best.get(start, 0.0):
            best[start] = weight
    best = _outside(best, clear)
    total = sum(best.values())
    return math.log1p(total), math.log1p(100 * total / len(words)), max(best.values(), default=0.0)


def _outside(best: dict[int, float], spans: list[tuple[int, int]]) -> dict[int, float]:
    """The places that lie in no span, by one sweep over both in order."""
    if not spans:
        return best
    spans, left, at, past = sorted(spans), {}, 0, -1
    for place in sorted(best):
        while at < len(spans) and spans[at][0] <= place:
            past, at = max(past, spans[at][1]), at + 1
        if place >= past:
            left[place] = best[place]
    return left


def fit_curve(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 30) -> np.ndarray:
    """Logistic regression by Newton's steps; the constant comes first."""
    x = np.column_stack([np.ones(len(x)), x])
    beta = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1])
        step = np.linalg.solve(hessian, x.T @ (y - p) - ridge * beta)
        beta += step
        if np.abs(step).max() < 1e-6:
            break
    return beta


def training_rows(docs: DataFrame, labels: DataFrame, label: str, bound: int, folds: int, held: int,
                  id_col: str, text_col: str) -> DataFrame:
    """(text, y) of at most about ``bound`` labelled rows that are not held out."""
    ids = F.col("doc_id").cast("string").cast("binary")
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & (F.pmod(F.crc32(ids), F.lit(folds)) != held))
    known = known.groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
    share = min(1.0, bound / max(1, known.count()))
    known = saved(known.where(F.pmod(F.xxhash64(F.lit(11), "doc_id"), F.lit(2**30)) < share * 2**30), "labels")
    texts = docs.select(F.col(id_col).cast("long").alias("rid"), F.col(text_col).alias("text"))
    return saved(texts.join(small(known, known.count()), texts.rid == known.doc_id).select("text", "y"), "training")


def learn_lexicon(training: DataFrame, terms: int = 4096, exceptions: tuple[str, ...] = EXCEPTIONS) -> Lexicon:
    """Terms that toxic documents hold far more often, at most ``terms`` of them, weighted by their log odds."""

    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = (Counter(), Counter())
        for part in parts:
            for text, y in zip(part["text"], part["y"], strict=True):
                seen[y].update(_features(set(folded(text))))
        both = [(term, seen[1][term], seen[0][term]) for term in seen[1].keys() | seen[0].keys()]
        yield pd.DataFrame(both, columns=["term", "good", "bad"])

    totals = training.agg(F.sum("y"), F.count(F.lit(1))).first()
    positive, negative = totals[0] or 0, (totals[1] or 0) - (totals[0] or 0)
    if not positive or not negative:
        return Lexicon({}, exceptions, (math.log((positive + 0.5) / (negative + 0.5)), 0.0, 0.0, 0.0))
    counts = training.mapInPandas(count, "term string, good long, bad long").groupBy("term").agg(
        F.sum("good").alias("good"), F.sum("bad").alias("bad"))
    odds = F.log((F.col("good") + 0.5) / (positive + 1)) - F.log((F.col("bad") + 0.5) / (negative + 1))
    least = max(3, positive // 200)
    chosen = counts.where(F.col("good") >= least).withColumn("odds", odds).where("odds > 3")
    chosen = chosen.orderBy(F.desc(F.col("good") * F.col("odds")), "term").limit(terms).collect()
    lexicon = Lexicon({r.term: r.odds for r in chosen}, exceptions)

    def weigh(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = lexicon.automaton()
        for part in parts:
            rows = [(*evidence(text, found), y) for text, y in zip(part["text"], part["y"], strict=True)]
            yield pd.DataFrame(rows, columns=["total", "rate", "largest", "y"])

    seen = training.mapInPandas(weigh, "total double, rate double, largest double, y int").toPandas()
    lexicon.curve = tuple(fit_curve(seen[["total", "rate", "largest"]].to_numpy(), seen["y"].to_numpy()))
    return lexicon


def score_toxicity(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    fit_rows: int = 20_000, folds: int = 5, held_fold: int = 0, exceptions: tuple[str, ...] = EXCEPTIONS,
) -> DataFrame:
    """Every row with the chance (0 to 1) that its text is toxic.

    The lexicon and its curve are fitted on about ``fit_rows`` labelled rows outside the held-out fold (crc32 of the
    id as text, modulo ``folds``). Each whole text is folded and matched; the matched weight counts both as a sum and
    by length. Only the text is scored. Returns rid, held_out, score.
    Null and empty texts have no evidence; null ids are not held out; labels of null, or without a document, teach nothing, of
    several labels of one id the largest holds; without labels of both kinds the score is their share;
    repeated rows repeat; an empty table gives an empty frame.
    """
    training = training_rows(docs, labels, label_col, fit_rows, folds, held_fold, id_col, text_col)
    learnt = learn_lexicon(training, exceptions=exceptions)
    parts_of = docs.sparkSession.sparkContext.broadcast((learnt.weights, learnt.exceptions, learnt.curve))

    def score(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lexicon = Lexicon(*parts_of.value)
        found, curve = lexicon.automaton(), lexicon.curve
        for part in parts:
            logits = [curve[0] + sum(c * x for c, x in zip(curve[1:], evidence(text, found), strict=True))
                      for text in part["text"]]
            part["score"] = 1 / (1 + np.exp(-np.clip(np.array(logits, dtype=float), -30, 30)))
            yield part[["rid", "held_out", "score"]]

    rows = identified(docs, id_col, text_col)
    fold = F.pmod(F.crc32(F.col("rid").cast("string").cast("binary")), F.lit(folds))
    rows = rows.select("rid", F.coalesce(fold == held_fold, F.lit(False)).alias("held_out"), "text")
    return rows.mapInPandas(score, "rid long, held_out boolean, score double")
