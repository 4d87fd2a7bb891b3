"""Words of whole Arrow columns and their hashes, by numpy on the text's bytes.

A word is a run of bytes other than ASCII blanks. Its 64-bit hash is a polynomial over a table of pseudorandom
values per byte, mixed; prefix sums give it for all words of a block at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK = 1 << 18
BLANK = np.zeros(256, dtype=bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_TABLES = tuple(mixed(np.arange(1, 257, dtype=np.uint64) * odd) for odd in _ODD)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(kind: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2**64, and of its inverse."""
    if kind not in _POWERS or len(_POWERS[kind][0]) < n:
        up, down = np.full(n, _ODD[kind]), np.full(n, np.uint64(pow(int(_ODD[kind]), -1, 2**64)))
        up[0] = down[0] = 1
        _POWERS[kind] = np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)
    return _POWERS[kind]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and where each begins and the last ends; null texts are empty."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    bytes_ = np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, dtype=np.uint8)
    return bytes_[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and for each text the number of its first word (one more at the end)."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    word = ~BLANK[data]
    opens, closes = word.copy(), word.copy()
    opens[1:] &= ~word[:-1]
    closes[:-1] &= ~word[1:]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    opens[inner] = word[inner]
    closes[inner - 1] = word[inner - 1]
    starts = np.flatnonzero(opens)
    return starts, np.flatnonzero(closes) + 1, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, kind: int = 0) -> np.ndarray:
    out, i = np.empty(len(starts), dtype=np.uint64), 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + BLOCK, "right")))
        low, n = starts[i], int(ends[j - 1] - starts[i])
        up, down = _powers(kind, max(n, BLOCK))
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(_TABLES[kind][data[low : low + n]] * up[:n], out=sums[1:])
        s, e = starts[i:j] - low, ends[i:j] - low
        out[i:j] = mixed((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64))
        i = j
    return out


def pieces(batch: pa.RecordBatch, size: int = 2 * BLOCK, texts: tuple[str, ...] = ("text",)) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about ``size`` bytes of text, so that numpy's arrays stay small."""
    ends = sum(np.cumsum(np.diff(text_bytes(batch.column(t))[1])) for t in texts)
    i = 0
    while i < batch.num_rows:
        done = ends[i - 1] if i else 0
        j = max(i + 1, int(np.searchsorted(ends, done + size, "right")))
        yield batch.slice(i, j - i)
        i = j


def groups(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[pa.Table]:
    """Whole groups of equal keys, one after the other, of batches sorted by them; each in one chunk."""
    rest: pa.Table | None = None
    for batch in batches:
        rest = pa.concat_tables([*([rest] if rest is not None else []), pa.Table.from_batches([batch])])
        values = [rest.column(k).to_numpy() for k in keys]
        new = np.logical_or.reduce([v[1:] != v[:-1] for v in values]) if rest.num_rows > 1 else np.zeros(0, dtype=bool)
        starts = np.concatenate([[0], np.flatnonzero(new) + 1])
        for i, j in zip(starts[:-1], starts[1:], strict=True):
            yield rest.slice(i, j - i).combine_chunks()
        rest = rest.slice(starts[-1])
    if rest is not None and rest.num_rows:
        yield rest.combine_chunks()


def doc_words(column: pa.Array, lower: bool = False, kind: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts in order, and for each text the number of its first word (one more at the end)."""
    data, offsets = text_bytes(column)
    if lower:
        data = LOWER[data]
    starts, ends, firsts = word_bounds(data, offsets)
    return word_hashes(data, starts, ends, kind), firsts


def runs_of(words: np.ndarray, firsts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of k words inside one text, and the number of its first word."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    acc = np.zeros(n, dtype=np.uint64)
    for j in range(k):
        acc = mixed(acc * np.uint64(0xC2B2AE3D27D4EB4F) + words[j : j + n])
    owner = np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))
    at = np.flatnonzero(owner[:n] == owner[k - 1 :])
    return acc[at], at


def shingle_sets(column: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hash) of each text's distinct k-word shingles, sorted; a shorter text is one shingle."""
    words, firsts = doc_words(column, lower=True)
    hashes, at = runs_of(words, firsts, k)
    docs = np.searchsorted(firsts, at, "right") - 1
    counts = np.diff(firsts)
    for m in range(1, k):
        short = np.flatnonzero(counts == m)
        acc = np.full(len(short), m, dtype=np.uint64)
        for j in range(m):
            acc = mixed(acc * np.uint64(0xC2B2AE3D27D4EB4F) + words[firsts[short] + j])
        hashes, docs = np.concatenate([hashes, acc]), np.concatenate([docs, short])
    order = np.lexsort((hashes, docs))
    hashes, docs = hashes[order], docs[order]
    new = np.ones(len(hashes), dtype=bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (docs[1:] != docs[:-1])
    return docs[new], hashes[new]
