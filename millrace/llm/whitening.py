"""Embedding whitening: leading eigenvectors of a covariance by Jacobi-Davidson, whose products are Spark jobs.

The covariance is never formed. The driver holds a search space of a few vectors; each product of the covariance with them is one
pass over the fit list, centred row by row, whose sums a grouping adds up.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.frames import saved

#: Numbers in one block of the fit list.
BLOCK = 1 << 17
#: Entries of this size and more are not told apart by a double.
LARGEST = float(1 << 53)
#: Guard vectors beside the wanted ones, columns of the search space, inner steps of one correction, outer steps.
GUARDS, SPACE, INNER, OUTER = 12, 64, 12, 200

Product = Callable[[np.ndarray], np.ndarray]


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors as blocks of one length: rows, and their whole numbers in the smallest type that holds them."""
    for batch in batches:
        x = batch.column("x")
        sizes = np.asarray(x.value_lengths())
        for length in np.unique(sizes):
            rows = x.filter(pa.array(sizes == length)).flatten().to_numpy().reshape(-1, length)
            step = max(1, BLOCK // int(length))
            for i in range(0, len(rows), step):
                part = rows[i : i + step]
                kind = next(t for t in (np.int16, np.int32, np.int64) if np.abs(part).max() <= np.iinfo(t).max)
                yield pa.RecordBatch.from_pydict({"length": [int(length)], "rows": [len(part)], "data": [part.astype(kind).tobytes()]})


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for batch in batches:
        for rows, length, data in zip(*(batch.column(c).to_pylist() for c in ("rows", "length", "data")), strict=True):
            yield np.frombuffer(data, dtype=f"i{len(data) // (rows * length)}").reshape(rows, length)


def _summed(blocks: DataFrame, partial: Callable[[np.ndarray], np.ndarray], columns: int) -> np.ndarray:
    """The sum of ``partial`` (a table of the given columns) over all blocks: per task first, then by row of the table."""
    names = [f"c{i}" for i in range(columns)]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for block in _blocks(batches):
            part = partial(block)
            total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(total))), *(pa.array(np.ascontiguousarray(c)) for c in total.T)], ["at", *names])

    sums = blocks.mapInArrow(add, ", ".join(["at long", *(f"{c} double" for c in names)])).groupBy("at").agg(
        *[F.sum(c).alias(c) for c in names])
    return np.array([r[1:] for r in sorted(sums.collect())], dtype=np.float64)


def _exact_sums(blocks: DataFrame) -> list[int]:
    """Sums of the entries by place, as whole numbers: the upper and the lower half of each entry apart."""

    def halves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            wide = block.astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(wide.shape[1])), pa.array((wide >> 27).sum(axis=0)),
                                              pa.array((wide & (1 << 27) - 1).sum(axis=0))], ["at", "high", "low"])

    found = blocks.mapInArrow(halves, "at long, high long, low long").groupBy("at").agg(
        *[F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low")])
    return [(int(r.high) << 27) + int(r.low) for r in sorted(found.collect())]


def _minres(product: Product, shifts: np.ndarray, fixed: np.ndarray, own: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Solves (1 - P)(A - shift)(1 - P) t = right for each column at once, P on the fixed vectors and the column's own one.

    Paige and Saunders' method: Lanczos vectors, their band matrix made triangular by rotations. All columns share a product;
    one that has come down to a hundredth, or ends early, stays as it is.
    """

    def project(x: np.ndarray) -> np.ndarray:
        for _ in range(2):
            x = x - fixed @ (fixed.T @ x) - own * (own * x).sum(axis=0)
        return x

    right = project(right)
    beta = first = np.linalg.norm(right, axis=0)
    found, old, new = np.zeros_like(right), np.zeros_like(right), right / np.where(beta > 0, beta, 1)
    ways = np.zeros((2, *right.shape))
    cos, sin = np.array([np.ones_like(beta), np.ones_like(beta)]), np.zeros((2, len(beta)))
    left, live, before = first.copy(), first > 0, np.zeros_like(beta)
    for _ in range(INNER):
        if not live.any():
            break
        step = project(product(new) - shifts * new)
        alpha = (new * step).sum(axis=0)
        step = step - alpha * new - before * old
        after = np.linalg.norm(step, axis=0)
        # The band's column, turned by the two rotations before and by a new one.
        far, near = sin[0] * before, cos[0] * before
        upper, middle = cos[1] * near + sin[1] * alpha, cos[1] * alpha - sin[1] * near
        lower = np.hypot(middle, after)
        live &= lower > 1e-300
        safe = np.where(lower > 1e-300, lower, 1)
        c, s = middle / safe, after / safe
        way = (new - upper * ways[1] - far * ways[0]) / safe
        found = np.where(live, found + c * left * way, found)
        left = np.where(live, -s * left, left)
        ways, cos, sin = np.array([ways[1], way]), np.array([cos[1], c]), np.array([sin[1], s])
        live &= (np.abs(left) > 0.01 * first) & (after > 1e-14 * np.abs(alpha))
        old, new, before = new, step / np.where(after > 0, after, 1), after
    return project(found)


def _orthogonal(new: np.ndarray, to: np.ndarray) -> np.ndarray:
    """An orthonormal base of what the new vectors add to others; vectors that add nothing drop out."""
    out = np.zeros((len(new), 0))
    for column in new.T:
        size = np.linalg.norm(column)
        if not size > 0:
            continue
        column = column / size
        for _ in range(3):
            for base in (to, out):
                column = column - base @ (base.T @ column)
            size = np.linalg.norm(column)
            if size < 1e-10:
                break
            column = column / size
        else:
            out = np.column_stack([out, column])
    return out


def leading_eigenpairs(product: Product, length: int, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues and their unit eigenvectors (columns) of a symmetric, non-negative operator.

    Jacobi-Davidson: Ritz pairs of a search space, residuals, corrections orthogonal to the pair and to the locked ones by a
    few MINRES steps, all columns in one product. A pair is locked when its residual has reached the rounding of
    double precision, in falling order; the space is cut to its best vectors when it is full.
    """
    wanted = min(wanted, length)
    active = min(length, wanted + GUARDS)
    rounding = 4 * np.finfo(float).eps * np.sqrt(length)
    space = _orthogonal(np.random.default_rng(7).normal(size=(length, active)), np.zeros((length, 0)))
    image = product(space)
    locked, values, best, stale = np.zeros((length, 0)), [], np.inf, 0
    for _ in range(OUTER):
        small = space.T @ image
        theta, turn = np.linalg.eigh((small + small.T) / 2)
        theta, turn = theta[::-1], turn[:, ::-1]
        vectors, images = space @ turn, image @ turn
        top = max([*values[:1], theta[0] if len(theta) else 0.0, 0.0])
        apart = images - vectors * theta
        apart = apart - locked @ (locked.T @ apart)
        residuals = np.linalg.norm(apart, axis=0)
        done, full = 0, locked.shape[1] + space.shape[1] >= length
        while done < len(theta) and len(values) + done < wanted and (residuals[done] <= rounding * top or full or top == 0):
            done += 1
        if done == 0 and residuals[0] <= 1e3 * rounding * top and stale >= 4:
            done = 1  # rounding in the products keeps it where it is
        if done:
            locked = np.column_stack([locked, vectors[:, :done]])
            values += list(theta[:done])
            vectors, images, theta, apart = vectors[:, done:], images[:, done:], theta[done:], apart[:, done:]
            best, stale = np.inf, 0
            if len(values) >= wanted:
                order = np.argsort(values)[::-1]
                return np.array(values)[order], locked[:, order]
        else:
            best, stale = (residuals[0], 0) if residuals[0] < best / 2 else (best, stale + 1)
        if vectors.shape[1] + active > min(SPACE, length):
            keep = max(1, min(vectors.shape[1], 2 * active))
            vectors, images = vectors[:, :keep], images[:, :keep]
        now = min(active, vectors.shape[1])
        more = _minres(product, theta[:now], locked, vectors[:, :now], -apart[:, :now])
        more = _orthogonal(more, np.column_stack([locked, vectors]))
        if not more.shape[1]:
            more = _orthogonal(np.random.default_rng(len(values)).normal(size=(length, 1)), np.column_stack([locked, vectors]))
        more = more[:, : max(0, length - locked.shape[1] - vectors.shape[1])]
        space = np.column_stack([vectors, more])
        image = np.column_stack([images, product(more)]) if more.shape[1] else images
    raise RuntimeError(f"no {wanted} eigenpairs of double precision after {OUTER} steps")


def whiten_embeddings(
    vectors: DataFrame, components: int = 4, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """Every sound vector on the leading principal components of the distinct ones, with unit variance.

    Entries become the whole number floor(scale * entry). The fit list holds each distinct vector once; its covariance V
    (divisor n, centred first) is only ever multiplied with a few vectors, a Spark job each. Components are unit
    eigenvectors of V to double precision, by falling eigenvalue; those without variance are left out.
    Returns vid, length, n (fit list), deviation (decimal: sum of (n * x - S)**2 over the places, exact; null beyond 38 digits), and
    whitened (array, a value per component), explained (array: share of the trace) and identity_error (largest entry of the
    whitened fit list's covariance beside the identity).
    Rows whose vector is null, empty, or holds null, non-finite or unmeasurable entries (2**53 or more after scaling) are left
    out; null and repeated ids count as rows; vectors of unlike lengths are fitted apart; other columns are left aside;
    an empty table gives an empty frame.
    """
    raw = vectors.select(F.col(id_col).cast("long").alias("vid"), F.col(vector_col).cast("array<double>").alias("v"))
    sound = (F.size("v") > 0) & F.forall("v", lambda c: c.isNotNull() & (F.abs(c * float(scale)) < LARGEST))
    rows = raw.where(F.coalesce(sound, F.lit(False))).select("vid", F.transform("v", lambda c: F.floor(c * float(scale))).alias("x"))
    blocks = saved(rows.select("x").distinct().mapInArrow(_packed, "length long, rows long, data binary"), "fit-list")
    found = None
    for length, n in blocks.groupBy("length").agg(F.sum("rows")).collect():
        one = _whitened(rows.where(F.size("x") == length), blocks.where(F.col("length") == length), length, n, components)
        found = one if found is None else found.unionAll(one)
    return vectors.sparkSession.createDataFrame([], WHITENED) if found is None else found


WHITENED = ("vid long, length long, n long, deviation decimal(38,0), whitened array<double>, explained array<double>, "
            "identity_error double")


def _whitened(rows: DataFrame, blocks: DataFrame, length: int, n: int, components: int) -> DataFrame:
    sums = _exact_sums(blocks)
    mean = np.array([float(Fraction(s, n)) for s in sums])

    def product(basis: np.ndarray) -> np.ndarray:
        def partial(block: np.ndarray) -> np.ndarray:
            centred = block - mean
            return centred.T @ (centred @ basis)

        return _summed(blocks, partial, basis.shape[1]) / n

    values, base = leading_eigenpairs(product, length, components)
    squares = _summed(blocks, lambda block: ((block - mean) ** 2).sum(axis=0)[:, None], 1)
    trace = float(squares.sum()) / n
    some = values > length * np.finfo(float).eps * trace
    values, base = values[some], base[:, some]
    turn = base / np.sqrt(values)

    def moments(block: np.ndarray) -> np.ndarray:
        white = np.column_stack([(block - mean) @ turn, np.ones(len(block))])
        return white.T @ white

    error = 0.0
    if len(values):
        table = _summed(blocks, moments, len(values) + 1) / n
        error = float(np.abs(table[:-1, :-1] - np.outer(table[-1, :-1], table[-1, :-1]) - np.eye(len(values))).max())

    def white(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x").flatten().to_numpy().reshape(batch.num_rows, length)
            flat = pa.array(((x - mean) @ turn).ravel())
            offsets = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * len(values))
            yield pa.RecordBatch.from_pydict({"vid": batch.column("vid"), "deviation": _deviations(x, n, sums),
                                              "whitened": pa.ListArray.from_arrays(offsets, flat)})

    told = rows.mapInArrow(white, "vid long, deviation decimal(38,0), whitened array<double>")
    return told.select(
        "vid", F.lit(length).cast("long").alias("length"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.lit((values / trace if trace else values).tolist()).cast("array<double>").alias("explained"),
        F.lit(error).alias("identity_error"))


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> pa.Array:
    """Exact sums of squares of n * x - S: in 64 bits where they fit, else as whole numbers of any size."""
    largest = n * int(np.abs(x).max(initial=0)) + max(map(abs, sums))
    if largest**2 * len(sums) < 1 << 63:
        apart = n * x.astype(np.int64) - np.array(sums, dtype=np.int64)
        return pa.array((apart * apart).sum(axis=1)).cast(pa.decimal128(38, 0))
    exact = ((n * x.astype(object) - np.array(sums, dtype=object)) ** 2).sum(axis=1)
    return pa.array([Decimal(int(v)) if v < 10**38 else None for v in exact], pa.decimal128(38, 0))
