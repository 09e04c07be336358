"""Whitening of embeddings by Jacobi-Davidson.

The covariance of the vectors is never formed. All that is asked of Spark is
its product with a block of a few vectors: each task centres its rows, before
anything is multiplied, and adds up its share; the shares are summed in a tree.
With that product alone the leading eigenpairs are found on the driver, where
nothing is larger than the dimensions times the size of the search space:

1. Rayleigh-Ritz in the search space gives the best pairs that it holds.
2. Pairs whose residual is as small as double precision allows are locked, the
   largest first, and the search goes on orthogonal to them.
3. For the other pairs the correction equation, projected to what is
   orthogonal to all of them, is solved by a few steps of MINRES. All pairs
   take their steps together, so a step is one pass over the vectors.
4. The corrections enlarge the search space; where it grows too large it
   starts again from its best vectors.
5. At the end the residuals are measured anew with fresh products.

Entries are whole numbers x = floor(1024 * c) + 100000. Sums are exact, and
x - S/n is taken as (x - q) - r/n with S = q*n + r, so that nothing cancels.

Defined cases: vectors that are null, empty, or hold null or non-finite
entries take no part, nor do those whose length is not the most frequent one
(the longer of two as frequent); equal rows count as often as they come; null
ids stay null; components whose variance is zero to double precision are left
out (all of them for a single vector); an empty table gives no rows; other
columns are ignored. Entries beyond 2 ** 42 are an error. A deviation that 64
bits do not hold is null.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

COMPONENTS = 8
SCALE, OFFSET = 1024, 100_000
LARGEST = float(1 << 42)
#: Rows that a task works on at once.
ROWS = 4096
#: Shares of tasks that are added up in one place, and bytes of them.
FAN, FAN_BYTES = 256, 32 << 20
#: MINRES steps of a correction, and what they must gain to stop earlier.
INNER_STEPS, INNER_GAIN = 6, 1e-3
#: Search spaces of more vectors than this times the pairs asked for restart.
SPACE = 5
MOST_ROUNDS = 300
EPS = float(np.finfo(np.float64).eps)


def whole_vectors(embeddings: DataFrame, vector: str = "embedding") -> DataFrame:
    """vec_id, x (array<long>) of the vectors that take part, as a table."""
    v = F.col(f"`{vector}`").cast("array<double>")
    d = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
    d = d.where((F.size("v") > 0) & ~F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == math.inf)))
    size = d.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    d = d.where(F.size("v") == (size["size"] if size else 0))

    def whole(c):
        x = F.floor(c * SCALE) + F.lit(OFFSET)
        return F.when(F.abs(c) <= LARGEST, x).otherwise(F.raise_error(F.lit("an entry of a vector is beyond 2 ** 42")).cast("long"))

    return cut(d.select("vec_id", F.transform("v", whole).alias("x")), "whole-vectors")


def _rows(column: pa.Array, d: int) -> Iterator[np.ndarray]:
    """Vectors of a batch as arrays of rows."""
    x = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
    for i in range(0, len(x), ROWS):
        yield x[i : i + ROWS]


def summed(vectors: DataFrame, d: int, share: Callable[[np.ndarray], np.ndarray], kind: type = np.float64) -> np.ndarray | None:
    """The sum of ``share(rows)`` over all rows; None without rows. Shares of
    one task are added up there, those of many tasks in a tree."""
    array = "array<long>" if kind is np.int64 else "array<double>"

    def sum_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            for x in _rows(b["x"], d):
                s = np.asarray(share(x), kind).ravel()
                total = s if total is None else total + s
        if total is not None:
            yield pa.RecordBatch.from_pydict({"share": [total]})

    def sum_shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            for s in b["share"]:
                s = s.values.to_numpy()
                total = s if total is None else total + s
        if total is not None:
            yield pa.RecordBatch.from_pydict({"share": [total]})

    shares = vectors.select("x").mapInArrow(sum_rows, f"share {array}")
    tasks = vectors.rdd.getNumPartitions()
    size = 8 * np.asarray(share(np.zeros((1, d), np.int64))).size
    while tasks > FAN and tasks * size > FAN_BYTES:
        tasks = -(-tasks // FAN)
        shares = shares.repartition(tasks).mapInArrow(sum_shares, f"share {array}")
    found = [np.asarray(r["share"], kind) for r in shares.collect()]
    return np.sum(found, axis=0, dtype=kind) if found else None


@dataclass
class Whitening:
    """n vectors of sums ``sums``; variances and unit directions (columns) of
    the components, and the sum of all variances."""

    n: int
    sums: np.ndarray
    trace: float
    values: np.ndarray
    directions: np.ndarray

    def centred(self, x: np.ndarray) -> np.ndarray:
        q, r = np.divmod(self.sums, self.n)
        return (x - q) - r / self.n

    def project(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.directions / np.sqrt(self.values))

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sums of (n * x - S) ** 2, exact."""
        q, r = np.divmod(self.sums, self.n)
        d = x - q
        widest = int(np.abs(d).max(initial=0)) + 1
        if (self.n * widest) ** 2 * d.shape[1] < 1 << 63:
            return ((self.n * d - r) ** 2).sum(axis=1).tolist()
        whole = [sum((self.n * a - b) ** 2 for a, b in zip(row, r.tolist())) for row in d.tolist()]
        return [w if w < 1 << 63 else None for w in whole]


def _orthonormal(new: np.ndarray, *against: np.ndarray) -> np.ndarray:
    """Columns of ``new`` made orthonormal, to ``against`` too; those that lie
    in the others' span are left out."""
    kept: list[np.ndarray] = []
    for v in new.T:
        size = np.linalg.norm(v)
        if size == 0:
            continue
        v = v / size
        for _ in range(3):
            for a in against:
                v = v - a @ (a.T @ v)
            for k in kept:
                v = v - k * (k @ v)
        size = np.linalg.norm(v)
        if size > 1e-8:
            kept.append(v / size)
    return np.array(kept).T if kept else np.empty((new.shape[0], 0))


def minres(product: Callable[[np.ndarray], np.ndarray], b: np.ndarray, steps: int, gain: float) -> np.ndarray:
    """Solves ``product(x) = b`` column by column, all columns a step at a
    time, by symmetric Lanczos and rotations."""
    x, v_last, w_last, w = (np.zeros_like(b) for _ in range(4))
    beta = np.linalg.norm(b, axis=0)
    least = gain * beta
    live = beta > 0
    v = np.divide(b, beta, out=np.zeros_like(b), where=live)
    rest, beta = beta.copy(), np.zeros_like(beta)
    c_last, c, s_last, s = np.ones_like(beta), np.ones_like(beta), np.zeros_like(beta), np.zeros_like(beta)
    for _ in range(steps):
        z = product(v)
        alpha = (v * z).sum(axis=0)
        z = z - alpha * v - beta * v_last
        beta_next = np.linalg.norm(z, axis=0)
        front = c * alpha - c_last * s * beta
        one = np.hypot(front, beta_next)
        two, three = s * alpha + c_last * c * beta, s_last * beta
        live &= one > 0
        safe = np.where(live, one, 1.0)
        c_last, c, s_last, s = c, front / safe, s, beta_next / safe
        w_last, w = w, np.where(live, (v - three * w_last - two * w) / safe, 0.0)
        x += np.where(live, c * rest, 0.0) * w
        rest = np.where(live, -s * rest, 0.0)
        if not (np.abs(rest) > least).any():
            break
        live &= beta_next > 0
        v_last, v, beta = v, np.divide(z, beta_next, out=np.zeros_like(z), where=live), beta_next
    return x


def leading_pairs(product: Callable[[np.ndarray], np.ndarray], d: int, wanted: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues, falling, and unit eigenvectors
    (columns) of the symmetric operator ``product`` of d dimensions."""
    least = max(d, 32) * EPS
    space = _orthonormal(np.random.default_rng(seed).standard_normal((d, min(d, wanted + 4))))
    image = product(space)
    locked, found = np.empty((d, 0)), []
    for _ in range(MOST_ROUNDS):
        h = space.T @ image
        theta, turn = np.linalg.eigh((h + h.T) / 2)
        theta, turn = theta[::-1], turn[:, ::-1]
        space, image = space @ turn, image @ turn
        left = wanted - locked.shape[1]
        r = image[:, :left] - space[:, :left] * theta[:left]
        r -= locked @ (locked.T @ r)
        small = np.linalg.norm(r, axis=0) <= least * max(abs(theta[0]), *found, 0.0)
        full = locked.shape[1] + space.shape[1] == d
        ready = left if full else int(np.argmin(small)) if not small.all() else left
        if ready:
            locked = np.hstack([locked, space[:, :ready]])
            found += theta[:ready].tolist()
            space, image, theta, r = space[:, ready:], image[:, ready:], theta[ready:], r[:, ready:]
        if locked.shape[1] >= wanted:
            fresh = product(locked)
            h = locked.T @ fresh
            theta, turn = np.linalg.eigh((h + h.T) / 2)
            theta, turn = theta[::-1], turn[:, ::-1]
            space, image = locked @ turn, fresh @ turn
            if full or (np.linalg.norm(image - space * theta, axis=0) <= 4 * least * abs(theta[0])).all():
                return theta, space
            locked, found = np.empty((d, 0)), []
            continue
        n = min(wanted - locked.shape[1], space.shape[1])
        held = np.hstack([locked, space[:, :n]])

        def corrected(v: np.ndarray, held=held, theta=theta[:n]) -> np.ndarray:
            v = product(v) - v * theta
            return v - held @ (held.T @ v)

        b = -(r[:, :n] - held @ (held.T @ r[:, :n]))
        new = minres(corrected, b, INNER_STEPS, INNER_GAIN)
        most = max(SPACE * wanted, 2 * n + wanted)
        if space.shape[1] + n > most:
            space, image = space[:, : n + wanted], image[:, : n + wanted]
        new = _orthonormal(np.hstack([new, b]) if new.shape[1] < n else new, locked, space)
        if not new.shape[1]:
            new = _orthonormal(np.random.default_rng(seed + 1 + locked.shape[1]).standard_normal((d, min(2, d - held.shape[1]))), locked, space)
        space, image = np.hstack([space, new]), np.hstack([image, product(new)])
    raise RuntimeError("the residuals did not become small")


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of ``whole_vectors``; None if there are none."""
    first = vectors.first()
    if first is None:
        return None
    d = len(first["x"])
    total = summed(vectors, d, lambda x: np.concatenate([[len(x)], x.sum(axis=0)]), np.int64)
    w = Whitening(int(total[0]), total[1:], 0.0, np.empty(0), np.empty((d, 0)))
    w.trace = float(summed(vectors, d, lambda x: np.square(w.centred(x)).sum())[0]) / w.n

    def product(block: np.ndarray) -> np.ndarray:
        def share(x: np.ndarray) -> np.ndarray:
            y = w.centred(x)
            return y.T @ (y @ block)

        return summed(vectors, d, share).reshape(d, -1) / w.n

    if w.trace > 0:
        values, directions = leading_pairs(product, d, min(components, d))
        real = values > 16 * d * EPS * values[0]
        w.values, w.directions = values[real], directions[:, real]
    return w


def identity_error(vectors: DataFrame, w: Whitening) -> float:
    """The largest absolute entry of the whitened vectors' covariance minus
    the identity, over all of them."""
    d, k = w.directions.shape
    mean = summed(vectors, d, lambda x: w.project(x).sum(axis=0)) / w.n

    def share(x: np.ndarray) -> np.ndarray:
        z = w.project(x) - mean
        return z.T @ z

    return float(np.abs(summed(vectors, d, share).reshape(k, k) / w.n - np.eye(k)).max())


WHITENED = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, w: Whitening | None) -> DataFrame:
    """A row per vector and component: its deviation, its whitened value, the
    component's share of all variance, and the covariance's error."""
    if w is None or not len(w.values):
        return vectors.sparkSession.createDataFrame([], WHITENED)
    d, k = w.directions.shape
    error, explained = identity_error(vectors, w), w.values / w.trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = 0
            for x in _rows(b["x"], d):
                ids = b["vec_id"].slice(at, len(x))
                at, m = at + len(x), len(x)
                each = np.repeat(np.arange(m), k)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, w.n)),
                        pa.array(w.deviation(x), pa.int64()).take(pa.array(each)), pa.array(w.project(x).ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error)),
                    ],
                    names=[f.split()[0] for f in WHITENED.split(", ")],
                )

    return vectors.select("vec_id", "x").mapInArrow(run, WHITENED)


def whiten_embeddings(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    vectors = whole_vectors(embeddings)
    return whiten(vectors, fit(vectors, components))
