"""Approximate nearest neighbours by multi-index hashing.

Vectors are lengthened by one coordinate that makes all lengths equal, so that
the largest inner product is the smallest angle. Learned rotations (principal
axes, then iterative quantisation, from several starts if more bits than axes
are asked for) turn each into a binary code, whose signs are split into
substrings of 8 bits; each substring has an index of its own.

A search widens a Hamming radius. By the pigeonhole principle a code within
m * (d + 1) - 1 bits of the query's, over m substrings, agrees with it to d
bits in some substring; so probing all values within d bits in every index
finds each such code. It stops at the radius that holds a number of codes,
takes every code within it, and reranks them by inner products of the original
vectors in double precision. A block finds that number by itself: it compares
``PROBE_QUERIES`` of its queries with all its vectors and takes the number by
which ``recall`` of their true neighbours is found, ``candidates`` at least and
the whole block if need be.

Spark deals the vectors to blocks of about ``block_rows`` by a hash of vec_id
and the queries to groups; a task indexes one block and answers one group, and
a window keeps each query's best over all blocks. In a block, vectors of like
length have an index of their own and are lengthened to the longest of these,
so that a few long vectors do not push the others together. Queries have no
added coordinate: theirs is the mean. Rotations are fitted on the
``sample_rows`` first vectors by hash, a documented bound; all vectors are
indexed.

Defined cases: vectors that are null, zero, hold null or non-finite numbers,
or have another length than most (the shorter of equally common ones) take no
part, nor do rows without vec_id; rows of equal vec_id count as one, with the
first of their vectors in order of value; ties go to the smaller vec_id;
fewer candidates than asked for give fewer rows; an empty table gives none;
other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut

BITS = 128
SUBSTRING = 8
CANDIDATES = 480
RECALL = 0.95
PROBE_QUERIES = 128
RANGE_RATIO = 1.5
BLOCK_ROWS = 8192
GROUP_ROWS = 8192
SAMPLE_ROWS = 10_000
RESULT = "query_id long, vec_id long, score double"


def lengthen(x: np.ndarray, longest: float) -> np.ndarray:
    """Unit-length rows: x / longest and what is missing to 1."""
    x = x / longest
    return np.hstack([x, np.sqrt(np.maximum(0.0, 1.0 - (x * x).sum(axis=1, keepdims=True)))])


def norm_ranges(x: np.ndarray, ratio: float = RANGE_RATIO) -> list[np.ndarray]:
    """Row numbers by length: in a range the longest has at most ``ratio``
    times the length of the shortest."""
    norms = np.sqrt((x * x).sum(axis=1))
    order = np.argsort(-norms, kind="stable")
    falling, out, i = -norms[order], [], 0
    while i < len(order):
        j = max(i + 1, int(np.searchsorted(falling, falling[i] / ratio, side="right")))
        out.append(np.sort(order[i:j]))
        i = j
    return out


def lengthen_ranges(x: np.ndarray, ranges: list[np.ndarray]) -> np.ndarray:
    """Rows lengthened to the longest of their range."""
    out = np.empty((len(x), x.shape[1] + 1))
    for rows in ranges:
        part = x[rows]
        out[rows] = lengthen(part, float(np.sqrt((part * part).sum(axis=1).max())))
    return out


def enough(codes: np.ndarray, asks: np.ndarray, near: np.ndarray, recall: float) -> int:
    """How many codes a ball must hold at least, so that ``recall`` of the
    neighbours lies within. near: (row of asks, row of codes) of each."""
    words, other = np.ascontiguousarray(codes).view("<u8"), np.ascontiguousarray(asks).view("<u8")
    need = []
    for a in np.unique(near[:, 0]):
        far = np.bitwise_count(words ^ other[a]).sum(axis=1)
        need.append(np.searchsorted(np.sort(far), far[near[near[:, 0] == a, 1]]) + 1)
    need = np.sort(np.concatenate(need)) if need else np.zeros(1, np.int64)
    return int(need[max(0, int(np.ceil(recall * len(need))) - 1)])


def learn_rotation(x: np.ndarray, bits: int = BITS, rounds: int = 30, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Mean and a matrix to ``bits`` columns whose signs are the code."""
    rng, mean = np.random.default_rng(seed), x.mean(axis=0)
    x = x - mean
    values, axes = np.linalg.eigh(x.T @ x / len(x))
    axes = axes[:, np.argsort(-values)][:, : min(bits, x.shape[1], max(1, int((values > 1e-9 * values.max()).sum())))]
    z, out = x @ axes, []
    while sum(r.shape[1] for r in out) < bits:
        r = np.linalg.qr(rng.standard_normal((axes.shape[1], axes.shape[1])))[0]
        for _ in range(rounds):
            u, _, vt = np.linalg.svd(np.where(z @ r >= 0, 1.0, -1.0).T @ z)
            r = (u @ vt).T
        out.append(axes @ r)
    return mean, np.hstack(out)[:, :bits]


def binary_codes(x: np.ndarray, mean: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """Codes as rows of bytes; a byte is a substring."""
    return np.packbits((x - mean) @ matrix >= 0, axis=1)


class MultiIndex:
    """Substring indexes over some codes."""

    #: Substrings' differences by number of bits.
    PROBES = [np.flatnonzero(np.bitwise_count(np.arange(256, dtype=np.uint8)) == d) for d in range(SUBSTRING + 1)]

    def __init__(self, codes: np.ndarray):
        self.codes, self.words = codes, np.ascontiguousarray(codes).view("<u8")
        n, self.m = codes.shape
        self.order = np.concatenate([np.argsort(codes[:, t], kind="stable") for t in range(self.m)])
        ends = np.concatenate([t * n + np.concatenate([[0], np.cumsum(np.bincount(codes[:, t], minlength=256))]) for t in range(self.m)])
        self.first = ends.reshape(self.m, 257)

    def within(self, code: np.ndarray, least: int) -> np.ndarray:
        """Every code in the smallest Hamming ball that holds ``least`` codes."""
        n = len(self.codes)
        seen, far = np.zeros(n, bool), np.full(n, self.m * SUBSTRING + 1, np.int16)
        words, table = code.view("<u8"), np.arange(self.m)[:, None]
        for d in range(SUBSTRING + 1):
            value = code[:, None].astype(np.int64) ^ self.PROBES[d]
            a, b = self.first[table, value].ravel(), self.first[table, value + 1].ravel()
            size = b - a
            found = self.order[np.arange(size.sum()) + np.repeat(a - (np.cumsum(size) - size), size)]
            fresh = np.zeros(n, bool)
            fresh[found] = True
            fresh &= ~seen
            new = np.flatnonzero(fresh)
            seen |= fresh
            far[new] = np.bitwise_count(self.words[new] ^ words).sum(axis=1)
            radius = self.m * (d + 1) - 1
            counts = np.cumsum(np.bincount(far[seen], minlength=self.m * SUBSTRING + 2))
            if counts[min(radius, len(counts) - 1)] >= min(least, n):
                return np.flatnonzero(far <= int(np.searchsorted(counts, min(least, n))))
        return np.arange(n)


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, embedding of the vectors that take part."""
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("embedding", lambda x: x != 0)
    v = v.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & fine)
    v = v.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    common = v.groupBy(F.size("embedding").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    return v.where(F.size("embedding") == (common["dim"] if common else 0))


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, candidates: int = CANDIDATES, recall: float = RECALL, bits: int = BITS, block_rows: int = BLOCK_ROWS, group_rows: int = GROUP_ROWS, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score. ``queries`` has a column vec_id: which of
    ``vectors`` ask."""
    spark = vectors.sparkSession
    v = cut(usable(vectors), "mih-vectors")
    q = cut(v.join(queries.select(F.col("vec_id").cast("long").alias("q")).distinct(), F.col("vec_id") == F.col("q"), "left_semi"), "mih-queries")
    n, asked = v.count(), q.count()
    blocks, groups = max(1, -(-n // block_rows)), max(1, -(-asked // group_rows))
    sample = v.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample_rows).select("embedding").toPandas()
    if not len(sample):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    first = np.stack(sample["embedding"].to_numpy())
    mean, matrix = learn_rotation(lengthen_ranges(first, norm_ranges(first)), bits)

    def answer(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})
        ids, x = left["vec_id"].to_numpy(), np.stack(left["embedding"].to_numpy())
        asks, y = right["vec_id"].to_numpy(), np.stack(right["embedding"].to_numpy())
        ranges, longest = norm_ranges(x), np.sqrt((x * x).sum(axis=1).max())
        codes = binary_codes(lengthen_ranges(x, ranges), mean, matrix)
        unit = np.hstack([y / np.sqrt((y * y).sum(axis=1, keepdims=True)), np.full((len(y), 1), mean[-1])])
        ask_codes = binary_codes(unit, mean, matrix)
        probes = np.unique(np.linspace(0, len(asks) - 1, min(len(asks), PROBE_QUERIES)).astype(np.int64))
        scores = np.where(ids == asks[probes, None], -np.inf, y[probes] @ x.T)
        true = np.argsort(-scores, axis=1, kind="stable")[:, :k]
        parts = []
        for rows in ranges:
            place = np.full(len(x), -1)
            place[rows] = np.arange(len(rows))
            at = place[true]
            p, j = np.nonzero(at >= 0)
            # One more, as a query may find itself.
            least = max(candidates, enough(codes[rows], ask_codes[probes], np.stack([p, at[p, j]], axis=1), recall)) + 1
            parts.append((rows, MultiIndex(codes[rows]) if least < len(rows) else None, least))
        q_out, v_out, s_out = [], [], []
        for ask, code, vector in zip(asks, ask_codes, y):
            near = np.concatenate([rows if index is None else rows[index.within(code, least)] for rows, index, least in parts])
            near = near[ids[near] != ask]
            # A product of matrices may round equal rows apart, by their places.
            # So it only picks, with a margin, and each row is summed by itself.
            rough = x[near] @ vector
            if len(near) > k:
                near = near[rough >= np.partition(rough, len(near) - k)[len(near) - k] - 1e-10 * longest * np.sqrt(vector @ vector)]
            score = (x[near] * vector).sum(axis=1)
            best = np.lexsort((ids[near], -score))[:k]
            q_out.append(np.full(len(best), ask))
            v_out.append(ids[near[best]])
            s_out.append(score[best])
        return pd.DataFrame({"query_id": np.concatenate(q_out), "vec_id": np.concatenate(v_out), "score": np.concatenate(s_out)})

    numbers = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    left = v.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")).withColumn("grp", numbers(groups))
    right = q.withColumn("grp", F.pmod(F.xxhash64("vec_id"), F.lit(groups)).cast("int")).withColumn("block", numbers(blocks))
    found = left.groupBy("block", "grp").cogroup(right.groupBy("block", "grp")).applyInPandas(answer, RESULT)
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
