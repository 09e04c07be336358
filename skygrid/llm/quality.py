"""Quality classifier on supervised subword embeddings.

A document's features are its words, the byte n-grams of each word between
word bounds, and its pairs of neighbouring words (a word repeated at once is
one feature, whatever the word: a bounded sample can't hold all such pairs).
Each feature hashes to a learned vector; the vectors are averaged, and a
softmax over two classes gives the score. Training is stochastic gradient
descent in numpy, one document at a time.

Training takes at most ``train_docs`` labelled documents, the first by a hash
of doc_id: a documented bound, so that one task holds them. The model is a
table of 2 ** ``bits`` features and goes to all tasks as a broadcast of fixed
size; since the score is linear in the mean before the softmax, only each
feature's share of the logit is sent. Scoring covers every whole text.

Defined cases: a null or empty text has no features and gets the score of the
bias alone; null doc_ids count as empty text in the fold rule; labels that are
null are not learned from, a document with both labels counts once for each,
and of a doc_id on several rows the least text counts; without any label every score is 0.5; rows of equal text score alike;
an empty table gives no rows; other columns are carried or ignored, and never
inputs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, crc32_mod, mix, text_runs

TRAIN_DOCS = 6000
BITS = 17
SUBWORDS = (3, 4, 5)
MEMO_WORDS = 200_000
BATCH_BYTES = 2 << 20


@dataclass(frozen=True)
class Model:
    """A feature's share of the logit of label 1, and the bias."""

    shares: np.ndarray
    bias: float


def _word_features(words: list[bytes], bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of each word and its n-grams, end offsets per word, word hashes."""
    import xxhash

    h = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words), np.uint64, len(words))
    raw = np.frombuffer(b"".join(b"<" + w + b">" for w in words), np.uint8).astype(np.uint64)
    size = np.fromiter(map(len, words), np.int64, len(words)) + 2
    end = np.cumsum(size)
    owner = np.repeat(np.arange(len(words)), size)
    left = end[owner] - np.arange(len(raw))
    buckets, owners = [h], [np.arange(len(words))]
    for n in SUBWORDS:
        at = np.flatnonzero(left >= n)
        x = np.full(len(at), n, np.uint64)
        for k in range(n):
            x = mix(x, raw[at + k])
        buckets.append(x)
        owners.append(owner[at])
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    found = (mix(np.concatenate(buckets), 1) >> np.uint64(64 - bits)).astype(np.int64)[order]
    return found, np.cumsum(np.bincount(owner, minlength=len(words))), h


def _pair_buckets(h: np.ndarray, bits: int) -> np.ndarray:
    """Buckets of neighbouring word hashes; equal neighbours share one bucket,
    as a pair of equal words says the same of a text whichever word it is."""
    a, b = h[:-1], h[1:]
    pair = np.where(a == b, np.uint64(7), mix(mix(a, b), 2))
    return (mix(pair, 3) >> np.uint64(64 - bits)).astype(np.int64)


class Scorer:
    """Logits of documents, with a bounded memo of words' sums."""

    def __init__(self, model: Model, memo_words: int = MEMO_WORDS):
        self.model, self.limit, self.bits = model, memo_words, len(model.shares).bit_length() - 1
        self._reset()

    def _reset(self) -> None:
        self.memo: dict[bytes, int] = {}
        self.sums, self.counts, self.hashes = np.empty(0), np.empty(0, np.int64), np.empty(0, np.uint64)

    def _learn(self, words: list[bytes]) -> None:
        buckets, ends, h = _word_features(words, self.bits)
        totals = np.concatenate([[0.0], np.cumsum(self.model.shares[buckets], dtype=np.float64)])[np.concatenate([[0], ends])]
        self.memo.update(zip(words, range(len(self.memo), len(self.memo) + len(words))))
        self.sums = np.concatenate([self.sums, np.diff(totals)])
        self.counts = np.concatenate([self.counts, np.diff(np.concatenate([[0], ends]))])
        self.hashes = np.concatenate([self.hashes, h])

    def __call__(self, docs: list[bytes]) -> np.ndarray:
        words = [d.split() for d in docs]
        n = np.fromiter(map(len, words), np.int64, len(words))
        flat = [w for d in words for w in d]
        if len(self.memo) > self.limit:
            self._reset()
        if new := [w for w in set(flat) if w not in self.memo]:
            self._learn(new)
        at = np.fromiter(map(self.memo.__getitem__, flat), np.int64, len(flat))
        doc = np.repeat(np.arange(len(docs)), n)
        total = np.bincount(doc, self.sums[at], len(docs))
        count = np.bincount(doc, self.counts[at], len(docs))
        if len(flat) > 1:
            inside = doc[1:] == doc[:-1]
            share = self.model.shares[_pair_buckets(self.hashes[at], self.bits)[inside]]
            total += np.bincount(doc[1:][inside], share, len(docs))
            count += np.bincount(doc[1:][inside], minlength=len(docs))
        return total / np.maximum(count, 1) + self.model.bias


def doc_features(text: bytes, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a document, and how often each occurs."""
    words = text.split()
    if not words:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    names = list(dict.fromkeys(words))
    place = dict(zip(names, range(len(names))))
    at = np.fromiter(map(place.__getitem__, words), np.int64, len(words))
    buckets, ends, h = _word_features(names, bits)
    starts = np.concatenate([[0], ends[:-1]])
    often = np.repeat(np.bincount(at, minlength=len(names)), ends - starts)
    pairs = _pair_buckets(h[at], bits)
    found, back = np.unique(np.concatenate([buckets, pairs]), return_inverse=True)
    return found, np.bincount(back, np.concatenate([often, np.ones(len(pairs), np.int64)])).astype(np.int64)


def train(texts: list[bytes], labels: np.ndarray, bits: int = BITS, dim: int = 8, epochs: int = 4, rate: float = 0.4, seed: int = 0) -> Model:
    """Gradient descent over the documents in a new order each epoch, with a
    rate that falls to 0."""
    rng = np.random.default_rng(seed)
    table = rng.uniform(-1 / dim, 1 / dim, (1 << bits, dim)).astype(np.float32)
    out, bias = rng.uniform(-0.5, 0.5, (2, dim)).astype(np.float32), np.zeros(2, np.float32)
    features = [(ids, (n / n.sum()).astype(np.float32)) for ids, n in (doc_features(t, bits) for t in texts)]
    step, steps = 0, max(1, epochs * len(texts))
    for _ in range(epochs):
        for i in rng.permutation(len(texts)):
            ids, share = features[i]
            now = rate * (1 - step / steps)
            step += 1
            mean = share @ table[ids] if len(ids) else np.zeros(dim, np.float32)
            z = out @ mean + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[int(labels[i])] -= 1
            if len(ids):
                # Features are averaged, so a step is spread over them; scaled
                # to their number it moves a document's mean by a full step.
                table[ids] -= np.float32(now * min(len(ids), 1000)) * share[:, None] * (p @ out)[None, :] * np.float32(0.1)
            out -= now * np.outer(p, mean)
            bias -= now * 0.1 * p
    return Model((table @ (out[1] - out[0])).astype(np.float32), float(bias[1] - bias[0]))


def fit(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS, bits: int = BITS) -> Model:
    """Train on labelled rows of the training folds, in one task."""
    bounded_batches(docs.sparkSession)
    l = labels.select(F.col("doc_id").cast("long").alias("label_id"), F.col("quality").cast("int").alias("quality"))
    l = l.where(F.col("quality").isin(0, 1) & (crc32_mod(F.col("label_id"), 5) != 0) & F.col("label_id").isNotNull())
    l = l.distinct().orderBy(F.xxhash64("label_id"), "label_id", "quality").limit(train_docs)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).cast("binary").alias("text")).join(F.broadcast(l), F.col("doc_id") == F.col("label_id"))
    # A doc_id may stand on any number of rows; one text of each is learned from.
    rows = rows.groupBy("doc_id", "quality").agg(F.min("text").alias("text"))

    def one(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = pd.concat([pd.DataFrame({"doc_id": [], "quality": [], "text": []}), *batches]).sort_values(["doc_id", "quality"])
        m = train([bytes(t) for t in held["text"]], held["quality"].to_numpy(), bits)
        yield pd.DataFrame({"shares": [m.shares.tobytes()], "bias": [m.bias]})

    got = rows.repartition(1).mapInPandas(one, "shares binary, bias double").first()
    if got is None:
        return Model(np.zeros(1 << bits, np.float32), 0.0)
    return Model(np.frombuffer(got["shares"], np.float32), got["bias"])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of ``docs`` and quality_score, which takes the place of a
    column of that name."""
    return _scored(docs.drop("quality_score"), model, None)


def filter_documents(docs: DataFrame, model: Model, least: float) -> DataFrame:
    """The documents that score ``least`` or more, with their columns."""
    return _scored(docs, model, least)


def _scored(docs: DataFrame, model: Model, least: float | None) -> DataFrame:
    from pyspark.sql import types as T

    bounded_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast((model.shares.tobytes(), model.bias))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shares, bias = sent.value
        scorer = Scorer(Model(np.frombuffer(shares, np.float32), bias))
        for b in batches:
            z = np.empty(b.num_rows)
            for i, j, texts in text_runs(b, BATCH_BYTES):
                z[i:j] = scorer(texts)
            p = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
            if least is None:
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(p)], names=[*b.schema.names, "quality_score"])
            else:
                yield b.filter(pa.array(p >= least))

    added = [T.StructField("quality_score", T.DoubleType())] if least is None else []
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *added]))
