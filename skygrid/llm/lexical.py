"""Ranked lexical search over a document FP-tree.

The items' terms are the vocabulary; a document is the vector of those of them
that it holds, most frequent first, with its counts. Documents in order of
these vectors are the leaves of a trie in which common beginnings are shared.

A node knows, for all documents below it, the largest count of its term and
the smallest m (the length factor). For an item the nodes of its terms, in
order of the trie, give every child's bound at once: the largest count of each
term below the child, or on the path to it, with the child's smallest m. The
search goes depth first into the child with the largest bound, and leaves out
children whose bound is below the worst of the ``k`` best so far. Subtrees of
few documents are scored whole. Bounds and scores are the same integer
formula, which grows with the count and falls with m, so nothing is lost.

Documents are tokenized once a block of items. Their vectors, a few bytes a
term, are dealt out in ranges of their first terms, so that a task's tree has
long shared paths; rows that are alike are spread by their place. A task builds
trees of a bounded number of vector entries, one after the other, and keeps
each item's best across them.

Defined cases: null or empty texts have no terms; items without terms, or
whose terms no document holds, give no rows; rows of ``items`` with one
item_id are one item with the terms of all their different texts; repeated
document rows are documents of their own; a null doc_id ranks last among equal
scores; null item_ids are one item; items may number more than a block holds,
then blocks of them follow each other; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_batches, cut, text_runs

K = 20
#: Items, and bytes of their texts, that are searched for at once.
ITEMS, ITEM_BYTES = 5_000, 16 << 20
#: Vector entries of one tree, documents of a subtree that is scored whole.
ENTRIES, LEAF = 4_000_000, 1024
#: Terms of a vector that say which task it goes to.
HEAD = 6
RUN_BYTES = 4 << 20

#: A term is a run of other characters than ASCII ones that are no letters or
#: digits; only A-Z are lower-cased. Bytes of other characters are above 127.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c > 127 or chr(c).isalnum() else 32 for c in range(256))


def terms(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def length_factor(n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    return 100 - 25 + (25 * n * n_docs) // n_terms


def gain(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a term of weight 1 adds to a score."""
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


class Tree:
    """The FP-tree of documents: ids, m, and vectors (ranks, rising, and counts)."""

    def __init__(self, ids: np.ndarray, known: np.ndarray, m: np.ndarray, paths: list[np.ndarray], counts: list[np.ndarray], n_terms: int):
        order = sorted(range(len(paths)), key=[p.astype(">u4").tobytes() for p in paths].__getitem__)
        paths, counts = [paths[i] for i in order], [counts[i] for i in order]
        self.ids, self.known, self.m = ids[order], known[order], m[order]
        n, sizes = len(order), np.array([len(p) for p in paths], np.int64)
        kind = np.uint16 if n_terms <= 1 << 16 else np.int32
        shared = np.zeros(n, np.int64)
        for i in range(1, n):
            k = min(sizes[i - 1], sizes[i])
            differ = paths[i - 1][:k] != paths[i][:k]
            at = int(differ.argmax()) if k else 0
            shared[i] = at if k and differ[at] else k
        #: Nodes before each document's own ones.
        self.first_node = np.concatenate([[0], np.cumsum(sizes - shared)])
        entry_node, path = np.empty(int(sizes.sum()), np.int64), np.empty(int(sizes.max(initial=0)), np.int64)
        at = 0
        for i in range(n):
            path[shared[i] : sizes[i]] = np.arange(self.first_node[i], self.first_node[i + 1])
            entry_node[at : at + sizes[i]] = path[: sizes[i]]
            at += sizes[i]
        entry_doc = np.repeat(np.arange(n), sizes)
        entry_term, entry_tf = np.concatenate(paths).astype(kind), np.concatenate(counts).astype(np.int64)
        n_nodes = int(self.first_node[-1])
        self.term = np.empty(n_nodes, kind)
        self.term[entry_node] = entry_term
        self.tf, self.least_m = np.zeros(n_nodes, np.int64), np.full(n_nodes, np.iinfo(np.int64).max)
        np.maximum.at(self.tf, entry_node, entry_tf)
        np.minimum.at(self.least_m, entry_node, self.m[entry_doc])
        #: Documents below a node, and the node after its subtree.
        self.low = np.repeat(np.arange(n), sizes - shared)
        self.high = np.zeros(n_nodes, np.int64)
        np.maximum.at(self.high, entry_node, entry_doc + 1)
        self.end = self.first_node[self.high]
        starts = np.cumsum(sizes) - sizes
        parent = np.full(n_nodes, -1)
        inner = np.ones(len(entry_node), bool)
        inner[starts] = False
        parent[entry_node[inner]] = entry_node[np.flatnonzero(inner) - 1]
        self.children = np.argsort(parent, kind="stable")
        self.child_at = np.searchsorted(parent[self.children], np.arange(-1, n_nodes + 1))
        self.by_term = np.argsort(self.term, kind="stable")
        self.term_at = np.searchsorted(self.term[self.by_term], np.arange(n_terms + 1))
        by_term = np.argsort(entry_term, kind="stable")
        self.post_doc, self.post_tf = entry_doc[by_term], entry_tf[by_term]
        self.post_at = np.searchsorted(entry_term[by_term], np.arange(n_terms + 1))
        #: Documents scored so far.
        self.scored = 0

    def scores(self, low: int, high: int, asked: list[tuple[int, int]]) -> np.ndarray:
        """Scores of the documents from ``low`` up to ``high``."""
        out = np.zeros(high - low, np.int64)
        for rank, w in asked:
            a, b = self.post_at[rank], self.post_at[rank + 1]
            i, j = a + np.searchsorted(self.post_doc[a:b], (low, high))
            if i < j:
                d = self.post_doc[i:j]
                out[d - low] += w * gain(self.post_tf[i:j], self.m[d])
        return out

    def search(self, asked: list[tuple[int, int]], best: Best) -> None:
        """Puts the best documents for (rank, weight) pairs into ``best``."""
        held = [(rank, w) for rank, w in asked if self.term_at[rank] < self.term_at[rank + 1]]
        if not held:
            return
        parts = [self.by_term[self.term_at[rank] : self.term_at[rank + 1]] for rank, _ in held]
        nodes = np.concatenate(parts)
        place = np.argsort(nodes, kind="stable")
        nodes, which = nodes[place], np.repeat(np.arange(len(held)), [len(p) for p in parts])[place]
        tf, weights, position = self.tf[nodes], np.array([w for _, w in held]), {rank: i for i, (rank, _) in enumerate(held)}
        n_held = len(held)
        stack = [(np.iinfo(np.int64).max, -1, np.zeros(n_held, np.int64))]
        while stack:
            bound, node, path_tf = stack.pop()
            if bound < best.least:
                continue
            # Down a path that does not branch; its terms are the children's too.
            while True:
                if node >= 0 and (p := position.get(int(self.term[node]))) is not None:
                    path_tf = path_tf.copy()
                    path_tf[p] = self.tf[node]
                kids = self.children[self.child_at[node + 1] : self.child_at[node + 2]]
                low, high = (self.low[node], self.high[node]) if node >= 0 else (0, len(self.m))
                if len(kids) != 1 or self.low[kids[0]] != low:
                    break
                node = int(kids[0])
            if high - low <= LEAF or not len(kids):
                self._score(np.array([[low, high]]), held, best)
                continue
            a, b = np.searchsorted(nodes, (node + 1, self.end[node] if node >= 0 else len(self.term)))
            most = np.tile(path_tf, len(kids))
            np.maximum.at(most, (np.searchsorted(kids, nodes[a:b], "right") - 1) * n_held + which[a:b], tf[a:b])
            bounds = (weights * gain(most.reshape(-1, n_held), self.least_m[kids][:, None])).sum(axis=1)
            few = self.high[kids] - self.low[kids] <= LEAF
            whole = [np.array([[low, self.low[kids[0]]]])] if self.low[kids[0]] > low else []
            chosen = kids[few & (bounds >= best.least)]
            self._score(np.concatenate([*whole, np.stack([self.low[chosen], self.high[chosen]], 1)]), held, best)
            large = np.flatnonzero(~few & (bounds >= best.least))
            for i in large[np.argsort(bounds[large], kind="stable")]:
                stack.append((int(bounds[i]), int(kids[i]), path_tf))

    def _score(self, ranges: np.ndarray, asked: list[tuple[int, int]], best: Best) -> None:
        """Scores the documents of rising ranges; near ones in one go."""
        at = 0
        while at < len(ranges):
            end = at + 1
            while end < len(ranges) and ranges[end, 0] - ranges[end - 1, 1] <= LEAF:
                end += 1
            low, high = ranges[at, 0], ranges[end - 1, 1]
            found = self.scores(low, high, asked)
            self.scored += int((ranges[at:end, 1] - ranges[at:end, 0]).sum())
            good = np.flatnonzero(found >= best.least)
            best.add(found[good], self.ids[low:high][good], self.known[low:high][good])
            at = end


class Best:
    """The ``k`` best (score, id), equal scores by id, unknown ids last."""

    def __init__(self, k: int):
        self.k, self.least = k, 1
        self.score, self.ids, self.known = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)

    def add(self, score: np.ndarray, ids: np.ndarray, known: np.ndarray) -> None:
        if not len(score):
            return
        score, ids, known = np.concatenate([self.score, score]), np.concatenate([self.ids, ids]), np.concatenate([self.known, known])
        if len(score) > 4 * self.k:
            at = score >= np.partition(score, len(score) - self.k)[len(score) - self.k]
            score, ids, known = score[at], ids[at], known[at]
        order = np.lexsort((ids, ~known, -score))[: self.k]
        self.score, self.ids, self.known = score[order], ids[order], known[order]
        if len(order) == self.k:
            self.least = int(self.score[-1])


def item_blocks(items: DataFrame) -> Iterator[list[tuple[int | None, Counter]]]:
    """Items with their terms, in blocks of bounded size."""
    i = cut(items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where(F.length("text") > 0).distinct(), "items")
    n, size = i.agg(F.count_distinct("item_id"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    n_blocks = max(1, -(-n // ITEMS), -(-size // ITEM_BYTES))
    for b in range(n_blocks):
        found: dict[int | None, Counter] = {}
        for r in i.where(F.pmod(F.xxhash64("item_id"), F.lit(n_blocks)) == b).toLocalIterator():
            found.setdefault(r["item_id"], Counter()).update(terms(r["text"].encode()))
        yield [(k, v) for k, v in found.items() if v]


def restricted(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """doc_id, n_terms, held (terms of the vocabulary) and counts of documents
    that have terms."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, texts in text_runs(b, RUN_BYTES):
                rows, n_terms, held, counts, ends = [], [], [], [], [0]
                for k, text in enumerate(texts, i):
                    words = terms(text)
                    if words:
                        found = Counter(map(vocabulary.get, words))
                        found.pop(None, None)
                        rows.append(k)
                        n_terms.append(len(words))
                        held.extend(found)
                        counts.extend(found.values())
                        ends.append(len(held))
                ends = pa.array(ends, pa.int32())
                yield pa.RecordBatch.from_arrays([b["doc_id"].take(pa.array(rows, pa.int64())), pa.array(n_terms, pa.int64()), pa.ListArray.from_arrays(ends, pa.array(held, pa.int32())), pa.ListArray.from_arrays(ends, pa.array(counts, pa.int32()))], names=["doc_id", "n_terms", "held", "counts"])

    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return d.mapInArrow(run, "doc_id long, n_terms long, held array<int>, counts array<int>")


def frequencies(vectors: DataFrame, size: int) -> np.ndarray:
    """In how many documents each term stands; counted within tasks first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(size, np.int64)
        for b in batches:
            n += np.bincount(b["held"].flatten().to_numpy(zero_copy_only=False), minlength=size)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_pydict({"term": pa.array(at, pa.int32()), "df": pa.array(n[at])})

    out = np.zeros(size, np.int64)
    for r in vectors.select("held").mapInArrow(run, "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).toLocalIterator():
        out[r["term"]] = r["df"]
    return out


def _search_block(docs: DataFrame, items: list[tuple[int | None, Counter]], k: int) -> DataFrame | None:
    vocabulary = {t: i for i, t in enumerate(sorted(set().union(*(c for _, c in items))))}
    vectors = cut(restricted(docs, vocabulary), "term-vectors")
    n_docs, n_all = vectors.agg(F.count("*"), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    if not n_docs:
        return None
    df = frequencies(vectors, len(vocabulary))
    weights = np.array([weight(n_docs, int(x)) if x else 0 for x in df], np.int64)
    # Ranks by falling frequency; terms that add nothing have none.
    order = np.lexsort((np.arange(len(df)), -df))
    order = order[weights[order] > 0]
    rank = np.full(len(df), -1, np.int64)
    rank[order] = np.arange(len(order))
    n_ranks = len(order)
    asked = [(i, [(int(rank[v]), n * int(weights[v])) for t, n in c.items() if rank[v := vocabulary[t]] >= 0]) for i, c in items]

    def as_paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ends = np.concatenate([[0], np.cumsum(b["held"].value_lengths().to_numpy(zero_copy_only=False))])
            r, tf = rank[b["held"].flatten().to_numpy(zero_copy_only=False)], b["counts"].flatten().to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
            at = np.lexsort((r, row))
            at = at[r[at] >= 0]
            sizes = np.bincount(row[at], minlength=len(ends) - 1)
            m = length_factor(b["n_terms"].to_numpy(zero_copy_only=False), n_docs, n_all)
            bounds = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(m, pa.int64()), pa.ListArray.from_arrays(bounds, pa.array(r[at], pa.int32())), pa.ListArray.from_arrays(bounds, pa.array(tf[at], pa.int32()))], names=["doc_id", "m", "path", "counts"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in asked]
        held, size = [], 0

        def work() -> None:
            t = pa.Table.from_batches(held).combine_chunks()
            ids = t["doc_id"].combine_chunks()
            split = lambda c: np.split(c.combine_chunks().flatten().to_numpy(zero_copy_only=False), np.cumsum(c.combine_chunks().value_lengths().to_numpy(zero_copy_only=False))[:-1])
            tree = Tree(ids.fill_null(0).to_numpy(zero_copy_only=False), ids.is_valid().to_numpy(zero_copy_only=False), t["m"].to_numpy(), split(t["path"]), split(t["counts"]), n_ranks)
            for (_, want), b in zip(asked, best):
                tree.search(want, b)

        for b in batches:
            held.append(b)
            size += len(b["path"].flatten())
            if size >= ENTRIES:
                work()
                held, size = [], 0
        if size:
            work()
        for (item, _), b in zip(asked, best):
            if len(b.score):
                ids = pa.array(b.ids, mask=~b.known)
                yield pa.RecordBatch.from_arrays([pa.array([item] * len(b.score), pa.int64()), ids, pa.array(b.score)], names=["item_id", "doc_id", "score"])

    paths = vectors.mapInArrow(as_paths, "doc_id long, m long, path array<int>, counts array<int>").where(F.size("path") > 0)
    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-int(df.sum()) // ENTRIES))
    dealt = paths.repartitionByRange(tasks, F.slice("path", 1, HEAD), F.monotonically_increasing_id())
    return dealt.mapInArrow(search, "item_id long, doc_id long, score long")


def best_documents(docs: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """item_id, rank (from 1), doc_id and score of each item's ``k`` documents
    of the highest score above 0."""
    found = [f for b in item_blocks(items) if b and (f := _search_block(docs, b, k)) is not None]
    if not found:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    all_found = found[0]
    for f in found[1:]:
        all_found = all_found.unionByName(f)
    rank = F.row_number().over(Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    return all_found.withColumn("rank", rank).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
