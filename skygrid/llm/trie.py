"""Language-model scoring with an Elias-Fano n-gram trie.

Model: words and one end per text, orders 1 to 3. Order 1 is the add-half
estimate of the base score. Orders 2 and 3 interpolate absolute discounting
with the order below: p(w|c) = max(n(cw) - D, 0) / n(c) + b(c) * p(w|c'), with
b(c) = D * successors(c) / n(c) and D from the counts of counts of the level.

Layout, one set of files per level:

1. vocabulary: sorted word hashes with counts; a word's id is its rank.
2. for each word its successors in order of id, with probability codes; the
   word's backoff code. Where a word's successors begin is an Elias-Fano list.
3. for each bigram its successors, each given as its place among the
   successors of the bigram's second word (a small, context-relative number),
   with probability codes; the bigram's backoff code; Elias-Fano pointers.

Probabilities and backoffs are 16-bit codes of log10 in steps of 1/4000. A
lookup searches a context's successors by bisection; where the bigram before
stood gives the context of the trigram.

Spark job: words are counted over the whole texts, which are then encoded once
as ids; the other levels are counted over these. Counting tasks deal their
sorted, compressed counts to parts by key range through a shuffle. A part is
merged by one task, which stores its counts and tells how many occur once and
twice; once the level's discount is known, a second task smooths the part and
writes its file. So the model does not depend on how it is cut into parts.

Parts are ranges of (context, successor) between quantiles of a sample of keys
and hold about ``part_tokens`` tokens, so a frequent context is spread over
several. What such a context has in other parts (its total, its number of
successors, their places) is known from the first and last contexts of each
part. The vocabulary is cut by hash, into more parts for more input splits.
Scoring tasks memory-map the files, so workers of a machine share pages. Parts
are listed in a file beside them; a level has ``MOST_PARTS`` at most, of more
tokens each where the corpus is larger, so what the driver holds is bounded.
Counts have 64 bits; words are numbered by 32, and more of them are an error.

Defined cases: a null or empty text is one end token; null doc_ids count as
empty text in the fold rule; without training texts every token is unknown and
both scores are equal; equal rows are counted and scored as often as they
stand there; long texts are whole; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

import json
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, crc32_mod, cut, map_array, mix, open_file, put_file, remove_file, shared_dir, slices, text_runs, tokens

STEP = 4000
BATCH_BYTES = 6 << 20
BATCH_TOKENS = 1_500_000
HELD_KEYS = 4_000_000
PART_TOKENS = 4_000_000
#: Parts of a level; from 10 ** 12 tokens on they hold more than PART_TOKENS.
MOST_PARTS = 1 << 18
PART_SAMPLE = 400
#: Quantiles that one aggregate gives; more are found within its ranges.
QUANTILES = 512
MOST_WORDS = (1 << 32) - 2
TEXTS_DRAWN = 4
SPLITS_OF_PART = 16
MEMO_WORDS = 300_000
END = b""


# --- files of arrays ------------------------------------------------------


def pack(arrays: dict[str, np.ndarray]) -> bytes:
    """Named arrays in one run of bytes, each at a multiple of 8."""
    head, body, at = {}, [], 0
    for name, x in arrays.items():
        x = np.ascontiguousarray(x)
        pad = -x.nbytes % 8
        head[name] = [x.dtype.str, at, len(x)]
        body += [x.tobytes(), bytes(pad)]
        at += x.nbytes + pad
    text = json.dumps(head).encode()
    text += b" " * (-len(text) % 8)
    return len(text).to_bytes(8, "little") + text + b"".join(body)


def unpack(uri: str) -> dict[str, np.ndarray]:
    """The arrays of a file, memory-mapped."""
    raw = map_array(uri, np.uint8)
    n = int(raw[:8].view("<u8")[0])
    head = json.loads(raw[8 : 8 + n].tobytes())
    return {name: raw[8 + n + at : 8 + n + at + count * np.dtype(kind).itemsize].view(kind) for name, (kind, at, count) in head.items()}


# --- Elias-Fano -----------------------------------------------------------


def ef_encode(x: np.ndarray, name: str) -> dict[str, np.ndarray]:
    """A list that never falls: low bits packed, high bits in unary, and the
    number of ones before each block of 512 bits."""
    n = len(x)
    width = max(0, ((int(x[-1]) + 1) // n).bit_length() - 1)
    x = x.astype(np.uint64)
    high = np.zeros(int(x[-1] >> np.uint64(width)) + n + 1, np.uint8)
    high[(x >> np.uint64(width)).astype(np.int64) + np.arange(n)] = 1
    words = np.packbits(high, bitorder="little")
    words = np.concatenate([words, np.zeros(-len(words) % 64, np.uint8)]).view("<u8")
    ones = np.cumsum(np.bitwise_count(words).astype(np.int64).reshape(-1, 8).sum(axis=1))
    low = np.packbits(((x[:, None] >> np.arange(width, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little")
    low = np.concatenate([low, np.zeros(-len(low) % 8 + 8, np.uint8)]).view("<u8")
    return {f"{name}_high": words, f"{name}_ones": np.concatenate([[0], ones[:-1]]).astype("<u4"), f"{name}_low": low, f"{name}_width": np.array([width], "<u4")}


class EliasFano:
    def __init__(self, arrays: dict[str, np.ndarray], name: str):
        self.high, self.ones, self.low = arrays[f"{name}_high"], arrays[f"{name}_ones"], arrays[f"{name}_low"]
        self.width = int(arrays[f"{name}_width"][0])

    def _select(self, i: np.ndarray) -> np.ndarray:
        """Bit position of the i-th one."""
        block = np.searchsorted(self.ones, i, side="right") - 1
        rest = i - self.ones[block]
        counts = np.cumsum(np.bitwise_count(self.high[block[:, None] * 8 + np.arange(8)]).astype(np.int64), axis=1)
        k = (counts <= rest[:, None]).sum(axis=1)
        rest = rest - np.where(k > 0, counts[np.arange(len(k)), np.maximum(k, 1) - 1], 0)
        word, at = self.high[block * 8 + k], np.zeros(len(k), np.int64)
        for half in (32, 16, 8, 4, 2, 1):
            ones = np.bitwise_count((word >> at.astype(np.uint64)) & np.uint64((1 << half) - 1)).astype(np.int64)
            skip = ones <= rest
            rest = np.where(skip, rest - ones, rest)
            at = np.where(skip, at + half, at)
        return (block * 8 + k) * 64 + at

    def _value(self, i: np.ndarray, at: np.ndarray) -> np.ndarray:
        high = (at - i).astype(np.uint64)
        if not self.width:
            return high.astype(np.int64)
        bit = i * self.width
        w, s = bit >> 6, (bit & 63).astype(np.uint64)
        low = self.low[w] >> s | np.where(s > 0, self.low[w + 1] << (np.uint64(64) - np.maximum(s, np.uint64(1))), np.uint64(0))
        return (high << np.uint64(self.width) | low & np.uint64((1 << self.width) - 1)).astype(np.int64)

    def get(self, i: np.ndarray) -> np.ndarray:
        return self._value(i, self._select(i))

    def span(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values i and i + 1; the next one is mostly in the same word."""
        at = self._select(i)
        bit = (at & 63).astype(np.uint64)
        left = np.where(bit < 63, self.high[at >> 6] >> np.minimum(bit + np.uint64(1), np.uint64(63)), np.uint64(0))
        after = at + 1 + np.bitwise_count((left & (~left + np.uint64(1))) - np.uint64(1)).astype(np.int64)
        far = np.flatnonzero(left == 0)
        after[far] = self._select(i[far] + 1)
        return self._value(i, at), self._value(i + 1, after)


def find_successor(succ: np.ndarray, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bisection in succ[lo:hi] for each x: place, and whether it is there."""
    lo, end, hi = lo.copy(), hi, hi.copy()
    act = np.flatnonzero(lo < hi)
    while len(act):
        a, b = lo[act], hi[act]
        m = (a + b) >> 1
        less = succ[m] < x[act]
        a, b = np.where(less, m + 1, a), np.where(less, b, m)
        lo[act], hi[act] = a, b
        act = act[a < b]
    there = lo < end
    there[there] = succ[lo[there]] == x[there]
    return lo, there


def codes(p: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        return np.minimum(np.rint(-STEP * np.log10(p)), 65535).astype("<u2")


def grouped(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct values, sorting order, and each sorted element's group."""
    order = np.argsort(x)
    s = x[order]
    new = np.concatenate([[True], s[1:] != s[:-1]]) if len(s) else np.zeros(0, bool)
    return s[new], order, np.cumsum(new) - 1


# --- the levels -----------------------------------------------------------


class Files(Sequence):
    """Names of a level's files: a beginning, and numbers from 0."""

    def __init__(self, beginning: str, n: int):
        self.beginning, self.n = beginning, n

    def __len__(self) -> int:
        return self.n

    def __getitem__(self, i: int) -> str:
        return f"{self.beginning}-{range(self.n)[i]}"


class Parts:
    """The files of a level; ``starts`` has the first index of each."""

    def __init__(self, uris: Sequence[str], starts: np.ndarray):
        self.uris, self.starts, self.held = uris, starts, {}

    def __getitem__(self, i: int) -> dict[str, np.ndarray]:
        if i not in self.held:
            self.held[i] = unpack(self.uris[i])
        return self.held[i]

    def over(self, sorted_index: np.ndarray) -> Iterator[tuple[int, slice]]:
        """The parts that a sorted list of indices touches, with its slices."""
        cuts = np.searchsorted(sorted_index, self.starts[1:])
        a = 0
        for i, b in enumerate([*cuts.tolist(), len(sorted_index)]):
            if b > a:
                yield i, slice(a, b)
            a = b

    def gather(self, name: str, index: np.ndarray) -> np.ndarray:
        """Values of one array by global index, in any order."""
        if len(self.starts) <= 16 and len(index):
            out = None
            for i, a in enumerate(self.starts.tolist()):
                mine = index >= a
                if i + 1 < len(self.starts):
                    mine &= index < self.starts[i + 1]
                at = np.flatnonzero(mine)
                if out is None:
                    out = np.empty(len(index), self[i][name].dtype)
                out[at] = self[i][name][index[at] - a]
            return out
        u, order, group = grouped(index)
        got = np.concatenate([self[i][name][u[s] - self.starts[i]] for i, s in self.over(u)]) if len(u) else np.empty(0)
        out = np.empty(len(index), got.dtype)
        out[order] = got[group]
        return out


class Vocabulary:
    """Words to ids, -1 for unknown ones."""

    def __init__(self, uris: Sequence[str], sizes: np.ndarray, total: int, memo_words: int = MEMO_WORDS):
        self.parts = Parts(uris, np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])[:-1].astype(np.int64))
        self.size, self.total, self.memo, self.limit = int(np.sum(sizes)), total, {}, memo_words
        self.bits = max(0, len(uris).bit_length() - 1)

    def ids(self, words: list[bytes]) -> np.ndarray:
        import xxhash

        if len(self.memo) > self.limit:
            self.memo.clear()
        if new := [w for w in set(words) if w not in self.memo]:
            h = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in new), np.uint64, len(new))
            order = np.argsort(h)
            h, found = h[order], np.full(len(new), -1, np.int64)
            first = np.searchsorted(h, np.arange(len(self.parts.uris), dtype=np.uint64) << np.uint64(64 - self.bits)) if self.bits else np.array([0])
            for i, (a, b) in enumerate(zip(first, [*first[1:], len(h)])):
                if b > a and self.parts.uris and len(known := self.parts[i]["hash"]):
                    at = np.minimum(np.searchsorted(known, h[a:b]), len(known) - 1)
                    found[a:b] = np.where(known[at] == h[a:b], at + self.parts.starts[i], -1)
            self.memo.update(zip([new[i] for i in order], found.tolist()))
        return np.fromiter(map(self.memo.__getitem__, words), np.int64, len(words))

    def counts(self, ids: np.ndarray) -> np.ndarray:
        """Counts of ids, 0 for -1."""
        out = np.zeros(len(ids), np.int64)
        known = ids >= 0
        out[known] = self.parts.gather("count", ids[known]).astype(np.int64)
        return out

    def p(self, ids: np.ndarray) -> np.ndarray:
        return (self.counts(ids) + 0.5) / (self.total + 0.5 * (self.size + 1))


class Bigrams:
    """Level 2: context ids 0 .. V (V stands for the start of a text).

    ``bounds`` has the first key (context << 32 | successor) of each part and
    ``offsets`` how many successors of its first context earlier parts hold.
    """

    def __init__(self, uris: Sequence[str], bounds: np.ndarray, offsets: np.ndarray, sizes: np.ndarray):
        self.by_key, self.nodes = Parts(uris, np.asarray(bounds).astype(np.int64)), Parts(uris, np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])[:-1].astype(np.int64))
        self.nodes.held, self.offsets = self.by_key.held, offsets

    def _local(self, i: int, v: np.ndarray) -> np.ndarray:
        """A part's contexts counted from its first."""
        return v - (int(self.by_key.starts[i]) >> 32)

    def starts(self, v: np.ndarray) -> np.ndarray:
        """Global index of the first successor of each context."""
        u, order, group = grouped(v)
        got = np.empty(len(u), np.int64)
        for i, s in self.by_key.over(u << 32):
            got[s] = EliasFano(self.by_key[i], "first").get(self._local(i, u[s])) + self.nodes.starts[i]
        out = np.empty(len(v), np.int64)
        out[order] = got[group]
        return out

    def find(self, v: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Node (-1: none), place among v's successors, log10 of p (nan: no
        such bigram) and log10 backoff of v. v is -1 for unknown contexts."""
        n = len(v)
        node, place, p, back = np.full(n, -1, np.int64), np.full(n, -1, np.int64), np.full(n, np.nan), np.zeros(n)
        some = np.flatnonzero(v >= 0)
        if not len(some) or not self.by_key.uris:
            return node, place, p, back
        u, order, group = grouped(v[some] << 32 | (w[some] + 1))
        uv, uw = u >> 32, (u & 0xFFFFFFFF) - 1
        u_node, u_place, u_p, u_back = (x[: len(u)].copy() for x in (np.full(len(u), -1, np.int64), np.full(len(u), -1, np.int64), np.full(len(u), np.nan), np.zeros(len(u))))
        for i, s in self.by_key.over(uv << 32 | np.maximum(uw, 0)):
            a, local = self.by_key[i], self._local(i, uv[s])
            new = np.concatenate([[True], local[1:] != local[:-1]])
            lo, hi = (x[np.cumsum(new) - 1] for x in EliasFano(a, "first").span(local[new]))
            u_back[s] = a["back"][local] / -STEP
            at, there = find_successor(a["succ"], lo, hi, uw[s])
            hit = np.flatnonzero(there) + s.start
            u_node[hit] = at[there] + self.nodes.starts[i]
            u_place[hit] = (at - lo + np.where(local == 0, self.offsets[i], 0))[there]
            u_p[hit] = a["p"][at[there]] / -STEP
        back_to = some[order]
        node[back_to], place[back_to], p[back_to], back[back_to] = u_node[group], u_place[group], u_p[group], u_back[group]
        return node, place, p, back


class Trigrams:
    """Level 3: contexts are nodes of level 2; keys are node << places | place."""

    def __init__(self, uris: Sequence[str], bounds: np.ndarray, places: int):
        self.parts, self.places = Parts(uris, np.asarray(bounds).astype(np.int64)), places

    def find(self, node: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """log10 of p (nan: no such trigram), log10 backoff of the context."""
        p, back = np.full(len(node), np.nan), np.zeros(len(node))
        some = np.flatnonzero(node >= 0)
        if not len(some) or not self.parts.uris:
            return p, back
        u, order, group = grouped(node[some] << self.places | (place[some] + 1))
        nodes, query = u >> self.places, (u & ((1 << self.places) - 1)) - 1
        u_p, u_back = np.full(len(u), np.nan), np.zeros(len(u))
        for i, s in self.parts.over(nodes << self.places | np.maximum(query, 0)):
            a, local = self.parts[i], nodes[s] - (int(self.parts.starts[i]) >> self.places)
            new = np.concatenate([[True], local[1:] != local[:-1]])
            lo, hi = (x[np.cumsum(new) - 1] for x in EliasFano(a, "first").span(local[new]))
            u_back[s] = a["back"][local] / -STEP
            at, there = find_successor(a["succ"], lo, hi, query[s])
            u_p[np.flatnonzero(there) + s.start] = a["p"][at[there]] / -STEP
        p[some[order]], back[some[order]] = u_p[group], u_back[group]
        return p, back


# --- counting -------------------------------------------------------------


def encode(docs: DataFrame, words: dict) -> DataFrame:
    """doc_id, held_out, ids: the 32-bit ids of each text's words and end, all
    ones for unknown words. Later passes read these and not the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = load(words)[0]
        for b in batches:
            for i, j, texts in text_runs(b, BATCH_BYTES):
                lists = [tokens(t) for t in texts]
                flat: list[bytes] = []
                for x in lists:
                    flat += x
                    flat.append(END)
                ids = vocabulary.ids(flat).astype(np.uint32)
                ends = np.cumsum([0, *(4 * (len(x) + 1) for x in lists)])
                raw = ids.tobytes()
                yield pa.RecordBatch.from_arrays([b["doc_id"].slice(i, j - i), b["held_out"].slice(i, j - i), pa.array([raw[x:y] for x, y in zip(ends, ends[1:])], pa.binary())], names=["doc_id", "held_out", "ids"])

    return docs.mapInArrow(run, "doc_id long, held_out boolean, ids binary")


def _runs(b: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of encoded rows: first row, row after, ids (-1 unknown), lengths."""
    column = b["ids"]
    n = pc.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64) // 4
    for i, j in slices(n, BATCH_TOKENS):
        raw = np.frombuffer(b"".join(column.slice(i, j - i).to_pylist()), "<u4")
        yield i, j, np.where(raw == 0xFFFFFFFF, np.int64(-1), raw.astype(np.int64)), n[i:j]


def _previous(ids: np.ndarray, size: np.ndarray, start: int) -> np.ndarray:
    """The id before each token; ``start`` before the first of a text."""
    v = np.empty_like(ids)
    v[1:] = ids[:-1]
    v[np.cumsum(size) - size] = start
    return v


def _squeeze(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted keys and counts, as compressed steps."""
    import zstandard

    step = np.diff(keys, prepend=np.uint64(0)) if len(keys) else keys
    return len(keys).to_bytes(8, "little") + zstandard.ZstdCompressor(level=1).compress(_planes(step) + _planes(counts))


def _planes(x: np.ndarray) -> bytes:
    """64-bit numbers byte by byte: all lowest bytes, then all next ones. High
    bytes are mostly zero and cost next to nothing compressed."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes() if len(x) else b""


def _from_planes(raw: bytes, n: int, at: int) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8, 8 * n, at).reshape(8, n).T).view("<u8").ravel()


def _unsqueeze(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    import zstandard

    n = int.from_bytes(data[:8], "little")
    raw = zstandard.ZstdDecompressor().decompress(data[8:], max_output_size=16 * n + 16)
    return np.cumsum(_from_planes(raw, n, 0), dtype=np.uint64), _from_planes(raw, n, 8 * n).astype(np.int64)


def _merge(keys: list[np.ndarray], counts: list[np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    k = np.concatenate(keys)
    if counts is None:
        return np.unique(k, return_counts=True)
    order = np.argsort(k)
    k, c = k[order], np.concatenate(counts)[order]
    first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
    return k[first], np.add.reduceat(c, first)


def _count_level(rows: DataFrame, read: Callable, make_keys: Callable, bounds: np.ndarray, store_part: Callable) -> dict[int, dict]:
    """Count keys, deal them by ``bounds`` (first keys of the parts) and let
    ``store_part(part, keys, counts)`` store each part. ``read(batch)`` gives
    pieces, of which ``make_keys()(piece)`` makes keys, or keys and counts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys_of = make_keys()
        held, counts, n = [], [], 0

        def flush() -> pa.RecordBatch:
            k, c = _merge(held, counts or None)
            cuts = np.searchsorted(k, bounds[1:])
            parts = [(i, _squeeze(a, b)) for i, (a, b) in enumerate(zip(np.split(k, cuts), np.split(c, cuts))) if len(a)]
            return pa.RecordBatch.from_arrays([pa.array([i for i, _ in parts], pa.int32()), pa.array([x for _, x in parts], pa.binary())], names=["part", "data"])

        for b in batches:
            for piece in read(b):
                k = keys_of(piece)
                if isinstance(k, tuple):
                    k, c = k
                    counts.append(c)
                held.append(k)
                n += len(k)
                if n >= HELD_KEYS:
                    yield flush()
                    held, counts, n = [], [], 0
        if n:
            yield flush()

    def reduce(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        got = [_unsqueeze(d) for d in rows["data"]]
        k, c = _merge([g[0] for g in got], [g[1] for g in got])
        return pd.DataFrame({"part": [key[0]], "said": [json.dumps(store_part(int(key[0]), k, c))]})

    got = rows.mapInArrow(count, "part int, data binary").groupBy("part").applyInPandas(reduce, "part int, said string").collect()
    return {r["part"]: json.loads(r["said"]) for r in got}


def quantiles(rows: DataFrame, make_keys: Callable, tokens: int, part_tokens: int) -> np.ndarray:
    """First keys of parts of about ``part_tokens``, by a sample of about
    ``PART_SAMPLE`` keys a part, drawn by hash from one text of
    ``TEXTS_DRAWN``. The sample stays in Spark: aggregates tell its quantiles,
    in two steps where there are many. Where the bounds lie decides about
    balance, not about results: every key is counted."""
    parts = min(MOST_PARTS, max(1, tokens // part_tokens))
    if parts == 1:
        return np.zeros(1, np.uint64)
    most = np.uint64(min(2**64 - 1, int(2.0**64 * TEXTS_DRAWN * PART_SAMPLE * parts / tokens)))

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys_of = make_keys()
        for b in batches:
            for piece in _runs(b):
                k = keys_of(piece)
                k = k[mix(k, mix(np.arange(len(k), dtype=np.uint64), 9)) <= most]
                yield pa.RecordBatch.from_arrays([pa.array(k.astype(np.float64))], names=["key"])

    # Quantiles are doubles: exact up to 2 ** 53, beyond that close to a key.
    keys = rows.where(F.pmod(F.xxhash64("ids"), F.lit(TEXTS_DRAWN)) == 0).mapInArrow(draw, "key double")
    coarse = min(parts, QUANTILES)
    if coarse < parts:
        keys = cut(keys, "trie-keys")

    def within(n: int):
        return F.percentile_approx("key", [i / n for i in range(1, n)] or [0.5], 10_000).alias("at")

    found = np.array(keys.agg(within(coarse)).first()["at"] or [], np.float64)
    if coarse < parts:
        bounds = found

        def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                yield pa.RecordBatch.from_arrays([b["key"], pa.array(np.searchsorted(bounds, b["key"].to_numpy(), side="right"), pa.int32())], names=["key", "range_no"])

        fine = keys.mapInArrow(ranges, "key double, range_no int").groupBy("range_no").agg(within(-(-parts // coarse)))
        found = np.concatenate([found, *(np.array(r["at"], np.float64) for r in fine.toLocalIterator())])
    return np.unique(np.concatenate([np.zeros(1, np.uint64), found[found < 2.0**64].astype(np.uint64)]))


def _level(spark, rows: DataFrame, make_keys: Callable, bounds: np.ndarray, shift: int, contexts: int, path: str, write_part: Callable) -> dict:
    """Count one level, then smooth and write its parts with one discount.

    ``write_part(part, keys, smooth)`` writes a part's file, where
    ``smooth(lower)`` gives probabilities, backoffs and first places. Returns
    the parts' sizes and the offsets of their first contexts' successors."""
    firsts = [int(b) >> shift for b in bounds]
    # A part's last context goes on in the next part unless that begins with a
    # context of its own; the last part ends with the last context.
    lasts = [(int(b) - 1) >> shift for b in bounds[1:]] + [contexts - 1]

    def store_part(part: int, k: np.ndarray, c: np.ndarray) -> dict:
        put_file(f"{path}-{part}-counts", _squeeze(k, c))
        context = (k >> np.uint64(shift)).astype(np.int64)
        ends = {v: [int(c[context == v].sum()), int((context == v).sum())] for v in {firsts[part], lasts[part]}}
        return {"n": len(k), "once": int((c == 1).sum()), "twice": int((c == 2).sum()), "ends": list(ends.items())}

    said = _count_level(rows, _runs, make_keys, bounds, store_part)
    once, twice = sum(x["once"] for x in said.values()), sum(x["twice"] for x in said.values())
    discount = once / (once + 2 * twice) if once and twice else 0.5
    whole: dict[int, list[int]] = {}
    offsets = []
    for i in range(len(bounds)):
        offsets.append(whole.get(firsts[i], [0, 0])[1])
        for v, (total, kinds) in said.get(i, {"ends": []})["ends"]:
            held = whole.setdefault(v, [0, 0])
            held[0] += total
            held[1] += kinds

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for part, some, ends in zip(b["part"].tolist(), b["some"].tolist(), b["ends"].tolist()):
                k, c = np.empty(0, np.uint64), np.empty(0, np.int64)
                if some:
                    with open_file(f"{path}-{part}-counts") as f:
                        k, c = _unsqueeze(f.read())
                context = (k >> np.uint64(shift)).astype(np.int64) - firsts[part]
                known = {int(v) - firsts[part]: x for v, x in json.loads(ends).items()}
                write_part(part, k, lambda lower: _smooth(context, c, lasts[part] - firsts[part] + 1, lower, discount, known))  # noqa: B023
                yield pd.DataFrame({"part": [part]})

    todo = [(i, i in said, json.dumps({v: whole[v] for v in {firsts[i], lasts[i]} if v in whole})) for i in range(len(bounds))]
    spark.createDataFrame(todo, "part int, some boolean, ends string").repartition(len(todo), "part").mapInPandas(write, "part int").collect()
    for i in said:
        remove_file(f"{path}-{i}-counts")
    return {"sizes": [said[i]["n"] if i in said else 0 for i in range(len(bounds))], "offsets": offsets}


def build(docs: DataFrame, vocabulary_parts: int | None = None, part_tokens: int = PART_TOKENS) -> tuple[dict, DataFrame]:
    """Count the texts of ``docs`` (doc_id, text, held_out) that are not held
    out and write the trie. Returns what ``load`` needs (file names and bounds
    of parts) and all texts encoded."""
    spark = docs.sparkSession
    bounded_batches(spark)
    path = shared_dir(spark, "ngram-trie")
    if vocabulary_parts is None:
        vocabulary_parts = max(8, docs.rdd.getNumPartitions() // SPLITS_OF_PART)
    bits = max(0, (vocabulary_parts - 1).bit_length())

    def word_keys() -> Callable:
        import xxhash

        def keys(piece: tuple) -> tuple[np.ndarray, np.ndarray]:
            c = Counter()
            for t in piece[2]:
                c.update(tokens(t))
            c[END] += len(piece[2])
            return np.fromiter((xxhash.xxh3_64_intdigest(w) for w in c), np.uint64, len(c)), np.fromiter(c.values(), np.int64, len(c))

        return keys

    def write_words(part: int, k: np.ndarray, c: np.ndarray) -> dict:
        put_file(f"{path}/words-{part}", pack({"hash": k.astype("<u8"), "count": c.astype("<u8")}))
        return {"n": len(k), "total": int(c.sum())}

    bounds = (np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)) if bits else np.zeros(1, np.uint64)
    read = lambda b: text_runs(b, BATCH_BYTES)
    said = _count_level(docs.where("not held_out").select("text"), read, word_keys, bounds, write_words)
    model = {"path": path, "total": 0, "places": 0, "parts": [0, 0, 0]}
    if not said:
        put_file(f"{path}/parts", pack({"sizes": np.empty(0, np.int64)}))
        return model, cut(encode(docs, model), "trie-ids")
    for i in set(range(1 << bits)) - said.keys():
        said[i] = write_words(i, np.empty(0, np.uint64), np.empty(0, np.int64))
    listed = {"sizes": np.array([said[i]["n"] for i in range(1 << bits)], np.int64)}
    size, total = int(listed["sizes"].sum()), sum(x["total"] for x in said.values())
    check_words(size)
    put_file(f"{path}/parts", pack(listed))
    model |= {"total": total, "parts": [1 << bits, 0, 0]}
    encoded = cut(encode(docs, model), "trie-ids")
    ids_of = encoded.where("not held_out").select("ids")

    one = dict(model)

    def bigram_keys() -> Callable:
        return lambda piece: (_previous(piece[2], piece[3], size) << 32 | piece[2]).astype(np.uint64)

    def write_bigrams(part: int, k: np.ndarray, smooth: Callable) -> None:
        w = (k & np.uint64(0xFFFFFFFF)).astype(np.int64)
        p, back, first = smooth(load(one)[0].p(w))
        put_file(f"{path}/bigrams-{part}", pack({"succ": w.astype("<u4"), "p": codes(p), "back": codes(back), **ef_encode(first, "first")}))

    bounds = quantiles(ids_of, bigram_keys, total, part_tokens)
    got = _level(spark, ids_of, bigram_keys, bounds, 32, size + 1, f"{path}/bigrams", write_bigrams)
    listed |= {"bounds": bounds, "offsets": np.array(got["offsets"], np.int64), "nodes": np.array(got["sizes"], np.int64)}
    places = int(size + 2).bit_length()
    two_levels = model | {"places": places, "parts": [1 << bits, len(bounds), 0], "list": "parts-2"}
    put_file(f"{path}/parts-2", pack(listed))

    def trigram_keys() -> Callable:
        _, two, _ = load(two_levels)

        def keys(piece: tuple) -> np.ndarray:
            _, _, ids, n = piece
            node, place, _, _ = two.find(_previous(ids, n, size), ids)
            before = _previous(node, n, -1)
            inner = before >= 0
            return (before[inner] << places | place[inner]).astype(np.uint64)

        return keys

    def write_trigrams(part: int, k: np.ndarray, smooth: Callable) -> None:
        _, two, _ = load(two_levels)
        node, place = (k >> np.uint64(places)).astype(np.int64), (k & np.uint64((1 << places) - 1)).astype(np.int64)
        u, order, group = grouped(node)
        second = two.nodes.gather("succ", u).astype(np.int64) if len(u) else u
        lower = two.nodes.gather("p", (two.starts(second) if len(u) else u)[group] + place) if len(u) else np.empty(0)
        p, back, first = smooth(10.0 ** (lower / -STEP))
        kind = "<u2" if not len(place) or place.max() < 1 << 16 else "<u4"
        put_file(f"{path}/trigrams-{part}", pack({"succ": place.astype(kind), "p": codes(p), "back": codes(back), **ef_encode(first, "first")}))

    third = quantiles(ids_of, trigram_keys, total, part_tokens)
    _level(spark, ids_of, trigram_keys, third, places, max(1, int(listed["nodes"].sum())), f"{path}/trigrams", write_trigrams)
    put_file(f"{path}/parts-3", pack(listed | {"third": third}))
    return two_levels | {"parts": [1 << bits, len(bounds), len(third)], "list": "parts-3"}, encoded


def check_words(n: int) -> None:
    """Ids of words, and the place after one, have 32 bits beside the mark of
    unknown words."""
    if n > MOST_WORDS:
        raise ValueError(f"{n} words: ids have 32 bits, for {MOST_WORDS} at most")


def _smooth(context: np.ndarray, count: np.ndarray, contexts: int, lower: np.ndarray, d: float, known: dict[int, list[int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Interpolated probabilities, backoffs and first places of contexts.
    ``known`` has total and successors of contexts that lie in other parts too."""
    successors = np.bincount(context, minlength=contexts)
    first = np.concatenate([[0], np.cumsum(successors)])
    totals = np.bincount(context, count, contexts)
    for v, (total, kinds) in known.items():
        totals[v], successors[v] = total, kinds
    back = np.where(totals > 0, d * successors / np.maximum(totals, 1), 1.0)
    p = (count - d) / totals[context] + back[context] * lower if len(context) else np.empty(0)
    return p, back, first


def load(model: dict) -> tuple[Vocabulary, Bigrams, Trigrams]:
    """A model's levels, by the list of its parts; other files are opened when
    they are asked for."""
    listed = defaultdict(lambda: np.empty(0, np.int64), unpack(f"{model['path']}/{model.get('list', 'parts')}"))
    words, bigrams, trigrams = (Files(f"{model['path']}/{level}", n) for level, n in zip(("words", "bigrams", "trigrams"), model["parts"]))
    return Vocabulary(words, listed["sizes"], model["total"]), Bigrams(bigrams, listed["bounds"], listed["offsets"], listed["nodes"]), Trigrams(trigrams, listed["third"], model["places"])


def log_probabilities(levels: tuple, ids: np.ndarray, size: np.ndarray, low1: np.ndarray) -> np.ndarray:
    """log10 probability of each token of some texts; low1 is that of order 1."""
    words, two, three = levels
    node, place, p2, back2 = two.find(_previous(ids, size, words.size), ids)
    low = np.where(np.isnan(p2), back2 + low1, p2)
    p3, back3 = three.find(_previous(node, size, -1), place)
    return np.where(np.isnan(p3), back3 + low, p3)


def score(encoded: DataFrame, model: dict) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = load(model)
        words = levels[0]
        for b in batches:
            for i, j, ids, size in _runs(b):
                low1 = np.log10(words.p(ids))
                at = np.cumsum(size) - size
                base, full = np.add.reduceat(low1, at), np.add.reduceat(log_probabilities(levels, ids, size, low1), at)
                known = np.add.reduceat((ids >= 0).astype(np.int64), at)
                yield pa.RecordBatch.from_arrays([b["doc_id"].slice(i, j - i), b["held_out"].slice(i, j - i), pa.array(size), pa.array(known), pa.array(np.full(j - i, words.total)), pa.array(base), pa.array(full)], names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return encoded.mapInArrow(run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def train_and_score(docs: DataFrame, folds: int = 5, held_fold: int = 1) -> DataFrame:
    """Train on documents whose crc32(doc_id) mod ``folds`` is not
    ``held_fold``; score all of them."""
    held = (crc32_mod(F.col("doc_id"), folds) == held_fold).alias("held_out")
    model, encoded = build(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", held))
    return score(encoded, model)
