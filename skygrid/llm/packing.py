"""Variable-capacity best-fit packing of documents into training sequences.

Texts are cut into pieces of at most the largest permitted length. Pieces go,
longest first, into the open sequence that they fill best. Where none has
room, a sequence is opened with the length that costs least for each word it
is expected to hold. What it can hold is read off the lengths that are still
to be packed: the longest that fit are taken again and again, as far as the
sequences that are open leave words for it. It is charged for the length it
would shrink to, so permitted lengths are weighed against each other by what
can fill them. A sequence of c costs c + ``overhead`` + c * c / ``attention``:
itself, a fixed part, and attention, which grows with the square. At the end
each sequence shrinks to the smallest permitted length that holds its contents.

Pieces are dealt to shards by hash, about ``shard_pieces`` each, and a shard
is packed by one task; only (doc_id, piece, length) move, never texts. A shard
is a fair sample of all lengths and leaves a handful of loose sequences, so the
loss against one global packing is about one part in ``shard_pieces`` / number
of lengths.

Defined cases: null texts and texts without words have no pieces and do not
appear; equal rows are packed as often as they stand there; ties in length go
by doc_id (null first), then piece; ids keep all 64 bits, beside nulls too; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyarrow import compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, word_count

CAPACITIES = (256, 512, 1024, 2048)
OVERHEAD = 16
ATTENTION = 8192
SHARD_PIECES = 20_000
SCHEMA = "bin_id long, capacity int, used int, slot int, bin_offset int, doc_id long, piece int, doc_start long, n_words int"


class Remaining:
    """The lengths still to be packed: how many of each, and how many words
    lie in lengths up to a limit."""

    def __init__(self, lengths: np.ndarray, longest: int):
        self.count = np.bincount(lengths, minlength=longest + 1).tolist()
        self.present, self.sums = 0, [0] * (longest + 2)
        for n, k in enumerate(self.count):
            if k:
                self.present |= 1 << n
                self._add(n, n * k)

    def _add(self, n: int, words: int) -> None:
        while n < len(self.sums):
            self.sums[n] += words
            n += n & -n

    def take(self, n: int) -> None:
        self.count[n] -= 1
        self._add(n, -n)
        if not self.count[n]:
            self.present ^= 1 << n

    def words(self, most: int) -> int:
        """Words in pieces of at most so many."""
        total = 0
        while most:
            total += self.sums[most]
            most -= most & -most
        return total

    def fill(self, room: int) -> int:
        """Words that the longest fitting pieces put into some room."""
        full, fits = room, self.present & ((1 << (room + 1)) - 1)
        while fits:
            n = fits.bit_length() - 1
            room -= n * min(self.count[n], room // n)
            fits &= (1 << min(n, room + 1)) - 1
        return full - room


def pack(lengths: np.ndarray, capacities=CAPACITIES, overhead: float = OVERHEAD, attention: float = ATTENTION) -> tuple[np.ndarray, list[int], list[int]]:
    """Bin of each length (given in packing order, longest first), the final
    bin capacities, and the ones that bins were opened with.

    Open bins are held by the room they have left; a bit set over rooms finds
    the tightest fit in one step.
    """
    caps = sorted(capacities)
    held = Remaining(lengths, caps[-1])
    shortest = int(lengths.min()) if len(lengths) else 0
    by_room: dict[int, list[int]] = {}
    # Rooms that no piece fits into don't compete for words.
    rooms = open_words = 0
    bins, used, opened = np.empty(len(lengths), np.int64), [], []

    def cost(c: int, n: int) -> tuple[float, int]:
        u = n + min(held.fill(c - n), max(0, held.words(min(c - n, n)) - open_words))
        shrunk = next(x for x in caps if x >= u)
        return (shrunk + overhead + shrunk * shrunk / attention) / u, c

    for i, n in enumerate(lengths.tolist()):
        held.take(n)
        fits = rooms >> n
        if fits:
            room = n + (fits & -fits).bit_length() - 1
            stack = by_room[room]
            b = stack.pop()
            if not stack:
                rooms ^= 1 << room
            open_words -= room
        else:
            room = min(cost(c, n) for c in caps if c >= n)[1]
            b = len(used)
            used.append(0)
            opened.append(room)
        bins[i] = b
        used[b] += n
        if room - n >= shortest > 0:
            by_room.setdefault(room - n, []).append(b)
            rooms |= 1 << (room - n)
            open_words += room - n
    return bins, [next(c for c in caps if c >= u) for u in used], opened


def pieces(docs: DataFrame, longest: int) -> DataFrame:
    """doc_id, piece, doc_start, n_words of every piece."""
    n = docs.select(F.col("doc_id").cast("long").alias("doc_id"), word_count(F.col("text")).alias("n")).where("n > 0")
    cut_at = F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(longest).cast("long"))
    each = n.select("doc_id", "n", F.posexplode(cut_at).alias("piece", "doc_start"))
    return each.select("doc_id", "piece", "doc_start", F.least(F.lit(longest), F.col("n") - F.col("doc_start")).cast("int").alias("n_words"))


def pack_documents(docs: DataFrame, capacities=CAPACITIES, overhead: float = OVERHEAD, attention: float = ATTENTION, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """One row per piece: its sequence, the sequence's final capacity and fill,
    its place there, and where in the document it begins."""
    p = cut(pieces(docs, max(capacities)), "pack-pieces")
    shards = max(1, -(-p.count() // shard_pieces))
    shard = F.pmod(F.xxhash64("doc_id", "piece", "n_words", F.monotonically_increasing_id()), F.lit(shards))

    def pack_shard(rows: pa.Table) -> pa.Table:
        rows = rows.take(pc.sort_indices(rows, [("n_words", "descending"), ("doc_id", "ascending"), ("piece", "ascending")], null_placement="at_start")).combine_chunks()
        n = rows["n_words"].to_numpy().astype(np.int64)
        bins, final, _ = pack(n, capacities, overhead, attention)
        # Pieces of a bin in packing order: their number and words before them.
        order = np.argsort(bins, kind="stable")
        first = np.flatnonzero(np.concatenate([[True], np.diff(bins[order]) > 0]))
        size = np.diff(np.append(first, len(n)))
        before = np.cumsum(n[order]) - n[order]
        slot, offset = np.empty(len(n), np.int64), np.empty(len(n), np.int64)
        slot[order] = np.arange(len(n)) - np.repeat(first, size)
        offset[order] = before - np.repeat(before[first], size)
        used = np.bincount(bins, n).astype(np.int64)
        int32 = lambda x: pa.array(x.astype(np.int32))
        return pa.table({
            "bin_id": pa.array((rows["shard"][0].as_py() << 32) + bins), "capacity": int32(np.asarray(final)[bins]), "used": int32(used[bins]), "slot": int32(slot),
            "bin_offset": int32(offset), "doc_id": rows["doc_id"], "piece": rows["piece"], "doc_start": rows["doc_start"], "n_words": rows["n_words"],
        })

    return p.withColumn("shard", shard).groupBy("shard").applyInArrow(pack_shard, SCHEMA)
