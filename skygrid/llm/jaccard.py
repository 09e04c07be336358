"""N-gram Jaccard join by rare-first prefix filtering.

A document's set holds the 64-bit hashes of its distinct word n-grams. Two
documents link when their sets' Jaccard similarity is ``percent`` / 100 or
more. Documents with the same set are one class; the join runs on classes.

1. A sketch of 2 ** ``sketch_bits`` counters holds how many documents have an
   n-gram in each hash range. N-grams are ordered by counter, then hash: rare
   first, the same order everywhere, so the prefix filter stays exact.
2. A class's prefix, its n - ceil(t * n) + 1 rarest n-grams, meets another's if
   they link. A bitmap that follows the number of prefix n-grams up to a bound
   drops those that only one class has (some pass by chance, which costs rows,
   not results); beyond the bound all go to the grouping by n-gram.
3. Classes that share a prefix n-gram are candidates if they pass the length
   filter, the positional filter (what may still match behind the shared
   n-gram) and the suffix filter (a lower bound of the symmetric difference
   from the counts of the sets' n-grams in equal hash ranges, about ``IN_RANGE``
   to a range).
4. First each class meets only the pivot of each of its n-grams, the class
   where that n-gram stands foremost. Links found make components. Then the
   remaining candidates in different components meet; pairs inside a component
   can't change the answer. So the near copies of one text cost about one test
   each, not one per pair. N-grams with more than ``BUCKET`` classes are dealt
   out in pairs of blocks and filtered by numpy; others by a join.
5. Each pair is verified once, on the exact sets.

Components come from alternating star contractions over the links, with every
round written to the shared folder.

Defined cases: null and empty texts and texts without words have the empty set
(n_shingles 0), link with nothing and are components of their own; a text with
fewer words than ``words`` has its whole sequence as its only n-gram; null
doc_ids take part, and a component's id is its smallest id that is not null;
a doc_id that stands on different texts names each of them; equal rows appear as often as they stand in the table; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, WordHashes, bounded_batches, cut, mix, small, text_runs, tokens

SKETCH_BITS = 20
#: A bitmap of 64 MB at most.
BITMAP_BITS = 29
LEAST_BITS = 20
SUMMED = 256
LARGE_CLASS = 1000
IN_RANGE = 2
MOST_RANGES = 1 << 16
BUCKET = 48
BLOCK = 1024
CHUNK = 128
BROADCAST_ROWS = 1_000_000
BATCH_BYTES = 2 << 20


def shingle_sets(texts: list[bytes], words: int, hashes: WordHashes) -> list[np.ndarray]:
    """Sorted distinct n-gram hashes of each text."""
    lists = [tokens(t) for t in texts]
    n = [len(x) for x in lists]
    h = hashes([w for x in lists for w in x])
    rolled = h
    for k in range(1, words):
        rolled = mix(rolled[: len(h) - k], h[k:])
    out, at = [], 0
    for m in n:
        if m >= words:
            out.append(np.unique(rolled[at : at + m - words + 1]))
        elif m:
            x = h[at : at + 1]
            for k in range(1, m):
                x = mix(x, h[at + k : at + k + 1])
            out.append(mix(x, 1000 + m))
        else:
            out.append(np.empty(0, np.uint64))
        at += m
    return out


def _set_id(s: np.ndarray) -> int:
    """One 64-bit id for a set, as a signed integer."""
    with np.errstate(over="ignore"):
        x = mix(np.array([np.bitwise_xor.reduce(mix(s, 5))]), np.array([mix(s, 6).sum()]))
    return int(mix(x, len(s)).view(np.int64)[0])


def _ranges(s: np.ndarray) -> bytes:
    """N-grams of a set in each of 2 ** k hash ranges; k follows its size.
    Empty (no bound) should a count not fit a byte."""
    bits = max(1, min(MOST_RANGES, len(s) // IN_RANGE).bit_length()) - 1
    counts = np.bincount((s >> np.uint64(63 - bits) >> np.uint64(1)).astype(np.int64), minlength=1 << bits)
    return counts.astype(np.uint8).tobytes() if counts.max(initial=0) < 256 else b""


def _fold(r: bytes, k: int) -> np.ndarray:
    return np.frombuffer(r, np.uint8).reshape(k, -1).sum(axis=1, dtype=np.int32)


def _apart(r1: bytes, r2: bytes) -> int:
    """A lower bound of the symmetric difference of two sets."""
    k = min(len(r1), len(r2))
    return int(np.abs(_fold(r1, k) - _fold(r2, k)).sum()) if k else 0


def _sets(b: pa.RecordBatch, words: int, hashes: WordHashes) -> Iterator[tuple[int, list[np.ndarray]]]:
    for i, _, texts in text_runs(b, BATCH_BYTES):
        yield i, shingle_sets(texts, words, hashes)


def count_sketch(docs: DataFrame, words: int, bits: int = SKETCH_BITS) -> np.ndarray:
    """Documents per hash range of n-grams, over all documents."""
    import zstandard
    from pyspark import TaskContext

    chunks = 16

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        import zstandard

        hashes, total = WordHashes(), np.zeros(1 << bits, np.int64)
        for b in batches:
            for _, sets in _sets(b, words, hashes):
                total += np.bincount((np.concatenate(sets) >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
        packed = [zstandard.compress(np.minimum(c, 0xFFFFFFFF).astype("<u4").tobytes()) for c in np.split(total, chunks)]
        task = np.full(chunks, TaskContext.get().partitionId(), np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(range(chunks), pa.int32()), pa.array(task), pa.array(packed, pa.binary())], names=["chunk", "task", "counts"])

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        import zstandard

        total = sum(np.frombuffer(zstandard.decompress(c), "<u4").astype(np.int64) for c in rows["counts"])
        return pd.DataFrame({"chunk": rows["chunk"].iloc[:1], "task": rows["task"].iloc[:1] // SUMMED, "counts": [zstandard.compress(np.minimum(total, 0xFFFFFFFF).astype("<u4").tobytes())]})

    # A tree of sums: no group holds more than SUMMED pieces of any chunk.
    kind = "chunk int, task int, counts binary"
    sums = docs.select("text").mapInArrow(count, kind).groupBy("chunk", F.floor(F.col("task") / SUMMED).alias("group")).applyInPandas(add, kind)
    sums = cut(sums, "jaccard-sketch")
    while (sums.agg(F.max("task")).first()[0] or 0) > 0:
        sums = cut(sums.groupBy("chunk", F.floor(F.col("task") / SUMMED).alias("group")).applyInPandas(add, kind), "jaccard-sketch")
    got = sums.collect()
    return np.concatenate([np.frombuffer(zstandard.decompress(r["counts"]), "<u4") for r in sorted(got, key=lambda r: r["chunk"])]) if got else np.zeros(1 << bits, np.uint32)


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, text. A doc_id may stand on rows of different texts;
    with the text's hash it names what rows are alike."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")


def prefixes(docs: DataFrame, words: int, percent: int, sketch: np.ndarray) -> DataFrame:
    """doc_id, text_key, n_shingles, class (null for empty sets), prefix, ranges."""
    sent = docs.sparkSession.sparkContext.broadcast(sketch.tobytes())
    shift = np.uint64(64 - (len(sketch).bit_length() - 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, rare = WordHashes(), np.frombuffer(sent.value, np.uint32)
        for b in batches:
            ids, keys = b["doc_id"], b["text_key"]
            for i, sets in _sets(b, words, hashes):
                n = [len(s) for s in sets]
                first, ranges = [], []
                for s in sets:
                    m = len(s)
                    keep = m - -(-percent * m // 100) + 1 if m else 0
                    first.append(s[np.argsort(rare[(s >> shift).astype(np.int64)], kind="stable")[:keep]].view(np.int64))
                    ranges.append(_ranges(s))
                flat = np.concatenate(first) if first else np.empty(0, np.int64)
                ends = np.concatenate([[0], np.cumsum([len(f) for f in first])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    ids.slice(i, len(sets)), keys.slice(i, len(sets)), pa.array(n, pa.int64()), pa.array([_set_id(s) if len(s) else None for s in sets], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)), pa.array(ranges, pa.binary()),
                ], names=["doc_id", "text_key", "n_shingles", "class", "prefix", "ranges"])

    return keyed(docs).mapInArrow(run, "doc_id long, text_key long, n_shingles long, class long, prefix array<long>, ranges binary")


def shared_bitmap(classes: DataFrame, most_bits: int = BITMAP_BITS) -> bytes | None:
    """A bit for each hash range in which some n-gram is in two prefixes. It
    has four bits for each n-gram, up to 2 ** most_bits, which bounds what is
    broadcast; None where it would be too full to be of use."""
    rows = classes.agg(F.sum(F.size("prefix"))).first()[0] or 0
    if rows > 2 << most_bits:
        return None
    bits = min(most_bits, max(LEAST_BITS, (4 * rows).bit_length()))
    parts = 1 << max(3, (rows // 4_000_000).bit_length())
    low = bits - (parts.bit_length() - 1)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.sort(b["prefix"].flatten().to_numpy(zero_copy_only=False).view(np.uint64))
            at = np.searchsorted(x, np.arange(1, parts, dtype=np.uint64) << np.uint64(64 - bits + low))
            yield pa.RecordBatch.from_arrays([pa.array(range(parts), pa.int32()), pa.array([p.tobytes() for p in np.split(x, at)], pa.binary())], names=["part", "grams"])

    def mark(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        x = np.sort(np.concatenate([np.frombuffer(g, np.uint64) for g in rows["grams"]]))
        twice = x[1:][x[1:] == x[:-1]]
        marks = np.zeros(1 << low, np.uint8)
        marks[((twice >> np.uint64(64 - bits)) & np.uint64((1 << low) - 1)).astype(np.int64)] = 1
        return pd.DataFrame({"part": [key[0]], "marks": [np.packbits(marks).tobytes()]})

    got = classes.select("prefix").mapInArrow(deal, "part int, grams binary").groupBy("part").applyInPandas(mark, "part int, marks binary").collect()
    return b"".join(r["marks"] for r in sorted(got, key=lambda r: r["part"])) if got else bytes(1 << (bits - 3))


def prefix_rows(classes: DataFrame, bitmap: bytes | None) -> DataFrame:
    """class, n, pos, gram of the prefix n-grams that may be shared."""
    if bitmap is None:
        return classes.select("class", "n", F.posexplode("prefix").alias("pos", "gram"))
    sent = classes.sparkSession.sparkContext.broadcast(bitmap)
    shift = np.uint64(64 - (len(bitmap).bit_length() + 2))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = np.frombuffer(sent.value, np.uint8)
        for b in batches:
            grams = b["prefix"].flatten().to_numpy(zero_copy_only=False)
            size = b["prefix"].value_lengths().to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(b.num_rows), size)
            pos = np.arange(len(grams)) - np.repeat(np.cumsum(size) - size, size)
            at = (grams.view(np.uint64) >> shift).astype(np.int64)
            hit = np.flatnonzero((marks[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1)
            take = pa.array(row[hit])
            yield pa.RecordBatch.from_arrays([b["class"].take(take), b["n"].take(take), pa.array(pos[hit].astype(np.int32)), pa.array(grams[hit])], names=["class", "n", "pos", "gram"])

    return classes.select("class", "n", "prefix").mapInArrow(run, "class long, n long, pos int, gram long")


def _may_link(percent: int, n1: Column, p1: Column, n2: Column, p2: Column) -> Column:
    """Length and positional filters."""
    need = F.ceil((percent * (n1 + n2)) / F.lit(100.0 + percent) - 1e-9)
    return (100 * F.least(n1, n2) >= percent * F.greatest(n1, n2)) & (F.least(n1 - p1, n2 - p2) >= need)


def _allowed(percent: int, total: np.ndarray) -> np.ndarray:
    """The largest symmetric difference of linked sets of so many elements."""
    return total - 2 * -(-percent * total // (100 + percent))


def verify(pairs: DataFrame, docs: DataFrame, classes: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b of classes) that link, tested on their exact sets."""
    r = classes.select(F.col("class").alias("r_class"), "n", "ranges")
    p = pairs.join(r, F.col("a") == F.col("r_class")).select("a", "b", F.col("n").alias("n1"), F.col("ranges").alias("r1"))
    p = p.join(r, F.col("b") == F.col("r_class")).select("a", "b", "n1", "r1", F.col("n").alias("n2"), F.col("ranges").alias("r2"))

    def suffix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            apart = np.fromiter(map(_apart, b["r1"].to_pylist(), b["r2"].to_pylist()), np.int64, b.num_rows)
            hit = pa.array(apart <= _allowed(percent, b["n1"].to_numpy() + b["n2"].to_numpy()))
            yield pa.RecordBatch.from_arrays([b["a"].filter(hit), b["b"].filter(hit)], names=["a", "b"])

    p = cut(p.mapInArrow(suffix, "a long, b long"), "jaccard-pairs")
    wanted = p.select(F.col("a").alias("class")).union(p.select("b")).distinct()
    ids = cut(wanted.join(classes, "class").select(F.col("first.doc_id").alias("w_doc"), F.col("first.text_key").alias("w_key")).distinct(), "jaccard-wanted")
    if ids.count() <= BROADCAST_ROWS:
        ids = F.broadcast(ids)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for b in batches:
            for _, sets in _sets(b, words, hashes):
                yield pa.RecordBatch.from_arrays([pa.array([_set_id(s) if len(s) else None for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], names=["s_class", "grams"])

    made = keyed(docs).join(ids, F.col("doc_id").eqNullSafe(F.col("w_doc")) & (F.col("text_key") == F.col("w_key")), "left_semi").select("text").mapInArrow(make, "s_class long, grams binary")
    # Each a is a head that its partners pass by, in chunks of bounded size.
    chunks = p.groupBy(F.col("a").alias("c_a")).agg(F.ceil(F.count("*") / CHUNK).alias("chunks"))
    p = p.join(chunks, F.col("a") == F.col("c_a")).select("a", "b", F.pmod(F.xxhash64("b"), F.col("chunks")).alias("chunk"))
    needs = p.select("a", "chunk", F.lit(1).alias("role"), F.col("b").alias("class")).union(p.select("a", "chunk", F.lit(0), F.col("a")).distinct())
    j = needs.join(made, F.col("class") == F.col("s_class")).select("a", "chunk", "role", "class", "grams")
    j = j.repartition("a", "chunk").sortWithinPartitions("a", "chunk", "role")

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, head = None, np.empty(0, np.uint64)
        for b in batches:
            out_a, out_b = [], []
            for a, chunk, role, c, grams in zip(*(b[k].to_pylist() for k in ("a", "chunk", "role", "class", "grams"))):
                x = np.frombuffer(grams, np.uint64)
                if role == 0:
                    now, head = (a, chunk), x
                elif (a, chunk) == now:
                    both = np.sort(np.concatenate([head, x]), kind="stable")
                    same = int(np.count_nonzero(both[1:] == both[:-1]))
                    if 100 * same >= percent * (len(x) + len(head) - same):
                        out_a.append(a)
                        out_b.append(c)
            yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], names=["a", "b"])

    return j.mapInArrow(test, "a long, b long").distinct()


def components(links: DataFrame) -> DataFrame:
    """(a, b) -> node, root: every linked node with its component's smallest."""
    e = cut(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct(), "cc-edges")
    before = None
    while True:
        both = e.union(e.select("v", "u"))
        low = both.groupBy(F.col("u").alias("lu")).agg(F.min("v").alias("m"))
        large = both.join(low, F.col("u") == F.col("lu")).where("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct()
        low = large.groupBy(F.col("u").alias("lu")).agg(F.min("v").alias("m"))
        small = large.join(low, F.col("u") == F.col("lu"))
        e = cut(small.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("lu", "m")).distinct(), "cc-edges")
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(e.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
        before = now


def _block_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """Candidates inside large buckets, by pairs of blocks of classes.

    rows: gram, size, class, n, pos, comp, ranges.
    """
    blocks = F.ceil(F.col("size") / BLOCK)
    dealt = rows.withColumn("blocks", blocks).withColumn("mine", F.pmod(F.xxhash64("class", "gram"), F.col("blocks")))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    dealt = dealt.withColumns({"i": F.least("mine", "other"), "j": F.greatest("mine", "other")})

    def meet(key: tuple, g: pd.DataFrame) -> pd.DataFrame:
        i, j = key[1], key[2]
        left, right = g[g["mine"] == i], g[g["mine"] == j]
        n2, p2, c2, id2 = (right[c].to_numpy() for c in ("n", "pos", "comp", "class"))
        sizes = right["ranges"].map(len).to_numpy()
        # The right side's counts, folded to each number of ranges.
        tables = {k: np.stack([_fold(r, k) if len(r) >= k else np.zeros(k, np.int32) for r in right["ranges"]]) for k in {*sizes, *left["ranges"].map(len)} - {0}}
        out_a, out_b = [], []
        for n1, p1, c1, id1, r1 in zip(left["n"], left["pos"], left["comp"], left["class"], left["ranges"]):
            total = n1 + n2
            ok = (c2 != c1) & (100 * np.minimum(n1, n2) >= percent * np.maximum(n1, n2)) & (np.minimum(n1 - p1, n2 - p2) >= -(-percent * total // (100 + percent)))
            if i == j:
                ok &= id2 > id1
            at = np.flatnonzero(ok)
            apart, level = np.zeros(len(at), np.int64), np.minimum(sizes[at], len(r1))
            for k in set(level.tolist()) - {0}:
                same = level == k
                apart[same] = np.abs(tables[k][at[same]] - _fold(r1, k)).sum(axis=1)
            at = at[apart <= _allowed(percent, total[at])]
            out_a.append(np.full(len(at), id1))
            out_b.append(id2[at])
        a, b = np.concatenate(out_a or [np.empty(0, np.int64)]), np.concatenate(out_b or [np.empty(0, np.int64)])
        return pd.DataFrame({"a": np.minimum(a, b).astype(np.int64), "b": np.maximum(a, b).astype(np.int64)})

    return dealt.groupBy("gram", "i", "j").applyInPandas(meet, "a long, b long")


def _first() -> Column:
    """Orders rows by doc_id, null last, then by text."""
    return F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_key")


def jaccard_components(docs: DataFrame, words: int = 3, percent: int = 90) -> DataFrame:
    """doc_id, text_key, n_shingles, class, component_id, and first, the first
    row of the component (by doc_id, null last, then by text): one row per row
    of ``docs``."""
    bounded_batches(docs.sparkSession)
    sketch = count_sketch(docs, words)
    sets = cut(prefixes(docs, words, percent, sketch), "jaccard-prefixes")
    full = sets.where("class is not null")
    classes = cut(full.groupBy("class").agg(F.count("*").alias("rows"), F.min(_first()).alias("first"), F.min("n_shingles").alias("n"), F.first("prefix").alias("prefix"), F.first("ranges").alias("ranges")), "jaccard-classes")
    rows = cut(prefix_rows(classes, shared_bitmap(classes)), "jaccard-rows")

    bucket = rows.groupBy(F.col("gram").alias("b_gram")).agg(F.count("*").alias("size"), F.min(F.struct("pos", "n", "class")).alias("pivot")).where("size > 1")
    rows = cut(rows.join(bucket, F.col("gram") == F.col("b_gram")).drop("b_gram"), "jaccard-buckets")
    p = F.col("pivot")
    to_pivot = rows.where((F.col("class") != p["class"]) & _may_link(percent, F.col("n"), F.col("pos"), p["n"], p["pos"]))
    to_pivot = cut(to_pivot.select(F.least("class", p["class"]).alias("a"), F.greatest("class", p["class"]).alias("b")).distinct(), "jaccard-pivots")
    links = cut(verify(to_pivot, docs, classes, words, percent), "jaccard-links")
    comp = cut(components(links), "jaccard-components")

    rest = rows.drop("pivot").join(comp, F.col("class") == F.col("node"), "left").withColumn("comp", F.coalesce("root", "class")).drop("node", "root")
    mixed = rest.groupBy(F.col("gram").alias("m_gram")).agg(F.min("comp").alias("c1"), F.max("comp").alias("c2")).where("c1 < c2").select("m_gram")
    rest = cut(rest.join(mixed, F.col("gram") == F.col("m_gram"), "left_semi"), "jaccard-rest")
    few = rest.where(F.col("size") <= BUCKET)
    x, y = (few.select(*[F.col(c).alias(f"{s}_{c}") for c in ("gram", "class", "n", "pos", "comp")]) for s in "xy")
    on = (F.col("x_gram") == F.col("y_gram")) & (F.col("x_class") < F.col("y_class")) & (F.col("x_comp") != F.col("y_comp")) & _may_link(percent, F.col("x_n"), F.col("x_pos"), F.col("y_n"), F.col("y_pos"))
    pairs = x.join(y, on).select(F.col("x_class").alias("a"), F.col("y_class").alias("b"))
    ranges = classes.select(F.col("class").alias("r_class"), "ranges")
    many = rest.where(F.col("size") > BUCKET).join(ranges, F.col("class") == F.col("r_class")).drop("r_class")
    pairs = pairs.unionByName(_block_pairs(many, percent)).distinct()
    pairs = cut(pairs.join(to_pivot, ["a", "b"], "left_anti"), "jaccard-others")
    more = cut(verify(pairs, docs, classes, words, percent), "jaccard-links")
    if not more.isEmpty():
        comp = cut(components(comp.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more)), "jaccard-components")

    # Only linked classes are grouped and named again; others stand alone.
    linked = classes.select("class", "first").join(comp, F.col("class") == F.col("node"))
    roots = cut(linked.groupBy(F.col("root").alias("g_root")).agg(F.min("first").alias("g_first")), "jaccard-roots")
    linked = comp.join(small(roots), F.col("root") == F.col("g_root")).select("node", "g_first")
    named = classes.join(linked, F.col("class") == F.col("node"), "left").select(F.col("class").alias("n_class"), "rows", F.coalesce("g_first", "first").alias("first"))
    named = cut(named, "jaccard-named")
    # Classes with many rows, of which there are few, come by broadcast, so
    # that no class fills a task; rows without n-gram need no join.
    each = sets.select("doc_id", "text_key", "n_shingles", "class")
    large = small(named.where(F.col("rows") > LARGE_CLASS).drop("rows"))
    on = F.col("class") == F.col("n_class")
    others = each.where("class is not null").join(large.select("n_class"), on, "left_anti").join(named.drop("rows"), on)
    lone = each.where("class is null").withColumns({"n_class": F.col("class"), "first": _first()})
    out = each.join(large, on).unionByName(others).unionByName(lone)
    return out.select("doc_id", "text_key", "n_shingles", "class", F.col("first.doc_id").alias("component_id"), "first")


def keep_one(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The documents, one of each component: the one with the smallest doc_id,
    then text hash; a row without doc_id only where all are. Of rows alike in
    doc_id and text the least in order of all columns (which must have an
    order) stays. Documents without an n-gram all stay. Columns are carried,
    whatever their names."""
    found = cut(jaccard_components(docs, words, percent), "jaccard-found")
    first = found.where("class is not null").groupBy("first").agg(F.count_if((F.col("first.text_key") == F.col("text_key")) & F.col("first.doc_id").eqNullSafe(F.col("doc_id"))).alias("rows"))
    keep = cut(first.select("first.doc_id", "first.text_key", "rows"), "jaccard-keep")
    # The document travels as one column, so that no name can clash.
    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), F.coalesce(F.col("text").rlike(WORD), F.lit(False)).alias("has_words"))
    k = (F.broadcast(keep) if keep.count() <= BROADCAST_ROWS else keep).alias("k")
    full = d.where("has_words").alias("d").join(k, F.col("d.doc_id").eqNullSafe(F.col("k.doc_id")) & (F.col("d.text_key") == F.col("k.text_key"))).select("d.doc", "d.doc_id", "d.text_key", "k.rows")
    kept = full.where("rows = 1").select("doc")
    if not keep.where("rows > 1").isEmpty():
        kept = kept.unionByName(full.where("rows > 1").groupBy("doc_id", "text_key").agg(F.min("doc").alias("doc")).select("doc"))
    return kept.unionByName(d.where("not has_words").select("doc")).select("doc.*")
