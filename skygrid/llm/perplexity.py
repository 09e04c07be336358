"""Quality rules: text counts, then language-specific perplexity bands.

The language model is a modified Kneser-Ney model over characters, one per
value of ``lang``. Tasks count the windows of four characters of all whole
texts; Spark sums them, derives the continuation counts of the lower orders,
the discounts and the interpolated probabilities with groupings and joins.
Characters are counted, not words: their table saturates, so copies of a text
do not make the text look predictable, and it stays small beside the corpus.

A second model of the same kind has order 1: single characters by all their
counts. Junk that is regular (words with a bar or two marks after each, texts
in capitals) is soon as predictable as prose to windows of four, as the model
has counted such junk too; its characters stay rare ones.

A model that has seen a document finds it predictable, even noise. So documents
are split in two halves by a hash of doc_id, each half has a model, and every
document is scored by that of the other half.

The model is stored in sorted hash arrays: 64-bit keys of (language, order,
window) and 32-bit log values, in shards by leading bits, written to the
shared folder and memory-mapped by the scoring tasks.

A document's perplexity is taken over its characters and one end symbol, and
again for stretches of about 200 of these; ``typical`` is the median over its
stretches, so that one foreign passage, name list or address does not make a
document look like junk, which is odd throughout; ``typical_characters`` is
the same by the model of order 1. A language has a band for each of the two,
around the median of all its documents that pass the base rule. On the log
scale it reaches down by ``width`` times 1.4826 times the
median distance of those below the median, up by that of those above it, and
``least_reach`` at least, so that documents which are much alike do not reject
each other. Documents outside of either band are rejected.

Defined cases: a null or empty text has no words and fails the base rule; a
null lang is the same language as the empty one; null doc_ids are in one half;
characters beyond the first plane share codes with it; equal rows are judged
alike; very long texts are worked through whole, each by itself; an empty
table gives no rows; other columns are carried, whatever their names, by
``filter_documents`` and otherwise ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WordHashes, bounded_batches, cut, map_array, mix, put_file, shared_dir, slices, small

ORDER = 4
#: Kinds of the model of order 1 begin here.
CHARACTERS = 32
START, END, OTHER = 1, 2, 3
SYMBOLS = b"#*$%&|<>"
WHITE = b" \t\n\x0b\x0c\r"
BATCH_CHARS = 1_500_000
SHARD_ROWS = 2_000_000
STRETCH = 200
WIDTH = 6.0
LEAST_REACH = 0.1
BROADCAST_LANGUAGES = 100_000


class Windows:
    """The symbols of some texts, and the windows of ORDER that end in each
    predicted symbol: distinct windows, their counts, and where each stands."""

    def __init__(self, texts: list[str]):
        size = np.fromiter(map(len, texts), np.int64, len(texts))
        pad = ORDER - 1
        joined = "".join("\x01\x01\x01" + t + "\x02" for t in texts)
        c = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
        self.chars = c
        c = np.where(c > 0xFFFF, OTHER + c % (0x10000 - OTHER), np.maximum(c, OTHER)).astype(np.int32)
        end = np.cumsum(size + pad + 1)
        first = end - size - pad - 1
        for k in range(pad):
            c[first + k] = START
        c[end - 1] = END
        self.first, self.size = first + pad, size
        predicted = np.ones(len(c), bool)
        for k in range(pad):
            predicted[first + k] = False
        self.at = np.flatnonzero(predicted)
        self.doc_start = np.concatenate([[0], np.cumsum(size + 1)[:-1]])
        self._number(c)

    def _number(self, c: np.ndarray) -> None:
        present = np.flatnonzero(np.bincount(c, minlength=0x10000))
        a = len(present)
        small = np.zeros(0x10000, np.int32)
        small[present] = np.arange(a)
        at = self.at
        if a <= 200:
            x = small[c]
            tri = (x[at - 3] * a + x[at - 2]) * a + x[at - 1]
            seen = np.bincount(tri, minlength=1)
            tri_codes = np.flatnonzero(seen)
            if len(tri_codes) * a <= 1 << 25:
                number = np.zeros(len(seen), np.int32)
                number[tri_codes] = np.arange(len(tri_codes))
                quad = number[tri] * a + x[at]
                counts = np.bincount(quad, minlength=1)
                found = np.flatnonzero(counts)
                self.counts = counts[found]
                place = np.zeros(len(counts), np.int32)
                place[found] = np.arange(len(found))
                self.where = place[quad]
                t, d = tri_codes[found // a], found % a
                parts = [present[t // (a * a)], present[t // a % a], present[t % a], present[d]]
                self.codes = sum(p.astype(np.uint64) << np.uint64(16 * (ORDER - 1 - k)) for k, p in enumerate(parts))
                return
        u = c.astype(np.uint64)
        code = sum(u[at - (ORDER - 1 - k)] << np.uint64(16 * (ORDER - 1 - k)) for k in range(ORDER))
        self.codes, self.where, self.counts = np.unique(code, return_inverse=True, return_counts=True)


def _by_language(b: pa.RecordBatch) -> Iterator[tuple[str, np.ndarray, list[str]]]:
    """Languages of a batch with row numbers and texts, in bounded runs."""
    langs = np.array([x or "" for x in b["lang"].to_pylist()], object)
    sizes = pc.fill_null(pc.binary_length(b["text"].cast(pa.binary())), 0).to_numpy(zero_copy_only=False)
    for lang in dict.fromkeys(langs):
        rows = np.flatnonzero(langs == lang)
        for i, j in slices(sizes[rows], BATCH_CHARS):
            yield lang, rows[i:j], [t or "" for t in b["text"].take(pa.array(rows[i:j])).to_pylist()]


def model_key(trains: bool) -> Column:
    """The model that a document's windows count for, or that scores it:
    language and half."""
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2))
    return F.concat_ws("|", F.coalesce(F.col("lang").cast("string"), F.lit("")), ((1 - half) if trains else half).cast("string"))


def count_windows(docs: DataFrame) -> DataFrame:
    """lang, code, n: how often each window of ORDER stands in all texts of a
    language and half."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[list, list]] = {}

        def merged(lang: str) -> tuple[np.ndarray, np.ndarray]:
            codes, back = np.unique(np.concatenate(held[lang][0]), return_inverse=True)
            return codes, np.bincount(back, np.concatenate(held[lang][1])).astype(np.int64)

        for b in batches:
            for lang, _, texts in _by_language(b):
                w = Windows(texts)
                codes, counts = held.setdefault(lang, ([], []))
                codes.append(w.codes)
                counts.append(w.counts)
                if len(codes) >= 8:
                    c, n = merged(lang)
                    held[lang] = ([c], [n])
        for lang in held:
            c, n = merged(lang)
            for i in range(0, len(c), 100_000):
                part = c[i : i + 100_000]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(part)), pa.array(part.view(np.int64)), pa.array(n[i : i + 100_000])], names=["lang", "code", "n"])

    d = docs.select(model_key(trains=True).alias("lang"), "text")
    return d.mapInArrow(run, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))


def _discounts(grams: DataFrame) -> DataFrame:
    """lang, d1, d2, d3 from the counts of counts."""
    c = grams.groupBy("lang").agg(*[F.count_if(F.col("n") == k).cast("double").alias(f"t{k}") for k in (1, 2, 3, 4)])
    y = F.col("t1") / (F.col("t1") + 2 * F.col("t2"))

    def d(k: int) -> Column:
        raw = F.when((F.col("t1") > 0) & (F.col(f"t{k}") > 0), k - (k + 1) * y * F.try_divide(F.col(f"t{k + 1}"), F.col(f"t{k}"))).otherwise(F.lit(0.5 * k))
        return F.least(F.greatest(raw, F.lit(0.05)), F.lit(k - 0.05)).alias(f"d{k}")

    return c.select(F.col("lang").alias("d_lang"), d(1), d(2), d(3))


def kneser_ney(counts: DataFrame, order: int = ORDER) -> DataFrame:
    """(lang, code, n) of the top order -> lang, kind, code, value: log
    probabilities of windows of k (kind k) and log weights of contexts of k
    (kind 16 + k), interpolated modified Kneser-Ney."""
    # What has a row a language comes by broadcast while there are few.
    few = counts.select("lang").distinct().count() <= BROADCAST_LANGUAGES
    hint = F.broadcast if few else (lambda df: df)
    grams, raw = {order: counts}, counts
    for k in range(order - 1, 0, -1):
        raw = raw.groupBy("lang", F.col("code").bitwiseAND(F.lit((1 << 16 * k) - 1)).alias("code")).agg(F.count("*").alias("n"))
        raw = cut(raw, f"kn{order}-grams{k}")
        grams[k] = raw
    parts, lower = [], None
    for k in range(1, order + 1):
        g = grams[k].withColumn("context", F.shiftrightunsigned("code", 16))
        d = hint(_discounts(g))
        contexts = g.groupBy("lang", "context").agg(F.sum("n").cast("double").alias("total"), F.count_if(F.col("n") == 1).alias("m1"), F.count_if(F.col("n") == 2).alias("m2"), F.count_if(F.col("n") > 2).alias("m3"))
        contexts = contexts.join(d, F.col("lang") == F.col("d_lang")).withColumn("gamma", (F.col("d1") * F.col("m1") + F.col("d2") * F.col("m2") + F.col("d3") * F.col("m3")) / F.col("total"))
        contexts = contexts.select(F.col("lang").alias("c_lang"), F.col("context").alias("c_context"), "total", "gamma", "d1", "d2", "d3")
        j = g.join(contexts, (F.col("lang") == F.col("c_lang")) & (F.col("context") == F.col("c_context")))
        cut_by = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
        own = F.greatest(F.col("n") - cut_by, F.lit(0.0)) / F.col("total")
        if lower is None:
            v = grams[1].groupBy("lang").agg((1.0 / (F.count("*") + 1)).alias("p_low")).withColumnRenamed("lang", "l_lang")
            j = j.join(hint(v), F.col("lang") == F.col("l_lang"))
            base = grams[1].groupBy("lang").agg(F.log(1.0 / (F.count("*") + 1)).alias("value")).select("lang", F.lit(0).alias("kind"), F.lit(0).cast("long").alias("code"), "value")
            parts.append(base)
        else:
            l = lower.select(F.col("lang").alias("l_lang"), F.col("code").alias("l_code"), F.col("p").alias("p_low"))
            j = j.join(l, (F.col("lang") == F.col("l_lang")) & (F.col("code").bitwiseAND(F.lit((1 << 16 * (k - 1)) - 1)) == F.col("l_code")))
        lower = cut(j.select("lang", "code", "context", "gamma", (own + F.col("gamma") * F.col("p_low")).alias("p")), f"kn{order}-p{k}")
        parts.append(lower.select("lang", F.lit(k).alias("kind"), "code", F.log("p").alias("value")))
        parts.append(lower.select("lang", F.lit(16 + k - 1).alias("kind"), F.col("context").alias("code"), F.log("gamma").alias("value")).distinct())
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def both_models(counts: DataFrame) -> DataFrame:
    """The models of ORDER and of order 1 from the counts of windows."""
    single = counts.groupBy("lang", F.col("code").bitwiseAND(F.lit(0xFFFF)).alias("code")).agg(F.sum("n").alias("n"))
    characters = kneser_ney(cut(single, "kn-characters"), 1).withColumn("kind", F.col("kind") + CHARACTERS)
    return kneser_ney(counts).unionByName(characters)


def _key(lang: str, kind: int, code: np.ndarray) -> np.ndarray:
    import xxhash

    return mix(mix(code, xxhash.xxh3_64_intdigest(lang.encode("utf-8", "surrogatepass"))), kind)


def store(model: DataFrame, rows: int, shard_rows: int = SHARD_ROWS) -> list[str]:
    """Write the sorted hash arrays; returns the shard files in key order."""
    spark = model.sparkSession
    bits = max(0, (max(1, rows) // shard_rows).bit_length())
    path = shared_dir(spark, "kn-arrays")

    def keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for (lang, kind), g in b.groupby(["lang", "kind"]):
                k = _key(lang, int(kind), g["code"].to_numpy().view(np.uint64))
                yield pd.DataFrame({"shard": (k >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(k), np.int64), "key": k.view(np.int64), "value": g["value"].to_numpy(np.float32)})

    def write(key: tuple, g: pd.DataFrame) -> pd.DataFrame:
        k = g["key"].to_numpy().view(np.uint64)
        order = np.argsort(k)
        put_file(f"{path}/{key[0]}", len(k).to_bytes(8, "little") + k[order].tobytes() + g["value"].to_numpy(np.float32)[order].tobytes())
        return pd.DataFrame({"shard": [key[0]], "n": [len(k)]})

    made = model.mapInPandas(keys, "shard long, key long, value float").groupBy("shard").applyInPandas(write, "shard long, n long").collect()
    there = {r["shard"] for r in made}
    return [f"{path}/{i}" if i in there else "" for i in range(1 << bits)]


class Arrays:
    """The stored model: look up values by language, kind and code."""

    def __init__(self, shards: list[str]):
        self.bits, self.shards = len(shards).bit_length() - 1, []
        for uri in shards:
            n = int(map_array(uri, "<u8", 0, 1)[0]) if uri else 0
            self.shards.append((map_array(uri, "<u8", 8, n), map_array(uri, "<f4", 8 + 8 * n, n)) if uri else (np.empty(0, np.uint64), np.empty(0, np.float32)))

    def get(self, lang: str, kind: int, code: np.ndarray) -> np.ndarray:
        """Values, nan where there is none."""
        key = _key(lang, kind, code)
        order = np.argsort(key)
        key = key[order]
        out = np.full(len(key), np.nan)
        bounds = [0, *(np.searchsorted(key, np.uint64(i << (64 - self.bits))) for i in range(1, 1 << self.bits)), len(key)] if self.bits else [0, len(key)]
        for (keys, values), i, j in zip(self.shards, bounds, bounds[1:]):
            if len(keys) and j > i:
                at = np.minimum(np.searchsorted(keys, key[i:j]), len(keys) - 1)
                out[i:j] = np.where(keys[at] == key[i:j], values[at], np.nan)
        back = np.empty(len(key))
        back[order] = out
        return back

    def log_p(self, lang: str, codes: np.ndarray, order: int = ORDER, first: int = 0) -> np.ndarray:
        """Natural log probability of the last symbol of each window, by the
        model of ``order`` whose kinds begin at ``first``; missing windows
        back off."""
        total, open_ = np.zeros(len(codes)), np.arange(len(codes))
        for k in range(order, -1, -1):
            part = codes[open_] & np.uint64((1 << 16 * k) - 1)
            v = self.get(lang, first + k, part)
            if k == 0:
                v = np.where(np.isnan(v), np.log(1 / 0x10000), v)
            hit = ~np.isnan(v)
            total[open_[hit]] += v[hit]
            open_ = open_[~hit]
            if not len(open_):
                break
            weight = self.get(lang, first + 16 + k - 1, (codes[open_] & np.uint64((1 << 16 * k) - 1)) >> np.uint64(16))
            total[open_] += np.where(np.isnan(weight), 0.0, weight)
        return total

    def log_p_characters(self, lang: str, codes: np.ndarray) -> np.ndarray:
        """The same by the model of order 1."""
        last, back = np.unique(codes & np.uint64(0xFFFF), return_inverse=True)
        return self.log_p(lang, last, 1, CHARACTERS)[back]


def _repeat_words(words: list[list[bytes]], hashes: WordHashes) -> np.ndarray:
    """Words per document that lie in 3-word windows found twice or more."""
    n = np.fromiter(map(len, words), np.int64, len(words))
    h = hashes([w for d in words for w in d])
    out = np.zeros(len(words), np.int64)
    if len(h) < 4:
        return out
    doc = np.repeat(np.arange(len(words), dtype=np.uint64), n)
    inside = doc[2:] == doc[:-2]
    window = mix(mix(mix(h[:-2], h[1:-1]), h[2:]), doc[2:])[inside]
    s = np.sort(window)
    twice = np.unique(s[1:][s[1:] == s[:-1]])
    if not len(twice):
        return out
    at = np.minimum(np.searchsorted(twice, window), len(twice) - 1)
    start = np.flatnonzero(inside)[twice[at] == window]
    covered = np.zeros(len(h), bool)
    for k in range(3):
        covered[start + k] = True
    return np.bincount(doc[covered].astype(np.int64), minlength=len(words))


def _typical(x: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The median over a document's stretches of about STRETCH symbols of the
    mean in each (the lower one of two)."""
    m = np.maximum(1, size // STRETCH)
    doc = np.repeat(np.arange(len(m)), m)
    no = np.arange(len(doc)) - np.repeat(np.cumsum(m) - m, m)
    at = start[doc] + no * size[doc] // m[doc]
    mean = np.add.reduceat(x, at) / np.diff(np.append(at, len(x)))
    return mean[np.lexsort((mean, doc))][np.cumsum(m) - m + (m - 1) // 2]


def _dup_lines(text: str) -> int:
    lines = [x for x in text.split("\n") if x.strip(" \t\x0b\x0c\r")]
    return len(lines) - len(set(lines))


FOUND = [("n_words", T.LongType(), pa.int64()), ("word_chars", T.LongType(), pa.int64()), ("n_symbols", T.LongType(), pa.int64()), ("n_dup_lines", T.LongType(), pa.int64()), ("n_repeat_words", T.LongType(), pa.int64()), ("log_perplexity", T.DoubleType(), pa.float64()), ("typical", T.DoubleType(), pa.float64()), ("typical_characters", T.DoubleType(), pa.float64())]


MADE = [*[name for name, _, _ in FOUND], "base_failed", "kept", "kn_key"]


def measure(docs: DataFrame, shards: list[str]) -> DataFrame:
    """All columns of ``docs``, the text counts, base_failed and log_perplexity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, hashes = Arrays(shards), WordHashes()
        symbol, white = np.zeros(128, bool), np.zeros(128, bool)
        symbol[list(SYMBOLS)], white[list(WHITE)] = True, True
        for b in batches:
            out = {name: np.zeros(b.num_rows, np.float64 if kind == pa.float64() else np.int64) for name, _, kind in FOUND}
            keys = b["kn_key"]
            b = b.drop_columns(["kn_key"])
            for lang, rows, texts in _by_language(pa.RecordBatch.from_arrays([keys, b["text"]], names=["lang", "text"])):
                w = Windows(texts)
                lp = model.log_p(lang, w.codes)[w.where]
                out["log_perplexity"][rows] = -np.add.reduceat(lp, w.doc_start) / (w.size + 1)
                out["typical"][rows] = _typical(-lp, w.doc_start, w.size + 1)
                out["typical_characters"][rows] = _typical(-model.log_p_characters(lang, w.codes)[w.where], w.doc_start, w.size + 1)
                ascii_ = np.minimum(w.chars, 127)
                for name, table in (("n_symbols", symbol), ("word_chars", white)):
                    # Text counts run over the pads too: the pads are neither.
                    sums = np.concatenate([[0], np.cumsum(table[ascii_], dtype=np.int64)])
                    out[name][rows] = sums[w.first + w.size] - sums[w.first]
                out["word_chars"][rows] = w.size - out["word_chars"][rows]
                words = [t.encode("utf-8", "surrogatepass").split() for t in texts]
                out["n_words"][rows] = [len(x) for x in words]
                out["n_repeat_words"][rows] = _repeat_words(words, hashes)
                out["n_dup_lines"][rows] = [_dup_lines(t) for t in texts]
            yield pa.RecordBatch.from_arrays([*b.columns, *[pa.array(out[name]) for name, _, _ in FOUND]], names=[*b.schema.names, *out])

    fields = [*docs.schema.fields, *[T.StructField(name, kind) for name, kind, _ in FOUND]]
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    keyed = docs.withColumn("kn_key", model_key(trains=False))
    return keyed.mapInArrow(run, T.StructType(fields)).withColumn("base_failed", failed)


#: The measures that have bands.
BANDED = ("typical", "typical_characters")


def bands(measured: DataFrame, width: float = WIDTH, least_reach: float = LEAST_REACH, measure: str = "typical") -> DataFrame:
    """b_lang, low, high of ``measure``. Medians are over values rounded
    to 1/1000, so that a language's group holds few distinct values."""
    m = measured.where("not base_failed").select(F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("b_lang"), F.round(measure, 3).alias("v"))
    middle = cut(m.groupBy("b_lang").agg(F.percentile("v", 0.5).alias("middle")), "kn-medians")
    off = m.join(small(middle.withColumnRenamed("b_lang", "m_lang")), F.col("b_lang") == F.col("m_lang")).withColumn("off", F.round(F.col("v") - F.col("middle"), 3))

    def reach(side: Column) -> Column:
        return F.greatest(1.4826 * width * F.percentile(F.when(side >= 0, side), 0.5), F.lit(least_reach))

    return off.groupBy("b_lang", "middle").agg(reach(-F.col("off")).alias("down"), reach(F.col("off")).alias("up")).select("b_lang", (F.col("middle") - F.col("down")).alias("low"), (F.col("middle") + F.col("up")).alias("high"))


def judge(docs: DataFrame, columns: list[str] | None = None, width: float = WIDTH, least_reach: float = LEAST_REACH) -> DataFrame:
    """The named columns of ``docs`` (default: all), the measures, and kept.
    These take the place of columns of the same names."""
    bounded_batches(docs.sparkSession)
    docs = docs.drop(*MADE)
    model = cut(both_models(cut(count_windows(docs), "kn-counts")), "kn-model")
    shards = store(model, model.count())
    measured = measure(docs, shards)
    if columns is not None:
        measured = measured.drop(*(set(docs.columns) - set(columns) - {"lang"}))
    measured = cut(measured, "kn-measured")
    names, inside = measured.columns, F.lit(True)
    j = measured.alias("m")
    for name in BANDED:
        b = f"b_{name}"
        band = small(cut(bands(measured, width, least_reach, name), "kn-bands")).alias(b)
        j = j.join(band, F.coalesce(F.col("m.lang").cast("string"), F.lit("")) == F.col(f"{b}.b_lang"), "left")
        inside = inside & F.coalesce(F.col(f"m.{name}").between(F.col(f"{b}.low"), F.col(f"{b}.high")), F.lit(True))
    return j.select(*[F.col(f"m.`{c}`") for c in names], (~F.col("m.base_failed") & inside).alias("kept"))


def filter_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents that are kept, with their columns, whatever their names."""
    read = ("doc_id", "lang", "text")
    own = {c: c if c in read else f"c{i}" for i, c in enumerate(docs.columns)}
    kept = judge(docs.select(*[F.col(f"`{c}`").alias(n) for c, n in own.items()]), None, **options).where("kept")
    return kept.select(*[F.col(n).alias(c) for c, n in own.items()])
