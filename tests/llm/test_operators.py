"""The training-data operators against brute force, and their defined cases."""

import collections
import html
import io
import math
import os
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from skygrid.llm import jaccard, mixing, neighbours, packing, perplexity, quality, template, tokenfiles, trie, urls

DOCS = "doc_id long, text string, lang string, source string, n_chars long, class string, block string, size string"


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def corpus(n=120, seed=1):
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("abcdeéöß") for _ in range(r.randint(1, 7))) for _ in range(400)]
    out = []
    for i in range(n):
        t = [r.choice(vocabulary[: r.choice((20, 400))]) for _ in range(r.choice((0, 1, 2, 3, 30, 80, 300)))]
        if i % 5 == 1 and out:
            t = (out[r.randrange(len(out))][1] or "").split()
            if t and i % 2:
                t[r.randrange(len(t))] = "changed"
        out.append((i, r.choice((" ", "\n", "\t", "  ")).join(t)))
    out[3], out[4] = (3, None), (4, "")
    out.append((900, "word " * 60_000))
    out.append((901, "\u00a0\u2003 \n\r\x0b"))
    return out


def frame(spark, rows):
    """Documents with clashing extra columns."""
    full = [(d, t, ("en", "de", None)[(d or 0) % 3], ("a", "b", "é", None)[(d or 0) % 4], len(t or ""), "c", "b", "s") for d, t in rows]
    return spark.createDataFrame(full, DOCS)


# --- mixing ---------------------------------------------------------------


def targets_by_hand(sizes, weights, cap):
    total, target, fixed = sum(sizes), [0.0] * len(sizes), set()
    while True:
        open_ = [i for i in range(len(sizes)) if i not in fixed]
        if not open_:
            return target
        rest, w = total - sum(target[i] for i in fixed), sum(weights[i % len(weights)] for i in open_)
        for i in open_:
            target[i] = rest * weights[i % len(weights)] / w
        over = [i for i in open_ if target[i] > cap * sizes[i] + 1e-9]
        if not over:
            return target
        for i in over:
            target[i] = float(cap * sizes[i])
        fixed |= set(over)


def test_targets(spark):
    sizes = {"a": 10, "b": 1000, "c": 5, "d": 0, None: 700}
    got = {r["source"]: r["target"] for r in mixing.source_targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()}
    names = ["a", "b", "c", "d", None]
    assert [got[n] for n in names] == pytest.approx(targets_by_hand([sizes[n] for n in names], (5, 2, 1), 3))


def test_targets_of_many_sources(spark):
    """Ranks and targets hold over several ranges of sources."""
    r = random.Random(3)
    sizes = {f"{chr(r.choice((65, 97, 233, 0xFFFD, 0x1F600)))}{i}": int(10 ** r.uniform(0, 7)) for i in range(400)} | {None: 5000, "": 12, "empty": 0}
    d = spark.createDataFrame(list(sizes.items()), "source string, source_size long").repartition(5)
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    try:
        assert mixing.ranked(d).select(F.spark_partition_id()).distinct().count() > 1
        ranks = {x["source"]: x["rank"] for x in mixing.ranked(d).collect()}
        got = {x["source"]: x["target"] for x in mixing.source_targets(d).collect()}
    finally:
        spark.conf.unset(name)
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    assert [ranks[n] for n in names] == list(range(len(names)))
    want = targets_by_hand([sizes[n] for n in names], (5, 2, 1), 3)
    assert [got[n] for n in names] == pytest.approx(want)
    assert sum(got.values()) == pytest.approx(sum(sizes.values()))
    nothing = mixing.source_targets(spark.createDataFrame([("a", 0), (None, 0)], "source string, source_size long")).collect()
    assert [x["target"] for x in nothing] == [0.0, 0.0]


def test_mix(spark):
    rows = corpus(400)
    d = frame(spark, rows + rows[:7] + [(None, "no id at all")])
    r = mixing.mix_report(d).collect()
    assert len(r) == d.count()
    size = collections.Counter()
    taken = collections.Counter()
    for x in r:
        assert 0 <= x["copies"] <= 3 and x["taken"] == x["copies"] * x["size"]
        size[x["source"]] += x["size"]
        taken[x["source"]] += x["taken"]
    names = sorted((s for s in size if s is not None), key=lambda s: s.encode("utf-32-be")) + [None]
    want = dict(zip(names, targets_by_hand([size[s] for s in names], (5, 2, 1), 3)))
    longest = collections.defaultdict(int)
    for x in r:
        assert x["target"] == pytest.approx(want[x["source"]]) and x["source_size"] == size[x["source"]]
        longest[x["source"]] = max(longest[x["source"]], x["size"])
    # Each source misses by less than a document (repeated rows share one draw).
    assert all(abs(taken[s] - want[s]) <= 2 * longest[s] for s in names)
    key = lambda x: (x["doc_id"] is None, x["doc_id"], x["source"] or "", x["taken"])
    assert sorted(map(tuple, sorted(r, key=key)), key=repr) == sorted(map(tuple, mixing.mix_report(d).collect()), key=repr)
    m = mixing.mix_documents(d)
    assert m.columns == d.columns and m.count() == sum(x["copies"] for x in r)


def test_mix_shares_copies_among_equal_rows(spark):
    """A third of all rows is one document, over many partitions."""
    rows = [(i, f"word{i} " * (1 + i % 9)) for i in range(120)] + [(5, "the same text again")] * 60 + [(None, "nor this")] * 3
    d = frame(spark, rows).withColumns({"source": F.lit("a"), "lang": F.lit("en")}).repartition(7)
    r = mixing.mix_report(d).collect()
    copies = collections.Counter((x["doc_id"], x["size"]) for x in r for _ in range(x["copies"]))
    m = mixing.mix_documents(d).collect()
    assert collections.Counter((x["doc_id"], len(words_of(x["text"]))) for x in m) == copies
    assert copies[5, 4] in range(50, 71)


def test_mix_is_unbiased_in_words(spark):
    u = spark.range(300).selectExpr("id AS doc_id", "'s' AS source", "xxhash64(id) AS mix_hash", "1 + id % 7 AS size", "0.3e0 AS p")
    want = 0.3 * sum(1 + i % 7 for i in range(300))
    for seed in range(3):
        got = mixing.round_copies(u, 16, seed).agg(F.sum(F.col("size") * F.col("extra")), F.count("*")).first()
        assert abs(got[0] - want) <= 7 and got[1] == 300


def test_empty_mix(spark):
    none = frame(spark, [])
    assert mixing.mix_report(none).count() == 0 and mixing.mix_documents(none).count() == 0


# --- packing --------------------------------------------------------------


def test_packing_holds_everything(spark):
    rows = corpus(200)
    d = frame(spark, rows + rows[:5])
    p = packing.pack_documents(d, (16, 64, 256), shard_pieces=100).collect()
    want = collections.Counter((i, len(words_of(t))) for i, t in rows + rows[:5] if words_of(t))
    got = collections.Counter()
    for r in p:
        got[r["doc_id"]] += r["n_words"]
    assert got == collections.Counter({i: sum(n * c for (j, n), c in want.items() if j == i) for i, _ in want})
    by_bin = collections.defaultdict(list)
    for r in p:
        by_bin[r["bin_id"]].append(r)
    for pieces in by_bin.values():
        pieces.sort(key=lambda r: r["slot"])
        used, cap = sum(r["n_words"] for r in pieces), pieces[0]["capacity"]
        assert used == pieces[0]["used"] <= cap and cap == min(c for c in (16, 64, 256) if c >= used)
        assert [r["bin_offset"] for r in pieces] == [sum(x["n_words"] for x in pieces[:i]) for i in range(len(pieces))]
    assert packing.pack_documents(frame(spark, [])).count() == 0


def least_capacity(lengths, caps):
    """The least total capacity over all ways to share pieces among bins."""
    best = math.inf

    def place(i, bins):
        nonlocal best
        if i == len(lengths):
            best = min(best, sum(min(c for c in caps if c >= b) for b in bins))
            return
        for k in range(len(bins)):
            if bins[k] + lengths[i] <= caps[-1]:
                place(i + 1, [*bins[:k], bins[k] + lengths[i], *bins[k + 1 :]])
        place(i + 1, [*bins, lengths[i]])

    place(0, [])
    return best


def test_best_fit_against_all_packings():
    r, caps, total, least = random.Random(11), (16, 64, 100), 0, 0
    for _ in range(150):
        lengths = sorted((r.choice((r.randint(1, 100), r.randint(1, 20))) for _ in range(r.randint(1, 7))), reverse=True)
        bins, final, _ = packing.pack(np.array(lengths), caps, 0, math.inf)
        used = collections.Counter()
        for b, n in zip(bins.tolist(), lengths):
            used[b] += n
        assert [min(c for c in caps if c >= used[b]) for b in range(len(final))] == final and max(used.values()) <= 100
        best = least_capacity(lengths, caps)
        assert sum(final) <= 2 * best
        total, least = total + sum(final), least + best
    assert total <= 1.1 * least


def test_lengths_of_sequences_are_chosen_by_what_fills_them():
    lengths = np.sort(np.minimum(2048, 1 + np.random.default_rng(0).lognormal(5.3, 1.0, 20_000).astype(np.int64)))[::-1]
    _, final, opened = packing.pack(lengths)
    assert all(opened.count(c) > 100 for c in packing.CAPACITIES)
    assert sum(final) <= 1.001 * lengths.sum()
    dearer = sum(c + packing.OVERHEAD + c * c / packing.ATTENTION for c in packing.pack(lengths, (2048,))[1])
    assert sum(c + packing.OVERHEAD + c * c / packing.ATTENTION for c in final) < 0.95 * dearer
    # Six pieces of 300 fill 2048 no better than three fill 1024; 1100 fits one size only.
    assert set(packing.pack(np.full(600, 300))[2]) == {1024} and set(packing.pack(np.full(9, 1100))[2]) == {2048}
    assert packing.pack(np.array([9]), (16, 64, 100))[1] == [16] and packing.pack(np.empty(0, np.int64))[1] == []


def test_packing_keeps_large_ids_beside_nulls(spark):
    big = (1 << 53) + 1
    d = spark.createDataFrame([(None, "a b c"), (big, "a b"), (-(1 << 63), "a")], "doc_id long, text string")
    assert {r["doc_id"]: r["n_words"] for r in packing.pack_documents(d).collect()} == {None: 3, big: 2, -(1 << 63): 1}


# --- URLs -----------------------------------------------------------------


def test_urls(spark):
    rows = [(1, "HTTPS://WWW.Spam.org:80/A/x.html?q#f"), (2, "http://spam.org/A/x/"), (3, "spam.org/A/x"), (4, None), (5, "http://ok.com/en/70"), (6, "http://a.example.com/en/7x"), (7, "x://h"), (8, "http://notexample.com/en/7"), (8, "http://notexample.com/en/7")]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    rules = (("com", "/en/", "block"), ("example.com", "/en/7", "allow"))
    got = sorted(map(tuple, urls.judge_urls(pages, pages.where("page_id = 2"), rules).collect()), key=repr)
    want = [
        (1, "www.spam.org:80", "/A/x.html", None, "block", True), (2, "spam.org", "/A/x/", None, "block", True), (3, "", "", None, "allow", False), (4, "", "", None, "allow", False),
        (5, "ok.com", "/en/70", "com/en/", "block", False), (6, "a.example.com", "/en/7x", "example.com/en/7", "allow", False), (7, "h", "", None, "allow", False),
        (8, "notexample.com", "/en/7", "com/en/", "block", False), (8, "notexample.com", "/en/7", "com/en/", "block", False),
    ]
    assert got == sorted(want, key=repr)


def test_bloom_filter_has_no_misses_and_few_false_hits(spark):
    listed = spark.range(3000).selectExpr("concat('h/', id) AS canonical")
    asked = spark.range(9000).selectExpr("concat('h/', id) AS canonical", "1 AS block").unionByName(spark.range(20).selectExpr("CAST(NULL AS STRING) AS canonical", "2 AS block"))
    for limit in (1 << 20, 0):
        r = urls.in_list(asked, listed, broadcast_bytes=limit)
        assert r.where("listed").count() == 3000 and r.where("maybe_listed").count() < 3300 and r.count() == 9020 and r.columns == [*asked.columns, "maybe_listed", "listed"]
    assert urls.in_list(asked, listed.limit(0)).where("maybe_listed").count() == 0


# --- token files ----------------------------------------------------------


@pytest.fixture(scope="module")
def vocabulary():
    return pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")


def test_token_files(spark, vocabulary, tmp_path):
    from tokenizers import Tokenizer

    odd = ["it's we'll don't", "a  b\n c \t d", " lead", "trail ", "x\u00a0y z", "<|endoftext|> a b", "1,2 3.5 a. b, c.. ,d", "\u4f60\u597d \u4e16\u754c", "\U0001f600 hi", "", None, "naïve Éa. ßen, \u0107x"]
    rows = corpus(60) + [(500 + i, t) for i, t in enumerate(odd)] + [(None, "no id"), (None, "nor here"), (7, "again"), (-(1 << 63), "least"), ((1 << 53) + 1, "large")]
    d = frame(spark, rows)
    keys = {r["text"]: r["k"] for r in d.select("text", F.xxhash64("text").alias("k")).collect()}
    manifest = tokenfiles.write_token_files(d, f"file://{tmp_path}/out", vocabulary, 2, 5, frame_ids=500)
    got = tokenfiles.read_token_files(manifest).orderBy("start").collect()
    t, at, want = Tokenizer.from_file(vocabulary), 0, []
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, keys[r[1]])):
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 2]
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert list(map(tuple, got)) == want
    path = manifest.orderBy("file_no").first()["path"]
    r = tokenfiles.Reader(path)
    assert len(r.table) > 1 and r.document(len(r.doc_id) - 1)[-1] == 2


def test_broken_frame_is_seen(vocabulary, tmp_path):
    out = io.BytesIO()
    w = tokenfiles.Writer(out, np.dtype("<u2"), 100)
    for i in range(5):
        w.add(i, np.arange(90, dtype="<u2").tobytes())
    w.finish()
    data = bytearray(out.getvalue())
    p = tmp_path / "x"
    p.write_bytes(data)
    assert tokenfiles.Reader(f"file://{p}").document(3).tolist() == list(range(90))
    table = tokenfiles.Reader(f"file://{p}").table
    at = len(data) - 9 - 12 * len(table) + 8
    data[at] ^= 1
    p.write_bytes(data)
    with pytest.raises(ValueError, match="checksum"):
        tokenfiles.Reader(f"file://{p}").document(0)


def test_frames_are_plain_zstandard():
    import zstandard

    data = io.BytesIO()
    w = tokenfiles.Writer(data, np.dtype("<u2"), 10)
    for i in range(4):
        w.add(i, np.full(9, i, "<u2").tobytes())
    w.finish()
    out = zstandard.ZstdDecompressor().decompressobj(read_across_frames=True).decompress(data.getvalue())
    assert np.frombuffer(out, "<u2").tolist() == [i for i in range(4) for _ in range(9)]


def test_no_files_for_no_documents(spark, vocabulary, tmp_path):
    m = tokenfiles.write_token_files(frame(spark, []), f"file://{tmp_path}/none", vocabulary, 2, 2)
    assert m.count() == 0 and tokenfiles.read_token_files(m).count() == 0


# --- Jaccard join ---------------------------------------------------------


def brute_components(rows, words, percent):
    sets = []
    for _, t in rows:
        w = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
        w = words_of(w)
        sets.append({tuple(w[i : i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)} if w else set())
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            same = len(a & b)
            if same and 100 * same >= percent * (len(a) + len(b) - same):
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least.setdefault(find(i), []).append(d)
    return sorted((d, len(sets[i]), min((x for x in least[find(i)] if x is not None), default=None)) for i, (d, _) in enumerate(rows) if d is not None)


@pytest.mark.parametrize("words,percent", [(3, 90), (5, 80)])
def test_jaccard(spark, words, percent, monkeypatch):
    monkeypatch.setattr(jaccard, "BUCKET", 4)
    monkeypatch.setattr(jaccard, "BLOCK", 8)
    monkeypatch.setattr(jaccard, "SUMMED", 2)
    monkeypatch.setattr(jaccard, "LARGE_CLASS", 2)
    if words == 5:
        monkeypatch.setattr(jaccard, "shared_bitmap", lambda classes: None)
    base = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty".split()
    chain = [(2000 + i, " ".join([*base[: 20 - i % 3], *[f"w{i}"] * (i % 4)] * 3)) for i in range(60)]
    rows = corpus(150, seed=words) + chain + [(5, "One TWO three"), (6000, "one two THREE"), (None, "one two three"), (6001, "É b c"), (6002, "é b c")]
    d = frame(spark, rows).repartition(7)
    found = jaccard.jaccard_components(d, words, percent).collect()
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found if r["doc_id"] is not None)
    assert got == brute_components(rows, words, percent) and len(found) == len(rows)
    kept = [r["doc_id"] for r in jaccard.keep_one(d, words, percent).collect()]
    assert len(kept) == len({r["first"] for r in found if r["n_shingles"]}) + sum(not r["n_shingles"] for r in found)
    empty = {r["doc_id"] for r in found if r["n_shingles"] == 0}
    firsts = {c for i, n, c in got if n}
    assert {x for x in kept if x is not None} == (firsts | empty) - {None}


def test_keep_one_keeps_texts_that_share_an_id(spark):
    a, b, c = ("one two three four five six", "red green blue black white grey", "sun moon star sky sea land")
    rows = [(1, a, "x"), (1, b, "x"), (2, b, "x"), (None, c, "x"), (None, c, "y"), (None, c, "y"), (None, a, "z"), (3, "", "e"), (3, None, "e"), (3, "", "e"), (7, a, "p"), (7, a, "o"), (0, c + " cloud", "q"), (0, "zwölf ganz andere Wörter stehen hier", "q"), (0, "zwölf ganz andere Wörter stehen hier", "a")]
    d = spark.createDataFrame(rows, "doc_id long, text string, k_doc string")
    got = sorted((tuple(r) for r in jaccard.keep_one(d, 5, 80).collect()), key=repr)
    assert got == sorted([(1, a, "x"), (1, b, "x"), (None, c, "x"), (3, "", "e"), (3, None, "e"), (3, "", "e"), (0, c + " cloud", "q"), (0, "zwölf ganz andere Wörter stehen hier", "a")], key=repr)


CLASHING = ["mix_doc", "mix_copies", "m", "doc", "rows", "copies", "i", "n_words", "b_lang", "low", "high", "kept", "kn_key", "log_perplexity", "base_failed", "k_doc", "class", "first", "text_key", "quality_score", "label_id", "quality", "has_words", "c0", "d"]


def test_stages_carry_columns_of_any_name(spark):
    r = random.Random(8)
    rows = [(i, " ".join(r.choice("ab cd ef gh ij kl mn".split()) + r.choice("xyz") for _ in range(80)), "en", "s", 1) for i in range(12)]
    base = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    d = base.select("*", *[F.concat(F.lit(f"{c}-"), F.col("doc_id")).alias(c) for c in CLASHING])
    want = {i: tuple(f"{c}-{i}" for c in CLASHING) for i in range(12)}
    labels = spark.createDataFrame([(i, 1) for i in range(12)], "doc_id long, quality int")
    stages = (lambda x: quality.filter_documents(x, quality.fit(x, labels), 0.0), perplexity.filter_documents, lambda x: jaccard.keep_one(x, 5, 80), mixing.mix_documents)
    for stage in stages:
        out = stage(d)
        assert out.columns == d.columns
        got = {x["doc_id"]: tuple(x[c] for c in CLASHING) for x in out.collect()}
        assert got == want
    assert packing.pack_documents(d).count() == 12
    s = quality.score(d, quality.fit(d, labels))
    assert dict(s.dtypes)["quality_score"] == "double" and len(s.columns) == len(d.columns)
    j = perplexity.judge(d)
    assert dict(j.dtypes)["n_words"] == "bigint" and len(j.columns) == len(set(j.columns))


def test_no_documents_to_join(spark):
    assert jaccard.jaccard_components(frame(spark, [])).count() == 0


def test_range_counts_bound_the_difference():
    r = np.random.default_rng(0)
    for _ in range(50):
        a = np.unique(r.integers(0, 1 << 63, r.integers(1, 900)).astype(np.uint64) * np.uint64(2))
        b = np.unique(np.concatenate([a[r.random(len(a)) < 0.8], r.integers(0, 1 << 63, r.integers(1, 99)).astype(np.uint64)]))
        assert jaccard._apart(jaccard._ranges(a), jaccard._ranges(b)) <= len(np.setxor1d(a, b))


# --- classifier -----------------------------------------------------------


def test_classifier(spark):
    r = random.Random(3)
    good = lambda: " ".join("".join(r.choice("abcdefgh") for _ in range(r.randint(2, 8))) for _ in range(60))
    rows, labels = [], []
    for i in range(400):
        bad = i % 4 == 0
        t = good()
        rows.append((i, t.upper().replace(" ", "!! ") if bad and i % 8 else " ".join(w for w in t.split() for _ in range(6)) if bad else t))
        labels.append((i, int(not bad), 0))
    d = frame(spark, rows + [(1000, None), (1001, ""), (None, "abc"), (1002, "abc " * 50_000)])
    l = spark.createDataFrame([*labels, (1, None, 0), (9999, 1, 0)], "doc_id long, quality int, toxic int")
    model = quality.fit(d, l)
    s = quality.score(d, model)
    assert s.columns == [*d.columns, "quality_score"] and s.count() == len(rows) + 4
    got = {x["doc_id"]: x["quality_score"] for x in s.collect()}
    assert all(0 <= v <= 1 for v in got.values()) and got[1000] == got[1001]
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 0]
    right = sum((got[i] >= 0.3) == (i % 4 != 0) for i in held)
    assert right / len(held) > 0.95
    again = quality.fit(d, l)
    assert np.array_equal(model.shares, again.shares) and model.bias == again.bias


def test_scores_are_means_of_learned_vectors(spark):
    """Scores again from the model's table, one feature at a time."""
    import xxhash

    def one(x, y):
        return int(quality.mix(np.array([x], np.uint64), y)[0])

    r = random.Random(9)
    rows = [(i, " ".join(r.choice(("ab", "Ünï", "c", "long-word", "x,")) for _ in range(r.randint(0, 30)))) for i in range(60)]
    d = frame(spark, rows)
    model = quality.fit(d, spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int"), bits=10)
    assert abs(model.shares).max() > 0
    for x in quality.score(d, model).collect():
        words, found = (x["text"] or "").encode().split(), []
        for w in words:
            raw = b"<" + w + b">"
            found.append(one(xxhash.xxh3_64_intdigest(w), 1))
            for n in (3, 4, 5):
                for k in range(len(raw) - n + 1):
                    g = n
                    for byte in raw[k : k + n]:
                        g = one(g, byte)
                    found.append(one(g, 1))
        for a, b in zip(words, words[1:]):
            pair = 7 if a == b else one(one(xxhash.xxh3_64_intdigest(a), xxhash.xxh3_64_intdigest(b)), 2)
            found.append(one(pair, 3))
        z = model.bias + (float(np.mean([model.shares[f >> 54] for f in found])) if found else 0.0)
        assert x["quality_score"] == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-6)


def test_held_out_labels_do_not_matter(spark):
    rows = [(i, f"text number {i} a b c") for i in range(60)]
    flip = lambda i: 1 - i % 2 if zlib.crc32(str(i).encode()) % 5 == 0 else i % 2
    d = frame(spark, rows)
    a = quality.fit(d, spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int"))
    b = quality.fit(d, spark.createDataFrame([(i, flip(i)) for i in range(60)], "doc_id long, quality int"))
    assert np.array_equal(a.shares, b.shares)


def test_classifier_learns_one_text_of_a_repeated_id(spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 40)] * 2 + [(1, None)], "doc_id long, quality int")
    rows = [(i, f"text number {i} a b c") for i in range(1, 40)]
    a = quality.fit(frame(spark, rows), labels)
    b = quality.fit(frame(spark, rows + [(1, "z other text")] * 500 + rows[:5] + [(1, "zz")]), labels)
    assert np.array_equal(a.shares, b.shares) and a.bias == b.bias


def test_classifier_without_labels_or_documents(spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    m = quality.fit(frame(spark, [(1, "a")]), none)
    assert quality.score(frame(spark, [(1, "a")]), m).first()["quality_score"] == 0.5
    assert quality.score(frame(spark, []), m).count() == 0


# --- perplexity -----------------------------------------------------------


def test_text_counts(spark):
    odd = ["a b c a b c", "x\nx\n \n\nx\ny", "# $ %a| <>&*", "é " * 60, "a b c " * 30, "one two three four", " \n\t", "\x01\x02 \ufffe\uffff z", "\U0001f600 b"]
    rows = corpus(60) + [(700 + i, t) for i, t in enumerate(odd)] + [(None, "a b")]
    got = perplexity.judge(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    found = collections.Counter()
    for r in got:
        found[(r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"])] += 1
        assert not (r["kept"] and r["base_failed"])
    want = collections.Counter()
    for i, t in rows:
        t = t or ""
        w = words_of(t)
        lines = [x for x in t.split("\n") if words_of(x)]
        c = collections.Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
        cover = {k + j for k in range(len(w) - 2) if c[tuple(w[k : k + 3])] > 1 for j in range(3)}
        want[(i, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(cover), len(w) < 50 or 100 * len(cover) > 50 * len(w))] += 1
    assert found == want


def brute_kneser_ney(texts):
    """p(symbol | three before) for one language, by the formulas."""
    grams = {4: collections.Counter()}
    for t in texts:
        s = [1, 1, 1, *[max(3, ord(c)) for c in t], 2]
        grams[4].update(tuple(s[i - 3 : i + 1]) for i in range(3, len(s)))
    for k in (3, 2, 1):
        grams[k] = collections.Counter(g[1:] for g in grams[k + 1])
    tables = {}
    for k, g in grams.items():
        n = collections.Counter(g.values())
        y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0
        d = [0]
        for j in (1, 2, 3):
            raw = j - (j + 1) * y * n[j + 1] / n[j] if n[1] and n[j] else 0.5 * j
            d.append(min(max(raw, 0.05), j - 0.05))
        total, back = collections.Counter(), collections.Counter()
        for x, c in g.items():
            total[x[:-1]] += c
            back[x[:-1]] += d[min(c, 3)]
        tables[k] = (g, d, total, back)

    def p(x):
        k = len(x)
        low = p(x[1:]) if k > 1 else 1 / (len(grams[1]) + 1)
        g, d, total, back = tables[k]
        if x[:-1] not in total:
            return low
        c = g[x]
        return max(c - d[min(c, 3)], 0) / total[x[:-1]] + back[x[:-1]] / total[x[:-1]] * low if c else back[x[:-1]] / total[x[:-1]] * low

    return p


def test_model_matches_formulas(spark):
    texts = ["the cat sat on the mat", "the dog sat", "a cat and a dog", "", "zebra!", "\u4f60\u597d the"]
    d = spark.createDataFrame([(i, t, "xx") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    got = {r["doc_id"]: r["log_perplexity"] for r in perplexity.judge(d).collect()}
    half = {r["doc_id"]: r["h"] for r in d.select("doc_id", F.expr("pmod(xxhash64(doc_id), 2)").alias("h")).collect()}
    assert set(half.values()) == {0, 1}
    models = [brute_kneser_ney([t for i, t in enumerate(texts) if half[i] != h]) for h in (0, 1)]
    for i, t in enumerate(texts):
        p, s = models[half[i]], [1, 1, 1, *[max(3, ord(c)) for c in t], 2]
        want = -sum(math.log(p(tuple(s[k - 3 : k + 1]))) for k in range(3, len(s))) / (len(t) + 1)
        assert got[i] == pytest.approx(want, rel=1e-5)
    p = brute_kneser_ney(texts)
    assert sum(p((ord("t"), ord("h"), ord("e"), c)) for c in {ord(c) for t in texts for c in t} | {2}) == pytest.approx(1, abs=0.05)


def test_characters_have_a_model_of_their_own(spark):
    texts = ["the cat sat on the mat", "the dog sat", "a cat and a dog", "", "zebra!", "\u4f60\u597d the", "The Cat"]
    d = spark.createDataFrame([(i, t, None) for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    got = {r["doc_id"]: r["typical_characters"] for r in perplexity.judge(d).collect()}
    half = {r["doc_id"]: r["h"] for r in d.select("doc_id", F.expr("pmod(xxhash64(doc_id), 2)").alias("h")).collect()}
    for i, t in enumerate(texts):
        counts = collections.Counter(c for j, u in enumerate(texts) if half[j] != half[i] for c in u + "\x02")
        n = collections.Counter(counts.values())
        y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0
        raw = [k - (k + 1) * y * n[k + 1] / n[k] if n[1] and n[k] else 0.5 * k for k in (1, 2, 3)]
        cuts = [0, *[min(max(x, 0.05), k - 0.05) for k, x in enumerate(raw, 1)]]
        total = counts.total()
        rest = sum(cuts[min(c, 3)] for c in counts.values()) / total / (len(counts) + 1)
        want = -sum(math.log(max(counts[c] - cuts[min(counts[c], 3)], 0) / total + rest) for c in t + "\x02") / (len(t) + 1)
        assert got[i] == pytest.approx(want, rel=1e-5)


def test_bands_reject_junk_that_the_model_has_learned(spark):
    r = random.Random(16)
    vocabulary = ["".join(r.choice("etaoinshñé") for _ in range(r.randint(2, 6))) for _ in range(300)]
    say = lambda: [r.choice(vocabulary) for _ in range(r.randint(80, 200))]
    rows = [(i, " ".join(say()), ("es", "fr")[i % 2]) for i in range(300)]
    kinds = (lambda w: " | ".join(w), lambda w: " ".join(x.upper() + "!!" for x in w), lambda w: " ".join(x + r.choice(("%%%", "###", "***")) for x in w))
    junk = [(900 + i, kinds[i % 3](say()), ("es", "fr")[i % 2]) for i in range(48)]
    d = spark.createDataFrame([*rows, *junk], "doc_id long, text string, lang string")
    assert {x["doc_id"] for x in perplexity.filter_documents(d).collect()} == set(range(300))


def test_typical_perplexity_is_the_median_stretch():
    r = np.random.default_rng(2)
    size = np.array([1, 1, 199, 200, 399, 400, 1000, 777, 2])
    x = r.random(size.sum())
    start = np.cumsum(size) - size
    for a, n, got in zip(start, size, perplexity._typical(x, start, size)):
        m = max(1, n // perplexity.STRETCH)
        means = sorted(x[a + i * n // m : a + (i + 1) * n // m].mean() for i in range(m))
        assert got == pytest.approx(means[(m - 1) // 2])


def test_a_foreign_passage_does_not_reject(spark):
    r = random.Random(12)
    vocabulary = ["".join(r.choice("etaoinsh") for _ in range(r.randint(2, 6))) for _ in range(300)]
    say = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    odd = " ".join("".join(chr(r.randrange(0xC0, 0x2FF)) for _ in range(6)) for _ in range(30))
    rows = [(i, say(300)) for i in range(150)] + [(500, say(150) + " " + odd + " " + say(150)), (501, " ".join(odd for _ in range(4)))]
    d = spark.createDataFrame([(i, t, "en") for i, t in rows], "doc_id long, text string, lang string")
    assert {x["doc_id"] for x in perplexity.filter_documents(d).collect()} == {*range(150), 500}


def test_bands_reject_what_is_far_out(spark):
    r = random.Random(5)
    vocabulary = ["".join(r.choice("etaoinsh") for _ in range(r.randint(2, 6))) for _ in range(300)]
    rows = [(i, " ".join(r.choice(vocabulary) for _ in range(r.randint(60, 200)))) for i in range(150)]
    noise = " ".join("".join(chr(r.randrange(33, 0x2FF)) for _ in range(6)) for _ in range(80))
    d = spark.createDataFrame([(i, t, "en") for i, t in [*rows, (999, noise)]], "doc_id long, text string, lang string")
    kept = {x["doc_id"] for x in perplexity.filter_documents(d).collect()}
    assert kept == set(range(150))
    assert perplexity.filter_documents(d.limit(0)).count() == 0


def test_bands_reject_junk_near_the_language(spark):
    r = random.Random(6)
    vocabulary = ["".join(r.choice("etaoinsh") for _ in range(r.randint(2, 6))) for _ in range(300)]
    rows = [(i, " ".join(r.choice(vocabulary) for _ in range(r.randint(100, 200)))) for i in range(200)]
    # Lists of the same words: less than twice the usual perplexity.
    junk = [(900 + i, " ".join(r.choice(vocabulary) + r.choice(("", "", " |", "!!")) for _ in range(120))) for i in range(10)]
    d = spark.createDataFrame([(i, t, "en") for i, t in [*rows, *junk]], "doc_id long, text string, lang string")
    got = perplexity.judge(d).collect()
    middle = np.median([x["log_perplexity"] for x in got])
    assert all(abs(x["log_perplexity"] - middle) < math.log(2) and not x["base_failed"] for x in got)
    assert {x["doc_id"] for x in got if x["kept"]} == set(range(200))


def test_bands_reach_to_each_side_by_its_own_documents(spark):
    rows = [("en", v, False) for v in (1.9, 1.95, 2.0, 2.3, 2.6)] + [("en", 9.0, True), (None, 1.0, False)]
    m = spark.createDataFrame(rows, "lang string, typical double, base_failed boolean")
    got = {x["b_lang"]: (x["low"], x["high"]) for x in perplexity.bands(m, 2.0, 0.01).collect()}
    assert got["en"] == pytest.approx((2 - 2 * 1.4826 * 0.05, 2 + 2 * 1.4826 * 0.3)) and got[""] == pytest.approx((0.99, 1.01))


# --- trie -----------------------------------------------------------------


def test_elias_fano():
    r = np.random.default_rng(1)
    for n, top in ((1, 0), (5, 3), (1000, 50), (3000, 10_000_000), (700, 0)):
        x = np.sort(r.integers(0, top + 1, n))
        e = trie.EliasFano(trie.ef_encode(x, "x"), "x")
        assert np.array_equal(e.get(np.arange(n)), x)
        if n > 1:
            a, b = e.span(np.arange(n - 1))
            assert np.array_equal(a, x[:-1]) and np.array_equal(b, x[1:])


def test_trie_scores(spark, monkeypatch):
    monkeypatch.setattr(trie, "BATCH_TOKENS", 700)
    monkeypatch.setattr(trie, "HELD_KEYS", 500)
    rows = [(i, t) for i, t in corpus(120) if i != 900] + [(902, "New Unknown words A b"), (5, "twice the id"), (None, "no id")]
    d = frame(spark, rows)
    model, encoded = trie.build(d.select("doc_id", "text", (F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 1).alias("held_out")), vocabulary_parts=4, part_tokens=60)
    assert model["parts"][1] > 3 and model["parts"][2] > 3
    got = collections.Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in trie.score(encoded, model).collect())
    full = {(r["doc_id"], r["n_tokens"]): r["score"] for r in trie.score(encoded, model).collect()}

    def toks(t):
        return [*words_of(re.sub("[A-Z]", lambda m: m[0].lower(), t or "")), ""]

    held = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 5 == 1
    c = collections.Counter(w for i, t in rows if not held(i) for w in toks(t))
    n, v = sum(c.values()), len(c)
    p1 = lambda w: (c[w] + 0.5) / (n + 0.5 * (v + 1))
    want = collections.Counter()
    for i, t in rows:
        w = toks(t)
        want[(i, held(i), len(w), sum(x in c for x in w), n, round(sum(math.log10(p1(x)) for x in w), 6))] += 1
    assert got == want
    # One part's model by hand.
    bounds = trie.unpack(f"{model['path']}/{model['list']}")["bounds"].tolist()
    assert model["parts"][1] == len(bounds) > len({b >> 32 for b in bounds})  # some context lies in several parts
    one, again = trie.build(d.select("doc_id", "text", (F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 1).alias("held_out")), 1, 10**9)
    two, three = collections.Counter(), collections.Counter()
    for i, t in rows:
        if not held(i):
            s = [None, *toks(t)]
            two.update(zip(s, s[1:]))
            three.update(zip(s, s[1:], s[2:]))
    levels = []
    for g in (two, three):
        k = collections.Counter(g.values())
        total, kinds = collections.Counter(), collections.Counter()
        for x, m in g.items():
            total[x[:-1]] += m
            kinds[x[:-1]] += 1
        levels.append((g, k[1] / (k[1] + 2 * k[2]) if k[1] and k[2] else 0.5, total, kinds))

    def p(x):
        if len(x) == 1:
            return p1(x[0])
        g, dd, total, kinds = levels[len(x) - 2]
        low = p(x[1:])
        return low if not total[x[:-1]] else max(g[x] - dd, 0) / total[x[:-1]] + dd * kinds[x[:-1]] / total[x[:-1]] * low

    scores = {(r["doc_id"], r["n_tokens"]): r["score"] for r in trie.score(again, one).collect()}
    for i, t in rows:
        s = [None, *toks(t)]
        by_hand = math.log10(p((None, s[1]))) + sum(math.log10(p(tuple(s[k - 2 : k + 1]))) for k in range(2, len(s)))
        assert scores[(i, len(s) - 1)] == pytest.approx(by_hand, abs=2e-4 * len(s))
    # The model does not depend on its parts.
    assert full == scores


def test_trie_counts_and_ids_beyond_32_bits():
    keys = np.array([0, 5, 1 << 40, (1 << 64) - 3], np.uint64)
    counts = np.array([1, 5_000_000_000, 1 << 40, 3])
    k, c = trie._unsqueeze(trie._squeeze(keys, counts))
    assert k.tolist() == keys.tolist() and c.tolist() == counts.tolist()
    k, c = trie._merge([k, k], [c, c])
    assert k.tolist() == keys.tolist() and c.tolist() == (2 * counts).tolist()
    trie.check_words((1 << 32) - 2)
    with pytest.raises(ValueError):
        trie.check_words((1 << 32) - 1)


def test_many_parts_are_bounded_in_two_steps(spark, monkeypatch):
    monkeypatch.setattr(trie, "QUANTILES", 4)
    ids = np.random.default_rng(0).integers(0, 1000, (50, 400)).astype("<u4")
    rows = spark.createDataFrame([(bytearray(x.tobytes()),) for x in ids], "ids binary")
    make_keys = lambda: lambda piece: (piece[2].astype(np.uint64) << np.uint64(54))
    bounds = trie.quantiles(rows, make_keys, 20_000, 1000)
    assert 16 <= len(bounds) <= 24 and bounds[0] == 0 and (np.diff(bounds.astype(object)) > 0).all()
    held = np.diff(np.searchsorted(np.sort(ids.ravel().astype(np.uint64) << np.uint64(54)), [*bounds, np.uint64(2**64 - 1)]))
    assert held.max() < 3000
    monkeypatch.setattr(trie, "MOST_PARTS", 3)
    assert len(trie.quantiles(rows, make_keys, 20_000, 1000)) == 3


def test_trie_of_nothing(spark):
    assert trie.train_and_score(frame(spark, [])).count() == 0
    held = [i for i in range(50) if zlib.crc32(str(i).encode()) % 5 == 1][:2]
    r = trie.train_and_score(frame(spark, [(i, "a b") for i in held])).collect()
    assert len(r) == 2 and all(x["n_known"] == 0 and x["score"] == x["base_score"] for x in r)


# --- neighbours -----------------------------------------------------------


def vectors(spark, n=900, dim=24, seed=2):
    r = np.random.default_rng(seed)
    x = r.standard_normal((n, dim)) * r.uniform(0.5, 2, (n, 1))
    x[10:40] = x[10]
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x.astype(np.float32))]
    return x.astype(np.float32).astype(np.float64), rows


def brute_nearest(x, ids, ask, k):
    s = x @ x[ask]
    s[ask] = -np.inf
    o = np.lexsort((ids, -s))[:k]
    return [(int(ids[i]), s[i]) for i in o]


def test_neighbours(spark):
    x, rows = vectors(spark)
    bad = [(5001, None, 0), (5002, [0.0] * 24, 0), (5003, [float("nan")] * 24, 0), (5004, [None] * 24, 0), (5005, [1.0] * 3, 0), (None, [1.0] * 24, 0), (5006, [float("inf")] * 24, 0)]
    v = spark.createDataFrame(rows + rows[:5] + bad, "vec_id long, embedding array<float>, label int")
    q = v.where("vec_id % 20 = 0").select("vec_id")
    got = collections.defaultdict(list)
    for r in neighbours.nearest(v, q, block_rows=300, group_rows=20).orderBy("query_id", "rank").collect():
        assert r["rank"] == len(got[r["query_id"]]) + 1
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    hit = total = 0
    for i in range(0, 900, 20):
        want = brute_nearest(x, np.arange(900), i, 20)
        assert len(got[i]) == 20 and all(s == pytest.approx(float(x[j] @ x[i]), abs=1e-12) for j, s in got[i])
        assert got[i] == sorted(got[i], key=lambda p: (-p[1], p[0]))
        hit += len({j for j, _ in got[i]} & {j for j, _ in want})
        total += 20
    assert len(got) == 45 and hit / total >= 0.9


@pytest.mark.parametrize("n, long", [(8192, 0), (4096, 1), (4096, 40)])
def test_neighbours_of_skewed_lengths(spark, n, long):
    r = np.random.default_rng(8)
    x = r.standard_normal((n, 64))
    x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
    x[:long] *= 10
    v = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(x)], "vec_id long, embedding array<double>")
    got = collections.defaultdict(set)
    for q in neighbours.nearest(v, v.where("vec_id % 20 = 7").select("vec_id")).collect():
        got[q["query_id"]].add(q["vec_id"])
    asks = range(7, n, 20)
    hit = sum(len(got[i] & {j for j, _ in brute_nearest(x, np.arange(n), i, 20)}) for i in asks)
    print("recall", n, long, hit / (20 * len(asks)))
    assert hit / (20 * len(asks)) >= 0.93


def test_equal_vectors_score_alike_wherever_they_stand(spark):
    r = np.random.default_rng(3)
    for n in (401, 402, 403):
        x = r.standard_normal((n, 50))
        x[r.choice(n, 40, replace=False)] = x[0] * 2
        v = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(x)], "vec_id long, embedding array<double>")
        got = collections.defaultdict(list)
        for q in neighbours.nearest(v, v.where("vec_id % 20 = 0").select("vec_id"), block_rows=137).orderBy("query_id", "rank").collect():
            got[q["query_id"]].append((q["vec_id"], q["score"]))
        for i, found in got.items():
            exact = {j: float((x[j] * x[i]).sum()) for j in range(n) if j != i}
            assert found == sorted(exact.items(), key=lambda p: (-p[1], p[0]))[:20]


def test_recall_where_few_are_visited():
    """Vectors in groups: balls of under a tenth of the codes hold the nearest."""
    r = np.random.default_rng(6)
    x = np.repeat(r.standard_normal((80, 48)), 100, axis=0) + 0.35 * r.standard_normal((8000, 48))
    ranges = neighbours.norm_ranges(x)
    long = neighbours.lengthen_ranges(x, ranges)
    mean, matrix = neighbours.learn_rotation(long)
    codes = neighbours.binary_codes(long, mean, matrix)
    asks = np.arange(0, 8000, 80)
    unit = np.hstack([x[asks] / np.sqrt((x[asks] ** 2).sum(axis=1, keepdims=True)), np.full((len(asks), 1), mean[-1])])
    ask_codes = neighbours.binary_codes(unit, mean, matrix)
    hit = visited = 0
    indexes = [(rows, neighbours.MultiIndex(codes[rows])) for rows in ranges]
    for i, code in zip(asks, ask_codes):
        near = np.concatenate([rows[index.within(code, 1 + 300 * len(rows) // 8000)] for rows, index in indexes])
        visited += len(near)
        want = {j for j, _ in brute_nearest(x, np.arange(8000), i, 20)}
        hit += len(want & set(near.tolist()))
    print("recall", hit / (20 * len(asks)), "visited", visited / len(asks) / 8000)
    assert visited < 0.1 * 8000 * len(asks) and hit >= 0.9 * 20 * len(asks)


def test_lengths_fall_in_ranges():
    x = np.array([[1.0], [-30.0], [1.4], [0.5], [29.0], [2.0]])
    assert [g.tolist() for g in neighbours.norm_ranges(x)] == [[1, 4], [2, 5], [0], [3]]


def test_few_vectors_give_all_others(spark):
    v = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (20, [1.0, 1.0])], "vec_id long, embedding array<float>")
    got = sorted(map(tuple, neighbours.nearest(v, v.where("vec_id % 20 = 0").select("vec_id")).collect()))
    assert [(a, b, c) for a, b, c, _ in got] == [(0, 1, 20), (0, 2, 1), (20, 1, 0), (20, 2, 1)]
    assert neighbours.nearest(v.limit(0), v.select("vec_id")).count() == 0


def test_within_finds_every_code_of_the_ball():
    r = np.random.default_rng(4)
    codes = r.integers(0, 256, (500, 16)).astype(np.uint8)
    index = neighbours.MultiIndex(codes)
    for i in range(20):
        far = np.bitwise_count(codes ^ codes[i]).sum(axis=1)
        for least in (1, 5, 100, 500, 900):
            found = index.within(codes[i], least)
            assert np.array_equal(found, np.flatnonzero(far <= np.sort(far)[min(least, 500) - 1]))


# --- pages ----------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T {i}</title><style>p{{}}</style><script>var a="</p><article>";</script></head><body>
<header><a href="/">Site</a></header><nav><ul><li><a href="/a">One</a></li><li><a href="/b">Two</a></li></ul></nav><!-- <p>no</p> -->
<div class="cookie-notice">We use cookies</div><div class="ad">Buy {i}</div><article><h1>Head &amp; {i}</h1><p>First  <b>bold{i}</b>tail<br>line
two &lt;x&gt; &nbsp; end<p>Second {w}</p><aside>skip</aside><div class="comments"><p>reader says</p></div><form><input name=q>Search</form></article>
<aside class="sidebar">Side</aside><footer>&copy; {i} words</footer>"""


def test_extract():
    got = template.extract([PAGE.format(i=i, w="x" * i) for i in range(4)])
    assert got == [f"Head & {i} First bold{i}tail line two <x> end Second" + (" " + "x" * i if i else "") for i in range(4)]


def test_extract_without_article():
    page = '<html><body><div id="top"><a href=/>Home</a> <a href=/x>X</a></div><div>Long text number {i} about things</div><div class="menu"><a href="/">a</a></div><p>All pages say this</p></body></html>'
    assert template.extract([page.format(i=i) for i in range(5)]) == [f"Long text number {i} about things" for i in range(5)]
    assert template.extract(["plain text only", "", "<p>a", "<a href='b\">x"])[:2] == ["plain text only", ""]


def test_extract_drops_what_repeats_in_articles():
    page = '<body><article><h1>Title {i}</h1><div class="x1">Send this to a friend</div><p>Text <b>{i}</b> goes on</p><p>Always this end</p>{odd}</article></body>'
    odd = '<div class="x2"><span>Terms</span> apply</div>'
    got = template.extract([page.format(i=i, odd=odd if i % 2 else "") for i in range(8)])
    assert got == [f"Title {i} Text {i} goes on Always this end" for i in range(8)]
    same = ["<article><p>The only text</p></article>" + "<i></i>" * i for i in range(5)]
    assert template.extract(same) == ["The only text"] * 5


def test_extract_host_of_mixed_templates():
    old = '<html><body><div id="top"><a href=/>Home</a> <a href=/x>X</a></div><div>Long text number {i} about things</div><p>All pages say this</p></body></html>'
    new = "<html><body><nav>Menu</nav><main><p>New text {i}</p></main></body></html>"
    got = template.extract([(old if i % 2 else new).format(i=i) for i in range(10)])
    assert got == [f"Long text number {i} about things" if i % 2 else f"New text {i}" for i in range(10)]


def test_names_only_break_ties():
    page = '<body><div class="q1"><a href=/>Home</a> <a href=/x>X</a></div><div class="{a}">Same words on all pages of this site</div><div class="{b}">Long text number {i} about things {w}</div><div class="q4">Same end</div></body>'
    want = [f"Long text number {i} about things {'w' * i}" for i in range(1, 6)]
    for a, b in (("q2", "q3"), ("content", "q3"), ("main", "q3"), ("q2", "content")):
        assert template.extract([page.format(i=i, w="w" * i, a=a, b=b) for i in range(1, 6)]) == want


def test_without_the_template_more_text_would_stay(monkeypatch):
    """The classes decide what is main: with no roles in them, the parts that
    repeat over a host's pages stay."""
    page = '<body><div class="q1">This site is about things</div><div class="q2">Text number {i} is here</div></body>'
    pages = [page.format(i=i) for i in range(6)]
    assert template.extract(pages) == [f"Text number {i} is here" for i in range(6)]
    article = '<body><article><div class="q1">Tell a friend</div><p>Text number {i} is here</p></article></body>'
    articles = [article.format(i=i) for i in range(6)]
    assert template.extract(articles) == [f"Text number {i} is here" for i in range(6)]
    monkeypatch.setattr(template, "equivalence_classes", lambda pages: [[]])
    assert template.extract(pages) != [f"Text number {i} is here" for i in range(6)]
    assert template.extract(articles) != [f"Text number {i} is here" for i in range(6)]


def test_repeated_pages_change_no_text():
    page = "<article><p>Fixed {w}</p><p>one {x}</p></article>"
    a, b, c = (page.format(w=w, x=x) for w, x in (("one", "x"), ("two", "y"), ("one", "z")))
    alone = dict(zip("abc", template.extract([a, b, c])))
    assert template.extract([a, a, b, c, c]) == [alone[k] for k in "aabcc"]
    assert template.extract([a, b]) == template.extract([a, a, b])[1:]


def test_classes_are_valid_in_whole_rounds():
    pages = [template.Page(h) for h in ("<p></p><hr><p></p><hr>", "<p></p><hr>")]
    bad = [template.Page(h) for h in ("<p></p><p></p><hr><hr>", "<p></p><hr>")]
    roles = ["/p|p", "/p|/p", "/hr|hr", "/hr|/hr"]
    assert template.whole_rounds(pages, roles) and not template.whole_rounds(bad, roles)
    assert template.nested(pages, [], [roles]) == {0: [roles]} and not template.nested(bad, [], [roles])


def test_extract_pages(spark):
    rows = [(i, f"http://h{i % 2}.org/{i}", PAGE.format(i=i, w="w")) for i in range(30)]
    rows += [(100, None, "<p>no url</p>"), (101, "http://lone.org/", "<article><p>&eacute;</p></article>"), (102, "http://h0.org/n", None), (103, "http://h0.org/e", ""), (5, rows[5][1], rows[5][2])]
    rows += [(104, "http://long.org", "<article><p>" + "word " * 100_000 + "</p></article>")]
    rows += [((1 << 53) + 1, "http://h0.org/big", "<article>big</article>"), (None, "http://h0.org/none", "<article>none</article>")]
    d = spark.createDataFrame([(*r, "c", "b") for r in rows], "page_id long, url string, html string, host string, block string")
    got = collections.Counter(map(tuple, template.extract_pages(d, block_pages=7).collect()))
    assert sum(got.values()) == len(rows)
    text = {r[0]: r[2] for r in got}
    assert text[3] == "Head & 3 First bold3tail line two <x> end Second w" and text[101] == "é" and text[102] == text[103] == "" and text[100] == "no url"
    assert all(n == len(t) for _, _, t, n in got) and got[(5, rows[5][1], text[5], len(text[5]))] == 2 and len(text[104]) == 499_999
    assert text[(1 << 53) + 1] == "big" and text[None] == "none"
    assert template.extract_pages(d.limit(0)).count() == 0


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="the driver's tables are not here")
def test_extract_driver_pages(spark):
    from skygrid.llm.queries import QUERIES

    got = {r["page_id"]: r["text"] for r in QUERIES["op8_html_extraction"](spark, "/root/testdata/sf0.01").collect()}
    for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect():
        a = re.search("<article>(.*?)</article>", r["html"], re.S)[1]
        blocks = re.split("</?(?:p|h1|br)[^>]*>", re.sub("</?b>", "", a))
        assert got[r["page_id"]] == " ".join(x for x in (" ".join(html.unescape(b).split()) for b in blocks) if x)
