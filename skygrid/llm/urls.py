"""URL filtering: rules on hosts and paths, then a blocked Bloom filter of
listed canonical URLs whose possible hits an exact hash join confirms.

The filter is a table of blocks of 512 bits (8 longs). A URL's hash picks one
block and one bit in each long, so a test reads one row. The filter is
broadcast while its size, known from the count of listed URLs, stays under
``broadcast_bytes``; beyond, pages and blocks meet by block number in a
shuffle. Only pages that pass it are compared in the exact join.

Defined cases: a null url or one without ``://`` has empty host and path,
fits no rule and is in no list; equal urls are judged alike; an empty table
gives no rows, an empty list blocks nothing; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut

BITS_PER_URL = 16
BROADCAST_BYTES = 32 << 20


def host_of(url: Column) -> Column:
    """After the first :// up to / ? # or the end, A-Z lower-cased."""
    rest = F.regexp_extract(url, "(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ? # or the end."""
    return F.coalesce(F.regexp_extract(url, "(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """host + path: no scheme, leading www., port, query or fragment; a path
    ends without .html and without slash. Null where there is no host."""
    host = F.regexp_replace(F.regexp_replace(host_of(url), "^www\\.", ""), ":[0-9]*$", "")
    path = F.regexp_replace(F.regexp_replace(path_of(url), "\\.html$", ""), "/+$", "")
    return F.when(host != "", F.concat(host, path))


def with_rule(pages: DataFrame, rules) -> DataFrame:
    """Adds rule and rule_verdict of the longest fitting rule (null: none).

    ``rules`` is a short literal list, so it is tried by plain expressions,
    longest first; ties go to the first by text.
    """
    rule = verdict = F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: (len(r[0]) + len(r[1]), r[0], r[1])):
        fits = ((F.col("host") == h) | F.col("host").endswith(f".{h}")) & F.col("path").startswith(p)
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, v).otherwise(verdict)
    return pages.withColumns({"rule": rule, "rule_verdict": verdict})


def _masks() -> list[Column]:
    """One bit in each of the block's 8 longs."""
    return [F.expr(f"shiftleft(1L, cast(shiftrightunsigned(xxhash64(1, canonical), {6 * i}) & 63 as int))") for i in range(8)]


def bloom_blocks(listed: DataFrame, blocks: int) -> DataFrame:
    """(canonical) -> block, w0..w7."""
    return listed.groupBy(F.expr(f"pmod(xxhash64(canonical), {blocks})").alias("block")).agg(*[F.bit_or(m).alias(f"w{i}") for i, m in enumerate(_masks())])


def in_list(urls: DataFrame, listed: DataFrame, bits_per_url: int = BITS_PER_URL, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``urls`` (with column canonical) plus maybe_listed and listed.

    While filter and list are small both are broadcast, and one pass over the
    urls does. Beyond, urls are written once; those without host are left out
    of the joins, and only possible hits are shuffled to the exact one.
    """
    listed = listed.where("canonical is not null").select("canonical").distinct()
    n, size = listed.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("canonical") + 50), F.lit(0))).first()
    blocks = max(1, -(-n * bits_per_url // 512))
    bloom = bloom_blocks(listed, blocks).alias("b")
    u = urls.withColumn("url_block", F.expr(f"pmod(xxhash64(canonical), {blocks})"))
    hit = F.lit(True)
    for i, m in enumerate(_masks()):
        hit = hit & (F.col(f"b.w{i}").bitwiseAND(m) == m)
    maybe = F.coalesce(hit & F.col("canonical").isNotNull(), F.lit(False)).alias("maybe_listed")
    exact = listed.select(F.col("canonical").alias("listed_url"))
    few = blocks * 80 <= broadcast_bytes and size <= broadcast_bytes
    if not few:
        u = cut(u, "urls")
    asked = (u if few else u.where("canonical is not null")).alias("u")
    tested = asked.join(F.broadcast(bloom) if few else bloom, F.col("u.url_block") == F.col("b.block"), "left").select(*[F.col(f"u.`{c}`") for c in urls.columns], maybe)
    sure = tested if few else tested.where("maybe_listed")
    on = F.col("maybe_listed") & (F.col("canonical") == F.col("listed_url"))
    sure = sure.join(F.broadcast(exact) if few else exact, on, "left").select(*tested.columns, F.col("listed_url").isNotNull().alias("listed"))
    if few:
        return sure
    none = F.lit(False)
    lone = u.where("canonical is null").select(*urls.columns, none.alias("maybe_listed"), none.alias("listed"))
    return sure.unionByName(tested.where("not maybe_listed").withColumn("listed", none)).unionByName(lone)


def judge_urls(pages: DataFrame, listed_urls: DataFrame, rules, **options) -> DataFrame:
    """page_id, host, path, rule, verdict, listed.

    ``listed_urls`` has a column url; pages on it are blocked unless a rule
    says otherwise.
    """
    u = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), canonical(F.col("url")).alias("canonical"))
    listed = listed_urls.select(canonical(F.col("url")).alias("canonical"))
    judged = with_rule(in_list(u, listed, **options), rules)
    verdict = F.coalesce("rule_verdict", F.when(F.col("listed"), "block").otherwise("allow"))
    return judged.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "listed")
