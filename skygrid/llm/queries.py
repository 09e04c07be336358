"""The registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import jaccard, lexical, mixing, neighbours, packing, perplexity, pieces, quality, template, tokenfiles, trie, urls, whitening
from .common import crc32_mod, shared_dir, table

#: The rules of the URL contract: (host, path, verdict).
URL_RULES = (("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "allow"), ("example.net", "/de/8", "block"), ("org", "/es/", "block"))


def op1_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = table(spark, sf_dir, "embeddings")
    return neighbours.nearest(v, v.where(F.col("vec_id") % 20 == 0).select("vec_id"))


def op2_ngram_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.train_and_score(table(spark, sf_dir, "documents").select("doc_id", "text"))


#: Vocabulary file and end id of the token files.
VOCABULARY = "byte_bpe_50k.json"
END_ID = 2


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = shared_dir(spark, "token-files")
    manifest = tokenfiles.write_token_files(docs, path, public_tokenizers.path(VOCABULARY), END_ID, tokenfiles.files_for(docs))
    return tokenfiles.read_token_files(manifest)


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents").select("doc_id", "text"), 3, 90).select("doc_id", "n_shingles", "component_id")


#: Score from which a document counts as of quality.
QUALITY_FROM = 0.3


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    scored = quality.score(docs, model)
    return scored.select("doc_id", (crc32_mod(F.col("doc_id"), 5) == 0).alias("held_out"), F.col("quality_score").alias("score"), (F.col("quality_score") >= QUALITY_FROM).cast("int").alias("predicted"))


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return template.extract_pages(table(spark, sf_dir, "pages"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = perplexity.judge(table(spark, sf_dir, "documents").select("doc_id", "lang", "text"), ["doc_id"])
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "log_perplexity", F.col("typical").alias("typical_log_perplexity"), F.col("typical_characters").alias("typical_characters_log_perplexity"))


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list: pages on hosts named after spam, and pages found under more
    than one spelling of their canonical URL, whatever their host."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    spellings = pages.groupBy(urls.canonical(F.col("url")).alias("canonical")).agg(F.min("url").alias("url"), F.max("url").alias("other"))
    listed = pages.where(urls.host_of(F.col("url")).contains("spam")).select("url").unionByName(spellings.where("url <> other").select("url"))
    return urls.judge_urls(pages, listed, URL_RULES)


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.best_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten_embeddings(table(spark, sf_dir, "embeddings"))


#: Model file of the merge-type encoding.
PIECES = "piece_bpe_32k.model"


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    model = public_tokenizers.path(PIECES)
    encoded = pieces.encode_documents(table(spark, sf_dir, "documents"), model)
    d = pieces.decode_documents(encoded, model)
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return d.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids.cast("binary"), 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


QUERIES = {
    "op1_nearest_neighbours": op1_nearest_neighbours,
    "op2_ngram_trie": op2_ngram_trie,
    "op3_token_files": op3_token_files,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_url_filters": op6_url_filters,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_html_extraction": op8_html_extraction,
    "op9_quality_rules": op9_quality_rules,
    "op10_source_mixing": op10_source_mixing,
    "op11_lexical_search": op11_lexical_search,
    "op12_whitening": op12_whitening,
    "op13_sentencepiece": op13_sentencepiece,
}

SQL = {
    "op6_url_filters": r"""
WITH u AS (
  SELECT page_id, url,
         coalesce(translate(regexp_extract(url, '^[\s\S]*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '^[\s\S]*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
c AS (
  SELECT *, CASE WHEN host <> '' THEN concat(
           regexp_replace(regexp_replace(host, '^www\.', ''), ':[0-9]*$', ''),
           regexp_replace(regexp_replace(path, '\.html$', ''), '/+$', '')) END AS canonical
  FROM u),
r(h, p, v) AS (VALUES ('com', '/en/', 'block'), ('example.com', '/en/7', 'allow'), ('net', '/de/', 'allow'), ('example.net', '/de/8', 'block'), ('org', '/es/', 'block')),
m AS (
  SELECT page_id, max_by(concat(h, p), length(h) + length(p)) AS rule, max_by(v, length(h) + length(p)) AS rule_verdict
  FROM c JOIN r ON (host = h OR ends_with(host, concat('.', h))) AND starts_with(path, p) GROUP BY page_id),
l AS (SELECT canonical FROM c GROUP BY canonical HAVING bool_or(contains(host, 'spam')) OR count(DISTINCT url) > 1)
SELECT c.page_id, c.host, c.path, m.rule, coalesce(m.rule_verdict, CASE WHEN l.canonical IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict,
       l.canonical IS NOT NULL AS listed
FROM c LEFT JOIN m ON c.page_id = m.page_id LEFT JOIN l ON c.canonical = l.canonical
""",
    "op11_lexical_search": r"""
WITH d AS (
  SELECT row_number() OVER () AS row_no, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
s AS (SELECT count(*) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_all FROM d WHERE len(terms) > 0),
p AS (SELECT row_no, term, count(*) AS tf FROM (SELECT row_no, unnest(terms) AS term FROM d) q GROUP BY row_no, term),
w AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM p CROSS JOIN s GROUP BY term),
m AS (SELECT row_no, doc_id, 75 + (25 * len(terms) * n_docs) // n_all AS m FROM d CROSS JOIN s WHERE len(terms) > 0),
i AS (
  SELECT item_id, term, count(*) AS n FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM (SELECT DISTINCT item_id, text FROM benchmark) q) q
  GROUP BY item_id, term),
r AS (
  SELECT item_id, any_value(doc_id) AS doc_id, row_no, CAST(sum(n * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
  FROM i JOIN p USING (term) JOIN w USING (term) JOIN m USING (row_no) GROUP BY item_id, row_no)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM r WHERE score > 0) q WHERE rank <= 20
""",
}
