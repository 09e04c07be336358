"""The registered training-data queries and the pipeline on the small tables."""

import os

import duckdb
import pytest

import corpus_pipeline
from skygrid.llm import queries as llm
from skygrid.llm.common import table

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")

COLUMNS = {
    "op1_nearest_neighbours": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "double"},
    "op2_ngram_trie": {"doc_id": "bigint", "held_out": "boolean", "n_tokens": "bigint", "n_known": "bigint", "train_tokens": "bigint", "base_score": "double", "score": "double"},
    "op3_token_files": {"doc_id": "bigint", "start": "bigint", "n_tokens": "bigint", "ids_crc32": "bigint"},
    "op4_jaccard_join": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint"},
    "op5_quality_classifier": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op6_url_filters": {"page_id": "bigint", "host": "string", "path": "string", "rule": "string", "verdict": "string"},
    "op7_best_fit_packing": {"bin_id": "bigint", "capacity": "int", "doc_id": "bigint", "piece": "int", "n_words": "int"},
    "op8_html_extraction": {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint"},
    "op9_quality_rules": {"doc_id": "bigint", "n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint", "n_dup_lines": "bigint", "n_repeat_words": "bigint", "base_failed": "boolean", "kept": "boolean"},
    "op10_source_mixing": {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"},
    "op11_lexical_search": {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"},
    "op12_whitening": {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double", "explained": "double", "identity_error": "double"},
    "op13_sentencepiece": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
}


@pytest.mark.parametrize("name", list(COLUMNS))
def test_query(spark, name):
    df = llm.QUERIES[name](spark, SF)
    types = dict(df.dtypes)
    assert {c: types.get(c) for c in COLUMNS[name]} == COLUMNS[name]
    cols = sorted(df.columns)
    rows = sorted(tuple(map(repr, r)) for r in df.select(*cols).collect())
    assert rows
    if name in llm.SQL:
        c = duckdb.connect()
        for t in ("pages", "documents", "benchmark"):
            c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
        assert rows == sorted(tuple(map(repr, r)) for r in c.sql(f"SELECT {', '.join(cols)} FROM ({llm.SQL[name]}) q").fetchall())


def test_pipeline(spark):
    docs = table(spark, SF, "documents")
    kept, before = docs, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, SF).cache()
        assert kept.columns == docs.columns
        now = kept.count()
        assert now <= before or name == "source mix"
        before = now
    packed = corpus_pipeline.STAGES[-1][1](spark, kept, SF)
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == {r["doc_id"] for r in kept.select("doc_id").distinct().collect()}
    assert corpus_pipeline.run(spark, SF).count() == packed.count()
