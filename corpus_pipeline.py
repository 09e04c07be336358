"""A corpus pipeline: five training-data operators, one after the other.

Each stage is written as Parquet and read again by the next, so an executor
lost later costs no earlier work. All but the last return the columns of
documents; the last returns one row per piece of a packed sequence.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skygrid.llm import jaccard, mixing, packing, perplexity, quality
from skygrid.llm.common import cut, table
from skygrid.llm.queries import QUALITY_FROM


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier takes to be of quality. It learns from
    the labelled rows of the training folds among its input."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.filter_documents(docs, model, QUALITY_FROM)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the text counts and their language's perplexity band."""
    return perplexity.filter_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at 0.8."""
    return jaccard.keep_one(docs, 5, 80)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.mix_documents(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("source mix", source_mix),
    ("best-fit packing", best_fit_packing),
]

#: A learned classifier, a language model and random rounding are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = cut(docs, f"stage-{i + 1}-{name.replace(' ', '-')}")
    return docs
