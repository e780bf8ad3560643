"""A training corpus from raw documents: filter, de-duplicate, decontaminate, pack.

Each stage takes (spark, docs, sf_dir), ``docs`` being what its predecessor
kept, written as Parquet and read again.  All but the last return the columns
of ``docs``, whatever others it has.  Rows are told apart by their place, not by
doc_id, which may be null or repeat.  Null, empty and very long texts are taken
as the operators' docstrings say; an empty table gives an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from encore.llm import bm25, importance, packing, paragraphs, simhash
from encore.llm.storage import staged


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the counted rules and read like trusted text; null and empty texts go."""
    trusted = spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1 AND toxic = 0").select("doc_id")
    return importance.kept_documents(docs, trusted)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each SimHash component, of the smallest id: 3-word shingles, 3 bits."""
    return simhash.one_of_each(docs, shingle=3, max_bits=3)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the runs of paragraphs that an earlier document or place has already; emptied texts go."""
    return paragraphs.drop_repeated(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item; all of them when there is none."""
    return bm25.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the documents in sequences of at most 2048 tokens; an empty text is its end token."""
    return packing.packed_documents(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=0, max_len=2048)


STAGES = [
    ("quality rules", quality_rules),
    ("simhash near-dedup", simhash_dedup),
    ("substring dedup", substring_dedup),
    ("benchmark decontamination", decontamination),
    ("best-fit packing", best_fit_packing),
]

#: Fingerprints, min-hashes and tokens are beyond SQL; tests/llm/test_pipeline.py has the brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
