"""The operators over the test tables, with their production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import bm25, bpe_count, chat, importance, kneser_ney, lattice, merkle, packing, paragraphs, simhash, spelling, token_store, toxicity


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op8_decontamination(spark, sf_dir):
    """Every document and the test items found in it."""
    return bm25.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op9_token_counts(spark, sf_dir):
    """Byte-level BPE token count of every document."""
    return bpe_count.token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def _trusted(spark, sf_dir):
    return _table(spark, sf_dir, "labels").where("quality = 1 AND toxic = 0").select("doc_id")


def op1_simhash(spark, sf_dir):
    """SimHash fingerprint and component of every document: 3-word shingles, links at 3 bits."""
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"), shingle=3, max_bits=3)


def op2_kneser_ney_quality(spark, sf_dir):
    """Perplexity of every document under trusted text, against its language's quantile."""
    return kneser_ney.quality(_table(spark, sf_dir, "documents"), _trusted(spark, sf_dir))


def op3_lattice_scores(spark, sf_dir):
    """Marginal log10 probability of every document over the segmentations into 32k pieces, with add-one word scores."""
    return lattice.scores(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op4_quality_rules(spark, sf_dir):
    """Counted rules and importance score of every document."""
    return importance.quality(_table(spark, sf_dir, "documents"), _trusted(spark, sf_dir))


def op5_paragraph_dedup(spark, sf_dir):
    """Every paragraph that repeats across or within documents, and the occurrence that stays."""
    return paragraphs.repeated_paragraphs(_table(spark, sf_dir, "documents"))


def op6_chat_collapse(spark, sf_dir):
    """Maximal logged conversations, rendered."""
    return chat.maximal_conversations(_table(spark, sf_dir, "conversations"))


def op7_token_store(spark, sf_dir):
    """Every document's ids written to a token store and read back through its index."""
    store = token_store.write_store(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), 2)
    found = token_store.lookup(store, store.records.select("doc_id", "j", "k"))
    return token_store.crc32s(token_store.read_documents(store, found))


def op10_best_fit_packing(spark, sf_dir):
    """Every document packed into sequences of at most 2048 tokens."""
    return packing.packed_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"),
                                    end_id=0, max_len=2048)


def op11_toxicity(spark, sf_dir):
    """Toxicity of every document's restored text, learned from the training labels."""
    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op12_spelling_variants(spark, sf_dir):
    """Every word of three or more occurrences, its near words, form and root."""
    return spelling.spelling_variants(_table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark, sf_dir):
    """Leaf, subroot, root and checked proof of every document."""
    return merkle.manifest(_table(spark, sf_dir, "documents"))


def queries() -> dict:
    return {f.__name__: f for f in (
        op1_simhash, op2_kneser_ney_quality, op3_lattice_scores, op4_quality_rules, op5_paragraph_dedup,
        op6_chat_collapse, op7_token_store, op8_decontamination, op9_token_counts, op10_best_fit_packing,
        op11_toxicity, op12_spelling_variants, op13_merkle_manifest)}


def oracle_sql() -> dict[str, str]:
    return {"op6_chat_collapse": chat.SQL, "op12_spelling_variants": spelling.SQL,
            "op13_merkle_manifest": merkle.SQL}
