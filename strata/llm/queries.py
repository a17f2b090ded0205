"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from typing import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import bpe, html_extract, mixing, near_dedup, ngram_quality, phrases, quality_rules, secrets, suffix_dedup, token_counts, topk_search, toxicity, whitening
from strata.llm.common import read_table
from strata.llm.oracles import ORACLES

__all__ = ["ORACLES", "QUERIES"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


@query
def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode every text, decode the ids, digest both."""
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = bpe.encode_documents(read_table(spark, sf_dir, "documents"), ranks, outputs=("token_ids", "decoded"))
    return encoded.select("doc_id", "n_tokens", F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality_rules.score_rules(read_table(spark, sf_dir, "documents"))
    return scored.withColumns({c: F.round(c, 6) for c in ("char_distance", "word_distance")})


@query
def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_pages(read_table(spark, sf_dir, "pages"))


@query
def op3_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("secret_spans", lambda s: s["kind_order"] < 3)
    count = lambda kind: F.size(F.filter("secret_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(secrets.span_text(base), 256).alias("base_sha256"),
                        secrets.span_text(F.col("secret_spans")).alias("spans"))


@query
def op6_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_k(read_table(spark, sf_dir, "embeddings"))


@query
def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(read_table(spark, sf_dir, "documents").select("doc_id", "source"))
    return mixed.select("row.doc_id", "source", "block", "in_block", "share", "release", "deadline", "slot")


@query
def op5_ngram_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_quality.classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")).drop("mark")


@query
def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_classes(read_table(spark, sf_dir, "documents")).drop("mark")


@query
def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = suffix_dedup.remove_repeats(read_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@query
def op12_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(read_table(spark, sf_dir, "documents"))


@query
def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"))
