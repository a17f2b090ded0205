"""Training-data pipeline over ``documents``: five stages, each on all that the one before kept.

Every stage is a function of (spark, docs, sf_dir) and returns a DataFrame,
which is written as Parquet and read again as the next one's docs.  All but the
last return the columns of ``docs``, extra ones included.  A stage deletes the
scratch tables of the stage before, whose result is written by then.
"""

from __future__ import annotations

import functools
import threading
from typing import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import bpe, mixing, near_dedup, ngram_quality, secrets
from strata.llm.common import collected_scratch, delete_scratch, materialise, read_table, row_mark


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
_left = threading.local()


def _stage(function: Stage) -> Stage:
    """A stage that clears up after the one that ran before it in this thread."""
    @functools.wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        delete_scratch(spark, getattr(_left, "paths", []))
        _left.paths = []
        with collected_scratch() as _left.paths:
            return function(spark, docs, sf_dir)

    return run_stage


def _matching(docs: DataFrame, verdicts: DataFrame, how: str, *mark_of: str) -> DataFrame:
    """Rows of docs that the verdicts (``doc_id, mark``) name, or don't; docs' columns only."""
    verdicts = materialise(verdicts.select(F.col("doc_id").alias("id_"), F.col("mark").alias("mark_")).distinct(), "verdicts")
    rows = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"), docs["doc_id"].alias("id"), row_mark(*mark_of).alias("mark"))
    return rows.join(verdicts, F.col("id").eqNullSafe(F.col("id_")) & (F.col("mark") == F.col("mark_")), how).select("row.*")


@_stage
def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the n-gram classifier rejects.

    Texts that are null or empty, or of a language without trusted text, stay.
    Rows that repeat an id are judged each by its own text and language.
    """
    judged = ngram_quality.classify(docs, read_table(spark, sf_dir, "labels"))
    return _matching(docs, judged.where(~F.col("kept")), "left_anti", "text", "lang")


@_stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep of each class of near duplicates the document with the smallest id.

    Rows that repeat both id and text count as one document, so one of them
    stays.  Rows with a null id have no class and stay.
    """
    classes = near_dedup.near_classes(docs)
    kept = _matching(docs, classes.where(F.col("is_first") | F.col("class_id").isNull()), "left_semi", "text")
    repeated = classes.where(F.col("doc_id").isNotNull()).groupBy("doc_id").count().where("count > 1")
    if repeated.isEmpty():
        return kept
    kept = materialise(kept, "kept")
    unnamed, named = kept.where("doc_id is null"), kept.where("doc_id is not null")
    rows = named.select(F.struct(*(named[c] for c in named.columns)).alias("row"), named["doc_id"].alias("id"), row_mark("text").alias("mark"))
    return rows.dropDuplicates(["id", "mark"]).select("row.*").unionByName(unnamed)


@_stage
def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace the secrets in the texts by a placeholder; n_chars follows. No document goes."""
    spans = "spans"
    while spans in docs.columns:
        spans += "_"
    scanned = secrets.scan(docs, spans_col=spans)
    redacted = secrets.redact(scanned.withColumn("n_chars", F.when(F.size(spans) > 0, F.lit(-1)).otherwise(F.col("n_chars"))), spans_col=spans)
    length = F.length("text").cast(docs.schema["n_chars"].dataType)
    return redacted.withColumn("n_chars", F.when(F.col("n_chars") == -1, length).otherwise(F.col("n_chars"))).select(*docs.columns)


@_stage
def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of the mix: the written files hold it one after another."""
    return mixing.mix(docs).orderBy("slot", "in_block").select("row.*")


@_stage
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids and offsets of every document, and digests of the ids and of what they decode to."""
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = bpe.encode_documents(docs, ranks, outputs=("token_ids", "token_offsets", "decoded"))
    return encoded.select("doc_id", "n_tokens", "token_ids", "token_offsets", F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality_classifier),
    ("near_duplicates", near_duplicates),
    ("secret_scans", secret_scans),
    ("source_mixing", source_mixing),
    ("byte_bpe", encode),
]

#: signatures, a trained model and token merges have no SQL; the tests run a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
