"""The corpus pipeline: raw documents to packed training sequences, each stage written and read again.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and returns a frame. All but the last return the
columns of `documents`. An empty table gives an empty result. The stages' folders stay in the shared folder: the last one
is what the result is read from, and the others let a broken run be looked at.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlift.llm.common import shared_folder, table
from ledgerlift.llm.exact_dedup import drop_copies
from ledgerlift.llm.ngram_join import drop_near_copies
from ledgerlift.llm.packing import pack
from ledgerlift.llm.quality import fit_quality, keep_quality
from ledgerlift.llm.secret_scan import redact_secrets

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the byte network rejects go. Null and empty texts score the share of label 1 among the training rows;
    repeated rows are judged alike; without labels nothing is learned and all score one half, so all stay."""
    return keep_quality(docs, fit_quality(docs, table(spark, sf_dir, "labels"))).select(*COLUMNS)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the smallest doc_id stays, once if its row is repeated. Null texts are empty ones; a null doc_id stays
    only if its group has no other."""
    return drop_copies(docs).select(*COLUMNS)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the smallest doc_id stays. Null, empty and blank texts and rows without a doc_id stay."""
    return drop_near_copies(docs).select(*COLUMNS)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; every document stays, with n_chars counted anew. A null text stays null."""
    return redact_secrets(docs).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces with their place in sequences of at most 4096 tokens. A null text is an empty one: its piece is the end id; a
    null doc_id stays null; repeated rows are packed each on their own."""
    return pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality_classifier),
    ("exact_dedup", exact_dedup),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("secret_scan", secret_scan),
    ("best_fit_packing", best_fit_packing),
]

#: SQL can express neither the network nor the tokenizer. Tests hold each stage, on what the one before kept, against a
#: brute-force version of its rule.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; what each returns is written as Parquet to the shared folder and read again."""
    folder = f"{shared_folder(spark)}/corpus-pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for place, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{place}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
