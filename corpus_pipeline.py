"""A corpus pipeline of five stages; each works on all that its predecessor kept.

Each stage takes documents with doc_id and text (language: lang too) and any other columns. Null ids are ids like any other; null and empty
texts and texts without a letter go in the first stage; repeated rows are copies; an empty table gives an empty result; extra columns
are kept up to the last stage, whatever their names.

Documents without an identifiable language go; of exact copies and of near copies one stays; secrets are replaced by a mark; what is
left is packed into training sequences.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import wraps

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import exact_dedup, language_id, ngram_join, packing, secret_scan
from tidemark.llm.queries import vocabulary_path
from tidemark.shared import Folder, release, shared_dir, small_batches

#: The cosine of unrelated vectors of so many dimensions has this standard deviation, twice.
NO_LANGUAGE = 2 / language_id.DIMENSIONS**0.5
#: A text of fewer letters has too few n-grams for its cosine to tell it from chance, so it is not dropped for it.
SHORT_LETTERS = 40


def in_small_batches(stage: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """``stage`` in a session whose Arrow batches are bounded in bytes: all stages share the Python workers of an executor, whose memory is that of the largest."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return stage(spark, docs, sf_dir)

    return run


@in_small_batches
def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from the labels at hand and drops what has no language: texts that are null or without a letter, and texts whose cosine with the
    predicted language's prototype is no larger than unrelated vectors have by chance (``NO_LANGUAGE``), as in a script that no label
    knows, unless they have fewer than ``SHORT_LETTERS`` letters, which the cosine cannot judge. Where nothing can be learned, as no text has a label, every text with a letter stays."""
    prototypes = language_id.learn(docs)
    least = NO_LANGUAGE if prototypes else 0.0
    taken = {c: f"__td_{c}" for c in docs.columns if c in ("lang_pred", "score")}
    found = language_id.predict(docs.withColumnsRenamed(taken), prototypes or {"unknown": np.ones(language_id.DIMENSIONS)})
    short = F.length(F.regexp_replace("text", r"[^\p{L}]", "")) < SHORT_LETTERS
    found = found.where((F.col("lang_pred") != "und") & ((F.col("score") >= least) | short)).drop("lang_pred", "score")
    return found.withColumnsRenamed({new: c for c, new in taken.items()}).select(*docs.columns)


@in_small_batches
def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_exact_duplicates(docs)


@in_small_batches
def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Five words, similarity of 0.8 or more; the smallest id of each component stays."""
    return ngram_join.drop_similar(docs)


@in_small_batches
def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; spans with secrets become a mark, and n_chars follows."""
    clean = secret_scan.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns) if "n_chars" in docs.columns else clean


@in_small_batches
def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    pieces = packing.pack(docs, vocabulary_path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [("language", identify_language), ("exact_copies", exact_copies), ("near_copies", near_copies), ("secrets", secrets), ("packing", sequences)]
#: Learned prototypes, components and tokenizers are beyond SQL; the tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; what each returns is written to the shared folder and read again."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    top = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{top}/{name}")
        docs = spark.read.parquet(f"{top}/{name}")
        if before:  # what the stage read is needed no more
            Folder(spark, top).delete(before)
        before = name
        release(spark)
    return STAGES[-1][1](spark, docs, sf_dir)
