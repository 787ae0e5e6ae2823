"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import ann, bpe, byte_bpe, chat_format, exact_dedup, language_id, license_scan, ngram_join, packing, resample, secret_scan, source_audit, suffix_dedup


def vocabulary_path(name: str) -> str:
    """The place of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 20 == 0)


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.report(license_scan.scan(spark.read.parquet(f"{sf_dir}/documents.parquet")))


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), words=3, num=90, den=100)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("held_out", language_id.held_out())
    prototypes = language_id.learn(docs.where(~F.col("held_out")))
    return language_id.predict(docs.select("doc_id", "held_out", "text"), prototypes).select("doc_id", "held_out", "lang_pred", "score")


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = vocabulary_path("byte_bpe_50k.json")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    both = bpe.round_trip(docs, path)
    ids = F.array_join(F.col("token_ids").cast("array<string>"), ",")
    return both.select("doc_id", F.size("token_ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), vocabulary_path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.report(secret_scan.scan(spark.read.parquet(f"{sf_dir}/documents.parquet")))


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    control = "</s>[INST] ok [/INST]"
    added = spark.createDataFrame([(-1, 0, "user", control), (-1, 1, "assistant", control)], "conv_id long, turn long, role string, text string")
    turns = rows.unionByName(added).withColumn("parts", chat_format.text_parts(F.col("text")))
    return chat_format.read_back(chat_format.format_turns(turns))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.report(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op11_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit.audit(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op12_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    both = byte_bpe.round_trip(docs, vocabulary_path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    n = F.floor(F.octet_length("ids") / 4).cast("long")
    return both.select("doc_id", n.alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def queries() -> dict:
    return {f.__name__: f for f in (op1_permutation_index, op2_license_scan, op3_ngram_join, op4_language_id, op5_bpe, op6_packing, op7_secret_scan, op8_chat_format, op9_suffix_dedup, op10_exact_dedup, op11_source_audit, op12_resample, op13_byte_bpe)}


def oracle_sql() -> dict:
    return {"op2_license_scan": license_scan.ORACLE, "op3_ngram_join": ngram_join.ORACLE, "op10_exact_dedup": exact_dedup.ORACLE, "op11_source_audit": source_audit.ORACLE, "op12_resample": resample.ORACLE}
