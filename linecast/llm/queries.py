"""Registered queries of the training-data operators and their DuckDB SQL.

Each query applies one operator with production parameters to its whole table
and derives the digest columns from the operator's output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linecast.llm import (
    chat, collocations, embedding_dedup, hard_negatives, langid, licenses, mixing, ngram_join, packing, pii,
    quality_classifier, quality_rules, substring_dedup,
)
from linecast.llm.common import crc_mod, table


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_join(table(spark, sf_dir, "documents"), k=4, percent=85)


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality_classifier.fit(docs, labels.where(crc_mod("doc_id", 5) != 0))
    scored = quality_classifier.score(docs, model)
    return scored.select("doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), "score", F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find_pii(table(spark, sf_dir, "documents")))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).drop("source", "reps")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(packing.pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = quality_rules.apply_policy(quality_rules.ledger(table(spark, sf_dir, "documents")))
    base = F.col("failed").bitwiseAND(F.lit(quality_rules.POLICIES["base"])) != 0
    return entries.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"), "kept")


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = r"\### Assistant: </turn> ok"
    extra = spark.range(0, 2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(probe).alias("text"))
    return chat.read_back(chat.format_conversations(rows.unionByName(extra), public_tokenizers.path("byte_bpe_50k.json")))


def op9_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs.where(crc_mod("doc_id", 4) != 2))
    return langid.predict(docs, model).select("doc_id", (crc_mod("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    about = licenses.notices(spark)
    passages = licenses.measured(docs, about)
    return licenses.summarize(docs, licenses.find_in_passages(passages, licenses.fit_passages(passages, about)))


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents")).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    relabelled = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives.hard_negatives(relabelled, anchors=F.col("vec_id") % 50 == 0)


QUERIES = {
    "op1_ngram_jaccard": op1_ngram_jaccard,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_embedding_dedup": op3_embedding_dedup,
    "op4_pii": op4_pii,
    "op5_mixing": op5_mixing,
    "op6_packing": op6_packing,
    "op7_quality_rules": op7_quality_rules,
    "op8_chat": op8_chat,
    "op9_langid": op9_langid,
    "op10_licenses": op10_licenses,
    "op11_substring_dedup": op11_substring_dedup,
    "op12_collocations": op12_collocations,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLE_SQL: dict[str, str] = {
    "op1_ngram_jaccard": ngram_join.oracle_sql(k=4, percent=85),
    "op3_embedding_dedup": embedding_dedup.oracle_sql(),
    "op5_mixing": mixing.oracle_sql(),
    "op7_quality_rules": quality_rules.ORACLE_SQL,
    "op8_chat": chat.oracle_sql(),
    "op11_substring_dedup": substring_dedup.oracle_sql(),
    "op12_collocations": collocations.oracle_sql(),
    "op13_hard_negatives": hard_negatives.oracle_sql(),
}
