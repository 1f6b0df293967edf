"""Corpus pipeline: language ID, near-duplicate removal, personal data, mixing, packing.

Each stage takes (spark, docs, sf_dir), works on all rows that its predecessor
kept and returns a DataFrame, which ``run`` writes as Parquet to the shared
folder and rereads as the next stage's ``docs``. All but the last return the
columns of ``documents``; the last returns the packed pieces.

Column names that clash with ``documents`` cannot arise: stages keep the
columns as they come and add none until the last. Null and empty texts go in
the first stage (no language); every stage takes an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from linecast.llm import langid, mixing, ngram_join, packing, pii
from linecast.llm.common import materialize, table

#: The pipeline's near-duplicate stage: five-word shingles, similarity 0.8.
SHINGLE, PERCENT = 5, 80


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with an identified language; ``lang`` becomes the prediction."""
    return langid.keep_identified(docs, langid.fit(docs))


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return ngram_join.keep_one(docs, k=SHINGLE, percent=PERCENT)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in texts replaced by its kind; ``n_chars`` follows the text."""
    return pii.redact(docs, length_col="n_chars" if "n_chars" in docs.columns else None)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of the sources takes it."""
    return mixing.resample(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in sequences of 2048 tokens."""
    import public_tokenizers

    return packing.pack(packing.pieces(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES = [
    ("language_id", identify_language),
    ("ngram_jaccard_join", remove_near_duplicates),
    ("pii", redact_personal_data),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Learned models and token packing are not expressible in SQL; tests/llm compares
#: the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
