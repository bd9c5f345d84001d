"""The training-data pipeline over ``documents``.

Each stage takes all that its predecessor kept, and all but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import jaccard, mixing, pieces, pii, quality_cnn
from corpusloom.llm.common import crc_of, staged, table
from corpusloom.llm.queries import piece_model

NEAR_WORDS = 5
NEAR_THRESHOLD = (80, 100)

# SQL cannot express the classifier, the sampled pieces or the seeded selection
ORACLE_SQL = None


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the network accepts; it learns from labels not held out."""
    learned = F.pmod(crc_of(F.col("doc_id")), F.lit(5)) != 0
    weights = quality_cnn.fit_quality_model(docs.filter(learned), table(spark, sf_dir, "labels"))
    return quality_cnn.keep_quality(docs, weights)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at 0.8 or more."""
    return jaccard.keep_one(docs, NEAR_WORDS, NEAR_THRESHOLD)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents with personal data replaced by marks."""
    clean = pii.redact(docs)
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast("long"))
    return clean


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated, cut or left out so that sources meet their targets."""
    return mixing.mix_documents(docs)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, piece_ids, n_pieces, lossless`` of every mixed document."""
    return pieces.encode_and_check(docs, pieces.load_vocabulary(piece_model()))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mix_sources", mix_sources),
    ("sentencepiece", sentencepiece),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's result written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
