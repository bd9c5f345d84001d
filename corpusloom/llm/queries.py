"""Registered queries of the operators, each over its whole table."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import alignment, collisions, curves, jaccard, langid, merkle, mixing, pieces, pii, quality_cnn, quality_rules, repeats, warc
from corpusloom.llm.common import crc_of, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op1_quality_rules(spark, folder):
    return quality_rules.apply_rules(table(spark, folder, "documents"))


@query
def op2_language_id(spark, folder):
    docs = table(spark, folder, "documents")
    held_out = F.pmod(crc_of(F.col("doc_id")), F.lit(3)) == 1
    model = langid.fit_language_model(docs.filter(~held_out))
    return langid.detect_languages(docs, model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score",
        F.size("spans").cast("long").alias("n_spans"),
    )


def piece_model():
    """The model file of the pieces; its place is a parameter of the environment."""
    return os.environ.get("PIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")


@query
def op3_sentencepiece(spark, folder):
    docs = table(spark, folder, "documents")
    vocabulary = pieces.load_vocabulary(piece_model())
    return pieces.encode_and_check(docs, vocabulary)


@query
def op4_pii(spark, folder):
    return pii.detect_pii(table(spark, folder, "documents")).drop("found")


def quality_weights(spark, folder):
    """Learned from the labelled rows that are not held out."""
    learned = F.pmod(crc_of(F.col("doc_id")), F.lit(5)) != 0
    return quality_cnn.fit_quality_model(
        table(spark, folder, "documents").filter(learned), table(spark, folder, "labels")
    )


@query
def op5_quality_classifier(spark, folder):
    scored = quality_cnn.score_quality(
        table(spark, folder, "documents"), quality_weights(spark, folder)
    )
    return scored.select(
        "doc_id",
        (F.pmod(crc_of(F.col("doc_id")), F.lit(5)) == 0).alias("held_out"),
        "score",
        (F.col("score") >= quality_cnn.THRESHOLD).cast("int").alias("predicted"),
    )


@query
def op6_ngram_jaccard(spark, folder):
    return jaccard.link_components(table(spark, folder, "documents"))


@query
def op7_repeats(spark, folder):
    return repeats.remove_repeats(table(spark, folder, "documents"), keep_text=False).drop("kept")


@query
def op8_mix_sources(spark, folder):
    mixed = mixing.mix_sources(table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query
def op9_warc(spark, folder):
    archives = warc.write_archives(table(spark, folder, "pages"))
    return warc.read_archives(archives).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@query
def op10_nearest_neighbours(spark, folder):
    return curves.nearest_neighbours(
        table(spark, folder, "embeddings"), lambda vec_id: vec_id % 20 == 0
    )


@query
def op12_minhash_duplicates(spark, folder):
    return collisions.near_duplicates(table(spark, folder, "documents"))


@query
def op13_merkle_manifest(spark, folder):
    changed = F.col("doc_id").isNotNull() & (F.pmod(crc_of(F.col("doc_id")), F.lit(3)) == 0)
    manifest = merkle.merkle_manifest(
        table(spark, folder, "documents"), {"text": merkle.lower_ascii(F.col("text"))}, changed,
        keep_copies=False,
    )
    return manifest.drop("changed", "copied")


def byte_tokenizer():
    """The file of the byte-level tokenizer; its place is a parameter of the environment."""
    return os.environ.get("BYTE_TOKENIZER", "/opt/tokenizers/byte_bpe_50k.json")


@query
def op11_token_alignment(spark, folder):
    docs = table(spark, folder, "documents")
    return alignment.alignment_digest(docs, byte_tokenizer(), piece_model()).drop("n_overlaps")
