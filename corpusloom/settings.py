"""Defaults shared by the operators."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Fixed values.
SCORE_DIGITS = 6            # scores are compared at 6 decimals, ties go to the smaller id
DEDUP_THRESHOLD = 0.85
NUM_PERM = 128
BANDS = 8                   # 8 bands of 16 rows: smallest error area for threshold 0.85
BM25_K1 = 1.2
BM25_B = 0.75
RRF_K = 60
QUANTILE = 0.99
EMBED_BATCH = 100
EMBED_DIM = 64
LIMIT = 10
PREFETCH_FACTOR = 25        # candidates per channel = 25 x limit
FUSED_FACTOR = 5            # candidates reranked = 5 x limit

# Largest tables that may be broadcast, in rows and in bytes.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 128 * 1024 * 1024


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting one only for local runs."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not context.master.startswith("local"):
            raise ValueError(
                "spark.checkpoint.dir is not set; name a folder every executor can reach"
            )
        configured = tempfile.mkdtemp(prefix="corpusloom-checkpoint-")
    context.setCheckpointDir(configured)
    return context.getCheckpointDir()
