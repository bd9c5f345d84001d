"""Incremental ingest of new files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corpusloom.functions.text import decode_text
from corpusloom.plans.corpus import ingest_documents
from corpusloom.sources.collection import Collection

# Schema of the binaryFile source.
FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def ingest_stream(
    spark: SparkSession,
    path: str,
    collection: Collection,
    checkpoint: str,
    embedder: Callable[[Column], Column] | None = None,
    html_mode: str = "nested",
    max_files: int = 10_000,
) -> StreamingQuery:
    """Chunk, deduplicate per file and store every file not seen before.

    One file is one row, so a micro-batch holds whole files and per-file dedup
    is exact.  Chunks are upserted by content id: a batch that runs again after
    a failure changes nothing.  IDF and mean length are computed from the
    collection when it is searched, so they do not drift.  Stops when all files
    present have been read.
    """
    files = (
        spark.readStream.format("binaryFile")
        .schema(FILE_SCHEMA)
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", max_files)
        .load(path)
        .select(F.col("path").alias("source"), decode_text(F.col("content")).alias("text"))
    )

    def store(batch: DataFrame, batch_id: int) -> None:
        ingest_documents(batch, collection, embedder, html_mode, "source", "upsert")

    return (
        files.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
