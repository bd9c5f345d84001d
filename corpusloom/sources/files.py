"""Scans of files and document tables."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from corpusloom.functions.text import decode_text, with_metadata


def scan_files(spark: SparkSession, path: str) -> DataFrame:
    """``source, modification_time, length, content`` of every file below a path.

    A single file is accepted too.  Spark skips names that start with ``_`` or
    ``.``.  A missing path raises ValueError.
    """
    try:
        files = (
            spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
        )
    except AnalysisException as problem:
        raise ValueError(f"no such path: {path}") from problem
    return files.select(
        F.col("path").alias("source"),
        F.col("modificationTime").alias("modification_time"),
        "length",
        "content",
    )


def count_files(files: DataFrame) -> int:
    """Number of files; content is not read."""
    return files.select("source").count()


def scan_texts(spark: SparkSession, path: str) -> DataFrame:
    """``source, text, file_type, content_type`` of every file, decoded."""
    files = scan_files(spark, path)
    return with_metadata(files.select("source", decode_text(F.col("content")).alias("text")))


def scan_queries(spark: SparkSession, path: str) -> DataFrame:
    """``query_id, query`` from a JSON file holding a list of ``{"query": ...}``.

    The position in the list is the id.  A file without queries raises
    ValueError.
    """
    files = spark.read.format("binaryFile").load(path)
    parsed = F.from_json(decode_text(F.col("content")), "array<struct<query:string>>")
    rows = files.select(F.posexplode(parsed).alias("pos", "item"))
    queries = rows.select(F.col("pos").cast("long").alias("query_id"), F.col("item.query").alias("query"))
    if queries.isEmpty():
        raise ValueError(f"no queries in {path}")
    return queries


def write_queries(path: str, queries: list[str]) -> None:
    """Write a query file of the shape :func:`scan_queries` reads."""
    with open(path, "w", encoding="utf-8") as out:
        json.dump([{"query": q} for q in queries], out, ensure_ascii=False, indent=2)


def sample_first(df: DataFrame, n: int = 20, order_col: str = "source") -> DataFrame:
    """First ``n`` rows by ``order_col``: a distributed top-n, not a global sort."""
    return df.orderBy(order_col).limit(n)


def scan_documents(
    elements: DataFrame,
    id_col: str = "doc_id",
    pos_col: str = "pos",
    text_col: str = "text",
    separator: str = "\n\n",
) -> DataFrame:
    """``id, text``: element texts of each document joined in order by blank lines.

    Elements without text are skipped.
    """
    rows = F.array_sort(
        F.collect_list(
            F.when(F.col(text_col).isNotNull(), F.struct(F.col(pos_col).alias("pos"), F.col(text_col).alias("text")))
        )
    )
    return elements.groupBy(id_col).agg(
        F.array_join(F.transform(rows, lambda r: r["text"]), separator).alias("text")
    )


def filter_payload(df: DataFrame, **equals) -> DataFrame:
    """Rows whose columns equal the given values, or are in the given lists."""
    for column, value in equals.items():
        condition = (
            F.col(column).isin(list(value))
            if isinstance(value, (list, tuple, set))
            else F.col(column) == F.lit(value)
        )
        df = df.filter(condition)
    return df
