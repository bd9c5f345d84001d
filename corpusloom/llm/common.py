"""Helpers of the operators in this subpackage."""

from __future__ import annotations

import atexit
import ctypes
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.settings import ensure_checkpoint_dir

# The white space that separates words.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def word_array(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; none for null."""
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(
        text.isNull() | (trimmed == ""), F.array().cast("array<string>")
    ).otherwise(F.split(trimmed, SPACE_RUN))


def count_words(text: Column) -> Column:
    return F.size(word_array(text)).cast("long")


def evaluated(df: DataFrame, *columns) -> DataFrame:
    """A select whose columns are computed once for each row.

    A plain select may be merged with what stands above it, or a filter from
    above be rewritten in terms of its inputs; an array used inside a lambda is
    then computed again for every element.  Neither happens across a generator.
    """
    return df.select(F.inline_outer(F.array(F.struct(*columns))))


def crc_of(doc_id: Column) -> Column:
    """crc32 of an id written in decimal; of the empty text for null."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder under the checkpoint folder, deleted when Python ends."""
    path = f"{ensure_checkpoint_dir(spark)}/llm-{uuid.uuid4().hex}/{name}"
    atexit.register(drop_folder, spark, path)
    return path


def drop_folder(spark: SparkSession, path: str) -> None:
    if spark.sparkContext._jsc is None:
        return
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a table into the shared folder and read it back: cuts the lineage.

    Parquet, unlike a checkpoint, is compressed and can be read column by
    column.  Survives the loss of any executor.
    """
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    frame = df.sparkSession.read.schema(df.schema).parquet(path)
    frame.staged_at = path
    return frame


def discard(*frames: DataFrame) -> None:
    """Delete staged tables that nothing reads any more."""
    for frame in frames:
        drop_folder(frame.sparkSession, frame.staged_at)


def text_slices(texts: pa.Array, most: int):
    """Slices of neighbouring texts of about ``most`` bytes, at least one text each.

    A batch is turned into Python strings a slice at a time; all of them at once
    would take its size again, several times that of texts beyond Latin-1.
    """
    begin, held = 0, 0
    for stop, size in enumerate(pc.fill_null(pc.binary_length(texts), 0).to_pylist(), 1):
        held += size
        if held >= most:
            yield slice(begin, stop)
            begin, held = stop, 0
    if begin < len(texts):
        yield slice(begin, len(texts))


def give_back() -> None:
    """Return the memory that this process has freed to the system.

    Spark keeps Python workers between tasks; what numpy and Arrow have freed
    would stay theirs while the JVM of the executor needs it.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def giving_back(step):
    """``step`` of a mapInArrow; its worker gives memory back at the end of a task."""

    def run(batches):
        try:
            yield from step(batches)
        finally:
            give_back()

    return run


def group_giving_back(step):
    """``step`` of an applyInArrow with large groups; memory goes back after each."""

    def run(table):
        try:
            return step(table)
        finally:
            give_back()

    return run


LOOKUP_ROWS = 200_000
LOOKUP_SALTS = 32
SALTED_ROWS = 20_000        # of a key that is spread
SALTED_KEYS = 10_000        # most keys that are


def left_lookup(
    big: DataFrame, small: DataFrame, big_key: str, small_key: str, salt_col: str,
    max_rows: int = LOOKUP_ROWS, salted_rows: int = SALTED_ROWS,
) -> DataFrame:
    """Left join with a staged table of narrow rows and unique keys.

    Broadcast while it has at most ``max_rows`` rows.  Beyond that both sides are
    shuffled, each row once; a key with ``salted_rows`` rows or more is spread by a
    salt, with a copy of its row of ``small`` for each.  Rows with a null key, which
    meet nothing, are spread as well.  The merge is asked for: Spark knows of the
    bytes of a file only, which are few where columns are alike, and would broadcast
    a table of millions of rows.
    """
    if small.limit(max_rows + 1).count() <= max_rows:
        return big.join(F.broadcast(small), F.col(big_key) == F.col(small_key), "left")
    often = staged(
        big.filter(F.col(big_key).isNotNull()).groupBy(F.col(big_key).alias("_often"))
        .agg(F.count("*").alias("_rows")).filter(F.col("_rows") >= salted_rows)
        .orderBy(F.desc("_rows"), "_often").limit(SALTED_KEYS).select("_often"),
        "often",
    )
    salt = F.pmod(F.xxhash64(salt_col), F.lit(LOOKUP_SALTS)).cast("int")
    dealt, spread, last = big.withColumn("_often", F.lit(None)), small, F.lit(0)
    if not often.isEmpty():
        dealt = big.join(F.broadcast(often), F.col(big_key) == F.col("_often"), "left")
        spread = small.join(F.broadcast(often), F.col(small_key) == F.col("_often"), "left")
        last = F.when(F.col("_often").isNotNull(), LOOKUP_SALTS - 1).otherwise(0)
    salted = dealt.withColumn(
        "_salt_b",
        F.when(F.col(big_key).isNull() | F.col("_often").isNotNull(), salt).otherwise(0),
    ).drop("_often")
    spread = spread.withColumn("_salt_s", F.explode(F.sequence(F.lit(0), last))).drop("_often")
    return salted.join(
        spread.hint("merge"),
        (F.col(big_key) == F.col(small_key)) & (F.col("_salt_b") == F.col("_salt_s")),
        "left",
    ).drop("_salt_b", "_salt_s")


PACKED_ROWS = 8_000_000     # ids that a task holds as plain numbers: 72 MB


def flagged(
    big: DataFrame, small: DataFrame, big_key: str, small_key: str, flag: str, salt_col: str,
    max_rows: int = LOOKUP_ROWS, packed_rows: int = PACKED_ROWS,
) -> DataFrame:
    """The rows of ``big`` whose key is in a staged table of unique whole numbers, and its flag.

    Rows of ``big`` may be long texts, and stay where they are: up to ``packed_rows``
    numbers travel to the tasks in 9 bytes each.  Beyond that both tables are shuffled.
    """
    count = small.limit(packed_rows + 1).count()
    if not max_rows < count <= packed_rows:
        found = left_lookup(big, small.select(small_key, flag), big_key, small_key, salt_col, max_rows)
        return found.filter(F.col(small_key).isNotNull()).drop(small_key)
    rows = small.select(small_key, flag).toArrow()
    keys = rows.column(0).to_numpy()
    order = np.argsort(keys)
    shared = small.sparkSession.sparkContext.broadcast((keys[order], rows.column(1).to_numpy()[order]))

    def look(wanted: pa.Array) -> pa.Array:
        names, flags = shared.value
        wanted = wanted.to_numpy(zero_copy_only=False)
        at = np.minimum(np.searchsorted(names, wanted), len(names) - 1)
        return pa.array(flags[at], pa.bool_(), mask=names[at] != wanted)

    # not deterministic: else the filter would call it once more
    look = F.arrow_udf(look, "boolean").asNondeterministic()
    return big.withColumn(flag, look(big_key)).filter(F.col(flag).isNotNull())


HOT_KEYS = 10_000


def share_join(big: DataFrame, small: DataFrame, big_key: str, small_key: str, weight: str) -> DataFrame:
    """Inner join with unique keys whose numbers of rows in ``big`` are known.

    Keys with at least one in ``HOT_KEYS`` of all rows are broadcast; by that share
    there are at most ``HOT_KEYS`` of them.  The others are shuffled, and none of
    them holds many rows.  Both tables are read twice and should be staged.
    """
    total = small.agg(F.sum(weight)).first()[0] or 0
    hot = F.col(weight) * HOT_KEYS >= F.lit(total)
    often = F.broadcast(small.filter(hot))
    near = big.join(often, F.col(big_key) == F.col(small_key))
    rest = big.join(
        F.broadcast(small.filter(hot).select(F.col(small_key).alias("_hot"))),
        F.col(big_key) == F.col("_hot"), "left_anti",
    )
    return near.unionByName(rest.join(small.filter(~hot), F.col(big_key) == F.col(small_key)))
