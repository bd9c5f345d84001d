"""Mixing sources to target weights by Sainte-Lague apportionment.

The mix is counted in blocks of equal token number.  Blocks are given to
sources, and the blocks of a source to its shards, always to the highest
quotient ``weight / (2 * given + 1)``.  A shard then takes its quota out of its
own blocks by a seeded selection, whole passes first.

* Sources: one row each; the table of sources is reduced map-side.
* Shards: a source is split by a hash of the row key, so that no source, however
  large, is ordered in one task.  A source has at most ``MAX_SHARDS`` shards.
* Selection is arithmetic on word offsets; no block is ever a row.

Texts are read once, to count words, and never shuffled.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusloom.llm.common import count_words, evaluated, staged, word_array

WEIGHTS = (3, 1, 2)
SHARE = 1.5
REPEATS = 2.0
BLOCK_WORDS = 8
TEXT_BLOCK_WORDS = 1024     # where texts are cut: mostly whole documents
SHARD_WORDS = 1 << 20
MAX_SHARDS = 1 << 16
SEED = 20240607


def capped_targets(sizes, weights, total: float, repeats: float):
    """Water filling: ``total`` by weight, no share above ``repeats * size``."""
    sizes = np.asarray(sizes, dtype=np.float64)
    weights = np.asarray(weights, dtype=np.float64)
    caps = repeats * sizes
    targets = np.zeros(len(sizes))
    free = np.ones(len(sizes), dtype=bool)
    left = total
    while free.any() and left > 0:
        share = left * weights / weights[free].sum()
        over = free & (share >= caps)
        if not over.any():
            targets[free] = share[free]
            break
        targets[over] = caps[over]
        left -= caps[over].sum()
        free &= ~over
    return targets


def apportion(weights, seats: int, caps) -> np.ndarray:
    """Sainte-Lague seats for ``weights``, at most ``caps`` each.

    Same outcome as giving seat after seat to the highest quotient
    ``w / (2 a + 1)``, ties to the earlier entry: a divisor is bisected until
    rounding gives at most ``seats``, the last seats go one by one.
    """
    weights = np.asarray(weights, dtype=np.float64)
    caps = np.asarray(caps, dtype=np.int64)
    seats = int(min(seats, caps[weights > 0].sum()))
    if seats <= 0:
        return np.zeros(len(weights), dtype=np.int64)

    def at(divisor):
        return np.minimum(np.floor(weights / divisor + 0.5), caps).astype(np.int64)

    high = 2 * weights.max() + 1e-300
    low = high
    while at(low).sum() < seats:
        low /= 2
    while at(high).sum() > seats:
        high *= 2
    for _ in range(200):
        middle = (low + high) / 2
        if not low < middle < high:
            break
        if at(middle).sum() > seats:
            low = middle
        else:
            high = middle
    given = at(high)
    for _ in range(seats - int(given.sum())):
        quotient = np.where(given < caps, weights / (2 * given + 1), -1.0)
        given[int(np.argmax(quotient))] += 1
    return given


def source_plan(sources: DataFrame, weights, share, repeats, block_words) -> DataFrame:
    """``source, source_size, target, seats`` of every source.

    One row a source goes through one task: the weights run over all sources in
    order and the excess of one is shared by all.
    """
    columns = "source string, source_size long, target double, seats long"

    def plan(frame: pd.DataFrame) -> pd.DataFrame:
        named = frame[frame["source"].notna()]
        # str order of Python is the order of code points
        frame = pd.concat([named.sort_values("source"), frame[frame["source"].isna()]])
        weight = np.array([weights[i % len(weights)] for i in range(len(frame))], dtype=float)
        total = share * float(frame["source_size"].sum())
        targets = capped_targets(frame["source_size"], weight, total, repeats)
        caps = np.ceil(repeats * frame["source_size"].to_numpy() / block_words)
        seats = apportion(targets, int(round(targets.sum() / block_words)), caps)
        frame = frame.assign(target=targets, seats=seats)
        return frame[["source", "source_size", "target", "seats"]]

    return sources.groupBy(F.lit("all")).applyInPandas(
        lambda _, frame: plan(frame), columns
    )


def mix_sources(
    docs: DataFrame,
    size: Column | None = None,
    weights=WEIGHTS,
    share: float = SHARE,
    repeats: float = REPEATS,
    block_words: int = BLOCK_WORDS,
    seed: int = SEED,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, source, size, source_size, target, taken``, one row per document,
    and where in its shard it lies: ``start_word, passes, extra_blocks, block_offset,
    blocks``.

    ``taken`` is how many words of the document the mix takes, repeats counted;
    at most ``repeats`` (a whole number) times its size.  A source's taken words
    differ from its target by less than one block per shard plus one.  The seed
    alone decides which blocks are taken; reruns agree.

    Null text: size 0.  Null source: a source of its own, last in order.  Null
    or repeated ids keep their rows; equal rows are dealt in any order, which
    cannot be told apart.  Empty table: no rows.  Other columns are ignored.
    """
    if repeats != int(repeats) or repeats < 1:
        raise ValueError("repeats must be a whole number of at least 1")
    length = count_words(F.col(text_col)) if size is None else size
    sized = staged(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.col(source_col).alias("source"),
            length.cast("long").alias("size"),
        ),
        "sizes",
    )
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = staged(source_plan(totals, weights, share, repeats, block_words), "sources")
    # one row a source: small against the documents, and joined by a merge if it is not
    placed = sized.join(
        plan.withColumnRenamed("source", "its_source"),
        F.col("source").eqNullSafe(F.col("its_source")),
    ).drop("its_source")
    shards = F.ceil(
        F.col("source_size")
        / F.greatest(F.lit(SHARD_WORDS), F.col("source_size") / MAX_SHARDS)
    )
    drawn = F.xxhash64(F.lit(seed), "doc_id", "size")
    placed = placed.withColumn("drawn", drawn).withColumn(
        "shard", F.pmod(F.xxhash64(F.lit(seed + 1), "drawn"), F.greatest(shards, F.lit(1)))
    )
    quotas = staged(shard_quotas(placed, repeats, block_words), "quotas")
    order = (
        Window.partitionBy("source", "shard")
        .orderBy("drawn", F.col("doc_id").asc_nulls_last(), "size")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    laid = placed.withColumn("end_word", F.sum("size").over(order))
    joined = laid.join(
        quotas.select(
            F.col("source").alias("q_source"), F.col("shard").alias("q_shard"), "blocks", "quota"
        ),
        F.col("source").eqNullSafe(F.col("q_source")) & (F.col("shard") == F.col("q_shard")),
    )
    passes = F.floor(F.col("quota") / F.col("blocks"))
    extra = F.col("quota") - passes * F.col("blocks")
    offset = F.pmod(F.xxhash64(F.lit(seed + 2), "source", "shard"), F.col("blocks"))

    def chosen_before(block: Column) -> Column:
        """How many of the first ``block`` blocks are taken once more."""
        return F.floor((block * extra + offset) / F.col("blocks"))

    def words_before(word: Column) -> Column:
        block = F.floor(word / F.lit(block_words))
        whole = (chosen_before(block) - chosen_before(F.lit(0))) * block_words
        inside = chosen_before(block + 1) - chosen_before(block)
        return whole + inside * (word - block * block_words)

    start = F.col("end_word") - F.col("size")
    taken = passes * F.col("size") + words_before(F.col("end_word")) - words_before(start)
    return joined.select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        F.when(F.col("size") == 0, F.lit(0)).otherwise(taken).cast("long").alias("taken"),
        start.alias("start_word"),
        passes.cast("long").alias("passes"),
        extra.cast("long").alias("extra_blocks"),
        offset.alias("block_offset"),
        "blocks",
    )


def mix_documents(
    docs: DataFrame, block_words: int = TEXT_BLOCK_WORDS, id_col: str = "doc_id",
    source_col: str = "source", text_col: str = "text", **options,
) -> DataFrame:
    """The mixed documents themselves, in the columns of ``docs``.

    A document comes once for every whole pass and, if some of its blocks are
    taken once more, again with the words of these blocks: its text as it is if
    that is all of them, else the words joined by blanks.  Documents of which
    nothing is taken, such as empty ones and nulls, are absent.  ``n_chars`` follows
    the text where the column exists.  Null and repeated ids and repeated rows are
    each taken by themselves; other columns pass through, whatever their names; an
    empty table stays empty.
    """
    packed = docs.select(
        F.struct("*").alias("doc"), F.col(id_col).alias("id"),
        F.xxhash64(text_col, source_col).alias("content"),
        F.col(text_col).alias("text"), F.col(source_col).alias("source"),
    )
    plan = mix_sources(
        packed.select("text", "source", F.struct("id", "content").alias("doc_id")),
        block_words=block_words, **options,
    ).select(
        F.col("doc_id.id").alias("p_id"), F.col("doc_id.content").alias("p_content"),
        "taken", "size", "start_word", "passes", "extra_blocks", "block_offset", "blocks",
    )
    copies = Window.partitionBy("p_id", "p_content").orderBy("start_word", "passes", "block_offset")
    plan = plan.withColumn("p_no", F.row_number().over(copies)).filter("taken > 0")
    numbered = Window.partitionBy("id", "content").orderBy(F.lit(0))
    placed = packed.select("doc", "id", "content", F.row_number().over(numbered).alias("no"))
    joined = placed.join(
        plan,
        F.col("id").eqNullSafe(F.col("p_id")) & (F.col("content") == F.col("p_content"))
        & (F.col("no") == F.col("p_no")),
    )
    text = F.col("doc").getField(text_col)
    again = F.col("taken") - F.col("passes") * F.col("size")
    ready = evaluated(
        joined, "doc", "size", "passes", "start_word", "extra_blocks", "block_offset",
        "blocks", again.alias("again"),
        F.when((again > 0) & (again < F.col("size")), word_array(text)).alias("words"),
    )

    def chosen(word, i):
        block = F.floor((F.col("start_word") + i) / F.lit(block_words))
        before = F.floor((block * F.col("extra_blocks") + F.col("block_offset")) / F.col("blocks"))
        after = F.floor(
            ((block + 1) * F.col("extra_blocks") + F.col("block_offset")) / F.col("blocks")
        )
        return after > before

    part = F.when(F.col("again") == F.col("size"), text).when(
        F.col("again") > 0, F.array_join(F.filter("words", chosen), " ")
    )
    texts = F.concat(
        F.array_repeat(text, F.col("passes").cast("int")),
        F.when(F.col("again") > 0, F.array(part)).otherwise(F.array().cast("array<string>")),
    )
    emitted = ready.select("doc", F.explode_outer(texts).alias("text"))
    return emitted.select(
        *[
            F.col("text").alias(c) if c == text_col
            else F.length("text").cast("long").alias(c) if c == "n_chars"
            else F.col("doc").getField(c).alias(c)
            for c in docs.columns
        ]
    )


def shard_quotas(placed: DataFrame, repeats: float, block_words: int) -> DataFrame:
    """``source, shard, blocks, quota``: whole blocks for every shard."""

    def divide(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("shard")
        blocks = np.maximum(-(-frame["words"].to_numpy() // block_words), 1)
        caps = (repeats * blocks).astype(np.int64)
        quota = apportion(frame["words"], int(frame["seats"].iloc[0]), caps)
        return frame.assign(blocks=blocks, quota=quota)[["source", "shard", "blocks", "quota"]]

    return (
        placed.groupBy("source", "shard", "seats")
        .agg(F.sum("size").alias("words"))
        .groupBy("source")
        .applyInPandas(divide, "source string, shard long, blocks long, quota long")
    )
