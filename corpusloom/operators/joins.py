"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.settings import BROADCAST_BYTES, BROADCAST_ROWS

HOT_KEYS = 256


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows and BROADCAST_BYTES bytes.

    Rows are counted no further than the bound; text has no bound of its own, so
    its bytes are summed.
    """
    width = F.lit(8 * len(df.columns))
    for name, kind in df.dtypes:
        if kind == "string":
            width = width + F.coalesce(F.octet_length(name), F.lit(0))
    found = df.limit(max_rows + 1).agg(
        F.count("*").alias("n"), F.coalesce(F.sum(width), F.lit(0)).alias("bytes")
    ).first()
    return found["n"] <= max_rows and found["bytes"] <= BROADCAST_BYTES


def lookup_join(
    big: DataFrame,
    small: DataFrame,
    on: Sequence[str],
    salt_col: str,
    max_rows: int = BROADCAST_ROWS,
    salts: int | None = None,
    bound: DataFrame | None = None,
) -> DataFrame:
    """Inner join of a large table with a smaller one of narrow rows.

    Within the row bound the small side is broadcast and the large side keeps
    its partitioning.  Beyond it, both sides are shuffled on the key, each row
    once; a partition that a frequent key has made large is split by Spark's
    adaptive skew join.  ``salts`` is for a key that holds most rows of the large
    side where that is switched off: the key gets a salt taken from ``salt_col``,
    and the small side is repeated ``salts`` times.

    The check counts ``bound`` when it is given: a table with at least as many
    rows as ``small`` that is cheaper to count.
    """
    on = list(on)
    if fits_broadcast(small if bound is None else bound, max_rows):
        return big.join(F.broadcast(small), on)
    if salts is None:
        return big.join(small, on)
    spread = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = big.withColumn("_salt", F.pmod(F.xxhash64(salt_col), F.lit(salts)).cast("int"))
    return salted.join(spread, [*on, "_salt"]).drop("_salt")


def heaviest(rows: DataFrame, weight: str, max_rows: int = BROADCAST_ROWS) -> int | None:
    """Smallest ``weight`` for which at most ``max_rows`` rows weigh that much or more.

    None if all rows are within the bound.  Rows are counted by the logarithm of
    their weight, so the driver sees a few hundred counts.
    """
    level = F.floor(F.log2(F.col(weight).cast("double")) * 8).alias("level")
    counted = rows.groupBy(level).agg(F.count("*").alias("n"), F.min(weight).alias("least")).collect()
    taken, least = 0, None
    for row in sorted(counted, key=lambda r: -r["level"]):
        taken += row["n"]
        if taken > max_rows:
            return row["least"] * 2 if least is None else least
        least = row["least"]
    return None


def hot_split_join(
    rows: DataFrame,
    groups: DataFrame,
    on: Sequence[str],
    size_col: str,
    hot_keys: int = HOT_KEYS,
) -> DataFrame:
    """Inner join of member rows with one row per group.

    The ``hot_keys`` largest groups are found by their size column and
    broadcast (a bounded number of rows), so members of a huge group are never
    sent to one task.  All other groups go through an ordinary shuffle join.
    """
    on = list(on)
    hot = groups.orderBy(F.desc(size_col), *on).limit(hot_keys)
    hot_part = rows.join(F.broadcast(hot), on)
    cold_rows = rows.join(F.broadcast(hot.select(*on)), on, "left_anti")
    return hot_part.unionByName(cold_rows.join(groups, on))


def attach_vectors(chunks: DataFrame, vectors: DataFrame, on: str = "chunk_id") -> DataFrame:
    """Pair chunks with their vectors by key; unmatched rows on either side drop."""
    return chunks.join(vectors, on)


def gather_chunks(*parts: DataFrame) -> DataFrame:
    """Concatenate chunk tables of equal columns."""
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result
