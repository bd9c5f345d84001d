"""One row per array element.

A plain ``explode`` lets the optimizer add a filter "array not null and not
empty" that computes the array again, and move it below a repartition to where
the parallelism is low.  The outer form gives no such filter; the rows of empty
arrays are dropped afterwards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def explode_items(df: DataFrame, keep: list, items: Column, name: str) -> DataFrame:
    """``*keep, name``; null elements and empty arrays give no row."""
    return df.select(*keep, F.explode_outer(items).alias(name)).filter(F.col(name).isNotNull())


def posexplode_items(
    df: DataFrame, keep: list, items: Column, pos: str, name: str
) -> DataFrame:
    """``*keep, pos, name``; empty arrays give no row."""
    return df.select(*keep, F.posexplode_outer(items).alias(pos, name)).filter(
        F.col(pos).isNotNull()
    )
