"""Vector expressions on ``array<float>`` columns, computed in double."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.settings import SCORE_DIGITS


def score_round(score: Column, digits: int = SCORE_DIGITS) -> Column:
    """Scores are compared rounded, so that the order of a distributed sum
    cannot change a ranking."""
    return F.round(score, digits)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")),
        F.lit(0.0),
        lambda acc, x: acc + x,
    )


def norm(a: Column) -> Column:
    return F.sqrt(
        F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))
    )


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; null when a vector is empty or all zero."""
    length = norm(a) * norm(b)
    return F.when(length > 0, dot(a, b) / length)


def cosine_pairs(a: Column, b: Column) -> Column:
    """As :func:`cosine`, a batch of rows at a time.

    Array lambdas are interpreted element by element; over many rows the matrix
    form is an order of magnitude faster.
    """

    @F.pandas_udf(T.DoubleType())
    def batch(left: pd.Series, right: pd.Series) -> pd.Series:
        import numpy as np

        out = np.full(len(left), None, dtype=object)
        full = [
            i for i, (x, y) in enumerate(zip(left, right))
            if x is not None and y is not None and len(x) and len(x) == len(y)
        ]
        if full:
            x = np.array([np.asarray(left.iloc[i], dtype=np.float64) for i in full])
            y = np.array([np.asarray(right.iloc[i], dtype=np.float64) for i in full])
            length = np.sqrt((x * x).sum(axis=1)) * np.sqrt((y * y).sum(axis=1))
            scores = (x * y).sum(axis=1) / np.where(length > 0, length, 1.0)
            for i, score, usable in zip(full, scores, length > 0):
                if usable:
                    out[i] = float(score)
        return pd.Series(out)

    return batch(a, b)


def int8_encode(vector: Column, lo: Column, hi: Column) -> Column:
    """One byte per component over ``[lo, hi]``; a flat range encodes as -128."""
    width = hi - lo

    def one(x: Column) -> Column:
        clamped = F.least(F.greatest(x.cast("double"), lo), hi)
        scaled = F.when(width > 0, (clamped - lo) / width * 255).otherwise(F.lit(0.0))
        return (F.round(scaled) - 128).cast("tinyint")

    return F.transform(vector, one)


def int8_decode(codes: Column, lo: Column, hi: Column) -> Column:
    return F.transform(codes, lambda c: lo + (c.cast("double") + 128) / 255 * (hi - lo))
