"""Packed rows: many small numbers in one binary value.

A job that moves tens of numbers for every line of text would spend its time on
row headers.  Here a task packs the numbers bound for one bucket into a few
binary columns, and a bucket is unpacked by one task; bytes of equal weight
stand together, so that the shuffle's compression sees runs of zeros.
"""

from __future__ import annotations

import numpy as np

MIX = np.uint64(0x9E3779B97F4A7C15)
LAST = np.iinfo(np.int64).max       # stands for a null id: after all others


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads all of their bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def pack(numbers: np.ndarray) -> bytes:
    """Bytes of a number array, first all lowest bytes, then the next ones."""
    raw = np.ascontiguousarray(numbers).view(np.uint8).reshape(len(numbers), -1)
    return raw.T.tobytes()


def unpack(data: bytes, kind) -> np.ndarray:
    width = np.dtype(kind).itemsize
    raw = np.frombuffer(data, np.uint8).reshape(width, -1)
    return np.ascontiguousarray(raw.T).view(kind).reshape(-1)


def steps(numbers: np.ndarray) -> np.ndarray:
    """Differences of neighbours; undone by a running sum."""
    return np.diff(numbers, prepend=numbers.dtype.type(0))


def groups_of(sorted_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and sizes of the runs of equal values."""
    if not len(sorted_keys):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    begins = np.flatnonzero(np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]]))
    return begins, np.diff(np.append(begins, len(sorted_keys)))


def ranges(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All numbers of the ranges ``begin .. begin + size``, one after another."""
    total = int(sizes.sum())
    if not total:
        return np.empty(0, np.int64)
    return np.arange(total) + np.repeat(begins - (np.cumsum(sizes) - sizes), sizes)
