"""MinHash near-duplicates by an inverted join of signature coordinates.

Documents are sets of word shingles with a signature of ``COORDINATES`` minima.

1. A set is posted under each pair of coordinate and value.  Values that no other
   set has are dropped; so is a set left with fewer than ``MATCHES`` of them,
   because it cannot match another one that often.
2. Prefix: a set's postings are ordered by length; two sets that match
   ``MATCHES`` times must share one of the shortest ``postings - MATCHES + 1``.
   Only those are kept.
3. In the lists of these, sets not yet in one component are counted: the shorter
   posting lists are merged, the longer ones are skipped through by binary search,
   and a pair is left as soon as it cannot reach the match threshold.
4. Pairs above it are compared on their full sets (``meeting``); only those that
   reach the similarity are links.

The match threshold is far below what linked sets have: of 64 coordinates, two
sets of similarity 0.85 match in 54 on average and in fewer than 26 with a
probability below 1e-14.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.meeting import BLOCK, BUCKET_BYTES, shingle_components
from corpusloom.llm.packing import groups_of, mixed

WORDS = 5
THRESHOLD = (85, 100)
COORDINATES = 64
MATCHES = 26

_SEEDS = mixed(np.arange(1, 2 * COORDINATES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
MASKS, FACTORS = _SEEDS[:COORDINATES], _SEEDS[COORDINATES:] | np.uint64(1)


def signatures(tokens: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A row of ``COORDINATES`` 32-bit minima for each (non-empty) set."""
    begins = np.cumsum(counts) - counts
    found = np.empty((len(counts), COORDINATES), np.uint32)
    if len(counts):
        for i in range(COORDINATES):
            lowest = np.minimum.reduceat((tokens ^ MASKS[i]) * FACTORS[i], begins)
            found[:, i] = (lowest >> np.uint64(32)).astype(np.uint32)
    return found


def posting_keys(tokens: np.ndarray, counts: np.ndarray):
    """Keys of coordinate and value, and the set each belongs to."""
    values = signatures(tokens, counts).astype(np.uint64)
    place = np.arange(COORDINATES, dtype=np.uint64) << np.uint64(32)
    owners = np.repeat(np.arange(len(counts)), COORDINATES)
    return mixed((values | place) + np.uint64(0x2545F4914F6CDD1D)).reshape(-1), owners


def signature_sketch(tokens: np.ndarray) -> bytes:
    return signatures(tokens, np.array([len(tokens)])).tobytes()


def signatures_allow(x: bytes, y: bytes) -> bool:
    return int((np.frombuffer(x, np.uint32) == np.frombuffer(y, np.uint32)).sum()) >= MATCHES


def prefixes(lists: DataFrame) -> DataFrame:
    """The shortest postings of each set, enough to meet all that match it."""
    postings = lists.groupBy("node").agg(
        F.sort_array(F.collect_list(F.struct("df", "key"))).alias("postings")
    )
    shortest = F.slice("postings", F.lit(1), F.size("postings") - (MATCHES - 1))
    return (
        postings.filter(F.size("postings") >= MATCHES)
        .select("node", F.explode(shortest).alias("p"))
        .select(F.col("p.key").alias("key"), "node", F.col("p.df").alias("df"))
    )


def occurring(lists: list[np.ndarray], least: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers in at least ``least`` of the ascending lists, and in how many."""
    lists = sorted((x for x in lists if len(x)), key=len)
    cut = len(lists) - least + 1
    if cut < 1:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    times = np.bincount(np.concatenate(lists[:cut]))
    numbers = np.flatnonzero(times)
    times = times[numbers]
    for i, longer in enumerate(lists[cut:]):
        # those that the lists left cannot bring to the threshold are skipped
        able = times + (len(lists) - cut - i) >= least
        numbers, times = numbers[able], times[able]
        if not len(numbers):
            break
        at = np.minimum(np.searchsorted(longer, numbers), len(longer) - 1)
        times = times + (longer[at] == numbers)
    return numbers[times >= least], times[times >= least]


def collision_search(sketches: list[bytes], roots: list, sides: list[int] | None):
    """Arrays ``matches, x, y``: sets of different components that match often enough.

    Sets stand by the size of their component, and each is looked up among those
    of later components: the largest one looks nothing up.
    """
    size = Counter(roots)
    order = sorted(range(len(roots)), key=lambda i: (size[roots[i]], roots[i], i))
    table = np.frombuffer(b"".join(sketches), np.uint32).reshape(-1, COORDINATES)[order]
    postings: list[np.ndarray] = []
    names = np.empty(table.shape, np.int64)
    for i in range(COORDINATES):
        by_value = np.argsort(table[:, i], kind="stable")
        for begin, run in zip(*groups_of(table[by_value, i]), strict=True):
            members = by_value[begin : begin + run]
            names[members, i] = len(postings)
            postings.append(members)
    ends, at = {}, 0
    for root, n in sorted(size.items(), key=lambda x: (x[1], x[0])):
        at += n
        ends[root] = at
    side_of = None if sides is None else np.array(sides)[order]
    found = []
    for place in range(len(order)):
        later = ends[roots[order[place]]]
        if later == len(order):
            break
        lists = [postings[name] for name in names[place].tolist()]
        lists = [x[np.searchsorted(x, later) :] for x in lists if x[-1] >= later]
        others, times = occurring(lists, MATCHES)
        if side_of is not None:
            across = side_of[others] != side_of[place]
            others, times = others[across], times[across]
        if len(others):
            found.append(np.stack([times, np.full(len(others), place), others]))
    if not found:
        return (np.empty(0, np.int64),) * 3
    times, x, y = np.concatenate(found, axis=1)
    order = np.array(order)
    return times, order[x], order[y]


def near_duplicates(
    docs: DataFrame,
    words: int = WORDS,
    threshold: tuple[int, int] = THRESHOLD,
    id_col: str = "doc_id",
    text_col: str = "text",
    block: int = BLOCK,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``, one row per row.

    Words are runs of anything but ASCII white space, A-Z lower-cased.  A text
    with fewer than ``words`` words has one shingle, one without words (or null)
    has none and links with nothing.  ``threshold (p, q)``: two documents link
    when ``q * intersection >= p * union``, counted on their full sets; ``MATCHES``
    suits thresholds from 0.8 on.  ``component_id`` is the smallest id reachable by
    links, and ``kept`` tells whether it is the document's own.  Null ids come after
    all others; a component of null ids has a null id, and its rows are kept.
    Repeated rows are in one component and have equal results.  An empty table gives
    no rows; other columns are not read.
    """
    found = shingle_components(
        docs, words, threshold, make_keys=posting_keys, keys_a_byte=COORDINATES / 1500,
        sketch=signature_sketch, may=signatures_allow, search=collision_search,
        narrow=prefixes,
        id_col=id_col, text_col=text_col, block=block, bucket_bytes=bucket_bytes,
    )
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
