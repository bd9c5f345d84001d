"""N-gram Jaccard join with signature trees.

Documents are sets of hashed word shingles; two link when their Jaccard
similarity reaches the threshold.  The result is each document's component.

1. Keys.  The sets of a size level are dealt into m parts by token hash.  A pair
   that links differs in at most D tokens, so at least m - D parts agree; each set
   sends its D + 1 heaviest parts as keys, and two such sets must share one
   (prefix filtering on parts).  No link is lost.
2. Comparisons.  Sets that share keys are united only by comparing their tokens
   (``meeting``).
3. Signature trees.  The members of a key's list that are not yet one component
   stand in a tree whose nodes hold the OR of their token bitmaps, a range of sizes
   and the largest number of tokens their bitmaps hide.  A dual traversal drops
   node pairs that cannot reach the threshold, and those of one component; the
   pairs of sets that are left are compared token by token.

Equal sets are one set throughout, so copies cost one row per task.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import flagged, staged
from corpusloom.llm.meeting import BLOCK, BUCKET_BYTES, bitmap_of, folded, shingle_components
from corpusloom.llm.packing import LAST, mixed, ranges

WORDS = 3
THRESHOLD = (90, 100)
LEVEL_RATIO = 1.4
LEAF = 8
FANOUT = 8
PROPOSED = np.dtype([("overlap", float), ("x", np.int32), ("y", np.int32)])


def size_levels(limit: int) -> np.ndarray:
    """First sizes of the levels, up to one that begins beyond ``limit``."""
    levels = [1]
    while levels[-1] <= limit:
        levels.append(max(levels[-1] + 1, int(np.ceil(levels[-1] * LEVEL_RATIO))))
    return np.array(levels)


def route_keys(tokens, counts, threshold) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all sets and the set each belongs to."""
    num, den = threshold
    if not len(tokens):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    levels = size_levels(int(counts.max()) * den // num + 2)
    own = np.searchsorted(levels, counts, side="right") - 1
    top = np.searchsorted(levels, counts * den // num, side="right") - 1
    begins = np.cumsum(counts) - counts
    keys, owners = [], []
    for ahead in range(int((top - own)[counts > 0].max()) + 1):
        # sets that meet sets of the level so far above their own
        some = np.flatnonzero((counts > 0) & (own + ahead <= top))
        level = own[some] + ahead
        differ = (den - num) * (levels[level + 1] - 1) // num
        parts = differ + 1 + differ // 8
        size = counts[some]
        mine = tokens[ranges(begins[some], size)]
        base = np.cumsum(parts) - parts
        spread = mixed(mine + np.uint64(0x51ED270B9F65E1D3)) >> np.uint64(32)
        part = ((spread * np.repeat(parts, size).astype(np.uint64)) >> np.uint64(32)).astype(np.int64)
        flat = part + np.repeat(base, size)
        total = int(parts.sum())
        weight = np.bincount(flat, minlength=total)
        low = np.bincount(flat, (mine & np.uint64(0xFFFFFFFF)).astype(float), total)
        high = np.bincount(flat, (mine >> np.uint64(32)).astype(float), total)
        whose = np.repeat(np.arange(len(some)), parts)
        place = np.arange(total) - base[whose] + (level[whose].astype(np.int64) << 32)
        key = mixed(
            mixed(low.astype(np.uint64)) + mixed(high.astype(np.uint64) + mixed(place.astype(np.uint64)))
        )
        order = np.lexsort((key, -weight, whose))
        rank = np.arange(total) - base[whose]
        chosen = order[rank <= differ[whose]]
        keys.append(key[chosen])
        owners.append(some[whose[chosen]])
    return np.concatenate(keys), np.concatenate(owners)


def bitmap_sketch(tokens: np.ndarray) -> bytes:
    """The set's size and a bitmap of its tokens, at least two bits a token."""
    bits, width = bitmap_of(tokens, 2)
    return len(tokens).to_bytes(8, "little") + bits.to_bytes(width // 8, "little")


class Node:
    """A node of a signature tree: what its sets have at most."""

    __slots__ = ("bits", "low", "high", "hidden", "children", "sets", "root")

    def __init__(self, children, sets, bits, low, high, hidden):
        self.children, self.sets, self.bits = children, sets, bits
        self.low, self.high, self.hidden = low, high, hidden
        self.root = None                # the component, if all sets are of one


class SignatureTree:
    """Signature trees over sketches, and their dual traversal."""

    def __init__(self, sketches: list[bytes], roots: list, threshold: tuple[int, int]):
        self.roots, self.threshold = roots, threshold
        self.sizes = [int.from_bytes(s[:8], "little") for s in sketches]
        narrow = min((8 * (len(s) - 8) for s in sketches), default=64)
        self.bits = [
            folded(int.from_bytes(s[8:], "little"), 8 * (len(s) - 8), narrow) for s in sketches
        ]
        self.hidden = [n - b.bit_count() for n, b in zip(self.sizes, self.bits, strict=True)]

    def tree(self, members: list[int]) -> Node:
        """Sets in the order of component and size, so that nodes have short ranges."""
        members = sorted(members, key=lambda i: (self.roots[i], self.sizes[i], i))
        nodes = [self.leaf(members[i : i + LEAF]) for i in range(0, len(members), LEAF)]
        while len(nodes) > 1:
            nodes = [self.inner(nodes[i : i + FANOUT]) for i in range(0, len(nodes), FANOUT)]
        return nodes[0]

    def leaf(self, members: list[int]) -> Node:
        bits = 0
        for i in members:
            bits |= self.bits[i]
        sizes = [self.sizes[i] for i in members]
        node = Node([], members, bits, min(sizes), max(sizes), max(self.hidden[i] for i in members))
        roots = {self.roots[i] for i in members}
        node.root = roots.pop() if len(roots) == 1 else None
        return node

    def inner(self, children: list[Node]) -> Node:
        bits = 0
        for c in children:
            bits |= c.bits
        node = Node(
            children, [], bits, min(c.low for c in children), max(c.high for c in children),
            max(c.hidden for c in children),
        )
        roots = {c.root for c in children}
        node.root = roots.pop() if len(roots) == 1 else None
        return node

    def possible(self, a: Node, b: Node) -> bool:
        """Whether any set under ``a`` may link with any under ``b``."""
        num, den = self.threshold
        if den * a.high < num * b.low or den * b.high < num * a.low:
            return False
        shared = (a.bits & b.bits).bit_count()
        most = min(a.hidden + shared, b.hidden + shared, a.high, b.high)
        return (num + den) * most >= num * (a.low + b.low)

    def traverse(self, left: Node, right: Node):
        """Pairs of sets of different components that may link."""
        stack = [(left, right)]
        while stack:
            a, b = stack.pop()
            if (a.root is not None and a.root == b.root) or not self.possible(a, b):
                continue
            if not a.children and not b.children:
                yield from self.pairs(a, b)
            elif a is b:
                c = a.children
                stack += [(c[i], c[j]) for i in range(len(c)) for j in range(i, len(c))]
            elif a.children and (not b.children or a.high - a.low >= b.high - b.low):
                stack += [(c, b) for c in a.children]
            else:
                stack += [(a, c) for c in b.children]

    def pairs(self, a: Node, b: Node):
        num, den = self.threshold
        for x, i in enumerate(a.sets):
            for j in a.sets[x + 1 :] if a is b else b.sets:
                if self.roots[i] == self.roots[j]:
                    continue
                shared = (self.bits[i] & self.bits[j]).bit_count()
                most = min(
                    shared + min(self.hidden[i], self.hidden[j]), self.sizes[i], self.sizes[j]
                )
                total = self.sizes[i] + self.sizes[j]
                if (num + den) * most >= num * total:
                    yield most / total, i, j


def bitmaps_allow(threshold: tuple[int, int]):
    """Whether two sketches leave a link possible."""
    search = tree_search(threshold)
    return lambda x, y: len(search([x, y], [0, 1], None)[0]) > 0


def tree_search(threshold: tuple[int, int]):
    """The search of a list's sketches: arrays ``overlap, x, y`` of pairs that may link."""

    def search(sketches: list[bytes], roots: list, sides: list[int] | None):
        work = SignatureTree(sketches, roots, threshold)
        if sides is not None:
            left, right = ([i for i, s in enumerate(sides) if s == x] for x in (0, 1))
        else:
            left, right = list(range(len(roots))), []
        found = []
        if left:
            tree = work.tree(left)
            if sides is None:
                found.append(work.traverse(tree, tree))
            if right:
                found.append(work.traverse(tree, work.tree(right)))
        # straight into an array: a list of near copies may propose millions of pairs
        pairs = np.fromiter(chain.from_iterable(found), PROPOSED)
        return pairs["overlap"], pairs["x"], pairs["y"]

    return search


def link_components(
    docs: DataFrame,
    words: int = WORDS,
    threshold: tuple[int, int] = THRESHOLD,
    id_col: str = "doc_id",
    text_col: str = "text",
    block: int = BLOCK,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """``doc_id, n_shingles, component_id``, one row per row.

    Words are runs of anything but ASCII white space, A-Z lower-cased.  A text
    with fewer than ``words`` words has one shingle, one without words (or null)
    has none and links with nothing.  ``threshold (p, q)``: two documents link
    when ``q * intersection >= p * union``.  ``component_id`` is the smallest id
    reachable by links.  Null ids come after all others; a component of null ids
    has a null id.  Repeated rows are in one component.  An empty table gives no
    rows; other columns are not read.
    """
    num, den = threshold
    return shingle_components(
        docs, words, threshold,
        make_keys=lambda tokens, counts: route_keys(tokens, counts, threshold),
        keys_a_byte=0.4 * (den - num) / num,
        sketch=bitmap_sketch, may=bitmaps_allow(threshold), search=tree_search(threshold),
        id_col=id_col, text_col=text_col, block=block, bucket_bytes=bucket_bytes,
    )


def keep_one(docs: DataFrame, words: int, threshold: tuple[int, int]) -> DataFrame:
    """``docs (doc_id, text, ...)`` with one document of each component: the smallest id.

    Documents without words are in no group and stay, as do those with a null id
    in groups of null ids only; of rows equal in id and text one stays.  Other
    columns pass through, whatever their names; an empty table stays empty.
    """
    linked = link_components(docs, words, threshold)
    ident = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST))
    kept = staged(
        linked.filter(F.col("doc_id").eqNullSafe(F.col("component_id")) | (F.col("n_shingles") == 0))
        .groupBy(ident.alias("kept_id")).agg((F.count("*") > 1).alias("repeated")),
        "kept",
    )
    rows = docs.select(
        ident.alias("id"), F.xxhash64("text").alias("content"), F.struct("*").alias("document")
    )
    chosen = flagged(rows, kept, "id", "kept_id", "repeated", "id")
    # only rows with a repeated id need to meet
    once = chosen.filter("not repeated").select("document")
    repeated = chosen.filter("repeated").dropDuplicates(["id", "content"]).select("document")
    return once.unionByName(repeated).select("document.*")
