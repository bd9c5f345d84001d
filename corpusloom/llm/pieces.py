"""SentencePiece encoding by sampling from the piece lattice, and decoding.

The lattice of a text has an edge for every vocabulary piece that occurs in it,
and byte pieces for every character.  Forward filtering sums the weights of all
paths that reach a place; backward sampling draws a path from the end.  The
draws are a hash of the row key, the unit and the step, so a row always gets the
same segmentation, wherever and whenever it is processed.

No piece of the vocabulary has a blank after another character, so every path
passes through the places before runs of blanks.  The lattice is therefore a
chain of independent lattices, one per unit ``blanks + non-blanks``; equal units
share their filtered weights.

The vocabulary is given as a SentencePiece model file.  A merge-rank vocabulary
has ranks and no probabilities; its pieces are weighted by Zipf's law over rank.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.packing import ranges

# Fixed value: how the model file writes a blank.
BLANK = "▁"

UNIT = re.compile(r" *[^ ]+| +")
SEED = 97
ZIPF_SHIFT = 10.0
SHARPNESS = 2.0         # exponent of the piece weights: higher, fewer and longer pieces
BYTE_WEIGHT = 1e-9      # of a byte piece before sharpening; pieces are preferred
SHORT = 48              # units up to this length are filtered together and cached
CACHE_EDGES = 2_000_000
PIECE_CHARS = 400_000

_STEP = np.uint64(0xD1342543DE82EF95)
_UNIT = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Vocabulary:
    ids: dict[str, int]          # piece with plain blanks -> id
    weights: np.ndarray          # by id
    byte_ids: np.ndarray         # id of each byte piece
    contents: list[bytes]        # what each id decodes to
    longest: int
    trie: Trie


def load_vocabulary(model_file: str, sharpness: float = SHARPNESS) -> Vocabulary:
    """Read a model file on the driver; tasks get the tables, not the path."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    size = model.get_piece_size()
    ids, contents = {}, [b""] * size
    byte_ids = np.full(256, -1, np.int64)
    scores = np.array([model.get_score(i) for i in range(size)], np.float64)
    for i in range(size):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            value = int(piece[3:5], 16)
            byte_ids[value] = i
            contents[i] = bytes([value])
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            plain = piece.replace(BLANK, " ")
            contents[i] = plain.encode("utf-8")
            if " " not in plain.lstrip(" "):
                ids[plain] = i
    if (byte_ids < 0).any():
        raise ValueError("the vocabulary has no byte pieces, so it cannot encode every text")
    rank = np.maximum(-scores, 0)
    weights = 1.0 / (rank + ZIPF_SHIFT)
    weights /= weights[list(ids.values())].sum()
    weights[byte_ids] = BYTE_WEIGHT
    return Vocabulary(
        ids, weights**sharpness, byte_ids, contents, max(map(len, ids), default=1), Trie(ids)
    )


def draws(keys: np.ndarray, units: np.ndarray, step: int) -> np.ndarray:
    """Numbers in [0, 1) that depend on row key, unit and step alone."""
    x = keys + units * _UNIT + np.uint64((step + 1) * int(_STEP) & 0xFFFFFFFFFFFFFFFF)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return (x >> np.uint64(11)).astype(np.float64) * 2.0**-53


def unit_edges(unit: str, vocabulary: Vocabulary) -> list[tuple[int, int, int]]:
    """``(end, start, id)`` of one lattice, the plain way; id -1 is one character in bytes."""
    ids, size, edges = vocabulary.ids, len(unit), []
    for start in range(size):
        edges.append((start + 1, start, -1))
        for end in range(start + 1, min(size, start + vocabulary.longest) + 1):
            found = ids.get(unit[start:end])
            if found is not None:
                edges.append((end, start, found))
    return edges


class Trie:
    """The pieces as a trie in one open hash table, walked for many places at once."""

    def __init__(self, ids: dict[str, int]):
        children, piece_at = {}, [-1]
        for piece, number in ids.items():
            node = 0
            for letter in piece:
                key = node << 21 | ord(letter)
                node = children.setdefault(key, len(piece_at))
                if node == len(piece_at):
                    piece_at.append(-1)
            piece_at[node] = number
        self.piece_at = np.array(piece_at, np.int32)
        self.bits = max(4, (4 * len(children)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.child = np.zeros(1 << self.bits, np.int32)
        keys = np.fromiter(children.keys(), np.int64, len(children))
        nodes = np.fromiter(children.values(), np.int32, len(children))
        for key, slot, node in zip(
            keys.tolist(), self.slots(keys).tolist(), nodes.tolist(), strict=True
        ):
            while self.keys[slot] >= 0:
                slot = (slot + 1) & ((1 << self.bits) - 1)
            self.keys[slot], self.child[slot] = key, node

    def slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * _STEP) >> np.uint64(64 - self.bits)).astype(np.int64)

    def step(self, nodes: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The child of each node by a character, 0 where there is none."""
        keys = nodes.astype(np.int64) << 21 | codes
        slot = self.slots(keys)
        held = self.keys[slot]
        out = np.where(held == keys, self.child[slot], 0)
        open_ = np.flatnonzero((held != keys) & (held >= 0))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & ((1 << self.bits) - 1)
            held = self.keys[slot[open_]]
            same = held == keys[open_]
            out[open_[same]] = self.child[slot[open_[same]]]
            open_ = open_[~same & (held >= 0)]
        return out


def piece_edges(codes: np.ndarray, stop: np.ndarray, trie: Trie):
    """``starts, ids`` of the pieces of each length, from 1 on, in the joined units.

    ``stop``: where the unit of each character ends; no piece goes beyond it.
    """
    found = []
    starts, nodes = np.arange(len(codes)), np.zeros(len(codes), np.int32)
    length = 0
    while len(starts):
        nodes = trie.step(nodes, codes[starts + length])
        starts, nodes = starts[nodes > 0], nodes[nodes > 0]
        length += 1
        ids = trie.piece_at[nodes]
        found.append((starts[ids >= 0], ids[ids >= 0]))
        inside = starts + length < stop[starts]
        starts, nodes = starts[inside], nodes[inside]
    return found


class Lattices:
    """Filtered lattices of the units seen by a task, in one set of flat arrays."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.logs = np.log(vocabulary.weights)
        self.clear()

    def clear(self):
        self.node_of: dict[str, int] = {}       # unit -> its last node
        self.edge_from = np.zeros(1, np.int64)  # by node: first edge that ends there
        self.cut = np.empty(0)                  # by edge: cumulated probability at its node
        self.start = np.empty(0, np.int32)      # by edge: node it starts from
        self.piece = np.empty(0, np.int32)      # by edge: id, or -1 - code point

    def add(self, units: list[str]) -> None:
        """Forward filtering of new units, all together, place by place.

        Edges are laid out by the node they end in, longest first; every sum is taken
        within a node, so a unit's numbers do not depend on its company.
        """
        sizes = np.array([len(u) for u in units])
        codes = np.frombuffer("".join(units).encode("utf-32-le"), np.uint32).astype(np.int64)
        owner = np.repeat(np.arange(len(units)), sizes)
        found = piece_edges(codes, np.cumsum(sizes)[owner], self.vocabulary.trie)
        # a unit has a node before its first character and one after each character
        node_at = np.arange(len(codes)) + owner
        counts = np.zeros(len(codes) + len(units), np.int64)
        counts[node_at + 1] = 1
        for length, (starts, _) in enumerate(found, 1):
            counts[node_at[starts] + length] += 1
        first = np.cumsum(counts) - counts
        start, piece = (np.empty(int(counts.sum()), np.int32) for _ in range(2))
        free = first.copy()

        def place_edges(starts, length, ids):
            ends = node_at[starts] + length
            at = free[ends]
            start[at], piece[at] = node_at[starts], ids
            free[ends] = at + 1

        for length in range(len(found), 1, -1):
            place_edges(found[length - 1][0], length, found[length - 1][1])
        place_edges(np.arange(len(codes)), 1, -1 - codes)
        if found:
            place_edges(found[0][0], 1, found[0][1])

        logs = self.logs
        points = -1 - piece
        n_bytes = 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF)
        weight = np.where(
            piece >= 0, logs[np.maximum(piece, 0)], n_bytes * logs[self.vocabulary.byte_ids[0]]
        )
        base = np.cumsum(sizes + 1) - (sizes + 1)
        by_size = np.argsort(-sizes, kind="stable")
        at_least = np.searchsorted(-sizes[by_size], -np.arange(sizes.max() + 1), side="right")
        alpha = np.zeros(len(counts))                # logarithms, as in long units
        share = np.empty(len(start))                 # of an edge at the node it ends in
        for place in range(1, sizes.max() + 1):
            nodes = base[by_size[: at_least[place]]] + place
            widths = counts[nodes]
            here = ranges(first[nodes], widths)
            flow = alpha[start[here]] + weight[here]
            groups = np.cumsum(widths) - widths
            top = np.maximum.reduceat(flow, groups)
            part = np.exp(flow - np.repeat(top, widths))
            total = np.add.reduceat(part, groups)
            alpha[nodes] = top + np.log(total)
            share[here] = part / np.repeat(total, widths)
        nodes = np.flatnonzero(counts > 1)
        for place in range(1, int(counts.max())):
            nodes = nodes[counts[nodes] > place]
            share[first[nodes] + place] += share[first[nodes] + place - 1]
        first_node, first_edge = len(self.edge_from) - 1, len(self.cut)
        self.cut = np.concatenate([self.cut, share])
        self.start = np.concatenate([self.start, start + np.int32(first_node)])
        self.piece = np.concatenate([self.piece, piece])
        self.edge_from = np.concatenate(
            [self.edge_from[:-1], first + first_edge, [first_edge + len(share)]]
        )
        self.node_of.update(zip(units, (base + sizes + first_node).tolist(), strict=True))

    def sample(self, units: list[str], keys: np.ndarray, numbers: np.ndarray):
        """Ids of all units in order, and how many each unit has.

        ``keys`` and ``numbers`` (uint64): row key and place in the row of each unit.
        """
        new = [u for u in set(units).difference(self.node_of) if len(u) <= SHORT]
        if new:
            if len(self.cut) > CACHE_EDGES:
                self.clear()
                new = [u for u in set(units) if len(u) <= SHORT]
            new.sort()
            self.add(new)
        node_of = self.node_of
        node = np.fromiter((node_of.get(u, -1) for u in units), np.int64, len(units))
        long_ones = np.flatnonzero(node < 0)
        active = np.flatnonzero(node >= 0)
        node = node[active]
        taken, step = [], 0
        while len(active):
            edge = self.edge_from[node]
            last = self.edge_from[node + 1] - 1
            u = draws(keys[active], numbers[active], step)
            open_ = np.flatnonzero((self.cut[edge] <= u) & (edge < last))
            while len(open_):
                edge[open_] += 1
                more = (self.cut[edge[open_]] <= u[open_]) & (edge[open_] < last[open_])
                open_ = open_[more]
            taken.append((active, self.piece[edge]))
            node = self.start[edge]
            # a unit's first node has no incoming edge
            going = self.edge_from[node + 1] > self.edge_from[node]
            active, node = active[going], node[going]
            step += 1
        return self.collect(units, keys, numbers, taken, long_ones)

    def collect(self, units, keys, numbers, taken, long_ones):
        byte_ids = self.vocabulary.byte_ids
        owner = np.concatenate([t[0] for t in taken] or [np.empty(0, np.int64)])
        piece = np.concatenate([t[1] for t in taken] or [np.empty(0, np.int64)])
        steps = np.concatenate(
            [np.full(len(t[0]), s) for s, t in enumerate(taken)] or [np.empty(0, np.int64)]
        )
        order = np.lexsort((-steps, owner))
        owner, piece = owner[order], piece[order]
        if len(long_ones):
            longer = [
                sample_long(units[i], self.vocabulary, keys[i], numbers[i]) for i in long_ones
            ]
            owner = np.concatenate([owner, np.repeat(long_ones, [len(x) for x in longer])])
            piece = np.concatenate([piece, *longer])
            order = np.argsort(owner, kind="stable")
            owner, piece = owner[order], piece[order]
        in_bytes = piece < 0
        if in_bytes.any():
            points = -1 - piece[in_bytes]
            raw = [chr(p).encode("utf-8") for p in points.tolist()]
            repeats = np.ones(len(piece), np.int64)
            repeats[in_bytes] = [len(r) for r in raw]
            owner, piece = np.repeat(owner, repeats), np.repeat(piece, repeats)
            piece[piece < 0] = byte_ids[np.frombuffer(b"".join(raw), np.uint8)]
        return piece, np.bincount(owner, minlength=len(units))


def sample_long(unit: str, vocabulary: Vocabulary, key, number) -> np.ndarray:
    """A path of one long unit: filtering with rescaling, place by place."""
    ids, weights, longest = vocabulary.ids, vocabulary.weights, vocabulary.longest
    one_byte = float(weights[vocabulary.byte_ids[0]])
    size = len(unit)
    alpha, shift = [1.0], [0.0]     # alpha[i] * exp(shift[i]) is the sum over paths to i
    incoming = []
    for end in range(1, size + 1):
        edges = [(end - 1, -1 - ord(unit[end - 1]), one_byte ** len(unit[end - 1].encode()))]
        for start in range(max(0, end - longest), end):
            found = ids.get(unit[start:end])
            if found is not None:
                edges.append((start, found, float(weights[found])))
        top = max(shift[e[0]] for e in edges)
        flow = [alpha[s] * np.exp(shift[s] - top) * w for s, _, w in edges]
        total = sum(flow)
        incoming.append((edges, flow, total))
        alpha.append(1.0)
        shift.append(top + float(np.log(total)))
    path, place, step = [], size, 0
    keys, numbers = np.array([key], np.uint64), np.array([number], np.uint64)
    while place:
        edges, flow, total = incoming[place - 1]
        left = float(draws(keys, numbers, step)[0]) * total
        for (start, piece, _), part in zip(edges, flow, strict=True):
            left -= part
            if left < 0:
                break
        path.append(piece)
        place = start
        step += 1
    return np.array(path[::-1], np.int64)


def encode_pieces(
    docs: DataFrame,
    vocabulary: Vocabulary,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: int = SEED,
    check: bool = False,
) -> DataFrame:
    """``doc_id, piece_ids``: one sampled segmentation of every whole text.

    The row key is the id; equal ids with equal texts get equal pieces, and so do
    reruns.  Null text: null.  Empty text: no piece.  A null id is a key like any
    other; an empty table gives no rows; other columns are not read.
    ``check`` decodes again and adds whether the text came back, ``lossless``.
    """
    source = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(text_col).cast("string").alias("text"),
        F.xxhash64(F.lit(seed), F.col(id_col)).alias("_key"),
    )

    def encode(batches):
        lattices = Lattices(vocabulary)
        for batch in batches:
            column, keys = batch.column("text"), batch.column("_key").to_numpy().view(np.uint64)
            begin = 0
            while begin < len(column):
                texts, size = [], 0
                while begin + len(texts) < len(column) and (size < PIECE_CHARS or not texts):
                    texts.append(column[begin + len(texts)].as_py())
                    size += len(texts[-1] or "")
                split = [UNIT.findall(t) if t else [] for t in texts]
                counts = np.array([len(s) for s in split])
                units = [u for s in split for u in s]
                number = np.arange(len(units)) - np.repeat(np.cumsum(counts) - counts, counts)
                ids, per_unit = lattices.sample(
                    units, np.repeat(keys[begin : begin + len(texts)], counts),
                    number.astype(np.uint64),
                )
                edges = np.concatenate([[0], np.cumsum(per_unit)])
                edges = edges[np.concatenate([[0], np.cumsum(counts)])].astype(np.int32)
                missing = np.array([t is None for t in texts] + [False])
                found = [
                    batch.column("doc_id").slice(begin, len(texts)),
                    pa.ListArray.from_arrays(
                        pa.array(edges, mask=missing), pa.array(ids.astype(np.int32))
                    ),
                ]
                if check:
                    same = [
                        t is None or decode_ids(ids[x:y].tolist(), vocabulary.contents) == t
                        for t, x, y in zip(texts, edges[:-1].tolist(), edges[1:].tolist(), strict=True)
                    ]
                    found.append(pa.array(same, pa.bool_()))
                yield pa.RecordBatch.from_arrays(found, names=names)
                begin += len(texts)

    kind = source.schema["doc_id"].dataType.simpleString()
    columns = f"doc_id {kind}, piece_ids array<int>" + ", lossless boolean" * check
    names = ["doc_id", "piece_ids", "lossless"][: 2 + check]
    return source.mapInArrow(encode, columns)


def decode_ids(ids, contents: list[bytes]) -> str:
    return b"".join(map(contents.__getitem__, ids)).decode("utf-8")


def decode_pieces(encoded: DataFrame, vocabulary: Vocabulary, keep=("doc_id",)) -> DataFrame:
    """``*keep, text``: the texts the pieces were made from, byte by byte.

    Null pieces: null.  Ids outside the vocabulary raise IndexError, bytes that
    are no UTF-8 a UnicodeDecodeError.
    """
    source = encoded.select(*dict.fromkeys([*keep, "piece_ids"]))
    contents = vocabulary.contents

    def decode(batches):
        for batch in batches:
            texts = [
                None if ids is None else decode_ids(ids.values.to_pylist(), contents)
                for ids in batch.column("piece_ids")
            ]
            arrays = [batch.column(c) for c in keep] + [pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*keep, "text"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in source.schema if f.name in keep)
    return source.mapInArrow(decode, f"{kinds}, text string")


def encode_and_check(docs: DataFrame, vocabulary: Vocabulary, **options) -> DataFrame:
    """``doc_id, piece_ids, n_pieces, lossless``: encoded, decoded again and compared."""
    encoded = encode_pieces(docs, vocabulary, check=True, **options)
    count = F.when(F.col("piece_ids").isNull(), F.lit(0)).otherwise(F.size("piece_ids"))
    return encoded.select(
        "doc_id", "piece_ids", count.cast("long").alias("n_pieces"), "lossless"
    )
