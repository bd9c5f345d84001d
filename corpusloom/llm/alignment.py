"""Alignment of the tokens that two tokenizers make of one text.

Each text is tokenized by A (byte-level pairs, with a space before it) and by B
(pieces, which adds that space itself).  A token is an interval of bytes.

* Interval coalescing, for all texts of a stretch at once: the tokens of both are
  sorted by start, the running maximum of their ends is taken, and a group ends
  where a start reaches it.  Inside a group every A token is expanded to the B
  tokens that it overlaps; those that end with it are its links.
* Corpus counts: links are counted for each pair of ids, over all texts.  Pairs
  are reduced within the text, then within the task, then by key.
* Counts come back to the texts by a join on the pair.  The pairs that hold at
  least a ``1 / HOT`` share of all rows, of which there are at most ``HOT``, are
  broadcast; the rest is shuffled, and no key of it is large.

No text is shuffled: only pairs of ids and one line of numbers for each text are.
"""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import staged
from corpusloom.llm.packing import ranges

SEGMENT = 1_000_000             # bytes of text tokenized together
HOT = 100_000
SPACE = "▁"

ALIGNED = (
    "doc_id long, a_ids array<int>, b_ids array<int>, n_groups long, n_overlaps long, "
    "groups string, pairs array<long>, pair_counts array<int>"
)


def byte_alphabet() -> dict[str, int]:
    """The letters of a byte-level vocabulary: printable bytes stand for themselves,
    the others for the code points from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {chr(b): b for b in plain}
    others = sorted(set(range(256)) - set(plain))
    return letters | {chr(256 + i): b for i, b in enumerate(others)}


class Side:
    """A tokenizer: ids of texts, and the bytes of every id."""

    def __init__(self, pieces: list[bytes]):
        self.pieces = pieces
        self.sizes = np.array([len(p) for p in pieces], np.int64)
        # ids written out with each of the three marks that may follow
        self.marked = [np.array([f"{i}{m}" for i in range(len(pieces))], object) for m in ",|;"]


# Fixed value: how a byte-level vocabulary of this kind cuts a text into words.
WORDS = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
# Characters outside of these ranges may be classed differently by the tables of
# the tokenizer and of the regex library (which may be of another Unicode version);
# a text that has one goes through the tokenizer as a whole.
UNSURE = regex.compile(
    "[^\u0000-\u0557\u0590-\u088e\u0890-\u0c5b\u0ce0-\u208e\u20a0-\ua7cd\uab70-\uffff"
    "\U0001f300-\U0001faff]"
)
WORD_CHARS = 40                 # longest word that is remembered
WORD_CACHE = 500_000


class WordIds(dict):
    """Ids of words, made on first use."""

    def __init__(self, model):
        self.model = model
        names = {byte: letter for letter, byte in byte_alphabet().items()}
        self.letters = [names[b] for b in range(256)]

    def __missing__(self, word: str) -> tuple[int, ...]:
        letters = "".join([self.letters[b] for b in word.encode("utf-8")])
        ids = tuple(token.id for token in self.model.tokenize(letters))
        if len(word) <= WORD_CHARS:
            if len(self) >= WORD_CACHE:
                self.clear()
            self[word] = ids
        return ids


class ByteLevel(Side):
    def __init__(self, data: bytes):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_str(data.decode("utf-8"))
        self.tokenizer.encode_special_tokens = True
        letters = byte_alphabet()
        words = self.tokenizer.get_vocab(with_added_tokens=True)
        config = json.loads(data)
        added = {t["content"] for t in config.get("added_tokens", [])}
        pieces = [b""] * (max(words.values()) + 1)
        for word, number in words.items():
            pieces[number] = (
                word.encode("utf-8") if word in added else bytes(letters[c] for c in word)
            )
        super().__init__(pieces)
        # words can be encoded one by one, and remembered, if nothing else shapes them
        cut = config.get("pre_tokenizer") or {}
        plain = (
            config.get("normalizer") is None
            and cut.get("type") == "ByteLevel"
            and cut.get("use_regex", True)
            and not cut.get("add_prefix_space", True)
            and config["model"].get("type") == "BPE"
            and not config["model"].get("dropout")
            and all(t["special"] for t in config.get("added_tokens", []))
        )
        self.words = WordIds(self.tokenizer.model) if plain else None

    def encode(self, texts: list[str]) -> list[list[int]]:
        out: list[list[int] | None] = [None] * len(texts)
        if self.words is not None:
            ids = self.words.__getitem__
            for i, text in enumerate(texts):
                if not UNSURE.search(text):
                    out[i] = list(chain.from_iterable(map(ids, WORDS.findall(" " + text))))
        whole = [i for i, found in enumerate(out) if found is None]
        made = self.tokenizer.encode_batch_fast(
            [" " + texts[i] for i in whole], add_special_tokens=False
        )
        for i, found in zip(whole, made, strict=True):
            out[i] = found.ids
        return out


class Pieces(Side):
    def __init__(self, data: bytes):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_proto=data)
        pieces = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            byte = re.fullmatch("<0x([0-9A-Fa-f]{2})>", piece)
            pieces.append(
                bytes([int(byte[1], 16)]) if byte else piece.replace(SPACE, " ").encode("utf-8")
            )
        super().__init__(pieces)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


@lru_cache(maxsize=2)
def both_sides(a: bytes, b: bytes) -> tuple[Side, Side]:
    return ByteLevel(a), Pieces(b)


def encoded(texts: list[str | None], a: Side, b: Side):
    """Flat ids and counts of A and of B; a text whose bytes do not come back has none."""
    ids = [side.encode([t or "" for t in texts]) for side in (a, b)]
    for i, text in enumerate(texts):
        raw = b" " + (text or "").encode("utf-8")
        same = bool(text) and all(
            b"".join(map(side.pieces.__getitem__, found[i])) == raw
            for side, found in zip((a, b), ids, strict=True)
        )
        if not same:
            ids[0][i] = ids[1][i] = []
    out = []
    for found in ids:
        counts = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter(chain.from_iterable(found), np.int64, int(counts.sum()))
        out += [flat, counts]
    return out


def coalesce(a_ends: np.ndarray, b_ends: np.ndarray):
    """Groups of the A and of the B tokens, and all overlapping pairs of tokens.

    The tokens of each side follow each other without gaps.
    """
    a_starts = np.concatenate([[0], a_ends[:-1]])
    b_starts = np.concatenate([[0], b_ends[:-1]])
    starts, ends = np.concatenate([a_starts, b_starts]), np.concatenate([a_ends, b_ends])
    side = np.repeat([0, 1], [len(a_ends), len(b_ends)])
    order = np.lexsort((side, starts))
    reach = np.maximum.accumulate(ends[order])
    breaks = np.concatenate([[False], starts[order][1:] >= reach[:-1]])
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(breaks)
    first = np.searchsorted(b_ends, a_starts, side="right")
    beyond = np.searchsorted(b_starts, a_ends, side="left")
    over_a = np.repeat(np.arange(len(a_ends)), beyond - first)
    over_b = ranges(first, beyond - first)
    return group[: len(a_ends)], group[len(a_ends) :], over_a, over_b


def written(a_ids, b_ids, a_group, b_group, a: Side, b: Side):
    """Pieces of ``a1,a2|b1;a3|b2,b3``, and where each token's piece stands."""
    n = len(a_ids) + len(b_ids)
    text = np.empty(n, object)
    for ids, own, other, side, last_mark, when in (
        (a_ids, a_group, b_group, a, 1, "left"), (b_ids, b_group, a_group, b, 2, "right")
    ):
        place = np.arange(len(ids)) + np.searchsorted(other, own, side=when)
        last = np.append(own[1:] != own[:-1], True)
        text[place[~last]] = side.marked[0][ids[~last]]
        text[place[last]] = side.marked[last_mark][ids[last]]
    return text


def lists(values: np.ndarray, counts: np.ndarray, kind) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(counts)])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def align_stretch(doc_ids: pa.Array, texts: list[str | None], a: Side, b: Side) -> pa.RecordBatch:
    a_ids, a_counts, b_ids, b_counts = encoded(texts, a, b)
    n = len(texts)
    if len(a_ids):
        a_ends, b_ends = np.cumsum(a.sizes[a_ids]), np.cumsum(b.sizes[b_ids])
        a_group, b_group, over_a, over_b = coalesce(a_ends, b_ends)
        text = written(a_ids, b_ids, a_group, b_group, a, b)
        a_owner = np.repeat(np.arange(n), a_counts)
        group_owner = np.empty(a_group[-1] + 1, np.int64)
        group_owner[a_group] = a_owner
        n_groups = np.bincount(group_owner, minlength=n)
        n_overlaps = np.bincount(a_owner[over_a], minlength=n)
        linked = a_ends[over_a] == b_ends[over_b]
        pair = a_ids[over_a[linked]] * len(b.pieces) + b_ids[over_b[linked]]
        space = len(a.pieces) * len(b.pieces)
        keys, pair_counts = np.unique(a_owner[over_a[linked]] * space + pair, return_counts=True)
        pairs, n_pairs = keys % space, np.bincount(keys // space, minlength=n)
    else:
        text, pairs, pair_counts = np.empty(0, object), np.empty(0, np.int64), np.empty(0, np.int64)
        n_groups = n_overlaps = n_pairs = np.zeros(n, np.int64)
    text = text.tolist()
    ends = np.cumsum(a_counts + b_counts)
    groups = [
        "".join(text[end - size : end])[:-1]
        for end, size in zip(ends.tolist(), (a_counts + b_counts).tolist(), strict=True)
    ]
    return pa.RecordBatch.from_arrays(
        [
            doc_ids, lists(a_ids, a_counts, pa.int32()), lists(b_ids, b_counts, pa.int32()),
            pa.array(n_groups, pa.int64()), pa.array(n_overlaps, pa.int64()),
            pa.array(groups, pa.string()), lists(pairs, n_pairs, pa.int64()),
            lists(pair_counts, n_pairs, pa.int32()),
        ],
        names=["doc_id", "a_ids", "b_ids", "n_groups", "n_overlaps", "groups", "pairs", "pair_counts"],
    )


def read_bytes(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def align_tokens(
    docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Tokens of both tokenizers and their alignment, one row per row.

    ``doc_id``, ``a_ids``, ``b_ids``, ``n_groups``, ``n_overlaps`` (pairs of tokens
    that share a byte), ``groups`` (``a1,a2|b1;a3|b2,b3``), ``pairs`` (distinct
    linked ids as ``a * size of B + b``) and ``pair_counts``.  Tokens link when
    they end at the same byte.

    Strings of special tokens in a text are plain text.  A text that is null or
    empty, or whose tokens do not join to it again, has no tokens: empty arrays and
    an empty ``groups``.  Null ids stay, repeated rows stay; an empty table gives no
    rows; columns not named are not read.  The files are read on the driver and
    sent to the tasks (about 2 MB); texts are tokenized whole.
    """
    files = docs.sparkSession.sparkContext.broadcast((read_bytes(a_path), read_bytes(b_path)))

    def align(batches):
        a, b = both_sides(*files.value)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            begin = 0
            while begin < len(texts):
                stop, size = begin, 0
                while stop < len(texts) and (size < SEGMENT or stop == begin):
                    size += len(texts[stop] or "")
                    stop += 1
                ids = batch.column("doc_id").slice(begin, stop - begin)
                yield align_stretch(ids, texts[begin:stop], a, b)
                begin = stop

    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    ).mapInArrow(align, ALIGNED)


def pair_table(links: DataFrame, b_size: int) -> DataFrame:
    """``pair, docs, total, best`` of ``links (pair, n)``.

    ``total`` counts the links of the pair in the corpus; ``best`` tells whether no
    other pair with its B id has more.
    """
    totals = staged(
        links.groupBy("pair").agg(F.count("*").alias("docs"), F.sum("n").alias("total")), "pairs"
    )
    # at most one row for every id of B's vocabulary
    most = totals.groupBy((F.col("pair") % b_size).alias("b")).agg(F.max("total").alias("most"))
    return totals.join(F.broadcast(most), F.col("pair") % b_size == F.col("b")).select(
        "pair", "docs", "total", (F.col("total") == F.col("most")).alias("best")
    )


def alignment_counts(aligned: DataFrame, b_size: int) -> DataFrame:
    """``aligned (pairs, pair_counts, ...)`` with ``n_links``, ``n_best``, ``count_sum``.

    ``n_best``: links of a text whose corpus count is the highest of their B id,
    ties included; ``count_sum``: the corpus counts summed over its links.
    """
    names = [c for c in aligned.columns if c not in ("pairs", "pair_counts")]
    kept = staged(aligned.withColumn("row", F.monotonically_increasing_id()), "aligned")
    links = kept.select(
        "row", F.inline(F.arrays_zip(F.col("pairs").alias("pair"), F.col("pair_counts").alias("n")))
    )
    table = staged(pair_table(links, b_size), "pair_table")
    rows = table.agg(F.sum("docs")).first()[0] or 0
    # their shares sum to one, so there are at most HOT of them
    hot = F.col("docs") * HOT >= rows
    often = table.filter(hot).select(F.col("pair").alias("its"), "total", "best")
    rare = table.filter(~hot).select(F.col("pair").alias("its"), "total", "best")
    marked = links.join(F.broadcast(often), F.col("pair") == F.col("its"), "left")

    def sums(frame):
        return frame.groupBy("row").agg(
            F.sum("n").alias("n_links"),
            F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("n_best"),
            F.sum(F.col("n") * F.col("total")).alias("count_sum"),
        )

    near = sums(marked.filter("its is not null"))
    far = sums(
        marked.filter("its is null").select("row", "pair", "n")
        .join(rare, F.col("pair") == F.col("its"))
    )
    parts = near.unionByName(far).groupBy(F.col("row").alias("of")).agg(
        *[F.sum(c).alias(c) for c in ("n_links", "n_best", "count_sum")]
    )
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_links", "n_best", "count_sum")]
    return kept.join(parts, F.col("row") == F.col("of"), "left").select(*names, *zero)


def vocabulary_size(path: str) -> int:
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_proto=read_bytes(path)).get_piece_size()


def alignment_digest(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """``align_tokens`` reduced to numbers and a hash of the groups, with corpus counts."""
    aligned = align_tokens(docs, a_path, b_path)
    digest = aligned.select(
        "doc_id",
        F.size("a_ids").cast("long").alias("n_a"),
        F.size("b_ids").cast("long").alias("n_b"),
        "n_groups",
        "n_overlaps",
        F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256)).alias("groups_sha256"),
        "pairs",
        "pair_counts",
    )
    return alignment_counts(digest, vocabulary_size(b_path))

