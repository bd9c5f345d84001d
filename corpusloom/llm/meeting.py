"""Links between sets of word shingles, found through keys that sets share.

An operator names the keys of a set, what a set looks like in short (its sketch),
and how a list of sketches is searched; this module does the rest:

1. One pass over the texts sends the keys, packed in buckets; a key that only one
   set has goes no further.  Sets are told apart by 128-bit digests, and equal
   sets are one set throughout.  As most keys go no further, they travel short: 40
   bits of a key, beside its bucket (keys taken for one only make a list longer),
   and half of the digest, which a join completes for the keys that sets share.
2. A list holds the sets of one key.  Each set is compared with the first set of
   those lists in which it meets that set most often: by sketches, and if these do
   not rule a link out, token by token.  This unites most groups of near copies for
   one comparison a set.
3. Lists whose members are one component are done, and of lists with the same
   members one is kept.  Lists of the same sets go to one task, with one sketch of
   each.  There the operator's search tells which members may link across
   components.  Only their token sets are loaded, and their pairs compared in the
   order of their likeliness; a pair that links before have united is skipped.  No
   pair leaves the task but those that unite.

Only compared pairs are links.  A list is searched whole by one task up to ``BLOCK``
members or ``SLOT_BYTES`` of token sets; longer ones are dealt into blocks that meet
pair by pair.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import (
    discard,
    flagged,
    giving_back,
    group_giving_back,
    left_lookup,
    share_join,
    staged,
    text_slices,
)
from corpusloom.llm.components import connected_components
from corpusloom.llm.packing import LAST, groups_of, mixed

SEGMENT = 500_000               # bytes of text whose sets are made together
BUCKET_KEYS = 400_000
BUCKET_BYTES = 128_000_000      # of keys in a bucket; more only if one key is very frequent
FLUSH_KEYS = 1_000_000
BLOCK = 4096                    # members of a list that one task searches
SLOT_BYTES = 32_000_000         # token sets of the lists that one task searches
SLOT_ROWS = 2000                # members of lists for each slot
WIDE = 32                       # bits a token, of the bitmaps that spare comparisons
PAIR_BYTES = 64_000_000         # bitmaps of the pairs that are judged at once
GROUP_BYTES = 16_000_000        # token sets that one comparison task holds
SPREAD = 0x2545F4914F6CDD1D     # odd
OTHER = np.uint64(0x9FB21C651E98DF25)


class Powers:
    """Powers of an odd number modulo 2**64 and their inverses."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, size: int):
        if len(self.up) < size:
            size = max(size, 2 * len(self.up))
            back = pow(SPREAD, -1, 1 << 64)
            for name, base in (("up", SPREAD), ("down", back)):
                factors = np.full(size, base, np.uint64)
                factors[0] = 1
                setattr(self, name, np.multiply.accumulate(factors))
        return self.up, self.down


POWERS = Powers()


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of lower-cased bytes, and where it begins."""
    codes = np.frombuffer(data, np.uint8)
    space = (codes == 32) | ((codes >= 9) & (codes <= 13))
    edges = np.flatnonzero(np.diff(np.concatenate([[True], space, [True]]).astype(np.int8)))
    begins, ends = edges[::2], edges[1::2]
    up, down = POWERS.upto(len(codes) + 1)
    sums = np.concatenate(
        [[np.uint64(0)], np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * up[: len(codes)])]
    )
    raw = (sums[ends] - sums[begins]) * down[begins]
    return mixed(raw + mixed((ends - begins).astype(np.uint64))), begins


def token_sets(texts: list[str | None], words: int):
    """``tokens, counts``: the sorted distinct shingle hashes of each text in a row."""
    raws = [(t or "").encode("utf-8").lower() for t in texts]
    hashes, owner, at = [], [], 0
    while at < len(raws):
        stop, size = at, 0
        while stop < len(raws) and (size < SEGMENT or stop == at):
            size += len(raws[stop]) + 1
            stop += 1
        found, begins = word_hashes(b"\n".join(raws[at:stop]))
        limits = np.cumsum([len(r) + 1 for r in raws[at:stop]])
        hashes.append(found)
        owner.append(at + np.searchsorted(limits, begins, side="right"))
        at = stop
    if not hashes:
        return np.empty(0, np.uint64), np.zeros(len(texts), np.int64)
    hashes, owner = np.concatenate(hashes), np.concatenate(owner)
    counts = np.bincount(owner, minlength=len(texts))
    chained = np.full(max(len(hashes) - words + 1, 0), words, np.uint64)
    for k in range(words):
        chained = mixed(chained * np.uint64(SPREAD) + hashes[k : k + len(chained)])
    whole = owner[: len(chained)] == owner[words - 1 :]
    tokens, whose = chained[whole], owner[: len(chained)][whole]
    short = np.flatnonzero((counts > 0) & (counts < words))
    if len(short):
        begins = (np.cumsum(counts) - counts)[short]
        chain = counts[short].astype(np.uint64)
        for k in range(words - 1):
            more = counts[short] > k
            chain[more] = mixed(chain[more] * np.uint64(SPREAD) + hashes[begins[more] + k])
        tokens, whose = np.concatenate([tokens, chain]), np.concatenate([whose, short])
    order = np.lexsort((tokens, whose))
    tokens, whose = tokens[order], whose[order]
    new = np.ones(len(tokens), bool)
    new[1:] = (tokens[1:] != tokens[:-1]) | (whose[1:] != whose[:-1])
    tokens, whose = tokens[new], whose[new]
    return tokens, np.bincount(whose, minlength=len(texts))


def set_ids(tokens: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Two 64-bit numbers for each set, in a row; empty sets have zeros."""
    ids = np.zeros((len(counts), 2), np.uint64)
    some = counts > 0
    if some.any():
        begins = (np.cumsum(counts) - counts)[some]
        size = mixed(counts[some].astype(np.uint64))
        ids[some, 0] = mixed(np.add.reduceat(mixed(tokens), begins) + size)
        ids[some, 1] = mixed(np.add.reduceat(mixed(tokens ^ OTHER), begins) ^ size)
    return ids


def id_column(ids: np.ndarray, null: np.ndarray | None = None) -> pa.Array:
    """A binary column of 16-byte ids."""
    offsets = pa.array(np.arange(len(ids) + 1, dtype=np.int32) * 16).buffers()[1]
    data = pa.py_buffer(np.ascontiguousarray(ids).tobytes())
    column = pa.Array.from_buffers(pa.binary(), len(ids), [None, offsets, data])
    if null is None:
        return column
    return pc.if_else(pa.array(null), pa.scalar(None, pa.binary()), column)


KEY_BYTES = 5


def short_keys(keys: np.ndarray) -> bytes:
    """The lowest bytes of keys; the bucket stands for the others."""
    return np.ascontiguousarray(keys).view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES].tobytes()


def long_keys(data: bytes, bucket: int) -> np.ndarray:
    """Numbers that are equal for equal keys, and different in different buckets."""
    raw = np.frombuffer(data, np.uint8).reshape(-1, KEY_BYTES)
    keys = np.zeros((len(raw), 8), np.uint8)
    keys[:, :KEY_BYTES] = raw
    return keys.view(np.uint64)[:, 0] | np.uint64(bucket << 8 * KEY_BYTES)


def short_counts(counts: np.ndarray) -> bytes:
    """Counts in as few bytes each as the largest needs."""
    return counts.astype(np.min_scalar_type(int(counts.max()))).tobytes()


def long_counts(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, f"u{len(data) // n}").astype(np.int64)


def half_column(halves: np.ndarray) -> pa.Array:
    """A binary column of the first 8 bytes of ids."""
    offsets = pa.array(np.arange(len(halves) + 1, dtype=np.int32) * 8).buffers()[1]
    data = pa.py_buffer(np.ascontiguousarray(halves).tobytes())
    return pa.Array.from_buffers(pa.binary(), len(halves), [None, offsets, data])


SCANNED = "doc_id long, n long, node binary, bucket int, keys binary, counts binary, nodes binary"
SCAN_SCHEMA = pa.schema([
    ("doc_id", pa.int64()), ("n", pa.int64()), ("node", pa.binary()), ("bucket", pa.int32()),
    ("keys", pa.binary()), ("counts", pa.binary()), ("nodes", pa.binary()),
])


def scan_sets(docs: DataFrame, words: int, make_keys: Callable, buckets: int) -> DataFrame:
    """A row ``doc_id, n, node`` for each document, and rows of packed keys.

    ``make_keys(tokens, counts)`` returns keys and the number of the set each
    belongs to.  A set that a task has seen sends its keys once.
    """

    def packed(held):
        keys = np.concatenate([h[0] for h in held])
        whose = np.concatenate(
            [h[1] + base for h, base in zip(held, np.cumsum([0] + [len(h[2]) for h in held]), strict=False)]
        )
        ids = np.concatenate([h[2] for h in held])
        bucket = ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
        order = np.lexsort((whose, bucket))
        keys, whose, bucket = keys[order], whose[order], bucket[order]
        rows = []
        for begin, size in zip(*groups_of(bucket), strict=True):
            here = slice(begin, begin + size)
            firsts, counts = groups_of(whose[here])
            rows.append((
                None, None, None, int(bucket[begin]), short_keys(keys[here]),
                short_counts(counts), ids[whose[here][firsts], 0].tobytes(),
            ))
        return pa.Table.from_arrays(
            [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(SCAN_SCHEMA)],
            schema=SCAN_SCHEMA,
        ).to_batches()

    def scan(batches):
        seen, held, total = set(), [], 0
        for batch in batches:
            doc_ids = batch.column("doc_id")
            for here in text_slices(batch.column("text"), SEGMENT):
                tokens, counts = token_sets(batch.column("text")[here].to_pylist(), words)
                ids = set_ids(tokens, counts)
                yield pa.RecordBatch.from_arrays(
                    [doc_ids.slice(here.start, len(counts)), pa.array(counts), id_column(ids, counts == 0)]
                    + [pa.nulls(len(counts), f.type) for f in list(SCAN_SCHEMA)[3:]],
                    schema=SCAN_SCHEMA,
                )
                new = np.array(
                    [c > 0 and x not in seen and not seen.add(x)
                     for c, x in zip(counts.tolist(), map(bytes, ids), strict=True)], bool
                )
                keys, owner = make_keys(tokens[np.repeat(new, counts)], counts[new])
                held.append((keys, owner, ids[new]))
                total += len(keys)
                if total > FLUSH_KEYS:
                    yield from packed(held)
                    held, total, seen = [], 0, set()
        if total:
            yield from packed(held)

    return docs.select("doc_id", "text").mapInArrow(giving_back(scan), SCANNED)


def unpacked(table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys, the number of the set of each, and the halves of the ids of the sets."""
    keys, whose, halves, base = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], [], 0
    columns = [table.column(name).to_pylist() for name in ("bucket", "keys", "counts", "nodes")]
    for bucket, packed, counts, nodes in zip(*columns, strict=True):
        here = np.frombuffer(nodes, np.uint64)
        keys.append(long_keys(packed, bucket))
        whose.append(np.repeat(np.arange(base, base + len(here)), long_counts(counts, len(here))))
        halves.append(here)
        base += len(here)
    return np.concatenate(keys), np.concatenate(whose), np.concatenate([np.empty(0, np.uint64), *halves])


def key_lists(scanned: DataFrame, bucket_bytes: int) -> DataFrame:
    """``key, node, df``: the sets of every key that at least two have."""
    packed = scanned.filter("bucket is not null").select("bucket", "keys", "counts", "nodes")
    held = F.octet_length("keys") * F.lit(8 / KEY_BYTES) + F.octet_length("nodes")
    heavy = [
        r[0] for r in packed.groupBy("bucket").agg(F.sum(held).alias("size"))
        .filter(F.col("size") > bucket_bytes).collect()     # at most one for that many bytes
    ]
    is_heavy = F.col("bucket").isin(heavy)

    def meet(table: pa.Table) -> pa.Table:
        keys, whose, halves = unpacked(table)
        halves, number = np.unique(halves, return_inverse=True)
        whose = number[whose]
        order = np.lexsort((whose, keys))
        keys, whose = keys[order], whose[order]
        once = np.ones(len(keys), bool)
        once[1:] = (keys[1:] != keys[:-1]) | (whose[1:] != whose[:-1])
        keys, whose = keys[once], whose[once]
        run = groups_of(keys)[1]
        sizes = np.repeat(run, run)
        many = sizes > 1
        return pa.table({
            "key": keys[many].view(np.int64), "half": half_column(halves[whose[many]]), "df": sizes[many],
        })

    def unpack(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                keys, whose, halves = unpacked(batch.slice(row, 1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.view(np.int64)), half_column(halves[whose])], names=["key", "half"]
                )

    lists = packed.filter(~is_heavy).groupBy("bucket").applyInArrow(
        group_giving_back(meet), "key long, half binary, df long"
    )
    if heavy:
        # buckets swollen by a very frequent key: row by row, that key spread over tasks
        rows = staged(
            packed.filter(is_heavy).mapInArrow(unpack, "key long, half binary").distinct(),
            "frequent",
        )
        sizes = rows.groupBy(F.col("key").alias("of")).agg(F.count("*").alias("df")).filter("df > 1")
        lists = lists.unionByName(
            share_join(rows, staged(sizes, "sizes"), "key", "of", "df").select("key", "half", "df")
        )
    # halves of two sets that are equal would give both, which makes lists longer
    names = scanned.filter("n > 0").select(F.substring("node", 1, 8).alias("its_half"), "node").distinct()
    return lists.join(names, F.col("half") == F.col("its_half")).select("key", "node", "df")


def common_tokens(a: np.ndarray, b: np.ndarray) -> int:
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())


def bitmap_of(tokens: np.ndarray, bits: int) -> tuple[int, int]:
    """A bitmap of at least ``bits`` bits a token, and its width."""
    width = 64
    while width < bits * len(tokens):
        width *= 2
    flags = np.zeros(width, np.uint8)
    flags[(tokens & np.uint64(width - 1)).astype(np.int64)] = 1
    return int.from_bytes(np.packbits(flags, bitorder="little").tobytes(), "little"), width


def folded(bits: int, width: int, to: int) -> int:
    """A bitmap of fewer bits: what the tokens would have set in that one."""
    while width > to:
        width //= 2
        bits = (bits & ((1 << width) - 1)) | (bits >> width)
    return bits


def wanted_sets(
    docs: DataFrame, wanted: DataFrame, firsts: DataFrame, words: int, sketch: Callable | None = None
) -> DataFrame:
    """``node, n, tokens`` (bytes, or their sketch) of the wanted nodes, made from their texts.

    ``firsts (its, first_id, many)`` names a document of each node; ``many`` marks
    ids of several rows, whose texts may be of other nodes or repeated.
    """
    ids = staged(
        firsts.join(wanted.distinct().hint("merge"), F.col("its") == F.col("node"), "left_semi")
        .groupBy("first_id").agg(F.max("many").alias("many")),
        "wanted",
    )
    texts = flagged(docs, ids, "doc_id", "first_id", "many", "doc_id")

    def make(batches):
        for batch in batches:
            many = batch.column("many")
            for here in text_slices(batch.column("text"), SEGMENT):
                tokens, counts = token_sets(batch.column("text")[here].to_pylist(), words)
                ends = np.cumsum(counts)
                sets = [tokens[e - c : e] for e, c in zip(ends.tolist(), counts.tolist(), strict=True)]
                contents = [sketch(t) if sketch and len(t) else t.tobytes() for t in sets]
                yield pa.RecordBatch.from_arrays(
                    [id_column(set_ids(tokens, counts)), pa.array(counts), pa.array(contents, pa.binary()),
                     many.slice(here.start, len(counts))],
                    names=["node", "n", "tokens", "many"],
                )

    made = staged(
        texts.select("text", "many")
        .mapInArrow(giving_back(make), "node binary, n long, tokens binary, many boolean").filter("n > 0"),
        "sets",
    )
    again = made.filter("many").drop("many").dropDuplicates(["node"])
    return made.filter("not many").drop("many").unionByName(again)


def likely(pairs: DataFrame, drawn: DataFrame, may: Callable) -> DataFrame:
    """The pairs whose sketches do not rule a link out."""
    both = pairs.join(
        drawn.select(F.col("node").alias("of_a"), F.col("tokens").alias("x")), F.col("a") == F.col("of_a")
    ).join(
        drawn.select(F.col("node").alias("of_b"), F.col("tokens").alias("y")), F.col("b") == F.col("of_b")
    )

    def keep(batches):
        for batch in batches:
            good = [
                may(x, y) for x, y in
                zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True)
            ]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return staged(both.select("a", "b", "x", "y").mapInArrow(giving_back(keep), "a binary, b binary"), "likely")


def compared(pairs: DataFrame, sets: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """The pairs ``a, b`` whose token sets reach the threshold.

    Partners of a set are dealt into groups of bounded size, each with one copy of
    the set.
    """
    num, den = threshold
    sizes = sets.select(F.col("node").alias("of"), "n")
    load = staged(
        pairs.groupBy("a").agg(F.count("*").alias("pairs"))
        .join(sizes, F.col("a") == F.col("of"))
        .select("of", "pairs", F.ceil(F.col("pairs") * F.col("n") * 8 * den / num / GROUP_BYTES).alias("slots")),
        "load",
    )
    slot = F.pmod(F.xxhash64("b"), F.col("slots"))
    dealt = share_join(pairs, load, "a", "of", "pairs").select("a", "b", slot.alias("slot"))
    dealt = staged(dealt, "dealt")
    members = dealt.select("a", "slot", F.col("b").alias("member")).unionByName(
        dealt.select("a", "slot", F.col("a").alias("member")).distinct()
    )
    loaded = members.join(sets.select("node", "tokens"), F.col("member") == F.col("node"))

    def check(table: pa.Table) -> pa.Table:
        pivot = table.column("a")[0].as_py()
        members = table.column("member").to_pylist()
        tokens = [np.frombuffer(t, np.uint64) for t in table.column("tokens").to_pylist()]
        own = tokens[members.index(pivot)]
        found = []
        for member, other in zip(members, tokens, strict=True):
            common = common_tokens(own, other)
            if member != pivot and den * common >= num * (len(own) + len(other) - common):
                found.append(member)
        return pa.table({
            "a": pa.array([pivot] * len(found), pa.binary()), "b": pa.array(found, pa.binary()),
        })

    links = loaded.select("a", "slot", "member", "tokens").groupBy("a", "slot").applyInArrow(
        check, "a binary, b binary"
    )
    return staged(links, "links")


def first_pairs(lists: DataFrame) -> DataFrame:
    """``a, b``: each set with the one that comes first in most of its lists."""
    firsts = staged(
        lists.groupBy(F.col("key").alias("of")).agg(F.min("node").alias("a"), F.count("*").alias("size"))
        .filter("size > 1"),
        "firsts",
    )
    met = (
        share_join(lists.select("key", F.col("node").alias("b")), firsts, "key", "of", "size")
        .filter("a <> b").groupBy("a", "b").agg(F.count("*").alias("times"))
    )
    return met.groupBy("b").agg(F.max_by("a", F.struct("times", "a")).alias("a")).select("a", "b")


def open_lists(lists: DataFrame, labels: DataFrame, sets: DataFrame, block: int) -> DataFrame:
    """``slot, i, j, key, node, root, side``: the lists that are not one component.

    Of lists with the same members one is kept.  Those that hold one smallest
    component, which mostly have the same members, go to one slot as far as the
    bytes of their sets allow; a list too long for a task is dealt into blocks, and
    block ``i`` meets block ``j >= i``.
    """
    known = sets.select(F.col("node").alias("of"), "n").join(
        labels.select(F.col("node").alias("its"), "root"), F.col("of") == F.col("its"), "left"
    ).select("of", (F.col("n") * 8).alias("bytes"), "root")
    rooted = staged(
        lists.select("key", "node").join(known, F.col("node") == F.col("of"))
        .select("key", "node", F.col("bytes").alias("its_bytes"), F.coalesce("root", "node").alias("root")),
        "rooted",
    )
    contents = rooted.groupBy("key").agg(
        F.count("*").alias("size"), F.sum("its_bytes").alias("bytes"),
        F.min("root").alias("low"), F.max("root").alias("high"),
        F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("one"),
        F.sum(F.xxhash64("node", F.lit(1)).cast("decimal(38,0)")).alias("two"),
    ).filter("low <> high")
    chosen = staged(
        contents.groupBy("size", "one", "two", "low", "bytes").agg(F.min("key").alias("of"))
        .select("of", "size", "bytes", "low"),
        "open",
    )
    members = share_join(rooted, chosen, "key", "of", "size")
    distinct = (
        members.select("low", "node", (F.col("its_bytes")).alias("b")).distinct()
        .groupBy(F.col("low").alias("its")).agg(F.sum("b").alias("distinct"))
    )
    # lists that share a smallest component stay together if its sets fit, else each part does
    by_low = staged(
        chosen.groupBy(F.col("low").alias("its_low"))
        .agg(F.count("*").alias("lists"), F.sum("bytes").alias("bytes"))
        .join(distinct, F.col("its_low") == F.col("its"))
        .select("its_low", "lists", F.when(F.col("distinct") <= SLOT_BYTES, 1)
                .otherwise(F.ceil(F.col("bytes") / SLOT_BYTES)).alias("parts")),
        "lows",
    )
    whole = chosen.agg(F.sum("size")).first()[0] or 0
    slots = F.lit(int(whole) // SLOT_ROWS + 1)
    blocks = F.greatest(F.ceil(F.col("size") / block), F.ceil(F.col("bytes") / SLOT_BYTES))
    placed = staged(
        share_join(chosen, by_low, "low", "its_low", "lists").select(
            "of", "size", blocks.alias("blocks"),
            F.pmod(F.xxhash64("low", F.pmod(F.xxhash64("of"), F.col("parts"))), slots).alias("slot"),
        ),
        "placed",
    )
    members = share_join(rooted, placed, "key", "of", "size")
    own = F.pmod(F.xxhash64("node"), F.col("blocks"))
    other = F.explode(
        F.when(F.col("blocks") == 1, F.array(F.lit(0).cast("long")))
        .otherwise(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    )
    dealt = members.select("key", "node", "root", "blocks", "slot", own.alias("own"), other.alias("other"))
    one = F.col("blocks") == 1
    return dealt.select(
        F.when(one, F.col("slot")).otherwise(F.col("key")).alias("slot"),
        F.when(one, F.lit(-1)).otherwise(F.least("own", "other")).cast("long").alias("i"),
        F.when(one, F.lit(-1)).otherwise(F.greatest("own", "other")).cast("long").alias("j"),
        "key", "node", "root", (F.col("own") > F.col("other")).cast("int").alias("side"),
    )


NOTHING = (np.empty(0), np.empty(0, np.int64), np.empty(0, np.int64))


class Reunion:
    """What a task knows of the components of its lists."""

    def __init__(self, sketches: dict[bytes, bytes], tokens: dict[bytes, np.ndarray] | None, threshold):
        self.sketches, self.tokens, self.threshold = sketches, tokens, threshold
        self.up: dict = {}
        self.links: list[tuple[bytes, bytes]] = []

    def find(self, name):
        while (above := self.up.get(name, name)) != name:
            self.up[name] = self.up.get(above, above)
            name = above
        return name

    def propose(self, nodes: list[bytes], roots: list[bytes], sides, search) -> tuple:
        """Arrays ``score, x, y`` of the pairs that may link."""
        roots = [self.find(r) for r in roots]
        if len(set(roots)) == 1:
            return NOTHING
        return search([self.sketches[n] for n in nodes], roots, sides)

    def settle(self, nodes: list[bytes], roots: list[bytes], sides, search) -> None:
        """Compare the proposed pairs, likeliest first."""
        score, first, second = self.propose(nodes, roots, sides, search)
        if not len(score):
            return
        order = np.argsort(-score, kind="stable")
        first, second = first[order], second[order]
        tokens = [self.tokens[n] for n in nodes]
        sizes = np.array([len(t) for t in tokens])
        bits = wide_bitmaps(tokens)
        hidden = sizes - np.bitwise_count(bits).sum(1, dtype=np.int64)
        num, den = self.threshold
        step = max(PAIR_BYTES // bits[0].nbytes, 1)
        for at in range(0, len(first), step):
            now = np.unique(np.array([self.find(r) for r in roots], object), return_inverse=True)[1]
            x, y = first[at : at + step], second[at : at + step]
            apart = now[x] != now[y]
            x, y = x[apart], y[apart]
            most = np.bitwise_count(bits[x] & bits[y]).sum(1, dtype=np.int64)
            most += np.minimum(hidden[x], hidden[y])
            able = (num + den) * most >= num * (sizes[x] + sizes[y])
            for i, j in zip(x[able].tolist(), y[able].tolist(), strict=True):
                above, below = self.find(roots[i]), self.find(roots[j])
                if above == below:
                    continue
                common = common_tokens(tokens[i], tokens[j])
                if den * common >= num * (len(tokens[i]) + len(tokens[j]) - common):
                    self.up[max(above, below)] = min(above, below)
                    self.links.append((nodes[i], nodes[j]))


def wide_bitmaps(sets: list[np.ndarray]) -> np.ndarray:
    """A row of words for each set, with at least ``WIDE`` bits a token."""
    width = 64
    while width < WIDE * max(map(len, sets)):
        width *= 2
    flags = np.zeros(width, np.uint8)
    rows = np.empty((len(sets), width // 64), np.uint64)
    for i, tokens in enumerate(sets):
        at = (tokens & np.uint64(width - 1)).astype(np.int64)
        flags[at] = 1
        rows[i] = np.packbits(flags).view(np.uint64)
        flags[at] = 0
    return rows


PLACE = ["slot", "i", "j"]


def with_contents(opened: DataFrame, sets: DataFrame) -> DataFrame:
    """One row for each set of each place, with its tokens or sketch."""
    places = opened.select(
        F.col("slot").alias("in_slot"), F.col("i").alias("in_i"), F.col("j").alias("in_j"),
        F.col("node").alias("member"),
    ).distinct()
    return places.join(sets.select("node", "tokens"), F.col("member") == F.col("node")).drop("node")


def each_list(lists: pa.Table):
    """Key, nodes, roots and sides of the lists of a table, long ones first.

    Lists of much the same members become one, of at most twice the longest's
    length, so that their pairs meet once.
    """
    keys = lists.column("key").to_numpy()
    order = np.argsort(keys, kind="stable")
    nodes, roots = lists.column("node").to_pylist(), lists.column("root").to_pylist()
    runs = sorted(zip(*groups_of(keys[order]), strict=True), key=lambda r: (-r[1], r[0]))
    lists_of = [order[begin : begin + size].tolist() for begin, size in runs]
    if lists.num_rows and lists.column("i")[0].as_py() != lists.column("j")[0].as_py():
        sides = lists.column("side").to_pylist()
        for here in lists_of:
            yield (
                int(keys[here[0]]), [nodes[x] for x in here], [roots[x] for x in here],
                [sides[x] for x in here],
            )
        return
    number, root_of = {}, {}
    for node, root in zip(nodes, roots, strict=True):
        number.setdefault(node, len(number))
        root_of[node] = root
    names = list(number)
    merged: list[list[int]] = []            # key, bitmap of the members, most members
    for here in lists_of:
        bits = sum(1 << number[nodes[x]] for x in here)
        best = max(merged, key=lambda m: (m[1] & bits).bit_count(), default=None)
        if best and 5 * (best[1] & bits).bit_count() >= 3 * len(here) and (
            (best[1] | bits).bit_count() <= best[2]
        ):
            best[1] |= bits
        else:
            merged.append([int(keys[here[0]]), bits, 2 * len(here)])
    for key, bits, _ in merged:
        members = [names[i] for i, flag in enumerate(reversed(f"{bits:b}")) if flag == "1"]
        yield key, members, [root_of[m] for m in members], None


def proposed_members(opened: DataFrame, drawn: DataFrame, search: Callable) -> DataFrame:
    """The members of open lists that the search pairs with any other one.

    ``search(sketches, roots, sides)`` returns arrays ``score, x, y`` for the positions
    of sets that may link: of different roots, on different sides if there are sides.
    """

    def look(lists: pa.Table, loads: pa.Table) -> pa.Table:
        work = Reunion(
            dict(zip(loads.column("member").to_pylist(), loads.column("tokens").to_pylist(), strict=True)),
            None, None,
        )
        rows = []
        for key, nodes, roots, sides in each_list(lists):
            _, first, second = work.propose(nodes, roots, sides, search)
            for x in np.union1d(first, second).tolist():
                rows.append((key, nodes[x], roots[x], sides[x] if sides else 0))
        place = [lists.column(c)[0].as_py() if lists.num_rows else None for c in PLACE]
        columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate(
            [pa.int64(), pa.binary(), pa.binary(), pa.int32()])]
        return pa.table(
            [pa.array([v] * len(rows), pa.int64()) for v in place] + columns,
            names=[*PLACE, "key", "node", "root", "side"],
        )

    found = opened.groupBy(*PLACE).cogroup(
        with_contents(opened, drawn).groupBy("in_slot", "in_i", "in_j")
    ).applyInArrow(look, "slot long, i long, j long, key long, node binary, root binary, side int")
    return staged(found, "proposed")


def settled_links(
    opened: DataFrame, sets: DataFrame, sketch: Callable, search: Callable, threshold: tuple[int, int]
) -> DataFrame:
    """Links ``a, b`` that unite the components of the open lists.

    Within a task a pair is compared only if no link has united it before, so the
    links are at most one fewer than the sets.
    """

    def look(lists: pa.Table, loads: pa.Table) -> pa.Table:
        tokens = {
            node: np.frombuffer(t, np.uint64) for node, t in
            zip(loads.column("member").to_pylist(), loads.column("tokens").to_pylist(), strict=True)
        }
        work = Reunion({node: sketch(t) for node, t in tokens.items()}, tokens, threshold)
        for _, nodes, roots, sides in each_list(lists):
            work.settle(nodes, roots, sides, search)
        return pa.table({
            "a": pa.array([x for x, _ in work.links], pa.binary()),
            "b": pa.array([y for _, y in work.links], pa.binary()),
        })

    links = opened.groupBy(*PLACE).cogroup(
        with_contents(opened, sets).groupBy("in_slot", "in_i", "in_j")
    ).applyInArrow(look, "a binary, b binary")
    return staged(links, "links")


def empty_labels(frame: DataFrame) -> DataFrame:
    return frame.sparkSession.createDataFrame([], "node binary, root binary")


def shingle_components(
    docs: DataFrame,
    words: int,
    threshold: tuple[int, int],
    make_keys: Callable,
    keys_a_byte: float,
    sketch: Callable,
    may: Callable,
    search: Callable,
    narrow: Callable[[DataFrame], DataFrame] = lambda lists: lists,
    id_col: str = "doc_id",
    text_col: str = "text",
    block: int = BLOCK,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """``doc_id, n_shingles, component_id``, one row per row; see the operators.

    ``narrow`` may leave out members of lists that need not meet there.
    """
    source = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("doc_id"),
        F.col(text_col).cast("string").alias("text"),
    )
    size = source.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    scanned = staged(
        scan_sets(source, words, make_keys, int(size * keys_a_byte // BUCKET_KEYS) + 1), "keys"
    )
    rows = staged(scanned.filter("bucket is null").select("doc_id", "n", "node"), "rows")
    lists = staged(narrow(key_lists(scanned, bucket_bytes)), "lists")
    discard(scanned)
    if lists.limit(1).count() == 0:
        labels = empty_labels(rows)
    else:
        twice = rows.groupBy("doc_id").agg((F.count("*") > 1).alias("many"))
        firsts = (
            rows.filter("n > 0").groupBy(F.col("node").alias("its")).agg(F.min("doc_id").alias("doc_id"))
            .join(twice.hint("merge"), "doc_id")    # a row a document: not for the driver
            .select("its", F.col("doc_id").alias("first_id"), "many")
        )
        firsts = staged(firsts, "firsts")
        drawn = wanted_sets(source, lists.select("node"), firsts, words, sketch)
        pairs = likely(staged(first_pairs(lists), "first_pairs"), drawn, may)
        ends = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node")))
        links = compared(pairs, wanted_sets(source, ends, firsts, words), threshold)
        labels = connected_components(links)
        opened = staged(open_lists(lists, labels, drawn, block), "opened")
        members = proposed_members(opened, drawn, search)
        if members.limit(1).count():
            sets = wanted_sets(source, members.select("node"), firsts, words)
            more = settled_links(members, sets, sketch, search, threshold)
            labels = connected_components(links.unionByName(more))
        discard(lists, opened)
    named = left_lookup(
        rows, labels.select(F.col("node").alias("known"), "root"), "node", "known", "doc_id"
    ).withColumn("root", F.coalesce("root", "node"))
    smallest = staged(
        named.filter("n > 0").groupBy(F.col("root").alias("its_root"))
        .agg(F.min("doc_id").alias("first_id"), F.count("*").alias("docs")).filter("docs > 1")
        .drop("docs"),
        "smallest",
    )
    result = left_lookup(named, smallest, "root", "its_root", "doc_id")
    component = F.when(F.col("n") > 0, F.coalesce("first_id", "doc_id")).otherwise(F.col("doc_id"))
    return result.select(
        F.nullif(F.col("doc_id"), F.lit(LAST)).alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.nullif(component, F.lit(LAST)).alias("component_id"),
    )
