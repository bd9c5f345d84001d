"""Removal of byte strings repeated across documents, by a depth-limited radix sort.

Two suffixes share a string of ``LENGTH`` bytes exactly if they are equal to that
depth, so suffixes are sorted only that deep, most significant digit first, and
the groups that are still equal at the end are the repeated windows.

The first digit is the window's minimizer: the smallest hash of the 16-byte
strings in it.  Equal windows have equal minimizers, and neighbouring windows
mostly share theirs, so a text becomes runs of windows, about one in 18 bytes.

1. Documents equal to an earlier one are removed whole and go no further.
2. Only the minimizers are dealt out, packed; those of a single document drop.
3. The bytes of the remaining runs are dealt out by minimizer, equal ones of a
   task once.  In each bucket the windows are sorted by digits of eight bytes,
   and after each digit those that stand alone drop out.
4. The ranges found go back to their documents.

Texts move twice, by a hash of the row, to tasks of bounded size.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import left_lookup, staged
from corpusloom.llm.packing import LAST, groups_of, mixed, pack, ranges, steps, unpack

LENGTH = 50
GRAM = 16
MAX_RUN = 512                       # windows of one run at most
SEGMENT = 1_000_000                 # bytes hashed at once
PART_BYTES = 12 * 1024 * 1024       # texts of one task
BUCKET_BYTES = 12 * 1024 * 1024     # bytes of text whose runs meet in one bucket
FLUSH_RUNS = 3_000_000

DEALT = "bucket int, docs binary, hashes binary, owner binary, number binary"
SHARED = "part int, docs binary, sizes binary, number binary"
RUNS = (
    "bucket int, docs binary, lengths binary, content binary, copies binary, owner binary, "
    "start binary"
)
RANGES = "part int, docs binary, owner binary, begin binary, end binary"


def words_at_every_byte(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each byte on as one number, most significant first."""
    view = np.lib.stride_tricks.sliding_window_view(data, 8)
    return np.ascontiguousarray(view).view(">u8").reshape(-1)


def window_runs(texts: list[bytes]):
    """Runs of windows of each text: ``hash, text, start, windows`` arrays.

    Depends on each text alone, not on its neighbours.
    """
    found = []
    pieces: list[tuple[int, int, bytes]] = []
    held = 0
    for i, text in enumerate(texts):
        for base in range(0, max(len(text) - LENGTH + 1, 0), SEGMENT):
            pieces.append((i, base, text[base : base + SEGMENT + LENGTH - 1]))
            held += len(pieces[-1][2])
            if held > SEGMENT:
                found.append(runs_of_pieces(pieces))
                pieces, held = [], 0
    if pieces:
        found.append(runs_of_pieces(pieces))
    if not found:
        return np.empty(0, np.uint64), *(np.empty(0, np.int64) for _ in range(3))
    return tuple(np.concatenate([f[k] for f in found]) for k in range(4))


def runs_of_pieces(pieces):
    data = np.frombuffer(b"".join(p[2] for p in pieces), np.uint8)
    sizes = np.array([len(p[2]) for p in pieces])
    begins = np.cumsum(sizes) - sizes
    first = words_at_every_byte(data).astype(np.uint64)
    hashes = mixed(first[: len(first) - 8] * np.uint64(0x9E3779B97F4A7C15) ^ mixed(first[8:]))
    smallest, width = hashes, 1
    span = LENGTH - GRAM + 1
    while 2 * width <= span:
        smallest = np.minimum(smallest[:-width], smallest[width:])
        width *= 2
    shift = span - width
    if shift:
        smallest = np.minimum(smallest[: len(smallest) - shift], smallest[shift:])
    owner = np.repeat(np.arange(len(pieces)), sizes)[: len(smallest)]
    inside = np.arange(len(smallest)) - begins[owner]
    valid = inside <= sizes[owner] - LENGTH
    at = np.flatnonzero(valid)
    value, owner, inside = smallest[at], owner[at], inside[at]
    new = np.concatenate([[True], (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])])
    starts = np.flatnonzero(new)
    lengths = np.diff(np.append(starts, len(at)))
    extra = -(-lengths // MAX_RUN)
    if (extra > 1).any():
        step = ranges(np.zeros(len(starts), np.int64), extra) * MAX_RUN
        left = np.repeat(lengths, extra) - step
        starts, lengths = np.repeat(starts, extra) + step, np.minimum(left, MAX_RUN)
    numbers = np.array([p[0] for p in pieces])
    bases = np.array([p[1] for p in pieces])
    whose = owner[starts]
    return mixed(value[starts]), numbers[whose], bases[whose] + inside[starts], lengths


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)


def pack_docs(doc_ids: np.ndarray, keys: np.ndarray) -> bytes:
    return pack(np.concatenate([doc_ids, keys]))


def unpack_docs(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    both = unpack(data, np.int64)
    return both[: len(both) // 2], both[len(both) // 2 :]


def batch_of(schema: pa.Schema, rows: list[tuple]) -> pa.Table:
    return pa.Table.from_arrays(
        [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema
    )


def arrow_schema(columns: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "binary": pa.binary()}
    return pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in columns.split(", ")])


def deal_minimizers(texts: DataFrame, buckets: int) -> DataFrame:
    """Minimizers of all texts, packed by bucket: which document has which."""
    schema = arrow_schema(DEALT)

    def deal(batches):
        held, docs, total = [], [], 0

        def flush():
            doc_ids = np.concatenate([d[0] for d in docs])
            keys = np.concatenate([d[1] for d in docs])
            hashes, owner, number = (np.concatenate([h[k] for h in held]) for k in range(3))
            bucket = bucket_of(hashes, buckets)
            order = np.argsort(bucket, kind="stable")
            begins, sizes = groups_of(bucket[order])
            for begin, size in zip(begins, sizes, strict=True):
                here = order[begin : begin + size]
                own, place = np.unique(owner[here], return_inverse=True)
                # 48 bits and the bucket tell minimizers apart well enough: a
                # chance match only sends a run to the exact comparison
                low = (hashes[here] & np.uint64(0xFFFFFFFFFFFF)).view(np.uint8).reshape(-1, 8)
                yield (
                    int(bucket[here[0]]),
                    pack_docs(doc_ids[own], keys[own]),
                    np.ascontiguousarray(low[:, :6]).tobytes(),
                    pack(steps(place.astype(np.int32))),
                    pack(number[here].astype(np.int32)),
                )

        for batch in batches:
            raw = [t.encode("utf-8") for t in batch.column("text").to_pylist()]
            base = sum(len(d[0]) for d in docs)
            hashes, owner, _, _ = window_runs(raw)
            begins, sizes = groups_of(owner)
            number = ranges(np.zeros(len(begins), np.int64), sizes)
            held.append((hashes, owner + base, number))
            docs.append((batch.column("doc_id").to_numpy(), batch.column("key").to_numpy()))
            total += len(hashes)
            if total > FLUSH_RUNS:
                for row in flush():
                    yield from batch_of(schema, [row]).to_batches()
                held, docs, total = [], [], 0
        if total:
            for row in flush():
                yield from batch_of(schema, [row]).to_batches()

    return texts.select("doc_id", "key", "text").mapInArrow(deal, DEALT)


def find_shared(dealt: DataFrame, parts: int) -> DataFrame:
    """Which runs of which documents have a minimizer of several documents."""
    schema = arrow_schema(SHARED)

    def compare(table: pa.Table) -> pa.Table:
        doc_ids, keys, hashes, owner, number, base = [], [], [], [], [], 0
        for row in table.to_pylist():
            ids, key = unpack_docs(row["docs"])
            wide = np.zeros((len(row["hashes"]) // 6, 8), np.uint8)
            wide[:, :6] = np.frombuffer(row["hashes"], np.uint8).reshape(-1, 6)
            doc_ids.append(ids)
            keys.append(key)
            hashes.append(wide.view(np.uint64).reshape(-1))
            owner.append(np.cumsum(unpack(row["owner"], np.int32)) + base)
            number.append(unpack(row["number"], np.int32))
            base += len(ids)
        doc_ids, keys, hashes, owner, number = map(
            np.concatenate, (doc_ids, keys, hashes, owner, number)
        )
        order = np.argsort(hashes, kind="stable")
        begins, sizes = groups_of(hashes[order])
        docs = doc_ids[owner[order]]
        several = np.minimum.reduceat(docs, begins) != np.maximum.reduceat(docs, begins)
        here = order[np.repeat(several, sizes)]
        part = keys[owner[here]] % parts
        here = here[np.lexsort((number[here], owner[here], part))]
        part = keys[owner[here]] % parts
        rows = []
        for begin, size in zip(*groups_of(part), strict=True):
            mine = here[begin : begin + size]
            first, counts = groups_of(owner[mine])
            own = owner[mine[first]]
            rows.append(
                (
                    int(part[begin]), pack_docs(doc_ids[own], keys[own]),
                    pack(counts.astype(np.int32)), pack(steps(number[mine])),
                )
            )
        return batch_of(schema, rows)

    return dealt.groupBy("bucket").applyInArrow(compare, SHARED)


def gather_runs(texts: DataFrame, shared: DataFrame, buckets: int) -> DataFrame:
    """The bytes of the shared runs, packed by bucket; equal ones of a task once."""
    schema = arrow_schema(RUNS)

    def gather(left: pa.Table, right: pa.Table) -> pa.Table:
        wanted: dict[tuple[int, int], list[np.ndarray]] = {}
        for row in right.to_pylist():
            ids, keys = unpack_docs(row["docs"])
            counts = unpack(row["sizes"], np.int32)
            numbers = np.cumsum(unpack(row["number"], np.int32))
            ends = np.cumsum(counts)
            for doc, key, end, size in zip(
                ids.tolist(), keys.tolist(), ends.tolist(), counts.tolist(), strict=True
            ):
                wanted.setdefault((doc, key), []).append(numbers[end - size : end])
        doc_ids, keys = left.column("doc_id").to_numpy(), left.column("key").to_numpy()
        column = left.column("text")
        # content -> [bucket, document, start, document, start, ...]
        held: dict[bytes, list[int]] = {}
        for i, (doc, key) in enumerate(zip(doc_ids.tolist(), keys.tolist(), strict=True)):
            numbers = wanted.get((doc, key))
            if numbers is None:
                continue
            text = column[i].as_py().encode("utf-8")
            hashes, _, start, windows = window_runs([text])
            mine = np.concatenate(numbers)
            for b, s, n in zip(
                bucket_of(hashes[mine], buckets).tolist(), start[mine].tolist(),
                windows[mine].tolist(), strict=True,
            ):
                content = text[s : s + n + LENGTH - 1]
                place = held.get(content)
                if place is None:
                    held[content] = [b, i, s]
                else:
                    place += (i, s)
        by_bucket: dict[int, list] = {}
        for content, place in held.items():
            by_bucket.setdefault(place[0], []).append((content, place))
        rows = []
        for bucket, items in by_bucket.items():
            copies = np.array([(len(p) - 1) // 2 for _, p in items], np.int32)
            flat = np.array([x for _, p in items for x in p[1:]], np.int64).reshape(-1, 2)
            own, owner = np.unique(flat[:, 0], return_inverse=True)
            rows.append(
                (
                    bucket, pack_docs(doc_ids[own], keys[own]),
                    pack(np.array([len(c) for c, _ in items], np.int32)),
                    b"".join(c for c, _ in items), pack(copies),
                    pack(owner.astype(np.int32)), pack(flat[:, 1].astype(np.int32)),
                )
            )
        return batch_of(schema, rows)

    return (
        texts.select("part", "doc_id", "key", "text").groupBy("part")
        .cogroup(shared.groupBy("part"))
        .applyInArrow(gather, RUNS)
    )


def radix_groups(data: np.ndarray, at: np.ndarray):
    """Groups of equal windows: most significant digit first, to LENGTH bytes.

    ``at``: the places of ``data`` where the windows begin.  A digit is read only
    for the windows that are still in a group of two or more.  Returns ``order,
    begins, sizes`` of the groups; windows that stand alone are in none.
    """
    eight = np.lib.stride_tricks.sliding_window_view(data, 8)
    order = np.arange(len(at))
    group = np.zeros(len(at), np.int64)
    depths = [*range(0, LENGTH - 8, 8), LENGTH - 8]
    for depth in depths:
        digit = eight[at[order] + depth].view(">u8").reshape(-1).astype(np.uint64)
        by = np.lexsort((digit, group)) if depth else np.argsort(digit, kind="stable")
        order, group, digit = order[by], group[by], digit[by]
        if not len(order):
            break
        new = np.concatenate([[True], (digit[1:] != digit[:-1]) | (group[1:] != group[:-1])])
        begins = np.flatnonzero(new)
        sizes = np.diff(np.append(begins, len(order)))
        several = sizes > 1
        keep = np.repeat(several, sizes)
        order = order[keep]
        sizes = sizes[several]
        group = np.repeat(np.arange(len(sizes)), sizes)
    if not len(order):
        return order, np.empty(0, np.int64), np.empty(0, np.int64)
    return order, *groups_of(group)


def find_ranges(runs: DataFrame, parts: int) -> DataFrame:
    """Byte ranges of each document that repeat one of a smaller document."""
    schema = arrow_schema(RANGES)

    def sort(table: pa.Table) -> pa.Table:
        doc_ids, keys, owners, starts, base = [], [], [], [], 0
        place_of: dict[bytes, int] = {}
        context = []                        # of each occurrence: number of its content
        for row in table.to_pylist():
            ids, key = unpack_docs(row["docs"])
            ends = np.cumsum(unpack(row["lengths"], np.int32))
            content = row["content"]
            numbers, begin = [], 0
            for end in ends.tolist():
                numbers.append(place_of.setdefault(content[begin:end], len(place_of)))
                begin = end
            context.append(np.repeat(np.array(numbers), unpack(row["copies"], np.int32)))
            owners.append(unpack(row["owner"], np.int32) + base)
            starts.append(unpack(row["start"], np.int32))
            doc_ids.append(ids)
            keys.append(key)
            base += len(ids)
        doc_ids, keys, owners, starts, context = map(
            np.concatenate, (doc_ids, keys, owners, starts, context)
        )
        doc = doc_ids[owners]
        contents = list(place_of)
        smallest = np.full(len(contents), LAST)
        np.minimum.at(smallest, context, doc)
        lengths = np.array([len(c) for c in contents])
        windows = lengths - LENGTH + 1
        data = np.frombuffer(b"".join(contents), np.uint8)
        at = ranges(np.cumsum(lengths) - lengths, windows)
        whose = np.repeat(np.arange(len(contents)), windows)
        source = smallest[whose]
        order, begins, sizes = radix_groups(data, at)
        if len(begins):
            least = np.minimum.reduceat(source[order], begins)
            source[order] = np.repeat(least, sizes)
        # the smallest document of a content loses the windows that an even smaller one has
        lost = source < smallest[whose]
        inside = at - np.repeat(np.cumsum(lengths) - lengths, windows)
        edge = np.concatenate([[True], (whose[1:] != whose[:-1]) | ~lost[:-1]]) & lost
        stop = np.concatenate([(whose[1:] != whose[:-1]) | ~lost[1:], [True]]) & lost
        part_of, part_begin = whose[edge], inside[edge]
        part_end = inside[stop] + LENGTH
        # occurrences: later documents lose the whole run, the first its lost windows
        later = doc > smallest[context]
        first = np.flatnonzero(~later)
        cuts, count = groups_of(part_of)
        of = np.full(len(contents), -1)
        of[part_of[cuts]] = np.arange(len(cuts))
        first = first[of[context[first]] >= 0]
        which = of[context[first]]
        detail = ranges(cuts[which], count[which]) if len(first) else np.empty(0, np.int64)
        owner = np.concatenate([owners[later], np.repeat(owners[first], count[which])])
        shift = np.repeat(starts[first], count[which])
        begin = np.concatenate([starts[later], shift + part_begin[detail]])
        end = np.concatenate([starts[later] + lengths[context[later]], shift + part_end[detail]])
        rows = []
        part = keys[owner] % parts
        order = np.lexsort((begin, owner, part))
        for first_row, size in zip(*groups_of(part[order]), strict=True):
            mine = order[first_row : first_row + size]
            own, number = np.unique(owner[mine], return_inverse=True)
            rows.append(
                (
                    int(part[mine[0]]), pack_docs(doc_ids[own], keys[own]),
                    pack(steps(number.astype(np.int32))), pack(begin[mine].astype(np.int32)),
                    pack(end[mine].astype(np.int32)),
                )
            )
        return batch_of(schema, rows)

    return runs.groupBy("bucket").applyInArrow(sort, RANGES)


RESULT = (
    "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
)


def cut_ranges(texts: DataFrame, found: DataFrame, keep_text: bool) -> DataFrame:
    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        wanted: dict[tuple[int, int], list] = {}
        for row in right.to_pylist():
            ids, keys = unpack_docs(row["docs"])
            owner = np.cumsum(unpack(row["owner"], np.int32))
            begin, end = unpack(row["begin"], np.int32), unpack(row["end"], np.int32)
            for first, size in zip(*groups_of(owner), strict=True):
                own = owner[first]
                wanted.setdefault((int(ids[own]), int(keys[own])), []).append(
                    (begin[first : first + size], end[first : first + size])
                )
        rows = []
        columns = (left.column("doc_id"), left.column("key"), left.column("text"))
        for doc, key, text in zip(*columns, strict=True):
            doc, raw = doc.as_py(), text.as_py().encode("utf-8")
            kept, removed, spans = raw, 0, 0
            for_this = wanted.get((doc, key.as_py()))
            if for_this is not None:
                change = np.zeros(len(raw) + 1, np.int32)
                for begin, end in for_this:
                    np.add.at(change, begin, 1)
                    np.add.at(change, end, -1)
                gone = np.cumsum(change[:-1]) > 0
                removed = int(gone.sum())
                spans = int((gone & ~np.concatenate([[False], gone[:-1]])).sum())
                kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
            rows.append(
                (
                    None if doc == LAST else doc, len(raw), removed, spans,
                    hashlib.sha256(kept).hexdigest(), kept if keep_text else None,
                )
            )
        kinds = [pa.int64()] * 4 + [pa.string(), pa.binary()]
        names = [c.split()[0] for c in RESULT.split(", ")]
        return pa.table(
            {n: pa.array([r[i] for r in rows], kinds[i]) for i, n in enumerate(names)}
        )

    return (
        texts.select("part", "doc_id", "key", "text").groupBy("part")
        .cogroup(found.groupBy("part"))
        .applyInArrow(cut, RESULT)
    )


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = True
) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept``, one row per row.

    Removed is every byte covered by a string of LENGTH bytes that also starts in
    a document with a smaller id; strings are judged on the input.  ``kept`` has
    the other bytes (null without ``keep_text``).  Null text counts as empty.  A
    null id comes after all others.  Rows with equal ids do not remove each
    other's text.  An empty table gives no rows; other columns are not read.
    """
    every = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    total = every.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts, buckets = int(total // PART_BYTES) + 1, int(total // BUCKET_BYTES) + 1
    digests = every.filter(F.octet_length("text") >= LENGTH).select(
        "doc_id", F.unhex(F.sha1("text")).alias("sha")
    )
    firsts = staged(
        digests.groupBy("sha")
        .agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"))
        .filter("first_id < last_id")
        .select(F.col("sha").alias("first_sha"), "first_id"),
        "first_copies",
    )
    marked = left_lookup(
        every.withColumn("sha", F.unhex(F.sha1("text"))), firsts, "sha", "first_sha", "doc_id"
    ).withColumn("copy", F.coalesce(F.col("first_id") < F.col("doc_id"), F.lit(False)))
    whole = F.octet_length("text").cast("long")
    copies = marked.filter("copy").select(
        F.nullif(F.col("doc_id"), F.lit(LAST)).alias("doc_id"),
        whole.alias("n_bytes"), whole.alias("n_removed"), F.lit(1).cast("long").alias("n_spans"),
        F.sha2(F.lit(""), 256).alias("kept_sha256"),
        F.when(F.lit(keep_text), F.lit(b"")).alias("kept"),
    )
    texts = marked.filter("not copy").withColumn("key", F.xxhash64("doc_id", "text")).select(
        F.pmod("key", F.lit(parts)).cast("int").alias("part"), "doc_id", "key", "text"
    )
    shared = find_shared(deal_minimizers(texts, buckets), parts)
    found = find_ranges(gather_runs(texts, shared, buckets), parts)
    return cut_ranges(texts, found, keep_text).unionByName(copies)
