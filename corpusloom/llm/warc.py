"""WARC archives with a Zstandard dictionary, written and read by Spark tasks.

A dictionary is trained on a bounded sample of the records, placed in a leading
skippable frame of every archive, and each record is a Zstandard frame of its
own, so that a reader can start at any record offset with nothing but the file.

Archives are rows ``archive_id, content`` of a table of the shared folder, which
any file system that Spark writes to can hold; :func:`export_archives` writes
them as ``.warc.zst`` files.
"""

from __future__ import annotations

import base64
import hashlib
import uuid

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import left_lookup, staged

# Fixed values of the formats.
DICTIONARY_FRAME = 0x184D2A5D
WARC_DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

SAMPLE_RECORDS = 400
SAMPLE_BYTES = 4_000_000
DICTIONARY_BYTES = 64 * 1024
ARCHIVE_BYTES = 16 * 1024 * 1024
LEVEL = 3
SEED = 7

RECORD_COLUMNS = (
    "page_id long, payload_bytes long, payload_digest string, record_type string, "
    "refers_to long, url string, payload binary"
)


def digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode("ascii")


def record_id(page_id: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, str(page_id))}>"


def header_text(value: str | None) -> str:
    """A header value on one line."""
    return " ".join((value or "").split())


def format_record(page_id, url, payload: bytes, sha: str, refers_to) -> bytes:
    """One WARC 1.1 record; a revisit has no payload block."""
    revisit = refers_to is not None
    body = b"" if revisit else payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(page_id)}",
        f"WARC-Date: {WARC_DATE}",
        f"WARC-Target-URI: {header_text(url)}",
        f"WARC-Payload-Digest: sha1:{sha}",
        f"X-Page-Id: {'' if page_id is None else page_id}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if revisit:
        lines += [
            f"WARC-Profile: {PROFILE}",
            f"WARC-Refers-To: {record_id(refers_to)}",
            f"X-Refers-To-Page: {refers_to}",
        ]
    lines += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(body)}"]
    return "\r\n".join(lines).encode("utf-8") + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse_record(record: bytes) -> dict:
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    length = int(fields["Content-Length"])
    body = rest[:length]
    if len(body) != length or rest[length:] != b"\r\n\r\n":
        raise ValueError("record and Content-Length differ")
    kind = fields["WARC-Type"]
    sha = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and digest(body) != sha:
        raise ValueError(f"damaged payload in {fields['WARC-Record-ID']}")
    number = fields["X-Page-Id"]
    refers = fields.get("X-Refers-To-Page")
    return {
        "page_id": int(number) if number else None,
        "payload_bytes": int(fields["X-Payload-Length"]) if kind == "revisit" else length,
        "payload_digest": sha,
        "record_type": kind,
        "refers_to": int(refers) if refers else None,
        "url": fields["WARC-Target-URI"],
        "payload": body if kind == "response" else None,
    }


def train_dictionary(records: DataFrame, seed: int = SEED) -> bytes:
    """A dictionary from at most SAMPLE_RECORDS records of about SAMPLE_BYTES.

    The sample is bounded in rows and in bytes; a corpus too small to train on
    gives its own start as a raw-content dictionary, possibly an empty one.
    """
    total = records.count()
    if not total:
        return b""
    part = min(1.0, 2.0 * SAMPLE_RECORDS / total)
    cut = SAMPLE_BYTES // SAMPLE_RECORDS
    rows = (
        records.sample(fraction=part, seed=seed)
        .select(F.substring("payload", 1, cut).alias("payload"))
        .limit(SAMPLE_RECORDS)
        .collect()
    )
    samples = [bytes(r[0]) for r in rows if r[0]]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:DICTIONARY_BYTES]


def skippable(dictionary: bytes) -> bytes:
    return (
        DICTIONARY_FRAME.to_bytes(4, "little") + len(dictionary).to_bytes(4, "little") + dictionary
    )


def write_archives(
    pages: DataFrame,
    dictionary: bytes | None = None,
    min_revisit_bytes: int = 0,
    archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """``archive_id, n_records, content`` staged in the shared folder.

    Columns read: ``page_id, url, html``.  Of records with equal payloads of at
    least ``min_revisit_bytes`` bytes the one with the smallest page_id is the
    response and the others are revisits of it; smaller ones are all responses.

    Only digests are grouped and joined: the payload stays in the task that
    reads it, until the pages move once to the archive that holds them.  A
    repeated page_id gives a record a row, and of equal ids with equal payloads
    one stays response.  A null page_id is a page whose record names no page; it
    comes last.  Null html: empty payload.  Empty table: no archive.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("sha", F.sha1("payload"))
    if dictionary is None:
        dictionary = train_dictionary(rows)
    light = rows.select("page_id", "sha", F.octet_length("payload").alias("bytes"))
    # groups of one need no reference; the rest is a lookup of first ids by digest
    firsts = staged(
        light.filter(F.col("bytes") >= min_revisit_bytes)
        .groupBy("sha")
        .agg(F.min("page_id").alias("first_id"), F.count("*").alias("copies"))
        .filter("copies > 1")
        .select(F.col("sha").alias("first_sha"), "first_id"),
        "firsts",
    )
    total = light.agg(F.coalesce(F.sum("bytes"), F.lit(0)), F.count("*")).first()
    if not total[1]:
        return rows.sparkSession.createDataFrame(
            [], "archive_id int, n_records long, content binary"
        )
    archives = int(total[0] // archive_bytes) + 1
    linked = left_lookup(rows, firsts, "sha", "first_sha", "page_id").withColumn(
        "archive_id", F.pmod(F.xxhash64("page_id", "sha"), F.lit(archives)).cast("int")
    )

    def pack(batches):
        held: dict[int, list] = {}
        compressor = zstandard.ZstdCompressor(
            level=LEVEL,
            dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None,
        )
        ended: set = set()
        for batch in batches:
            columns = batch.to_pydict()
            for page_id, url, payload, sha, first, archive in zip(
                columns["page_id"], columns["url"], columns["payload"], columns["sha"],
                columns["first_id"], columns["archive_id"], strict=True,
            ):
                refers = first if first is not None and first != page_id else None
                if first is not None and first == page_id:
                    # equal ids with equal payloads: one response, the others refer to it
                    if (page_id, sha) in ended:
                        refers = first
                    ended.add((page_id, sha))
                named = base64.b32encode(bytes.fromhex(sha)).decode("ascii")
                record = format_record(page_id, url, payload, named, refers)
                held.setdefault(archive, []).append(
                    (page_id is None, page_id or 0, named, compressor.compress(record))
                )
        for archive, records in held.items():
            records.sort(key=lambda r: r[:3])
            content = skippable(dictionary) + b"".join(r[3] for r in records)
            yield pa.RecordBatch.from_pydict(
                {
                    "archive_id": pa.array([archive], pa.int32()),
                    "n_records": pa.array([len(records)], pa.int64()),
                    "content": pa.array([content], pa.binary()),
                }
            )

    packed = (
        linked.select("page_id", "url", "payload", "sha", "first_id", "archive_id")
        .repartition(archives, "archive_id")
        .mapInArrow(pack, "archive_id int, n_records long, content binary")
    )
    return staged(packed, "archives")


def read_archives(archives: DataFrame) -> DataFrame:
    """All records of archives: ``page_id, payload_bytes, payload_digest, record_type,
    refers_to, url, payload`` (null for revisits).

    The dictionary comes from each archive's own leading frame.  A record whose
    payload does not fit its digest, or a cut file, raises ValueError.
    """
    schema = pa.schema(
        [
            ("page_id", pa.int64()),
            ("payload_bytes", pa.int64()),
            ("payload_digest", pa.string()),
            ("record_type", pa.string()),
            ("refers_to", pa.int64()),
            ("url", pa.string()),
            ("payload", pa.binary()),
        ]
    )

    def unpack(batches):
        for batch in batches:
            for content in batch.column("content"):
                rows, size = [], 0
                for record in split_archive(content.as_py()):
                    row = parse_record(record)
                    rows.append(row)
                    size += len(row["payload"] or b"")
                    if size > 8_000_000:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    return archives.select("content").mapInArrow(unpack, RECORD_COLUMNS)


def split_archive(content: bytes):
    """The decompressed records of one archive, frame by frame."""
    if int.from_bytes(content[:4], "little") != DICTIONARY_FRAME:
        raise ValueError("archive without a dictionary frame")
    size = int.from_bytes(content[4:8], "little")
    dictionary = content[8 : 8 + size]
    decompressor = zstandard.ZstdDecompressor(
        dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    )
    rest = memoryview(content)[8 + size :]
    while len(rest):
        frame = decompressor.decompressobj()
        window, record, used = 1 << 16, b"", 0
        while not frame.eof:
            if used >= len(rest):
                raise ValueError("archive ends inside a record")
            piece = rest[used : used + window]
            record += frame.decompress(piece)
            used += len(piece)
        used -= len(frame.unused_data)
        yield record
        rest = rest[used:]


def export_archives(archives: DataFrame, folder_uri: str) -> DataFrame:
    """Write each archive as ``<folder>/part-<id>.warc.zst``; returns ``path, bytes``.

    ``folder_uri`` is anything ``pyarrow.fs`` opens on the executors.  A file is
    written under another name and then renamed, so a repeated task is harmless.
    """

    def export(batches):
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder_uri)
        store.create_dir(root, recursive=True)
        for batch in batches:
            for archive, content in zip(
                batch.column("archive_id").to_pylist(),
                batch.column("content").to_pylist(),
                strict=True,
            ):
                name = f"{root}/part-{archive:06d}.warc.zst"
                draft = f"{name}.{uuid.uuid4().hex}"
                with store.open_output_stream(draft) as out:
                    out.write(content)
                store.move(draft, name)
                yield pa.RecordBatch.from_pydict({"path": [name], "bytes": [len(content)]})

    return archives.mapInArrow(export, "path string, bytes long")
