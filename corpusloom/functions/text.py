"""Text expressions.  All but Unicode composition stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.memory import memory_returner

# Suffixes and languages.
CODE_LANGUAGES = {
    ".py": "python",
    ".js": "javascript",
    ".java": "java",
    ".cpp": "cpp",
    ".c": "c",
    ".h": "c",
    ".rs": "rust",
    ".go": "go",
}
MARKUP_SUFFIXES = [".html", ".htm", ".xhtml", ".xml", ".svg"]
TOKEN_MIN = 2               # bounds of the text index, that is of match_text only
TOKEN_MAX = 20
NFC_BYTES = 4_000_000       # of text that is composed at once

# White space as str.strip and str.split see it: the Unicode White_Space
# property plus the four ASCII separators.
SPACE_CLASS = r"[\s\x1c-\x1f]"
_TOKEN_BREAK = r"[^\p{L}\p{N}]+"

# Stands for a genuine U+FFFD while malformed bytes are being dropped.  Built
# of Unicode noncharacters, which are not for interchange.
_KEPT_REPLACEMENT = "﷐﷑"


def decode_text(content: Column) -> Column:
    """UTF-8 bytes to text; malformed bytes vanish, line ends become ``\\n``."""
    raw = F.replace(content.cast("string"), F.lit("�"), F.lit(_KEPT_REPLACEMENT))
    valid = F.replace(F.make_valid_utf8(raw), F.lit("�"), F.lit(""))
    restored = F.replace(valid, F.lit(_KEPT_REPLACEMENT), F.lit("�"))
    return F.regexp_replace(restored, "\r\n?", "\n")


def compose_nfc(df: DataFrame, text_col: str) -> DataFrame:
    """Unicode NFC of a text column, a few megabytes of text at a time."""
    give_back, most = memory_returner(), NFC_BYTES

    def composed(batches):
        import unicodedata

        import pyarrow as pa
        import pyarrow.compute as pc

        for batch in batches:
            place = batch.schema.get_field_index(text_col)
            sizes = pc.fill_null(pc.binary_length(batch.column(place)), 0).to_pylist()
            start, held = 0, 0
            for end, size in enumerate(sizes, 1):
                held += size
                if held < most and end < len(sizes):
                    continue
                part = batch.slice(start, end - start)
                texts = [
                    None if t is None else unicodedata.normalize("NFC", t)
                    for t in part.column(place).to_pylist()
                ]
                columns = list(part.columns)
                columns[place] = pa.array(texts, batch.schema.field(place).type)
                yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)
                start, held = end, 0
            give_back()

    return df.mapInArrow(composed, df.schema)


def normalize_nfc(df: DataFrame, text_col: str = "text") -> DataFrame:
    """NFC form of ``text_col``.

    Text of characters below U+0300 is already composed: none of them combines
    or decomposes to anything else in NFC.  It is kept out of Python by splitting
    the rows into two branches, because a Python function inside ``when`` would
    be evaluated for every row.
    """
    composed = F.col(text_col).rlike(r"^[\x00-\x{2FF}]*\z")
    plain = df.filter(F.col(text_col).isNull() | composed)
    return plain.unionByName(compose_nfc(df.filter(~composed), text_col))


def strip(text: Column) -> Column:
    """White space, as ``str.strip`` sees it, off both ends."""
    return F.regexp_replace(text, rf"(?U)^{SPACE_CLASS}+|{SPACE_CLASS}+\z", "")


def not_blank(text: Column) -> Column:
    return text.rlike(r"(?U)[^\s\x1c-\x1f]")


def drop_blank(df: DataFrame, text_col: str = "text") -> DataFrame:
    return df.filter(not_blank(F.col(text_col)))


def tokenize(text: Column, min_len: int = 1, max_len: int | None = None) -> Column:
    """Lower-cased runs of letters and digits; bounds on their length are off by default."""
    pieces = F.split(F.lower(text), _TOKEN_BREAK)
    if max_len is None:
        return F.filter(pieces, lambda t: F.length(t) >= min_len)
    return F.filter(pieces, lambda t: F.length(t).between(min_len, max_len))


def whitespace_words(text: Column) -> Column:
    """Distinct white-space separated words."""
    pieces = F.split(text, "(?U)" + SPACE_CLASS + "+")
    return F.array_distinct(F.filter(pieces, lambda w: w != ""))


def word_hash(word: Column) -> Column:
    """28-bit hash that any SQL engine with md5 can reproduce."""
    return F.conv(F.substring(F.md5(word), 1, 7), 16, 10).cast("long")


def word_hasher():
    """A function from an Arrow array of word lists to the :func:`word_hash` of every
    word, in a row, and the number of words of each list (0 for null).

    A word is hashed once for a batch, however often it stands there.  Returned as a
    nested function so that it travels to the executors by value.
    """

    def hash_words(lists):
        import hashlib

        import numpy as np
        import pyarrow.compute as pc

        lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        coded = lists.flatten().dictionary_encode()
        words = coded.dictionary.cast("binary").to_pylist()
        digests = np.frombuffer(b"".join([hashlib.md5(w).digest() for w in words]), np.uint8)
        # the first seven hexadecimal digits
        hashes = np.ascontiguousarray(digests.reshape(-1, 16)[:, :4]).view(">u4")[:, 0].astype(np.int64) >> 4
        return hashes[coded.indices.to_numpy(zero_copy_only=False)], lengths.astype(np.int64)

    return hash_words


def suffix(path: Column) -> Column:
    """Lower-cased suffix of the last path component, or the empty string."""
    return F.lower(F.regexp_extract(path, r"[^/](\.[^./]+)\z", 1))


def content_type(suffix_col: Column) -> Column:
    return (
        F.when(suffix_col.isin(list(CODE_LANGUAGES)), F.lit("code"))
        .when(suffix_col.isin(MARKUP_SUFFIXES), F.lit("markup"))
        .otherwise(F.lit("document"))
    )


def code_language(suffix_col: Column) -> Column:
    branches = None
    for name, language in CODE_LANGUAGES.items():
        condition = suffix_col == name
        branches = (
            F.when(condition, F.lit(language))
            if branches is None
            else branches.when(condition, F.lit(language))
        )
    return branches


def splitter(suffix_col: Column) -> Column:
    """Which chunker handles a suffix: code, html, xml or document."""
    return (
        F.when(suffix_col.isin(list(CODE_LANGUAGES)), F.lit("code"))
        .when(suffix_col.isin(MARKUP_SUFFIXES) & suffix_col.startswith(".htm"), F.lit("html"))
        .when(suffix_col.isin(MARKUP_SUFFIXES), F.lit("xml"))
        .otherwise(F.lit("document"))
    )


def classify_file(df: DataFrame, path_col: str = "source") -> DataFrame:
    """Add ``file_type, content_type, language, splitter`` from the path suffix."""
    ext = suffix(F.col(path_col))
    return (
        df.withColumn("file_type", ext)
        .withColumn("content_type", content_type(F.col("file_type")))
        .withColumn("language", code_language(F.col("file_type")))
        .withColumn("splitter", splitter(F.col("file_type")))
    )


def with_metadata(df: DataFrame, path_col: str = "source") -> DataFrame:
    """Attach ``source, file_type, content_type``."""
    ext = suffix(F.col(path_col))
    return df.withColumns(
        {
            "source": F.col(path_col),
            "file_type": ext,
            "content_type": content_type(ext),
        }
    )


def flatten_payload(df: DataFrame, metadata_col: str = "metadata") -> DataFrame:
    """Metadata fields become top-level columns beside the others."""
    others = [c for c in df.columns if c != metadata_col]
    return df.select(*others, f"{metadata_col}.*")


def snippet(text: Column, n: int = 100) -> Column:
    return F.substring(text, 1, n)
