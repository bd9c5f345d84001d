"""Language identification: scripts narrow, word scores compare, Viterbi labels.

The script of a word limits the languages it may belong to.  Each word gets a
log-likelihood under every candidate from hashed byte n-grams, and a Viterbi
path over the words with a penalty for switching labels the spans of a text in
one or several languages.

The model is two small tables: n-gram weights (buckets x languages) and the
scripts each language was seen in.  Prediction is a map over the rows: no
shuffle, memory bounded by one piece of a batch.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# First code points of script ranges, and their scripts.
SCRIPT_RANGES = [
    (0x0000, "common"), (0x0041, "latin"), (0x005B, "common"), (0x0061, "latin"),
    (0x007B, "common"), (0x00AA, "latin"), (0x02B9, "common"), (0x0370, "greek"),
    (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"), (0x0600, "arabic"),
    (0x0700, "syriac"), (0x0750, "arabic"), (0x0780, "other"), (0x0900, "devanagari"),
    (0x0980, "bengali"), (0x0A00, "gurmukhi"), (0x0A80, "gujarati"), (0x0B00, "oriya"),
    (0x0B80, "tamil"), (0x0C00, "telugu"), (0x0C80, "kannada"), (0x0D00, "malayalam"),
    (0x0D80, "sinhala"), (0x0E00, "thai"), (0x0E80, "lao"), (0x0F00, "tibetan"),
    (0x1000, "myanmar"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"),
    (0x13A0, "other"), (0x1780, "khmer"), (0x1800, "mongolian"), (0x1900, "other"),
    (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "common"), (0x2C60, "latin"),
    (0x2C80, "other"), (0x3040, "kana"), (0x3100, "other"), (0x3130, "hangul"),
    (0x3190, "other"), (0x3400, "han"), (0xA000, "other"), (0xAC00, "hangul"),
    (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "latin"), (0xFB13, "other"),
    (0xFF21, "latin"), (0xFF5B, "other"), (0x20000, "han"), (0x32000, "other"),
]

# letters with the marks that combine with them; the second form is the same for ASCII
WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")
ASCII_WORD = re.compile("[A-Za-z]+")
GRAMS = (1, 2, 3, 4)
BUCKETS = 1 << 15
TRAIN_DOCS = 2000        # labelled documents per language, the bound of the sample
SWITCH_PENALTY = 8.0
SCRIPT_SHARE = 0.001     # of a language's letters: below, a script is not its own
SCRIPT_MISS = 20.0
CACHE_WORDS = 150_000
PIECE_CHARS = 2_000_000
SEED_HASH = 1_000_003

_STARTS = np.array([r[0] for r in SCRIPT_RANGES])
SCRIPTS = sorted({r[1] for r in SCRIPT_RANGES})
_NUMBERS = np.array([SCRIPTS.index(r[1]) for r in SCRIPT_RANGES])
_MIX = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    weights: np.ndarray      # float32, buckets x languages
    scripts: np.ndarray      # bool, scripts x languages


def scripts_of(words: list[str]) -> np.ndarray:
    """Script number of each word, by its first letter."""
    points = np.fromiter((ord(w[0]) for w in words), np.int64, len(words))
    return _NUMBERS[np.searchsorted(_STARTS, points, side="right") - 1]


def gram_buckets(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed byte n-grams of the words between blanks, and each one's word."""
    data = np.frombuffer((" " + " ".join(words) + " ").encode("utf-8"), np.uint8)
    blank = data == 32
    word = np.cumsum(blank) - 1
    codes = data.astype(np.uint64)
    buckets, owners = [], []
    rolling = np.zeros(len(data), np.uint64)
    for n in range(1, max(GRAMS) + 1):
        size = len(data) - n + 1
        if size <= 0:
            break
        rolling = rolling[:size] * np.uint64(257) + codes[n - 1 :] + np.uint64(1)
        # a gram may begin or end with the blank at a word's edge, not span it
        good = np.ones(size, bool)
        for k in range(1, n - 1):
            good &= ~blank[k : k + size]
        if n == 1:
            good &= ~blank
        at = np.flatnonzero(good)
        if n == 2:
            at = at[~(blank[at] & blank[at + 1])]
        hashed = (rolling[at] + np.uint64(n)) * _MIX
        buckets.append((hashed >> np.uint64(64 - 15)).astype(np.int64))
        owners.append(np.minimum(word[at], len(words) - 1))
    return np.concatenate(buckets), np.concatenate(owners)


def words_in(text: str):
    return ASCII_WORD if text.isascii() else WORD


def lower_words(text: str | None) -> list[str]:
    return words_in(text).findall(text.lower()) if text else []


def fit_language_model(
    labelled: DataFrame, text_col: str = "text", lang_col: str = "lang",
    train_docs: int = TRAIN_DOCS,
) -> LanguageModel:
    """Learn from rows with text and language.

    At most about ``train_docs`` rows of a language are used, chosen by a hash of
    the text.  What comes to the driver is one count per bucket and language.
    Without any labelled row the model knows no language and every text is ``und``.
    """
    rows = labelled.select(
        F.col(text_col).alias("text"), F.col(lang_col).alias("lang")
    ).filter("text is not null and lang is not null")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return LanguageModel(
            (), np.zeros((BUCKETS, 0), np.float32), np.zeros((len(SCRIPTS), 0), bool)
        )
    share = F.create_map(
        *[F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, train_docs / n))]
    )
    drawn = F.pmod(F.xxhash64("text"), F.lit(SEED_HASH)) / F.lit(SEED_HASH)
    chosen = rows.filter(drawn < share[F.col("lang")]).repartition(8)

    def count(batches):
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            texts, langs = batch.column("text").to_pylist(), batch.column("lang").to_pylist()
            for text, lang in zip(texts, langs, strict=True):
                words = lower_words(text)
                if words:
                    held = total.setdefault(lang, np.zeros(BUCKETS + len(SCRIPTS), np.int64))
                    held += np.bincount(
                        np.concatenate([gram_buckets(words)[0], BUCKETS + scripts_of(words)]),
                        minlength=len(held),
                    )
        for lang, held in total.items():
            at = np.flatnonzero(held)
            yield pa.RecordBatch.from_pydict(
                {
                    "lang": pa.array([lang] * len(at), pa.string()),
                    "bucket": pa.array(at, pa.int64()),
                    "n": pa.array(held[at], pa.int64()),
                }
            )

    counts = (
        chosen.mapInArrow(count, "lang string, bucket long, n long")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    languages = tuple(sorted(sizes))
    table = np.zeros((BUCKETS + len(SCRIPTS), len(languages)))
    numbers = {lang: i for i, lang in enumerate(languages)}
    table[counts["bucket"].to_numpy(int), counts["lang"].map(numbers).to_numpy(int)] = counts["n"]
    grams, scripts = table[:BUCKETS] + 0.5, table[BUCKETS:]
    weights = np.log(grams / grams.sum(0))
    seen = scripts > SCRIPT_SHARE * np.maximum(scripts.sum(0), 1)
    # overlapping grams tell the same thing about max(GRAMS) times
    return LanguageModel(
        languages, (weights / len(GRAMS)).astype(np.float32), seen
    )


def score_words(model: LanguageModel, words: list[str]) -> np.ndarray:
    """Log-likelihood of each word in each language, candidates by script only."""
    buckets, owners = gram_buckets(words)
    scores = np.empty((len(words), len(model.languages)), np.float32)
    for k in range(len(model.languages)):
        scores[:, k] = np.bincount(owners, model.weights[buckets, k], len(words))
    allowed = model.scripts[scripts_of(words)]
    unknown = ~allowed.any(1)
    scores[unknown] = 0.0
    barred = ~allowed & ~unknown[:, None]
    return scores - np.where(barred, np.float32(SCRIPT_MISS), np.float32(0))


def viterbi(scores: np.ndarray, lengths: np.ndarray, penalty: float) -> np.ndarray:
    """Best label of every word; ``lengths`` cuts ``scores`` into texts.

    All texts advance together, longest first, so a step is one array
    operation.  Ties keep the label, then take the first language.
    """
    total, k = scores.shape
    order = np.argsort(-lengths, kind="stable")
    begins = (np.cumsum(lengths) - lengths)[order]
    sizes = lengths[order]
    steps = int(sizes[0]) if len(sizes) else 0
    alive = np.searchsorted(-sizes, -np.arange(steps), side="left")
    came = np.empty((total, k), np.uint16)
    value = np.zeros((len(sizes), k), np.float32)
    columns = np.arange(k, dtype=np.uint16)
    for t in range(steps):
        at = begins[: alive[t]] + t
        now = value[: alive[t]]
        if t:
            best = now.argmax(1)
            switched = now[np.arange(len(now)), best] - penalty
            stay = now >= switched[:, None]
            came[at] = np.where(stay, columns, best[:, None])
            now = np.where(stay, now, switched[:, None])
        value[: alive[t]] = now + scores[at]
    labels = np.empty(total, np.int64)
    state = value.argmax(1)
    for t in range(steps - 1, -1, -1):
        at = begins[: alive[t]] + t
        labels[at] = state[: alive[t]]
        if t:
            state[: alive[t]] = came[at, state[: alive[t]]]
    return labels


class Labeller:
    """Word scores with a bounded cache, for one task."""

    def __init__(self, model: LanguageModel, penalty: float):
        self.model, self.penalty = model, penalty
        self.rows: dict[str, int] = {}
        self.table = np.empty((0, len(model.languages)), np.float32)

    def scores(self, words: list[str]) -> np.ndarray:
        new = list(set(words).difference(self.rows))
        if len(self.rows) + len(new) > CACHE_WORDS:
            self.rows, self.table = {}, self.table[:0]
            new = list(set(words))
        if new:
            new.sort()
            first = len(self.rows)
            self.rows.update(zip(new, range(first, first + len(new)), strict=True))
            self.table = np.concatenate([self.table, score_words(self.model, new)])
        return self.table[np.fromiter(map(self.rows.__getitem__, words), np.int64, len(words))]

    def label(self, texts: list[str | None]):
        """Of each text: language or ``und``, score, and spans ``(start, end, language)``."""
        listed = [lower_words(t) for t in texts]
        words = [w for found in listed for w in found]
        if not words or not self.model.languages:
            return [("und", 0.0, []) for _ in texts]
        labels = viterbi(
            self.scores(words), np.array([len(found) for found in listed if found]), self.penalty
        )
        letters = np.fromiter(map(len, words), np.int64, len(words))
        counts = np.array([len(found) for found in listed])
        owner = np.repeat(np.arange(len(texts)), counts)
        k = len(self.model.languages)
        shares = np.bincount(owner * k + labels, letters, len(texts) * k).reshape(-1, k)
        best, sums = shares.argmax(1), shares.sum(1)
        ends = np.cumsum(counts)
        result = []
        for i, text in enumerate(texts):
            if not counts[i]:
                result.append(("und", 0.0, []))
                continue
            own = labels[ends[i] - counts[i] : ends[i]]
            changes = np.flatnonzero(np.diff(own)) + 1
            result.append(
                (
                    self.model.languages[best[i]],
                    float(shares[i, best[i]] / sums[i]),
                    self.spans(text, own, changes),
                )
            )
        return result

    def spans(self, text: str, labels: np.ndarray, changes: np.ndarray) -> list:
        """Code point ranges; the first begins at 0, the last ends the text."""
        names = [self.model.languages[k] for k in labels[np.concatenate([[0], changes])]]
        if not len(changes):
            return [(0, len(text), names[0])]
        wanted, cuts = set(changes.tolist()), [0]
        # offsets in the text as it is: a letter that lower() lengthens may shift the count
        for i, match in enumerate(words_in(text).finditer(text)):
            if i in wanted:
                cuts.append(match.start())
        cuts += [len(text)] * (len(names) + 1 - len(cuts))
        return list(zip(cuts[:-1], cuts[1:], names, strict=True))


def detect_languages(
    docs: DataFrame,
    model: LanguageModel,
    id_col: str = "doc_id",
    text_col: str = "text",
    penalty: float = SWITCH_PENALTY,
) -> DataFrame:
    """``doc_id, lang_pred, score, spans``, one row per row.

    ``lang_pred`` is the language of most letters, ``score`` its share of the
    letters, ``spans`` the ranges of code points with their languages.  Null text
    and text without letters: ``und``, 0, no span.  A script that no language was
    seen in says nothing; its words take the label of their neighbours.  Repeated
    rows get equal results; an empty table gives no rows; other columns, whatever
    their names, are not read.
    """
    span = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())])

    def predict(batches):
        labeller = Labeller(model, penalty)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            found, piece, size = [], [], 0
            for text in texts:
                piece.append(text)
                size += len(text or "")
                if size > PIECE_CHARS:
                    found += labeller.label(piece)
                    piece, size = [], 0
            found += labeller.label(piece)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([f[0] for f in found], pa.string()),
                    pa.array([f[1] for f in found], pa.float64()),
                    pa.array(
                        [[dict(zip(("start", "end", "lang"), s, strict=True)) for s in f[2]] for f in found],
                        pa.list_(span),
                    ),
                ],
                names=["doc_id", "lang_pred", "score", "spans"],
            )

    kind = docs.select(F.col(id_col).alias("doc_id")).schema["doc_id"].dataType.simpleString()
    return docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")
    ).mapInArrow(
        predict,
        f"doc_id {kind}, lang_pred string, score double, "
        "spans array<struct<start:bigint,end:bigint,lang:string>>",
    )
