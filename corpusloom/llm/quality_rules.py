"""Quality rules as a short-circuit cascade, in DataFrame expressions only.

The cost and the rejection rate of every rule are measured on a bounded sample;
the rules then stand in the order of rejection per cost inside one CASE
expression, whose later branches are not evaluated once a rule has rejected.
The order changes the work, never the verdict.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import evaluated, staged, word_array

SAMPLE_ROWS = 2000
SEED = 11

# What the base rules count.
SYMBOLS = r"[#*$%&|<>]"
LINE_WITH_WORD = r"[^\x20\x09-\x0D]"


@dataclass(frozen=True)
class Rule:
    """A named condition that rejects; it reads the columns of :func:`text_counts`."""

    name: str
    rejects: Column


def default_rules() -> list[Rule]:
    text, n = F.col("text"), F.col("n_words")
    capitals = F.length(F.regexp_replace(text, r"[^\p{Lu}]+", ""))
    others = F.length(F.regexp_replace(text, r"[\p{L}\p{M}\x20\x09-\x0D]+", ""))
    breaks = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))
    shouts = F.regexp_count(text, F.lit(r"[!?]{2,}"))
    return [
        Rule("symbols", 4 * F.col("n_symbols") > n),
        Rule("word_length", (F.col("word_chars") < 2 * n) | (F.col("word_chars") > 14 * n)),
        Rule("repeated_lines", 10 * F.col("n_dup_lines") > 3 * (breaks + 1)),
        Rule("capitals", 2 * capitals > F.col("word_chars")),
        Rule("few_letters", 2 * others > F.col("word_chars")),
        Rule("shouting", 5 * shouts > n),
    ]


def text_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words``, longs.

    Everything happens inside the row.  Equal three-word windows are found by
    sorting the windows of the document with their positions:
    n log n in the length of the text, without a shuffle.  Words stand for
    themselves by 64-bit hashes.
    """
    text = F.col(text_col)
    kept = docs.columns
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(LINE_WITH_WORD))
    split = evaluated(docs, *kept, word_array(text).alias("_words"), lines.alias("_lines"))
    hashed = evaluated(
        split,
        *kept,
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.coalesce(F.regexp_count(text, F.lit(SYMBOLS)), F.lit(0)).cast("long").alias("n_symbols"),
        F.when(text.isNull(), F.lit(0))
        .otherwise(F.size("_lines") - F.size(F.array_distinct("_lines")))
        .cast("long")
        .alias("n_dup_lines"),
        F.transform("_words", lambda w: F.xxhash64(w)).alias("_hashes"),
    )
    # windows as structs of three word hashes and their place, sorted; zips and
    # slices are compiled, and the only lambda over all words compares neighbours
    count = F.size("_hashes") - 2
    windows = F.arrays_zip(
        F.slice("_hashes", 1, count).alias("a"),
        F.slice("_hashes", 2, count).alias("b"),
        F.slice("_hashes", 3, count).alias("c"),
        F.sequence(F.lit(0), count - 1).alias("at"),
    )
    others = [c for c in hashed.columns if c != "_hashes"]
    ordered = evaluated(
        hashed,
        *others,
        F.when(count > 0, F.sort_array(windows)).alias("_windows"),
    )
    equal_pairs = F.filter(
        F.arrays_zip(
            F.slice("_windows", 1, F.size("_windows") - 1).alias("x"),
            F.slice("_windows", 2, F.size("_windows") - 1).alias("y"),
        ),
        lambda p: (p["x"]["a"] == p["y"]["a"])
        & (p["x"]["b"] == p["y"]["b"])
        & (p["x"]["c"] == p["y"]["c"]),
    )
    pairs = evaluated(ordered, *others, equal_pairs.alias("_pairs"))
    places = pairs.select(
        *others,
        F.sort_array(
            F.array_distinct(
                F.flatten(F.transform("_pairs", lambda p: F.array(p["x"]["at"], p["y"]["at"])))
            )
        ).alias("_places"),
    )
    covered = F.aggregate(
        "_places",
        F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("total")),
        lambda a, p: F.struct(
            p.alias("last"),
            (a["total"] + F.least(F.lit(3), p - a["last"]).cast("long")).alias("total"),
        ),
        lambda a: a["total"],
    )
    return places.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long"))).drop(
        "_places"
    )


def base_failure() -> Column:
    """Fewer than 50 words, or more than half of them in repeated windows."""
    n = F.col("n_words")
    return (n < 50) | (100 * F.col("n_repeat_words") > 50 * n)


def order_rules(
    docs: DataFrame, rules: list[Rule], sample_rows: int = SAMPLE_ROWS, seed: int = SEED
) -> list[tuple[Rule, float, float]]:
    """Rules with cost (seconds) and rejection rate on a sample, best first.

    The sample has about ``sample_rows`` rows, drawn over the whole table; those
    that pass the base rules are measured.
    """
    total = docs.count()
    part = min(1.0, sample_rows / total) if total else 1.0
    sample = staged(text_counts(docs.sample(fraction=part, seed=seed)), "rule_sample")
    sample = sample.filter(~base_failure())

    def timed(rejects: Column) -> tuple[float, float]:
        started = time.perf_counter()
        rate = sample.agg(F.avg(F.coalesce(rejects, F.lit(False)).cast("double"))).first()[0]
        return time.perf_counter() - started, rate or 0.0

    timed(F.lit(False))
    idle = timed(F.lit(False))[0]
    measured = []
    for rule in rules:
        seconds, rate = timed(rule.rejects)
        measured.append((rule, max(seconds - idle, 1e-3), rate))
    return sorted(measured, key=lambda m: -m[2] / m[1])


def apply_rules(
    docs: DataFrame,
    rules: list[Rule] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """``doc_id``, the five counts, ``base_failed`` and ``kept``, a row per row.

    ``kept`` is false where the base rules fail or any rule of the cascade
    rejects; a rule whose condition is null does not reject.  Null and empty
    texts have no words and fail.  Repeated rows are judged each by itself, an
    empty table gives no rows, other columns are ignored whatever their names.
    """
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    counted = text_counts(source)
    ordered = order_rules(
        source, default_rules() if rules is None else rules, sample_rows
    )
    verdict = F.when(F.col("base_failed"), F.lit(False))
    for rule, _, _ in ordered:
        verdict = verdict.when(F.coalesce(rule.rejects, F.lit(False)), F.lit(False))
    return counted.withColumn("base_failed", base_failure()).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", verdict.otherwise(F.lit(True)).alias("kept"),
    )
