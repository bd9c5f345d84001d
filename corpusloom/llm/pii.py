"""Personal data: patterns propose, checksums confirm, context words adjust.

DataFrame expressions only, inside the row: no shuffle, no Python.  Places are
found by splitting the text at the pattern and extracting what it matched, so
that the start of a match is the length of everything before it.

Patterns are written so that they neither backtrack nor recurse on long runs
(possessive quantifiers, and a look-behind that starts a run only at its
beginning); the matches are those of the plain patterns given in ``BASE``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import evaluated

CONTEXT_CHARS = 40
THRESHOLD = 0.5

# The plain patterns of the base kinds, in the order of the kinds.
BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"


def always(hit: Column, before: Column) -> Column:
    return F.lit(True)


def is_ip(hit: Column, before: Column) -> Column:
    return hit.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$")


def is_card(hit: Column, before: Column) -> Column:
    digits = F.regexp_replace(hit, r"[\x20-]", "")
    return F.length(digits).between(14, 19) & F.call_function("luhn_check", digits)


def is_phone(hit: Column, before: Column) -> Column:
    return F.length(F.regexp_replace(hit, r"[^0-9]", "")).between(10, 15)


def is_iban(hit: Column, before: Column) -> Column:
    """ISO 7064 mod 97: letters count as 10 to 35, the first four go last."""
    compact = F.replace(hit, F.lit(" "), F.lit(""))
    moved = F.concat(F.substr(compact, F.lit(5)), F.substring(compact, 1, 4))
    rest = F.aggregate(
        F.split(moved, ""),
        F.lit(0),
        lambda a, c: F.when(
            c.rlike("^[0-9]$"), F.pmod(a * 10 + F.ascii(c) - 48, F.lit(97))
        )
        .when(c == "", a)
        .otherwise(F.pmod(a * 100 + F.ascii(c) - 55, F.lit(97))),
    )
    return F.length(compact).between(15, 34) & (rest == 1)


def stands_alone(hit: Column, before: Column) -> Column:
    return ~before.rlike(r"[0-9-]$")


def has_digit(hit: Column, before: Column) -> Column:
    return hit.rlike(r"[0-9]")


@dataclass(frozen=True)
class Kind:
    """A pattern, its validator, and the scores without and with a context word."""

    name: str
    pattern: str
    gate: Callable[[Column], Column]
    valid: Callable[[Column, Column], Column]
    score: float
    context: str
    bonus: float
    base: bool = field(default=False)


KINDS = [
    Kind(
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        lambda t: F.contains(t, F.lit("@")),
        always, 0.9, "mail|contact|write", 0.1, True,
    ),
    Kind(
        "ip",
        r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        lambda t: t.rlike(r"[0-9]\.[0-9]"),
        is_ip, 0.6, "ip|host|server|address", 0.2, True,
    ),
    Kind(
        "card",
        r"[0-9](?:[\x20-]?[0-9])++",
        lambda t: t.rlike(r"[0-9][\x20-]?[0-9]"),
        is_card, 0.8, "card|visa|credit|karte|tarjeta|carte", 0.15, True,
    ),
    Kind(
        "phone",
        r"\+[0-9][\x20().0-9-]+[0-9]",
        lambda t: F.contains(t, F.lit("+")),
        is_phone, 0.6, "phone|tel|call|fax|mobil", 0.2, True,
    ),
    Kind(
        "iban",
        r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?",
        lambda t: t.rlike(r"[A-Z]{2}[0-9]{2}"),
        is_iban, 0.75, "iban|account|bank|konto|cuenta|compte", 0.2,
    ),
    Kind(
        "ssn",
        r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
        lambda t: t.rlike(r"[0-9]-[0-9]"),
        stands_alone, 0.3, "ssn|social security|sozialversicherung", 0.5,
    ),
    Kind(
        "secret",
        r"(?:password|passwd|secret|token|api_key|apikey)\x20?[=:]\x20?[\"']?[A-Za-z0-9_+/.=-]{8,}"
        r"|AKIA[0-9A-Z]{16}",
        lambda t: t.rlike(r"(?:password|passwd|secret|token|api_?key)\x20?[=:]|AKIA"),
        has_digit, 0.7, "key|login|auth", 0.2,
    ),
]

SPAN = "struct<start:int,rank:int,end:int,kind:string,score:double>"


def find_spans(
    docs: DataFrame, text_col: str = "text", threshold: float = THRESHOLD, into: str = "spans"
) -> DataFrame:
    """Adds the column ``into``: array of ``start, rank, end, kind, score``, in that order.

    Offsets are code points, ``end`` exclusive.  Per kind the matches are leftmost
    and do not overlap; a match that its validator refuses is dropped and nothing
    inside it is tried again.  Base kinds stay whatever their score, the others
    need ``threshold``.  Kinds may overlap one another.  Null text: empty array.
    """
    text, kept = F.col(text_col), docs.columns
    cut = evaluated(
        docs,
        *kept,
        *[
            column
            for k in KINDS
            for column in (
                F.when(k.gate(text), F.split(text, k.pattern, -1)).alias(f"_p_{k.name}"),
                F.when(
                    k.gate(text), F.regexp_extract_all(text, F.lit(k.pattern), F.lit(0))
                ).alias(f"_h_{k.name}"),
            )
        ],
    )

    def ends(k: Kind) -> Column:
        pieces = F.col(f"_p_{k.name}")
        lengths = F.transform(
            f"_h_{k.name}", lambda h, i: F.length(F.get(pieces, i)) + F.length(h)
        )
        return F.aggregate(
            lengths,
            F.array(F.lit(0)),
            lambda a, n: F.array_append(a, F.element_at(a, F.lit(-1)) + n),
        )

    placed = evaluated(
        cut,
        *kept,
        *[F.col(f"_{part}_{k.name}") for k in KINDS for part in "ph"],
        *[ends(k).alias(f"_e_{k.name}") for k in KINDS],
    )

    def spans(k: Kind, rank: int) -> Column:
        pieces, after = F.col(f"_p_{k.name}"), F.col(f"_e_{k.name}")

        def span(hit, i):
            before = F.lower(F.substring(F.get(pieces, i), -CONTEXT_CHARS, CONTEXT_CHARS))
            score = F.when(before.rlike(k.context), k.score + k.bonus).otherwise(k.score)
            end = F.get(after, i + 1)
            found = F.struct(
                (end - F.length(hit)).alias("start"),
                F.lit(rank).alias("rank"),
                end.alias("end"),
                F.lit(k.name).alias("kind"),
                score.alias("score"),
            )
            return F.when(k.valid(hit, before), found)

        good = F.filter(
            F.transform(f"_h_{k.name}", span),
            lambda s: s.isNotNull() & (F.lit(k.base) | (s["score"] >= threshold)),
        )
        return F.coalesce(good, F.array().cast(f"array<{SPAN}>"))

    everything = F.concat(*[spans(k, rank) for rank, k in enumerate(KINDS)])
    return placed.select(*kept, F.sort_array(everything).alias(into))


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def count_kind(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def detect_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, found``.

    ``base_sha256`` digests the base spans, ``spans`` lists all, ``found`` has
    them with their scores.  Null and empty texts have none.  Repeated rows are
    searched each by itself; an empty table gives no rows; other columns are
    ignored whatever their names.
    """
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    found = find_spans(source)
    base_kinds = [k.name for k in KINDS if k.base]
    listed = evaluated(found, "doc_id", F.col("spans").alias("found"))
    base = F.filter("found", lambda s: s["kind"].isin(base_kinds))
    return listed.select(
        "doc_id",
        *[
            count_kind("found", name).alias(f"n_{name}") for name in base_kinds
        ],
        F.sha2(span_text(base), 256).alias("base_sha256"),
        span_text(F.col("found")).alias("spans"),
        "found",
    )


def redact(docs: DataFrame, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The same rows, with every span of personal data replaced by ``[KIND]``.

    Spans are found as in :func:`find_spans`; overlapping ones become one mark,
    that of the first.
    Null stays null, empty stays empty; rows with null or repeated ids are rows like
    others; other columns are untouched, whatever their names.
    """
    packed = docs.select(
        F.struct("*").alias("document"), F.col(text_col).cast("string").alias("text")
    )
    found = find_spans(packed, "text", threshold, into="found")
    merged = F.aggregate(
        "found",
        F.array().cast("array<struct<start:int,end:int,kind:string>>"),
        lambda a, s: F.when(
            (F.size(a) > 0) & (F.get(a, F.size(a) - 1)["end"] > s["start"]),
            F.array_append(
                F.slice(a, F.lit(1), F.size(a) - 1),
                F.struct(
                    F.get(a, F.size(a) - 1)["start"].alias("start"),
                    F.greatest(F.get(a, F.size(a) - 1)["end"], s["end"]).alias("end"),
                    F.get(a, F.size(a) - 1)["kind"].alias("kind"),
                ),
            ),
        ).otherwise(
            F.array_append(
                a, F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))
            )
        ),
    )
    ready = evaluated(found, "document", "text", merged.alias("spans"))
    text = F.col("text")
    pieces = F.transform(
        "spans",
        lambda s, i: F.concat(
            F.substr(
                text,
                F.coalesce(F.get(F.col("spans"), i - 1)["end"], F.lit(0)) + 1,
                s["start"] - F.coalesce(F.get(F.col("spans"), i - 1)["end"], F.lit(0)),
            ),
            F.lit("["), F.upper(s["kind"]), F.lit("]"),
        ),
    )
    tail = F.substr(text, F.get(F.col("spans"), F.size("spans") - 1)["end"] + 1)
    clean = F.when(F.size("spans") == 0, text).otherwise(
        F.concat(F.array_join(pieces, ""), tail)
    )
    return ready.select(
        *[
            clean.alias(c) if c == text_col else F.col("document").getField(c).alias(c)
            for c in docs.columns
        ]
    )
