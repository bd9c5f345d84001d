"""Sparse term vectors: BM25 weights, IDF, and the expanded-term channel.

Postings are long tables ``chunk_id, term, ...`` partitioned by ``chunk_id``.
All terms of a chunk then sit in one task, so term counts, weights and later
the per-chunk score need no further shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusloom.functions.rows import explode_items, posexplode_items
from corpusloom.functions.text import tokenize
from corpusloom.operators.joins import heaviest, lookup_join
from corpusloom.settings import BM25_B, BM25_K1, BROADCAST_ROWS, ensure_checkpoint_dir

SPAN = 4
NEIGHBOURS = 3
MIN_STRENGTH = 0.0          # associations above it count
MIN_PAIRS = 1
EXPANSION_SCALE = 0.5
PART_BYTES = 8_000_000      # of text in a part
PAIR_PART_BYTES = 16_000_000    # where pairs are counted: larger parts send fewer counts


def place_texts(
    df: DataFrame, id_col: str, text_col: str, part_bytes: int | None = None
) -> DataFrame:
    """The texts, partitioned by id into as many parts as their bytes ask for.

    A task that counts the terms of its texts, or adds up their scores, then
    needs the same memory however large the table is.
    """
    texts = df.select(id_col, text_col)
    held = texts.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    least = df.sparkSession.sparkContext.defaultParallelism
    return texts.repartition(max(least, -(-held // (part_bytes or PART_BYTES))), id_col)


def term_counts(
    df: DataFrame, id_col: str = "chunk_id", text_col: str = "text", colocate: bool = True
) -> DataFrame:
    """``chunk_id, dl, term, tf``: token counts, with the chunk's token count.

    ``colocate`` sends the texts to partitions by id first; leave it out for a
    table that is bucketed by the id already.
    """
    texts = place_texts(df, id_col, text_col) if colocate else df.select(id_col, text_col)
    tokens = texts.select(id_col, tokenize(F.col(text_col)).alias("tokens"))
    terms = explode_items(tokens, [id_col, F.size("tokens").alias("dl")], F.col("tokens"), "term")
    return terms.groupBy(id_col, "dl", "term").agg(F.count("*").alias("tf"))


def corpus_stats(
    df: DataFrame, id_col: str = "chunk_id", text_col: str = "text", colocate: bool = True
) -> DataFrame:
    """One row ``n_chunks, avg_len``: number of chunks and mean token count.

    The texts are placed as in :func:`term_counts`, so a plan that uses both
    moves them once.
    """
    texts = place_texts(df, id_col, text_col) if colocate else df.select(id_col, text_col)
    return texts.select(F.size(tokenize(F.col(text_col))).alias("dl")).agg(
        F.count("*").alias("n_chunks"), F.avg("dl").alias("avg_len")
    )


def vocabulary(counts: DataFrame) -> DataFrame:
    """``term, df``: number of chunks that have the term.

    ``counts`` holds each chunk and term once, so rows are counted map-side and
    only the vocabulary is shuffled.
    """
    return counts.groupBy("term").agg(F.count("*").alias("df"))


def saturated_tf(tf: Column, dl: Column, avg_len: Column, k1: float, b: float) -> Column:
    return tf * (k1 + 1) / (tf + k1 * (1 - b + b * dl / avg_len))


def bm25_weights(
    df: DataFrame,
    id_col: str = "chunk_id",
    text_col: str = "text",
    k1: float = BM25_K1,
    b: float = BM25_B,
    stats: DataFrame | None = None,
    counts: DataFrame | None = None,
) -> DataFrame:
    """``chunk_id, term, weight``: term part of BM25, without IDF."""
    stats = corpus_stats(df, id_col, text_col) if stats is None else stats
    counts = term_counts(df, id_col, text_col) if counts is None else counts
    avg_len = stats.select("avg_len").scalar()
    weight = saturated_tf(F.col("tf"), F.col("dl"), avg_len, k1, b)
    return counts.select(id_col, "term", weight.alias("weight"))


def idf_table(terms: DataFrame, n_chunks: DataFrame) -> DataFrame:
    """``term, df, idf`` from :func:`vocabulary` and the one-row chunk count."""
    total = n_chunks.select("n_chunks").scalar()
    return terms.select(
        "term",
        "df",
        F.log(1 + (total - F.col("df") + 0.5) / (F.col("df") + 0.5)).alias("idf"),
    )


def coded_tokens(
    df: DataFrame, id_col: str, text_col: str, colocate: bool, seed: int
) -> DataFrame:
    """``tokens, codes``: the tokens of a text and a 64-bit hash of each."""
    texts = df.select(id_col, text_col)
    if colocate:
        texts = place_texts(df, id_col, text_col, PAIR_PART_BYTES)
    tokens = texts.select(tokenize(F.col(text_col)).alias("tokens"))
    return tokens.select(
        "tokens", F.transform("tokens", lambda t: F.xxhash64(t, F.lit(seed))).alias("codes")
    )


def coded_terms(
    df: DataFrame, id_col: str, text_col: str, colocate: bool
) -> tuple[DataFrame, int]:
    """``term, code`` of all terms, and the seed under which no two share a code."""
    seed = 0
    while True:
        coded = coded_tokens(df, id_col, text_col, colocate, seed)
        terms = (
            explode_items(coded, [], F.arrays_zip("tokens", "codes"), "t")
            .select(F.col("t.tokens").alias("term"), F.col("t.codes").alias("code"))
            .distinct()
            .checkpoint()
        )
        if terms.groupBy("code").agg(F.count("*").alias("n")).filter("n > 1").isEmpty():
            return terms, seed
        seed += 1


def neighbouring(coded: DataFrame, span: int) -> DataFrame:
    """``a, b`` with a < b: the codes of two different terms within ``span`` tokens.

    A text's tokens are paired with the same tokens moved by one to ``span``
    places, inside its row: nothing is sorted, and a long text is one row of
    linear size.
    """
    count = F.size("codes")
    moved = [
        F.arrays_zip(
            F.slice("codes", F.lit(1), F.greatest(count - step, F.lit(0))).alias("x"),
            F.slice("codes", F.lit(1 + step), F.greatest(count - step, F.lit(0))).alias("y"),
        )
        for step in range(1, span + 1)
    ]
    met = explode_items(coded, [], F.flatten(F.array(*moved)), "p").select("p.x", "p.y")
    return met.filter("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))


def term_neighbours(
    df: DataFrame,
    id_col: str = "chunk_id",
    text_col: str = "text",
    span: int = SPAN,
    top: int = NEIGHBOURS,
    min_pairs: int = MIN_PAIRS,
    min_strength: float = MIN_STRENGTH,
    colocate: bool = True,
    max_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """``term, neighbour, strength``: the ``top`` most strongly associated terms.

    Strength is normalized pointwise mutual information over windows of
    neighbouring tokens, at most 1; every association above ``min_strength``
    takes part, by default every positive one.  ``colocate`` spreads the texts
    first, which a table of few or uneven files needs; leave it out where the
    files are many or bucketed, and no text is shuffled.

    Pairs are counted as pairs of 64-bit codes, checked to be unique, and never
    stored: the totals of the terms are counted from the texts beforehand.  The
    totals of the most frequent terms, at most ``max_rows``, are broadcast, so
    only pairs with a rare term are moved to meet theirs.
    """
    ensure_checkpoint_dir(df.sparkSession)
    terms, seed = coded_terms(df, id_col, text_col, colocate)
    met = neighbouring(coded_tokens(df, id_col, text_col, colocate, seed), span)
    margins = (
        met.select(F.explode(F.array("a", "b")).alias("code"))
        .groupBy("code")
        .agg(F.count("*").alias("m"))
    )
    # place: numbers in the order of the terms, so that ties are broken without strings
    words = (
        terms.join(margins, "code")
        .orderBy("term")
        .select("term", "code", "m", F.monotonically_increasing_id().alias("place"))
        .checkpoint()
    )
    total = words.agg(F.sum("m").alias("s")).scalar()
    pairs = met.groupBy("a", "b").agg(F.count("*").alias("n")).filter(F.col("n") >= min_pairs)

    def margin(rows: DataFrame, side: str) -> DataFrame:
        return rows.select(
            F.col("code").alias(side), F.col("m").alias(f"m{side}"), F.col("place").alias(f"p{side}")
        )

    least = heaviest(words, "m", max_rows)
    often = words if least is None else words.filter(F.col("m") >= least)
    known = pairs.join(F.broadcast(margin(often, "a")), "a", "left").join(
        F.broadcast(margin(often, "b")), "b", "left"
    )
    linked = known.filter("ma is not null and mb is not null")
    if least is not None:
        rare = known.filter("ma is null or mb is null").select("a", "b", "n")
        linked = linked.unionByName(rare.join(margin(words, "a"), "a").join(margin(words, "b"), "b"))
    information = F.log(
        F.col("n").cast("double") * total / (F.col("ma").cast("double") * F.col("mb"))
    )
    strength = F.round(information / -F.log(F.col("n") / total), 6)
    linked = linked.select("pa", "pb", strength.alias("strength")).filter(
        F.col("strength") > min_strength
    )
    both_ways = linked.select(
        F.explode(
            F.array(
                F.struct(F.col("pa").alias("place"), F.col("pb").alias("near")),
                F.struct(F.col("pb").alias("place"), F.col("pa").alias("near")),
            )
        ).alias("p"),
        "strength",
    ).select("p.place", "p.near", "strength")
    order = Window.partitionBy("place").orderBy(F.desc("strength"), "near")
    best = (
        both_ways.withColumn("rn", F.row_number().over(order))
        .filter(F.col("rn") <= top)
        .drop("rn")
    )
    named = lookup_join(best, words.select("place", "term"), ["place"], "near", max_rows)
    near = words.select(F.col("place").alias("near"), F.col("term").alias("neighbour"))
    return lookup_join(named, near, ["near"], "place", max_rows).select(
        "term", "neighbour", "strength"
    )


def expand_terms(
    counts: DataFrame,
    neighbours: DataFrame,
    id_col: str = "chunk_id",
    scale: float = EXPANSION_SCALE,
    only: DataFrame | None = None,
) -> DataFrame:
    """``chunk_id, term, weight``: own terms plus weaker related terms.

    The own weight is ``ln(1 + tf)``; a neighbour gets ``scale * strength`` of
    the weight of the term that brought it in, and the largest value counts.
    Any table ``term, neighbour, strength`` may take the place of
    :func:`term_neighbours`, and any ``id, term, weight`` table the place of
    this function's result.

    ``only`` (``term``, distinct) names the terms that will be looked at, such
    as those of the queries; weights of other terms are not computed.
    """
    weight = F.log1p(F.col("tf").cast("double")).alias("weight")
    weighted = counts.select(id_col, "term", weight)
    factors = neighbours.select(
        "term", F.col("neighbour").alias("target"), (F.col("strength") * scale).alias("factor")
    )
    if only is None:
        brought = lookup_join(weighted, factors, ["term"], salt_col=id_col)
        expanded = weighted.select(
            id_col, F.col("term").alias("target"), "weight", F.lit(1.0).alias("factor")
        ).unionByName(brought.select(id_col, "target", "weight", "factor"))
    else:
        # an asked term brings itself in with factor 1: one join serves both kinds
        asked = only.select(F.col("term").alias("target"))
        near = lookup_join(factors, asked, ["target"], salt_col="term")
        itself = asked.select(F.col("target").alias("term"), "target", F.lit(1.0).alias("factor"))
        expanded = lookup_join(
            weighted, itself.unionByName(near.select("term", "target", "factor")), ["term"],
            salt_col=id_col,
        )
    return expanded.groupBy(id_col, F.col("target").alias("term")).agg(
        F.max(F.col("weight") * F.col("factor")).alias("weight")
    )


def embed_sparse(
    df: DataFrame,
    neighbours: DataFrame,
    id_col: str = "chunk_id",
    text_col: str = "text",
    stats: DataFrame | None = None,
) -> DataFrame:
    """``chunk_id, channel, term, weight`` for channels ``bm25`` and ``expanded``.

    Documents and queries take the same path, so query weights are saturated as
    well; pass the corpus ``stats`` when embedding queries.
    """
    counts = term_counts(df, id_col, text_col)
    plain = bm25_weights(df, id_col, text_col, stats=stats, counts=counts)
    wide = expand_terms(counts, neighbours, id_col)
    return plain.select(id_col, F.lit("bm25").alias("channel"), "term", "weight").unionByName(
        wide.select(id_col, F.lit("expanded").alias("channel"), "term", "weight")
    )
