"""Hybrid search over chunks, and the quantization recall benchmark."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.memory import settled
from corpusloom.operators.embedding import embed_documents, embed_queries
from corpusloom.operators.evaluate import exact_ground_truth, mean_recall, recall_at_k
from corpusloom.operators.joins import lookup_join
from corpusloom.operators.quantize import int8_fit, int8_quantize, quantized_topk
from corpusloom.operators.search import (
    attach_payload,
    coverage_score,
    coverage_terms,
    dense_topk,
    exact_rescore,
    few_rows,
    limit_per_query,
    min_score,
    rerank,
    rrf_fuse,
    sparse_topk,
    union_candidates,
)
from corpusloom.operators.sparse import (
    bm25_weights,
    corpus_stats,
    expand_terms,
    idf_table,
    term_counts,
    term_neighbours,
    vocabulary,
)
from corpusloom.settings import FUSED_FACTOR, LIMIT, PREFETCH_FACTOR, ensure_checkpoint_dir
from corpusloom.sources.collection import Collection
from corpusloom.sources.files import sample_first

COVERAGE = "coverage"


def bm25_search(queries: DataFrame, chunks: DataFrame, limit: int = LIMIT) -> DataFrame:
    """``query_id, chunk_id, score, rank`` by BM25 alone."""
    counts = term_counts(chunks)
    terms = vocabulary(counts)
    stats = corpus_stats(chunks)
    weights = bm25_weights(chunks, stats=stats, counts=counts)
    wanted = bm25_weights(
        queries, "query_id", "query", stats=stats, counts=term_counts(queries, "query_id", "query")
    )
    return sparse_topk(wanted, weights, limit, idf=idf_table(terms, stats))


class Asked(NamedTuple):
    """What the sparse channels and the reranker read, counted once."""

    query_counts: DataFrame     # query_id, dl, term, tf
    wide_queries: DataFrame     # query_id, term, weight
    postings: DataFrame         # chunk_id, dl, term, tf: terms the queries can reach
    terms: DataFrame            # term, df of those
    stats: DataFrame
    neighbours: DataFrame


def asked_postings(
    queries: DataFrame,
    chunks: DataFrame,
    neighbours: DataFrame | None = None,
    counts: DataFrame | None = None,
    stats: DataFrame | None = None,
) -> Asked:
    """Count the terms of the chunks in one pass, for the terms in question only.

    A query reaches its own terms, their neighbours, and the terms that have one
    of those as a neighbour.  Other postings take part in no score, no document
    frequency and no weight that is read, so they go before anything is
    aggregated.  What is left is checkpointed: all channels read it.
    """
    ensure_checkpoint_dir(chunks.sparkSession)
    if neighbours is None:
        # used for documents and for queries: computed once
        neighbours = settled(lambda: term_neighbours(chunks))
    query_counts = term_counts(queries, "query_id", "query")
    wide_queries = expand_terms(query_counts, neighbours, "query_id").checkpoint()
    asked = wide_queries.select("term").distinct()
    bringing = lookup_join(
        neighbours.select("term", "neighbour"),
        asked.withColumnRenamed("term", "neighbour"), ["neighbour"], "term",
    )
    reached = asked.unionByName(bringing.select("term")).distinct().checkpoint()
    counts = term_counts(chunks) if counts is None else counts
    postings = lookup_join(counts, reached, ["term"], "chunk_id").select(
        "chunk_id", "dl", "term", "tf"
    ).checkpoint()
    stats = (corpus_stats(chunks) if stats is None else stats).checkpoint()
    return Asked(
        query_counts, wide_queries, postings, vocabulary(postings).checkpoint(), stats, neighbours
    )


def channel_hits(
    queries: DataFrame,
    chunks: DataFrame,
    per_channel: int,
    embedder: Callable[[Column], Column] | None = None,
    asked: Asked | None = None,
    allowed: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Best chunks of the dense, expanded and bm25 channels.

    ``chunks`` without a ``dense`` column is embedded on the way.  ``asked`` is
    the result of :func:`asked_postings`, where that has been called already.
    ``allowed`` (``query_id, chunk_id``, each pair once) names the only pairs
    that may be found; every channel ranks after it, and the dense one computes
    no other pair.
    """
    asked = asked_postings(queries, chunks) if asked is None else asked
    if "dense" in chunks.columns:
        vectors = chunks
    else:
        vectors = embed_documents(
            chunks.select("chunk_id", "text").repartition("chunk_id"), embedder
        )
    only = asked.wide_queries.select("term").distinct()
    points = embed_queries(queries, embedder)
    return {
        "dense": dense_topk(points, vectors, per_channel)
        if allowed is None
        else exact_rescore(allowed, points, vectors, per_channel),
        "expanded": sparse_topk(
            asked.wide_queries,
            expand_terms(asked.postings, asked.neighbours, only=only),
            per_channel,
            allowed=allowed,
        ),
        "bm25": sparse_topk(
            bm25_weights(
                queries, "query_id", "query", stats=asked.stats, counts=asked.query_counts
            ),
            bm25_weights(chunks, stats=asked.stats, counts=asked.postings),
            per_channel,
            idf=idf_table(asked.terms, asked.stats),
            allowed=allowed,
        ),
    }


def hybrid_search(
    queries: DataFrame,
    chunks: DataFrame,
    limit: int = LIMIT,
    embedder: Callable[[Column], Column] | None = None,
    scorer: str | Callable[[DataFrame], Column] | None = COVERAGE,
    neighbours: DataFrame | None = None,
    counts: DataFrame | None = None,
    stats: DataFrame | None = None,
    threshold: float | None = None,
    prefetch_factor: int = PREFETCH_FACTOR,
    fused_factor: int = FUSED_FACTOR,
    where: Column | str | None = None,
    allowed: DataFrame | None = None,
) -> DataFrame:
    """Answer a table ``query_id, query`` over ``chunk_id, text, ...``.

    Each channel gives ``prefetch_factor * limit`` candidates; fusion keeps
    ``fused_factor * limit``; reranking orders those and ``limit`` remain.
    ``scorer=None`` keeps the fused order.  The result has ``query_id, rank,
    chunk_id, score, [rerank_score,]`` and the chunk's other columns.

    Two filters act below the channels, so a query gets ``limit`` hits wherever
    so many chunks match.  ``where`` is a condition on the chunk's columns, the
    same for all queries: other chunks are not there at all, also not for
    statistics, document frequencies and neighbours that are not given.
    ``allowed`` (``query_id, chunk_id``) lists what each query may find, such as
    the result of :func:`match_text`; weights stay those of all chunks, and a
    query without a row there finds nothing.
    """
    if where is not None:
        chunks = chunks.filter(where)
        if counts is not None:
            counts = counts.join(chunks.select("chunk_id"), "chunk_id", "left_semi")
        stats = None
    if allowed is not None:
        ensure_checkpoint_dir(chunks.sparkSession)
        allowed = allowed.select("query_id", "chunk_id").distinct().checkpoint()
    asked = asked_postings(queries, chunks, neighbours, counts, stats)
    hits = channel_hits(queries, chunks, prefetch_factor * limit, embedder, asked, allowed)
    fused = rrf_fuse(union_candidates(**hits), fused_factor * limit)
    payload = [c for c in chunks.columns if c not in ("chunk_id", "dense")]
    small = few_rows(queries, fused_factor * limit)
    candidates = attach_payload(fused, chunks, payload, small=small)
    if scorer is None:
        best = limit_per_query(candidates, limit)
        shown = ["query_id", "rank", "chunk_id", "score"]
    else:
        if scorer == COVERAGE:
            wanted = coverage_terms(queries, idf_table(asked.terms, asked.stats), asked.stats)
            candidates = candidates.join(wanted, "query_id", "left")
            scorer = coverage_score(
                F.coalesce("terms", F.create_map().cast("map<string,double>")), F.col("text")
            )
        else:
            candidates = candidates.join(queries.select("query_id", "query"), "query_id")
        # few rows, dear scores: spread them evenly whatever files they came from
        best = rerank(candidates.repartition("query_id", "chunk_id"), scorer, limit)
        shown = ["query_id", "rank", "chunk_id", "score", "rerank_score"]
    if threshold is not None:
        best = min_score(best, threshold, "score" if scorer is None else "rerank_score")
    return best.select(*shown, *payload)


def search_collection(collection: Collection, queries: DataFrame, **options) -> DataFrame:
    """:func:`hybrid_search` over a stored collection: its postings and vectors
    are read, not computed again."""
    chunks = collection.chunks().drop("version", "dl")
    options.setdefault("neighbours", collection.neighbours())
    return hybrid_search(
        queries, chunks, counts=collection.postings(), stats=collection.stats(), **options
    )


def quantization_benchmark(
    queries: DataFrame,
    corpus: DataFrame,
    k: int = LIMIT,
    id_col: str = "chunk_id",
    rescore: bool = True,
) -> DataFrame:
    """``mean_recall`` of INT8 search against exact search, over all queries.

    ``queries`` has ``query_id, vector``, ``corpus`` has ``id, dense``.
    """
    if queries.isEmpty():
        raise ValueError("the benchmark needs at least one query")
    bounds = int8_fit(corpus)
    codes = int8_quantize(corpus, bounds)
    truth = exact_ground_truth(queries, corpus, k, id_col=id_col)
    found = quantized_topk(
        queries, codes, bounds, k, corpus if rescore else None, id_col=id_col
    )
    return mean_recall(recall_at_k(queries, truth, found, k, id_col))


def benchmark_sources(
    documents: DataFrame,
    queries: DataFrame,
    k: int = LIMIT,
    n_sources: int = 20,
    embedder: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """The whole benchmark: chunk the first sources, embed, compare recalls."""
    from corpusloom.plans.corpus import process_corpus

    ensure_checkpoint_dir(documents.sparkSession)
    chunks = process_corpus(sample_first(documents, n_sources), embedder)
    corpus = embed_documents(chunks.select("chunk_id", "text"), embedder).select(
        "chunk_id", "dense"
    ).checkpoint()
    return quantization_benchmark(embed_queries(queries, embedder), corpus, k)

