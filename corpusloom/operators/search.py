"""Ranking: dense, sparse, approximate and quantized top-k, fusion, reranking.

Queries are a table, and every operator answers all of them at once.  Hits are
``query_id, chunk_id, score, rank``.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from corpusloom.functions.rows import explode_items
from corpusloom.functions.text import TOKEN_MAX, TOKEN_MIN, tokenize
from corpusloom.functions.vectors import cosine_pairs, score_round
from corpusloom.operators.joins import fits_broadcast, lookup_join
from corpusloom.settings import BROADCAST_BYTES, BROADCAST_ROWS, RRF_K, SCORE_DIGITS

GROUP_LIMIT = 1000          # default of spark.sql.optimizer.windowGroupLimitThreshold
RANK_PARTS = 64
GRID_ROWS = 65_536          # vectors per block when the queries are too many to broadcast
GRID_DIM = 64               # of longer vectors there are fewer, down to GRID_LEAST
GRID_LEAST = 4096


def rank_hits(
    scored: DataFrame, k: int, id_col: str = "chunk_id", query_col: str = "query_id"
) -> DataFrame:
    """Best ``k`` rows per query; ties go to the smaller id.

    Up to ``GROUP_LIMIT`` Spark keeps k rows a query in each task before the
    shuffle.  For larger k the rows of a query are first ranked in salted parts,
    so that one query's matches never meet in one task unreduced.
    """
    best_first = [F.desc("score"), F.col(id_col)]
    if k > GROUP_LIMIT:
        part = Window.partitionBy(query_col, "_part").orderBy(*best_first)
        scored = (
            scored.withColumn("_part", F.pmod(F.xxhash64(id_col), F.lit(RANK_PARTS)))
            .withColumn("_rank", F.row_number().over(part))
            .filter(F.col("_rank") <= k)
            .drop("_part", "_rank")
        )
    order = Window.partitionBy(query_col).orderBy(*best_first)
    return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def limit_per_query(hits: DataFrame, limit: int) -> DataFrame:
    return hits.filter(F.col("rank") <= limit)


def min_score(hits: DataFrame, threshold: float, score_col: str = "score") -> DataFrame:
    return hits.filter(F.col(score_col) >= threshold)


# --------------------------------------------------------------------- sparse


def sparse_dot(
    query_terms: DataFrame,
    postings: DataFrame,
    id_col: str = "chunk_id",
    idf: DataFrame | None = None,
) -> DataFrame:
    """``query_id, chunk_id, score``: sum over shared terms of weight products.

    ``idf`` multiplies each term by its inverse document frequency.  It is
    joined to the query terms, which are few, and never to the postings.  With
    postings partitioned by chunk the sum needs no shuffle.
    """
    terms = query_terms.select("query_id", "term", F.col("weight").alias("query_weight"))
    if idf is not None:
        vocabulary = terms.select("term").distinct()
        if fits_broadcast(vocabulary):
            known = idf.join(F.broadcast(vocabulary), "term", "left_semi")
        else:
            known = idf
        terms = terms.join(known.select("term", "idf"), "term").select(
            "query_id", "term", (F.col("query_weight") * F.col("idf")).alias("query_weight")
        )
    matched = lookup_join(
        postings.select(id_col, "term", "weight"), terms, ["term"], id_col,
        bound=query_terms.select("term"),
    )
    return matched.groupBy("query_id", id_col).agg(
        score_round(F.sum(F.col("query_weight") * F.col("weight"))).alias("score")
    )


def sparse_topk(
    query_terms: DataFrame,
    postings: DataFrame,
    k: int,
    id_col: str = "chunk_id",
    idf: DataFrame | None = None,
    allowed: DataFrame | None = None,
) -> DataFrame:
    """Best ``k`` chunks per query among those sharing a term with it.

    ``allowed`` (``query_id``, id) leaves only the pairs it lists, before ranking.
    """
    scored = sparse_dot(query_terms, postings, id_col, idf)
    if allowed is not None:
        scored = scored.join(allowed, ["query_id", id_col], "left_semi")
    return rank_hits(scored, k, id_col)


def match_text(query_texts: DataFrame, postings: DataFrame, id_col: str = "chunk_id") -> DataFrame:
    """``query_id, chunk_id``: chunks that contain every token of the query.

    Like a text index, it looks at tokens of TOKEN_MIN to TOKEN_MAX letters only.
    """
    indexed = tokenize(F.col("query"), TOKEN_MIN, TOKEN_MAX)
    terms = query_texts.select("query_id", F.array_distinct(indexed).alias("tokens"))
    wanted = explode_items(
        terms, ["query_id", F.size("tokens").alias("wanted")], F.col("tokens"), "term"
    )
    return (
        lookup_join(postings.select(id_col, "term"), wanted, ["term"], id_col)
        .groupBy("query_id", "wanted", id_col)
        .agg(F.count("*").alias("found"))
        .filter("found = wanted")
        .select("query_id", id_col)
    )


# ---------------------------------------------------------------------- dense


def _block_scorer(k: int, digits: int):
    """Score a block of corpus vectors against a block of queries.

    Returned as a nested function so that it travels to the executors by value.
    """

    def best(running, query_ids, query_matrix, ids, matrix, allowed):
        import numpy as np
        import pandas as pd

        norms = np.sqrt((matrix * matrix).sum(axis=1))
        good = norms > 0
        if not good.any():
            return running
        unit = matrix[good] / norms[good, None]
        ids = ids[good]
        allowed = None if allowed is None else allowed[:, good]
        parts = [] if running is None else [running]
        step, scale = max(1, 8_000_000 // max(1, len(ids))), 10.0**digits

        def rounded(x):
            return np.sign(x) * np.floor(np.abs(x) * scale + 0.5) / scale

        for start in range(0, len(query_ids), step):
            scores = query_matrix[start : start + step] @ unit.T
            if allowed is not None:
                scores = np.where(allowed[start : start + step], scores, -np.inf)
            if scores.shape[1] > k:
                cut = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
                # rounding keeps the order: nothing further below can tie with the cut
                keep = scores >= (cut - 1.0 / scale)[:, None]
            else:
                cut = np.full(len(scores), -np.inf)
                keep = np.ones_like(scores, dtype=bool)
            keep &= scores > -np.inf
            rows, columns = np.nonzero(keep)
            kept, cut = rounded(scores[rows, columns]), rounded(cut)
            tied = kept >= cut[rows]
            rows, columns = rows[tied], columns[tied]
            parts.append(
                pd.DataFrame({"q": rows + start, "id": ids[columns], "score": kept[tied]})
            )
        merged = pd.concat(parts, ignore_index=True)
        merged = merged.sort_values(
            ["q", "score", "id"], ascending=[True, False, True], kind="stable"
        )
        return merged.groupby("q", sort=False).head(k)

    return best


def _unit_rows():
    def unit(vectors):
        import numpy as np

        matrix = np.array([np.asarray(v, dtype=np.float64) for v in vectors])
        norms = np.sqrt((matrix * matrix).sum(axis=1))
        return matrix / np.where(norms > 0, norms, 1.0)[:, None], norms > 0

    return unit


def query_size(queries: DataFrame, query_vec_col: str) -> tuple[int, int]:
    """Number of queries, and the largest vector length among them."""
    row = queries.agg(
        F.count("*").alias("n"), F.max(F.size(query_vec_col)).alias("dim")
    ).first()
    return row["n"], max(1, row["dim"] or 1)


def grid_blocks(n_queries: int, n_vectors: int, dim: int, parallelism: int) -> tuple[int, int]:
    """Blocks of queries and of vectors, each of which is copied for every block of the other.

    Blocks are as large as a task can hold, so that copies are few; but no fewer
    than give every core two pairs of them.
    """
    rows = max(min(GRID_ROWS, GRID_LEAST), GRID_ROWS * GRID_DIM // max(dim, GRID_DIM))
    least = math.ceil(math.sqrt(2 * parallelism))
    return max(least, -(-n_queries // rows)), max(least, -(-n_vectors // rows))


def dense_topk(
    queries: DataFrame,
    corpus: DataFrame,
    k: int,
    id_col: str = "chunk_id",
    vec_col: str = "dense",
    query_vec_col: str = "vector",
    cell_col: str | None = None,
    probes_col: str | None = None,
    bounds: DataFrame | None = None,
    max_bytes: int = BROADCAST_BYTES,
    digits: int = SCORE_DIGITS,
) -> DataFrame:
    """Exact best cosine per query, as matrix products over corpus blocks.

    Every task scores its part of the corpus against all queries and emits only
    its best ``k`` per query, so no query-chunk pairs are shuffled and the
    corpus is read once, in place.  The query matrix is broadcast when its
    size, checked first, is within ``max_bytes``; otherwise queries and corpus
    are both cut into blocks of bounded size and met block by block.

    ``cell_col``/``probes_col`` restrict a query to the corpus cells it lists.
    ``bounds`` (``lo, hi``) marks ``vec_col`` as INT8 codes.
    Zero vectors score nothing.
    """
    query_fields = ["query_id", query_vec_col] + ([probes_col] if probes_col else [])
    queries = queries.select(*query_fields)
    fields = [id_col, vec_col] + ([cell_col] if cell_col else [])
    # Empty vectors are left out inside the tasks: a filter on a vector would be
    # moved below the repartition and compute the vectors a second time there.
    corpus = corpus.select(*fields)
    limits = None if bounds is None else tuple(bounds.select("lo", "hi").first())
    schema = T.StructType(
        [
            T.StructField("query_id", queries.schema["query_id"].dataType),
            T.StructField(id_col, corpus.schema[id_col].dataType),
            T.StructField("score", T.DoubleType()),
        ]
    )
    n_queries, dim = query_size(queries, query_vec_col)
    # the matrix, and the running best k per query kept by each task
    needed = n_queries * (8 * dim + 48 * k)
    best, unit = _block_scorer(k, digits), _unit_rows()

    def filled(part, column):
        lengths = part[column].map(lambda v: 0 if v is None else len(v))
        return part[lengths > 0].reset_index(drop=True)

    def matrix_of(column):
        import numpy as np

        matrix = np.array([np.asarray(v, dtype=np.float64) for v in column])
        if limits is None:
            return matrix
        low, high = limits
        return low + (matrix + 128.0) / 255.0 * (high - low)

    def probe_mask(probes, cells):
        import numpy as np

        return np.array([np.isin(cells, np.asarray(p)) for p in probes])

    if needed <= max_bytes:
        block = filled(queries.toPandas(), query_vec_col)
        if len(block) == 0:
            return _empty(corpus, schema)
        matrix, usable = unit(block[query_vec_col])
        block = block[usable].reset_index(drop=True)
        shared = corpus.sparkSession.sparkContext.broadcast(
            (
                block["query_id"].to_numpy(),
                matrix[usable],
                list(block[probes_col]) if probes_col else None,
            )
        )

        def score(batches):
            query_ids, query_matrix, probes = shared.value
            running = None
            for batch in batches:
                batch = filled(batch, vec_col)
                if len(batch) == 0 or len(query_ids) == 0:
                    continue
                allowed = probe_mask(probes, batch[cell_col].to_numpy()) if probes else None
                running = best(
                    running, query_ids, query_matrix, batch[id_col].to_numpy(),
                    matrix_of(batch[vec_col]), allowed,
                )
            if running is not None:
                out = running.rename(columns={"id": id_col})
                out.insert(0, "query_id", query_ids[out.pop("q").to_numpy()])
                yield out[["query_id", id_col, "score"]]

        partial = corpus.mapInPandas(score, schema)
    else:
        query_blocks, corpus_blocks = grid_blocks(
            n_queries, corpus.count(), dim, corpus.sparkSession.sparkContext.defaultParallelism
        )
        left = queries.withColumn(
            "_q", F.pmod(F.xxhash64("query_id"), F.lit(query_blocks)).cast("long")
        ).withColumn("_c", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(corpus_blocks - 1).cast("long"))))
        right = corpus.withColumn(
            "_c", F.pmod(F.xxhash64(id_col), F.lit(corpus_blocks)).cast("long")
        ).withColumn("_q", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(query_blocks - 1).cast("long"))))

        def score_block(query_part, corpus_part):
            import pandas as pd

            running = None
            query_part = filled(query_part, query_vec_col)
            corpus_part = filled(corpus_part, vec_col)
            if len(query_part) and len(corpus_part):
                query_matrix, usable = unit(query_part[query_vec_col])
                query_part = query_part[usable].reset_index(drop=True)
                if len(query_part):
                    allowed = (
                        probe_mask(query_part[probes_col], corpus_part[cell_col].to_numpy())
                        if probes_col
                        else None
                    )
                    running = best(
                        None, query_part["query_id"].to_numpy(), query_matrix[usable],
                        corpus_part[id_col].to_numpy(), matrix_of(corpus_part[vec_col]), allowed,
                    )
            if running is None:
                return pd.DataFrame({"query_id": [], id_col: [], "score": []})
            out = running.rename(columns={"id": id_col})
            out.insert(0, "query_id", query_part["query_id"].to_numpy()[out.pop("q").to_numpy()])
            return out[["query_id", id_col, "score"]]

        partial = (
            left.groupBy("_q", "_c")
            .cogroup(right.groupBy("_q", "_c"))
            .applyInPandas(score_block, schema)
        )
    return rank_hits(partial, k, id_col)


def _empty(corpus: DataFrame, schema: T.StructType) -> DataFrame:
    wanted = T.StructType([*schema.fields, T.StructField("rank", T.IntegerType())])
    return corpus.sparkSession.createDataFrame([], wanted)


def exact_rescore(
    candidates: DataFrame,
    queries: DataFrame,
    corpus: DataFrame,
    k: int,
    id_col: str = "chunk_id",
    vec_col: str = "dense",
    query_vec_col: str = "vector",
    per_query: int | None = None,
) -> DataFrame:
    """Replace candidate scores by exact cosine and keep the best ``k``.

    ``per_query`` is the largest number of candidates a query has, if known.
    """
    wanted = candidates.select("query_id", id_col)
    vectors = corpus.select(id_col, vec_col)
    if few_rows(queries, per_query):
        paired = vectors.join(F.broadcast(wanted), id_col)
    else:
        paired = vectors.join(wanted, id_col)
    vectors_of = queries.select("query_id", query_vec_col)
    n_queries, dim = query_size(queries, query_vec_col)
    if n_queries * dim * 8 <= BROADCAST_BYTES:
        vectors_of = F.broadcast(vectors_of)
    scored = (
        paired.join(vectors_of, "query_id")
        .select(
            "query_id", id_col,
            score_round(cosine_pairs(F.col(query_vec_col), F.col(vec_col))).alias("score"),
        )
        .filter(F.col("score").isNotNull())
    )
    return rank_hits(scored, k, id_col)


# --------------------------------------------------------------------- fusion


def union_candidates(**channels: DataFrame) -> DataFrame:
    """``channel, query_id, chunk_id, rank`` of all channels together."""
    result = None
    for name, hits in channels.items():
        part = hits.select(F.lit(name).alias("channel"), "query_id", "chunk_id", "rank")
        result = part if result is None else result.unionByName(part)
    return result


def rrf_fuse(candidates: DataFrame, limit: int, k: int = RRF_K) -> DataFrame:
    """Reciprocal rank fusion: sum of ``1 / (k + rank)`` over the channels."""
    fused = candidates.groupBy("query_id", "chunk_id").agg(
        score_round(F.sum(1.0 / (k + F.col("rank")))).alias("score")
    )
    return rank_hits(fused, limit)


def few_rows(queries: DataFrame, per_query: int | None) -> bool:
    """Whether a table with at most ``per_query`` rows a query may be broadcast.

    Counts the queries, which is cheap, and not the hits, which are the search.
    """
    return per_query is not None and fits_broadcast(queries, BROADCAST_ROWS // max(1, per_query))


def attach_payload(
    hits: DataFrame,
    chunks: DataFrame,
    columns: list[str] | None = None,
    id_col: str = "chunk_id",
    small: bool = False,
) -> DataFrame:
    """Join hit rows to chunk columns; text is fetched for the hits only.

    ``small`` says that the number of hits is known to be within the broadcast
    bound (:func:`few_rows`); the chunks then stay where they are.
    """
    payload = chunks if columns is None else chunks.select(id_col, *columns)
    return payload.join(F.broadcast(hits) if small else hits, id_col)


def project_hits(
    hits: DataFrame, chunks: DataFrame, columns: list[str], small: bool = False
) -> DataFrame:
    """``query_id, rank, chunk_id, score`` and the payload columns, flat."""
    return attach_payload(hits, chunks, columns, small=small).select(
        "query_id", "rank", "chunk_id", "score", *columns
    )


def hits_to_json(hits: DataFrame, columns: list[str]) -> DataFrame:
    """``query_id, results``: the hits of a query as a JSON array in rank order."""
    ordered = F.array_sort(F.collect_list(F.struct("rank", *columns)))
    listed = hits.groupBy("query_id").agg(ordered.alias("rows"))
    plain = F.transform("rows", lambda r: F.struct(*[r[c].alias(c) for c in columns]))
    return listed.select("query_id", F.to_json(plain, {"pretty": "true"}).alias("results"))


# -------------------------------------------------------------------- rerank


def coverage_terms(queries: DataFrame, idf: DataFrame, n_chunks: DataFrame) -> DataFrame:
    """``query_id, terms``: map of distinct query terms to IDF, one row a query.

    A term the corpus does not have counts with the IDF of frequency zero.
    """
    total = n_chunks.select("n_chunks").scalar()
    terms = explode_items(
        queries, ["query_id"], F.array_distinct(tokenize(F.col("query"))), "term"
    )
    vocabulary = terms.select("term").distinct()
    known = (
        idf.join(F.broadcast(vocabulary), "term", "left_semi")
        if fits_broadcast(vocabulary)
        else idf
    )
    unseen = F.log(1 + (total + 0.5) / 0.5)
    weighted = terms.join(known.select("term", "idf"), "term", "left").select(
        "query_id", "term", F.coalesce("idf", unseen).alias("idf")
    )
    return weighted.groupBy("query_id").agg(
        F.map_from_entries(F.collect_list(F.struct("term", "idf"))).alias("terms")
    )


def coverage_score(terms: Column, text: Column) -> Column:
    """Share of the query's IDF mass whose terms occur in the text.

    The text is tokenized once per row, outside of any lambda: an expression
    inside a lambda is evaluated for every element.
    """
    found = F.array_intersect(tokenize(text), F.map_keys(terms))
    mass = F.aggregate(F.map_values(terms), F.lit(0.0), lambda acc, x: acc + x)
    covered = F.aggregate(found, F.lit(0.0), lambda acc, t: acc + F.coalesce(terms[t], F.lit(0.0)))
    return F.when(mass > 0, covered / mass).otherwise(F.lit(0.0))


def rerank(
    fused: DataFrame, scorer: Callable[[DataFrame], Column] | Column, limit: int | None = None
) -> DataFrame:
    """Order by ``rerank_score`` descending; equal scores keep the fused order.

    ``scorer`` is a Column, or a function from the DataFrame to a Column, over
    the columns of ``fused``: a native expression or a ``predict_batch_udf``.
    """
    column = scorer(fused) if callable(scorer) else scorer
    scored = fused.withColumn("rerank_score", score_round(column)).withColumnRenamed(
        "rank", "fused_rank"
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("rerank_score"), "fused_rank")
    ranked = scored.withColumn("rank", F.row_number().over(order))
    return ranked if limit is None else limit_per_query(ranked, limit)
