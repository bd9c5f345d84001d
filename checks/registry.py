"""One function ``(spark, folder) -> DataFrame`` per operator, on whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import text as tx
from corpusloom.functions.memory import settled
from corpusloom.functions.rows import explode_items, posexplode_items
from corpusloom.functions.vectors import cosine, score_round
from corpusloom.operators import ann, chunking, dedup, embedding, evaluate, joins, metrics
from corpusloom.operators import quantize, search, sparse, telemetry
from corpusloom.plans import corpus as corpus_plans
from corpusloom.plans import retrieval
from corpusloom.settings import ensure_checkpoint_dir
from corpusloom.sources import collection, files

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


# ------------------------------------------------------------------ the tables


def table(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def docs(spark, folder):
    """Documents as chunks: ``chunk_id, source, text``."""
    return table(spark, folder, "documents").select(
        F.col("doc_id").alias("chunk_id"), "source", "text"
    )


def asks(spark, folder):
    """Benchmark texts as queries: ``query_id, query``."""
    return table(spark, folder, "benchmark").select(
        F.col("item_id").alias("query_id"), F.col("text").alias("query")
    )


def vectors(spark, folder):
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("chunk_id"), F.col("embedding").alias("dense")
    ).repartition("chunk_id")


def vector_asks(spark, folder):
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector")
    )


def readings(spark, folder):
    """Events as host readings."""
    value = F.col("value")
    return table(spark, folder, "events").select(
        F.col("user_id").alias("host"),
        "ts",
        "event_id",
        F.least(value, F.lit(100.0)).alias("cpu_percent"),
        F.round(value / 5, 2).alias("mem_percent"),
        F.round(24 - value / 20, 2).alias("mem_available_gb"),
        F.when(F.col("event_type") == "error", F.lit(0.0))
        .when(F.col("event_type") == "view", F.round(value / 4, 1))
        .alias("cpu_temp_c"),
        F.when(F.col("event_type") == "click", F.round(value / 5, 1)).alias("gpu_temp_c"),
    )


def search_parts(spark, folder):
    chunks, queries = docs(spark, folder), asks(spark, folder)
    counts = sparse.term_counts(chunks)
    return chunks, queries, counts, sparse.corpus_stats(chunks)


# ------------------------------------------------------------ scans and sources


@query
def classify_file(spark, folder):
    pages = table(spark, folder, "pages").select("page_id", F.col("url").alias("source"))
    return tx.classify_file(pages)


@query
def sample_first(spark, folder):
    return files.sample_first(table(spark, folder, "documents"), 20, "doc_id").select(
        "doc_id", "source"
    )


@query
def scan_documents(spark, folder):
    turns = table(spark, folder, "conversations")
    return files.scan_documents(turns, "conv_id", "turn", "text")


# ------------------------------------------------- projections, filters, scalars


@query
def normalize_nfc(spark, folder):
    return tx.normalize_nfc(table(spark, folder, "documents").select("doc_id", "text"))


@query
def drop_blank(spark, folder):
    return tx.drop_blank(table(spark, folder, "documents").select("doc_id", "text"))


@query
def with_metadata(spark, folder):
    pages = table(spark, folder, "pages").select("page_id", "url")
    return tx.with_metadata(pages, "url").drop("url")


@query
def flatten_payload(spark, folder):
    nested = tx.classify_file(table(spark, folder, "pages").withColumnRenamed("url", "source")).select(
        "page_id", F.struct("source", "file_type", "content_type").alias("metadata"),
        F.col("html").alias("text"),
    )
    return tx.flatten_payload(nested)


@query
def tokenize(spark, folder):
    texts = docs(spark, folder).repartition("chunk_id")
    tokens = explode_items(texts, [], tx.tokenize(F.col("text")), "term")
    return tokens.groupBy("term").agg(F.count("*").alias("n"))


@query
def whitespace_words(spark, folder):
    texts = docs(spark, folder).repartition("chunk_id")
    words = explode_items(texts, [], tx.whitespace_words(F.col("text")), "word")
    return words.groupBy("word").agg(F.count("*").alias("n"))


@query
def project_hits(spark, folder):
    queries = asks(spark, folder)
    chunks = docs(spark, folder)
    hits = retrieval.bm25_search(queries, chunks)
    return search.project_hits(
        hits, chunks, ["source", "text"], small=search.few_rows(queries, 10)
    )


@query
def hits_to_json(spark, folder):
    queries = asks(spark, folder)
    hits = retrieval.bm25_search(queries, docs(spark, folder))
    return search.hits_to_json(hits, ["chunk_id", "score"])


@query
def filter_payload(spark, folder):
    return files.filter_payload(docs(spark, folder), source=["src1", "src7"]).select(
        "chunk_id", "source"
    )


@query
def match_text(spark, folder):
    chunks, _, counts, _ = search_parts(spark, folder)
    # every sentence-like line of the benchmark texts is a query of its own
    lines = table(spark, folder, "benchmark").select(
        F.col("item_id"), F.posexplode(F.split("text", r"[.,:\n]")).alias("pos", "query")
    )
    wanted = lines.select(
        F.concat_ws("-", "item_id", "pos").alias("query_id"), "query"
    )
    return search.match_text(wanted, counts)


@query
def min_score(spark, folder):
    return search.min_score(
        retrieval.bm25_search(asks(spark, folder), docs(spark, folder)), 20.0
    )


@query
def snippet(spark, folder):
    return docs(spark, folder).select("chunk_id", tx.snippet(F.col("text")).alias("snippet"))


# -------------------------------------------------------------------- chunking


def pages(spark, folder):
    return table(spark, folder, "pages").select(
        F.col("page_id").alias("doc_id"), F.col("html").alias("text")
    )


@query
def html_blocks(spark, folder):
    return chunking.html_blocks(pages(spark, folder))


@query
def html_blocks_nested(spark, folder):
    return chunking.html_blocks(pages(spark, folder), mode="nested")


@query
def xml_text(spark, folder):
    return chunking.xml_text(pages(spark, folder))


@query
def code_blocks(spark, folder):
    """Each conversation written as a program with one function per turn."""
    lines = table(spark, folder, "conversations").select(
        F.col("conv_id").alias("doc_id"),
        F.col("turn").alias("pos"),
        F.concat(
            F.lit("@turn\ndef "), F.col("role"), F.lit("_"), F.col("turn").cast("string"),
            F.lit("():\n    "), F.replace(F.col("text"), F.lit("\n"), F.lit("\n    ")),
        ).alias("text"),
    )
    programs = files.scan_documents(lines).withColumn("language", F.lit("python"))
    return chunking.code_blocks(programs, max_lines=6)


@query
def semantic_chunks(spark, folder):
    texts = table(spark, folder, "documents").select("doc_id", "text")
    return chunking.semantic_chunks(texts)


@query
def process_corpus(spark, folder):
    """Pages and documents routed by suffix, chunked, and deduplicated per source."""
    texts = table(spark, folder, "documents").select(
        F.concat(F.lit("/corpus/doc"), F.col("doc_id"), F.lit(".txt")).alias("source"), "text"
    )
    web = table(spark, folder, "pages").select(
        F.concat(
            F.lit("/corpus/page"), F.col("page_id"),
            F.when(F.col("url").contains(".html"), ".xml").otherwise(".html"),
        ).alias("source"),
        F.col("html").alias("text"),
    )
    return corpus_plans.process_corpus(texts.unionByName(web), html_mode="leaf").select(
        "source", "chunk_no", "text", "file_type", "content_type"
    )


@query
def process_markup(spark, folder):
    """The markup branch before dedup."""
    web = table(spark, folder, "pages").select(
        F.concat(F.lit("/corpus/page"), F.col("page_id"), F.lit(".htm")).alias("source"),
        F.col("html").alias("text"),
    )
    return corpus_plans.process_corpus(web, html_mode="leaf", dedup=None).select(
        "source", "chunk_no", "text", "file_type", "content_type"
    )


# ----------------------------------------------------------------------- dedup


@query
def minhash_signature(spark, folder):
    signed = dedup.minhash_signature(docs(spark, folder).repartition("chunk_id"))
    return posexplode_items(signed, ["chunk_id"], F.col("signature"), "i", "value")


@query
def lsh_candidates(spark, folder):
    signed = dedup.minhash_signature(docs(spark, folder).repartition("chunk_id"))
    return dedup.lsh_candidates(signed.select("chunk_id", "signature"))


@query
def lsh_candidates_verified(spark, folder):
    signed = dedup.minhash_signature(docs(spark, folder).repartition("chunk_id"))
    return dedup.lsh_candidates(signed.select("chunk_id", "signature"), verify=True).drop("bucket")


def by_source(spark, folder):
    return dedup.dedup_keep_first(docs(spark, folder).repartition("chunk_id"))


@query
def dedup_keep_first(spark, folder):
    return by_source(spark, folder)


@query
def dedup_corpus(spark, folder):
    return dedup.dedup_corpus(
        docs(spark, folder).repartition("chunk_id"), scope="corpus"
    ).select("chunk_id", "source")


@query
def dedup_report(spark, folder):
    flags = by_source(spark, folder)
    return dedup.dedup_report(docs(spark, folder).join(flags, "chunk_id"))


# ------------------------------------------------------- vectors and term weights


@query
def embed_documents(spark, folder):
    made = embedding.embed_documents(docs(spark, folder).repartition("chunk_id"))
    return posexplode_items(made, ["chunk_id"], F.col("dense"), "i", "x").select(
        "chunk_id", "i", F.round(F.col("x").cast("double"), 5).alias("x")
    )


@query
def embed_queries(spark, folder):
    made = embedding.embed_queries(asks(spark, folder))
    return posexplode_items(made, ["query_id"], F.col("vector"), "i", "x").select(
        "query_id", "i", F.round(F.col("x").cast("double"), 5).alias("x")
    )


@query
def bm25_weights(spark, folder):
    return sparse.bm25_weights(docs(spark, folder)).select(
        "chunk_id", "term", F.round("weight", 6).alias("weight")
    )


@query
def idf_table(spark, folder):
    _, _, counts, stats = search_parts(spark, folder)
    return sparse.idf_table(sparse.vocabulary(counts), stats).select("term", "df", F.round("idf", 6).alias("idf"))


@query
def term_neighbours(spark, folder):
    return sparse.term_neighbours(docs(spark, folder))


@query
def expand_terms(spark, folder):
    chunks = docs(spark, folder)
    near = settled(lambda: sparse.term_neighbours(chunks))
    return sparse.expand_terms(sparse.term_counts(chunks), near).select(
        "chunk_id", "term", F.round("weight", 6).alias("weight")
    )


@query
def embed_sparse(spark, folder):
    chunks = docs(spark, folder)
    near = settled(lambda: sparse.term_neighbours(chunks))
    both = sparse.embed_sparse(chunks, near)
    return both.groupBy("chunk_id", "channel").agg(
        F.count("*").alias("terms"), F.round(F.sum("weight"), 4).alias("mass")
    )


@query
def int8_fit(spark, folder):
    return quantize.int8_fit(vectors(spark, folder)).select(
        F.round("lo", 6).alias("lo"), F.round("hi", 6).alias("hi")
    )


@query
def int8_encode(spark, folder):
    corpus = vectors(spark, folder)
    codes = quantize.int8_quantize(corpus, quantize.int8_fit(corpus))
    return posexplode_items(codes, ["chunk_id"], F.col("codes"), "i", "code").select(
        "chunk_id", "i", F.col("code").cast("int").alias("code")
    )


@query
def vector_cosine(spark, folder):
    """Each vector against its successor."""
    left = vectors(spark, folder)
    right = left.select((F.col("chunk_id") - 1).alias("chunk_id"), F.col("dense").alias("next"))
    return left.join(right, "chunk_id").select(
        "chunk_id", score_round(cosine(F.col("dense"), F.col("next"))).alias("cosine")
    )


@query
def sparse_dot(spark, folder):
    chunks, queries, counts, stats = search_parts(spark, folder)
    weights = sparse.bm25_weights(chunks, stats=stats, counts=counts)
    wanted = sparse.bm25_weights(
        queries, "query_id", "query", stats=stats,
        counts=sparse.term_counts(queries, "query_id", "query"),
    )
    return search.sparse_dot(wanted, weights)


# ---------------------------------------------------------- joins, set operations


@query
def attach_vectors(spark, folder):
    joined = joins.attach_vectors(docs(spark, folder), vectors(spark, folder))
    return joined.select(
        "chunk_id", "source", F.length("text").alias("n"), F.size("dense").alias("dim")
    )


@query
def intersect_topk(spark, folder):
    corpus, queries = vectors(spark, folder), vector_asks(spark, folder)
    bounds = quantize.int8_fit(corpus)
    codes = quantize.int8_quantize(corpus, bounds)
    return evaluate.intersect_topk(
        evaluate.exact_ground_truth(queries, corpus, 10),
        quantize.quantized_topk(queries, codes, bounds, 10, corpus),
    )


@query
def union_candidates(spark, folder):
    hits = retrieval.channel_hits(asks(spark, folder), docs(spark, folder), 50)
    return search.union_candidates(**hits)


@query
def gather_chunks(spark, folder):
    a = docs(spark, folder).select("chunk_id", "text")
    b = table(spark, folder, "pages").select(
        F.col("page_id").alias("chunk_id"), F.col("html").alias("text")
    )
    return joins.gather_chunks(a, b)


# ---------------------------------------------------------------------- ranking


@query
def dense_topk(spark, folder):
    return search.dense_topk(vector_asks(spark, folder), vectors(spark, folder), 10)


@query
def sparse_topk(spark, folder):
    chunks, queries, counts, _ = search_parts(spark, folder)
    near = settled(lambda: sparse.term_neighbours(chunks))
    wanted = sparse.expand_terms(
        sparse.term_counts(queries, "query_id", "query"), near, "query_id"
    )
    asked = wanted.select("term").distinct()
    return search.sparse_topk(wanted, sparse.expand_terms(counts, near, only=asked), 10)


@query
def bm25_search(spark, folder):
    return retrieval.bm25_search(asks(spark, folder), docs(spark, folder))


def chosen_cells(corpus):
    """Every 25th vector, at length one, as the centre of a cell."""
    chosen = ann.unit_vectors(corpus.filter("chunk_id % 25 = 0"), "dense")
    return chosen.select(F.col("chunk_id").cast("int").alias("cell"), F.col("dense").alias("centre"))


@query
def ann_topk(spark, folder):
    """Cells about centres chosen by a rule; a quarter of them is probed."""
    corpus, queries = vectors(spark, folder), vector_asks(spark, folder)
    centres = chosen_cells(corpus)
    return ann.ann_topk(queries, corpus, 10, centres, -(-centres.count() // 4))


@query
def ann_recall(spark, folder):
    """Cells fitted by k-means; the probes are measured for recall 0.95."""
    corpus, queries = vectors(spark, folder), vector_asks(spark, folder)
    centres = ann.fit_cells(corpus)
    ensure_checkpoint_dir(spark)
    index = ann.index_cells(corpus, centres).checkpoint()
    probes = ann.probes_for_recall(queries, index, centres, 10)
    truth = evaluate.exact_ground_truth(queries, corpus, 10)
    found = ann.ann_topk(queries, index, 10, centres, probes)
    return evaluate.mean_recall(evaluate.recall_at_k(queries, truth, found, 10))


@query
def quantized_topk(spark, folder):
    corpus, queries = vectors(spark, folder), vector_asks(spark, folder)
    bounds = quantize.int8_fit(corpus)
    return quantize.quantized_topk(
        queries, quantize.int8_quantize(corpus, bounds), bounds, 10, corpus
    )


@query
def rrf_fuse(spark, folder):
    hits = retrieval.channel_hits(asks(spark, folder), docs(spark, folder), 250)
    return search.rrf_fuse(search.union_candidates(**hits), 50)


@query
def rerank(spark, folder):
    """BM25 hits, 50 a query, reordered by coverage of the query's terms."""
    chunks, queries, counts, stats = search_parts(spark, folder)
    hits = retrieval.bm25_search(queries, chunks, 50)
    terms = search.coverage_terms(queries, sparse.idf_table(sparse.vocabulary(counts), stats), stats)
    candidates = search.attach_payload(
        hits, chunks, ["text"], small=search.few_rows(queries, 50)
    ).join(terms, "query_id")
    return search.rerank(
        candidates.repartition("query_id", "chunk_id"), search.coverage_score(F.col("terms"), F.col("text")), 10
    ).select("query_id", "chunk_id", "score", "rerank_score", "fused_rank", "rank")


@query
def hybrid_search(spark, folder):
    return retrieval.hybrid_search(asks(spark, folder), docs(spark, folder)).drop("text")


@query
def filtered_search(spark, folder):
    """Hybrid search over the chunks of every source but one, by payload filter."""
    return retrieval.hybrid_search(
        asks(spark, folder), docs(spark, folder), where="source <> 'src7'"
    ).drop("text")


@query
def matched_search(spark, folder):
    """Hybrid search among the chunks that hold the query's longest term."""
    chunks, queries, counts, _ = search_parts(spark, folder)
    terms = sparse.term_counts(queries, "query_id", "query").filter("length(term) between 2 and 20")
    longest = terms.groupBy("query_id").agg(
        F.min(F.struct(-F.length("term"), "term"))["term"].alias("query")
    )
    return retrieval.hybrid_search(
        queries, chunks, allowed=search.match_text(longest, counts)
    ).drop("text")


# --------------------------------------------------------- evaluation and metrics


@query
def exact_ground_truth(spark, folder):
    return evaluate.exact_ground_truth(vector_asks(spark, folder), vectors(spark, folder), 10)


@query
def recall_at_k(spark, folder):
    """INT8 without rescoring against exact."""
    corpus, queries = vectors(spark, folder), vector_asks(spark, folder)
    bounds = quantize.int8_fit(corpus)
    found = quantize.quantized_topk(queries, quantize.int8_quantize(corpus, bounds), bounds, 10)
    truth = evaluate.exact_ground_truth(queries, corpus, 10)
    return evaluate.recall_at_k(queries, truth, found, 10)


@query
def quantization_benchmark(spark, folder):
    return retrieval.quantization_benchmark(vector_asks(spark, folder), vectors(spark, folder))


@query
def ingest_metrics(spark, folder):
    chunks = docs(spark, folder)
    flagged = settled(lambda: chunks.join(by_source(spark, folder), "chunk_id"))
    kept = flagged.filter("kept")
    near = settled(lambda: sparse.term_neighbours(chunks))
    sources = chunks.select("source").distinct()
    return metrics.ingest_metrics(
        sources, flagged, sparse.embed_sparse(kept.select("chunk_id", "text"), near)
    )


@query
def ingest_rates(spark, folder):
    """Documents and characters per second of event time, as a rates table."""
    events = table(spark, folder, "events").groupBy("event_type").agg(
        F.countDistinct("user_id").alias("files_processed"),
        F.count("*").alias("deduped_chunks"),
        F.round(F.sum("value"), 2).alias("seconds"),
    )
    return metrics.rates(events)


@query
def upsert_merge(spark, folder):
    """Two overlapping halves of the documents: later rows win."""
    rows = docs(spark, folder).select("chunk_id", "source", "text")
    labels = table(spark, folder, "labels").select(F.col("doc_id").alias("chunk_id"))
    newer = rows.join(labels, "chunk_id", "left_semi").withColumn("source", F.lit("again"))
    return collection.merge_points(rows, newer)


# -------------------------------------------------------------------- telemetry


@query
def classify_pressure(spark, folder):
    return telemetry.classify_pressure(readings(spark, folder)).select(
        "event_id", "under_pressure", "reason"
    )


@query
def critical_alerts(spark, folder):
    return telemetry.critical_alerts(readings(spark, folder)).select("event_id", "alert")


@query
def throttle_state(spark, folder):
    return telemetry.throttle_state(
        readings(spark, folder), order_cols=("ts", "event_id")
    ).select("event_id", "host", "throttled")
