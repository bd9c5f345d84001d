import math
import random

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import ann, embedding, evaluate, quantize, search, sparse
from corpusloom.plans import retrieval


def frame(spark, rows, kind="long"):
    return spark.createDataFrame(rows, f"chunk_id {kind}, dense array<float>")


def asked(spark, rows):
    return spark.createDataFrame(rows, "query_id long, vector array<float>")


def vectors(n, dim=8, seed=1):
    rng = random.Random(seed)
    return [(i, [rng.gauss(0, 1) for _ in range(dim)]) for i in range(n)]


def hits(df):
    return sorted((r.query_id, r.rank, r.chunk_id, r.score) for r in df.collect())


def test_dense_ties_zero_and_empty(spark):
    corpus = frame(spark, [(3, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [0.0, 0.0]), (4, [0.0, 1.0]), (5, [])])
    queries = asked(spark, [(1, [1.0, 0.0]), (2, []), (3, [0.0, 0.0])])
    got = hits(search.dense_topk(queries, corpus, 2))
    assert got == [(1, 1, 1, 1.0), (1, 2, 3, 1.0)]
    assert hits(search.dense_topk(queries.filter("query_id = 2"), corpus, 2)) == []


def test_blockwise_equals_broadcast(spark, monkeypatch):
    monkeypatch.setattr(search, "GRID_ROWS", 16)
    corpus, queries = frame(spark, vectors(70)), asked(spark, vectors(40, seed=2))
    small = hits(search.dense_topk(queries, corpus, 5))
    assert len(small) == 200
    assert hits(search.dense_topk(queries, corpus, 5, max_bytes=0)) == small


def test_blocks_are_few(spark):
    """720,000 vectors against as many: 11 copies of each and not 176."""
    assert search.grid_blocks(720_000, 720_000, 64, 12) == (11, 11)
    assert search.grid_blocks(720_000, 65_536, 64, 12) == (11, 5)       # every core has work
    assert search.grid_blocks(100_000, 100_000, 3072, 1) == (25, 25)    # and no block is too wide


def test_large_k_in_parts_equals_one_window(spark, monkeypatch):
    rows = [(q, i, float((i * 7 + q) % 11)) for q in range(3) for i in range(50)]
    scored = spark.createDataFrame(rows, "query_id long, chunk_id long, score double")
    whole = hits(search.rank_hits(scored, 20))
    monkeypatch.setattr(search, "GROUP_LIMIT", 5)
    assert hits(search.rank_hits(scored, 20)) == whole and len(whole) == 60


def test_string_ids(spark):
    corpus = frame(spark, [("b", [1.0, 0.0]), ("a", [1.0, 0.0])], "string")
    got = hits(search.dense_topk(asked(spark, [(1, [1.0, 0.0])]), corpus, 1))
    assert got == [(1, 1, "a", 1.0)]


def test_recall_of_exact_is_one_and_short_results_divide_by_k(spark):
    corpus, queries = frame(spark, vectors(30)), asked(spark, vectors(6, seed=3))
    truth = evaluate.exact_ground_truth(queries, corpus, 10)
    exact = evaluate.recall_at_k(queries, truth, truth, 10)
    assert {r.recall for r in exact.collect()} == {1.0}
    few = evaluate.exact_ground_truth(queries, frame(spark, vectors(3)), 10)
    assert {round(r.recall, 6) for r in evaluate.recall_at_k(queries, few, few, 10).collect()} == {0.3}
    none = few.filter("query_id < 0")
    assert evaluate.mean_recall(evaluate.recall_at_k(queries, few, none, 10)).first()[0] == 0.0


def test_quantization(spark):
    flat = frame(spark, [(1, [0.5, 0.5]), (2, [0.5, 0.5])])
    codes = quantize.int8_quantize(flat, quantize.int8_fit(flat))
    assert [list(r.codes) for r in codes.collect()] == [[-128, -128]] * 2
    corpus, queries = frame(spark, vectors(200)), asked(spark, vectors(20, seed=4))
    bounds = quantize.int8_fit(corpus)
    back = quantize.int8_dequantize(quantize.int8_quantize(corpus, bounds), bounds)
    step = bounds.select((F.col("hi") - F.col("lo")) / 255).first()[0]
    paired = back.withColumnRenamed("dense", "near").join(corpus, "chunk_id").collect()
    lo, hi = bounds.first()
    for row in paired:
        for a, b in zip(row.near, row.dense):
            assert abs(a - min(max(b, lo), hi)) <= step
    assert retrieval.quantization_benchmark(queries, corpus).first()[0] > 0.9
    with pytest.raises(ValueError):
        retrieval.quantization_benchmark(queries.filter("query_id < 0"), corpus)


@pytest.mark.parametrize("bins", [4, 65_536])
def test_quantiles_are_exact(spark, bins):
    rng = random.Random(3)
    values = [rng.gauss(0, 1) for _ in range(3000)] + [0.25] * 500 + [1e300, -1e300, 1e-300, 5.0]
    odd = [None, float("nan"), float("inf"), -float("inf")]
    rows = spark.createDataFrame([(v,) for v in values + odd], "v double")
    asked_for = [0.0, 0.005, 0.3, 0.5, 0.55, 0.995, 1.0]
    ordered = sorted(values)
    expected = [ordered[max(1, math.ceil(round(q * len(ordered), 6))) - 1] for q in asked_for]
    assert quantize.exact_quantiles(rows, asked_for, bins=bins) == expected
    assert quantize.exact_quantiles(rows.filter("v is null"), asked_for) == [None] * 7


def test_quantiles_of_over_a_million_values(spark):
    # a permutation of 0 .. 2999999, cut beyond any sketch of a million entries
    rows = spark.range(3_000_000).select(((F.col("id") * 1_000_003) % 3_000_000).alias("v"))
    found = quantize.exact_quantiles(rows, [0.005, 0.1234567, 0.995])
    assert found == [14999.0, 370370.0, 2984999.0]


def test_ann_with_every_cell_is_exact(spark):
    corpus, queries = frame(spark, vectors(120)), asked(spark, vectors(10, seed=6))
    centres = ann.fit_cells(corpus, cells=4)
    exact = hits(search.dense_topk(queries, corpus, 5))
    assert hits(ann.ann_topk(queries, corpus, 5, centres, probes=4)) == exact
    some = ann.ann_topk(queries, corpus, 5, centres, probes=2)
    assert {h[0] for h in hits(some)} <= set(range(10))


def clustered(n, seed=1, dim=16, clusters=10):
    rng = random.Random(seed)
    heads = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(clusters)]
    return [
        (i, [x + rng.gauss(0, 0.4) for x in heads[rng.randrange(clusters)]]) for i in range(n)
    ]


def test_ann_finds_nearly_all_for_a_quarter_of_the_pairs(spark):
    corpus = frame(spark, clustered(20_000)).repartition(8).persist()
    queries = corpus.filter("chunk_id % 50 = 0").select(
        F.col("chunk_id").alias("query_id"), F.col("dense").alias("vector")
    )
    centres = ann.fit_cells(corpus)
    assert centres.count() == 141
    index = ann.index_cells(corpus, centres).persist()
    probes = ann.probes_for_recall(queries, index, centres, 10)
    truth = evaluate.exact_ground_truth(queries, corpus, 10)
    found = ann.ann_topk(queries, index, 10, centres, probes)
    assert evaluate.mean_recall(evaluate.recall_at_k(queries, truth, found, 10)).first()[0] >= 0.94
    assert ann.scored_share(queries, index, centres, probes) <= 0.25
    # the plan moves vectors of asked cells only, and never a query with all of them
    few = ann.ann_topk(queries.limit(1), index, 10, centres, probes)
    assert few.count() == 10


def test_ann_splits_crowded_cells_and_their_queries(spark, monkeypatch):
    same = [(i, [1.0, 0.001 * i, 0.0]) for i in range(60)]
    rows = same + [(i, [0.0, 0.0, 1.0]) for i in range(60, 66)]
    corpus = frame(spark, rows + [(7, [1.0, 0.007, 0.0])])
    queries = asked(spark, rows)
    centres = spark.createDataFrame([(0, [1.0, 0.0, 0.0]), (1, [0.0, 0.0, 1.0])], "cell int, centre array<double>")
    whole = hits(ann.ann_topk(queries, corpus, 4, centres, 1))
    monkeypatch.setattr(ann, "ASK_ROWS", 5)
    index = ann.index_cells(corpus, centres, part_rows=8)
    assert index.filter("cell = 0").agg(F.max("part")).first()[0] >= 5
    assert hits(ann.ann_topk(queries, index, 4, centres, 1)) == whole
    assert sum(1 for h in whole if h[0] == 7 and h[2] == 7) == 2


def test_ann_leaves_out_what_has_no_direction(spark):
    corpus = frame(spark, [(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, []), (4, None), (5, [1.0, 0.0, 0.0])])
    queries = asked(spark, [(1, [1.0, 0.0]), (2, None), (3, []), (4, [0.0, 0.0]), (5, [1.0])])
    centres = spark.createDataFrame([(0, [1.0, 0.0])], "cell int, centre array<double>")
    assert hits(ann.ann_topk(queries, corpus, 3, centres, 1)) == [(1, 1, 1, 1.0)]
    assert hits(ann.ann_topk(queries.filter("query_id < 0"), corpus, 3, centres, 1)) == []
    nothing = corpus.filter("chunk_id < 0")
    assert hits(ann.ann_topk(queries, nothing, 3, ann.fit_cells(nothing), 1)) == []
    with pytest.raises(ValueError):
        ann.fit_cells(corpus)


def test_fusion_sums_reciprocal_ranks(spark):
    def ranked(rows):
        return spark.createDataFrame(rows, "query_id long, chunk_id long, rank int")

    one = ranked([(1, 10, 1), (1, 11, 2)])
    two = ranked([(1, 11, 1), (1, 12, 2)])
    three = ranked([(1, 11, 3), (1, 13, 1)])
    fused = hits(search.rrf_fuse(search.union_candidates(a=one, b=two, c=three), 10))
    expected = {11: 1 / 62 + 1 / 61 + 1 / 63, 10: 1 / 61, 13: 1 / 61, 12: 1 / 62}
    assert [h[2] for h in fused] == [11, 10, 13, 12]
    assert all(h[3] == round(expected[h[2]], 6) for h in fused)
    turned = hits(search.rrf_fuse(search.union_candidates(c=three, a=one, b=two), 10))
    assert turned == fused


def test_rerank_ties_keep_the_fused_order(spark):
    fused = spark.createDataFrame(
        [(1, 7, 0.5, 1, 2.0), (1, 8, 0.4, 2, 3.0), (1, 9, 0.3, 3, 2.0)],
        "query_id long, chunk_id long, score double, rank int, s double",
    )
    got = search.rerank(fused, F.col("s"), 3).orderBy("rank").collect()
    assert [r.chunk_id for r in got] == [8, 7, 9]
    assert [r.rerank_score for r in got] == [3.0, 2.0, 2.0]


def test_unknown_terms_find_nothing_sparse_but_dense_answers(spark):
    chunks = spark.createDataFrame(
        [(1, "red apples"), (2, "green pears"), (3, "blue plums")], "chunk_id long, text string"
    )
    queries = spark.createDataFrame([(1, "zebra zoo"), (2, "green pears")], "query_id long, query string")
    found = retrieval.bm25_search(queries, chunks).collect()
    assert {(r.query_id, r.chunk_id) for r in found} == {(2, 2)}
    answers = retrieval.hybrid_search(queries, chunks, limit=2).collect()
    assert {r.query_id for r in answers} == {1, 2}
    best = [r for r in answers if r.query_id == 2 and r.rank == 1]
    assert best[0].chunk_id == 2 and best[0].rerank_score == 1.0
    plain = retrieval.hybrid_search(queries, chunks, limit=2, scorer=None)
    assert "rerank_score" not in plain.columns and plain.filter("rank > 2").isEmpty()


def test_match_needs_every_token(spark):
    chunks = spark.createDataFrame([(1, "red big apples"), (2, "red pears")], "chunk_id long, text string")
    queries = spark.createDataFrame([(1, "Red apples"), (2, "red")], "query_id long, query string")
    got = search.match_text(queries, sparse.term_counts(chunks)).collect()
    assert sorted((r.query_id, r.chunk_id) for r in got) == [(1, 1), (2, 1), (2, 2)]


def test_expansion_restricted_to_asked_terms_is_the_same(spark):
    chunks = spark.createDataFrame([(1, "aa bb cc aa"), (2, "bb dd")], "chunk_id long, text string")
    near = spark.createDataFrame(
        [("aa", "xx", 0.9), ("bb", "aa", 0.5), ("dd", "xx", 0.2)],
        "term string, neighbour string, strength double",
    )
    counts = sparse.term_counts(chunks)
    every = {(r.chunk_id, r.term): r.weight for r in sparse.expand_terms(counts, near).collect()}
    asked_terms = spark.createDataFrame([("aa",), ("xx",)], "term string")
    some = sparse.expand_terms(counts, near, only=asked_terms).collect()
    got = {(r.chunk_id, r.term): r.weight for r in some}
    assert got == {k: v for k, v in every.items() if k[1] in ("aa", "xx")}
    assert (1, "xx") in got and got[(2, "aa")] < got[(1, "aa")]


def test_json_of_hits(spark):
    rows = spark.createDataFrame(
        [(1, 5, 0.25, 2), (1, 4, 0.5, 1)], "query_id long, chunk_id long, score double, rank int"
    )
    import json

    text = search.hits_to_json(rows, ["chunk_id", "score"]).first().results
    assert json.loads(text) == [{"chunk_id": 4, "score": 0.5}, {"chunk_id": 5, "score": 0.25}]
    assert "\n" in text


def test_user_model_in_batches(spark):
    def make_predict(task):
        def predict(batch):
            import numpy as np

            return np.array([[float(len(t)), float(task == "query")] for t in batch], dtype=np.float32)

        return predict

    df = spark.createDataFrame([(1, "abc"), (2, "abcde")], "chunk_id long, text string")
    got = embedding.embed_documents(df, embedding.model_embedder(make_predict)).orderBy("chunk_id").collect()
    assert [list(r.dense) for r in got] == [[3.0, 0.0], [5.0, 0.0]]


def test_filters_act_below_every_channel(spark):
    words = "amber basin cedar delta ember fjord grove haven islet jetty".split()
    rng = random.Random(5)
    rows = [
        (i, f"s{i % 4}", " ".join(rng.choice(words) for _ in range(12))) for i in range(80)
    ] + [(80, "s0", None), (81, None, "amber basin"), (82, "s0", "")]
    chunks = spark.createDataFrame(rows, "chunk_id long, source string, text string")
    queries = spark.createDataFrame(
        [(1, "amber delta"), (2, "jetty grove haven"), (3, "unknown")], "query_id long, query string"
    )

    def found(df):
        return sorted((r.query_id, r.rank, r.chunk_id, r.score, r.rerank_score) for r in df.collect())

    some = found(retrieval.hybrid_search(queries, chunks, 5, where="source = 's1'"))
    assert some == found(retrieval.hybrid_search(queries, chunks.filter("source = 's1'"), 5))
    assert {r[2] % 4 for r in some} == {1} and sum(r[0] == 1 for r in some) == 5

    # seven chunks that rank low without the filter are all found with it
    low = [(1, c) for c in (3, 9, 21, 33, 47, 58, 71)]
    allowed = spark.createDataFrame(low + low[:2] + [(1, 999)], "query_id long, chunk_id long")
    got = found(retrieval.hybrid_search(queries, chunks, 10, allowed=allowed))
    assert {(r[0], r[2]) for r in got} == set(low)
    assert found(retrieval.hybrid_search(queries, chunks, 5, where="source = 'none'")) == []
