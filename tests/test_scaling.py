"""Steps whose memory, disk or moves must not grow with the tables."""

from pyspark.sql import functions as F

from corpusloom.operators import joins, sparse

TEXTS = [
    (1, "red fox sees red hen, red fox runs"),
    (2, "blue hen sees blue fox; hen runs far far far"),
    (3, "éa éb red fox éa éb far"),
    (4, "alone"),
    (5, None),
    (6, ""),
    (6, "red fox sees red hen"),
    (None, "blue fox runs"),
]


def texts(spark):
    return spark.createDataFrame(TEXTS, "chunk_id long, text string")


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_large_lookup_moves_each_row_once(spark):
    big = spark.range(200).select("id", (F.col("id") % 20).alias("k"))
    small = spark.range(20).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    joined = joins.lookup_join(big, small, ["k"], "id", max_rows=5)
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan
    assert rows(joined.select("id", "v")) == [(i, i % 20 * 2) for i in range(200)]


def test_heaviest_keeps_within_the_bound(spark):
    weights = spark.createDataFrame([(i,) for i in [1] * 50 + [3] * 7 + [100, 900, 901]], "m long")
    for bound, held in [(60, None), (59, 10), (10, 10), (9, 3), (3, 3), (1, 0)]:
        least = joins.heaviest(weights, "m", bound)
        found = None if least is None else weights.filter(F.col("m") >= least).count()
        assert found == held, bound


def neighbours_by_hand(span=4, top=3):
    import math
    import re
    from collections import Counter

    pairs = Counter()
    for _, words in TEXTS:
        tokens = re.findall(r"\w+", (words or "").lower())
        for i, x in enumerate(tokens):
            for y in tokens[i + 1 : i + 1 + span]:
                if x != y:
                    pairs[min(x, y), max(x, y)] += 1
    margin = Counter()
    for (a, b), n in pairs.items():
        margin[a] += n
        margin[b] += n
    total = 2 * sum(pairs.values())
    found = {}
    for (a, b), n in pairs.items():
        s = round(math.log(n * total / (margin[a] * margin[b])) / -math.log(n / total), 6)
        if s > 0:
            found.setdefault(a, []).append((-s, b))
            found.setdefault(b, []).append((-s, a))
    return sorted((t, b, -s) for t, near in found.items() for s, b in sorted(near)[:top])


def test_neighbours_with_few_totals_broadcast(spark):
    expected = neighbours_by_hand()
    assert rows(sparse.term_neighbours(texts(spark))) == expected
    # every bound leaves some totals to be met by a shuffle
    for bound in (0, 1, 4):
        assert rows(sparse.term_neighbours(texts(spark), max_rows=bound)) == expected
    assert rows(sparse.term_neighbours(texts(spark).filter("false"))) == []


def test_terms_that_share_a_code_get_another_seed(spark, monkeypatch):
    plain, seeds = sparse.coded_tokens, []

    def clashing(df, id_col, text_col, colocate, seed):
        seeds.append(seed)
        coded = plain(df, id_col, text_col, colocate, seed)
        if seed:
            return coded
        return coded.withColumn("codes", F.transform("codes", lambda c: F.pmod(c, F.lit(3))))

    monkeypatch.setattr(sparse, "coded_tokens", clashing)
    assert rows(sparse.term_neighbours(texts(spark))) == neighbours_by_hand()
    assert seeds == [0, 1, 1]


def test_parts_grow_with_the_texts(spark, monkeypatch):
    whole = sorted(map(str, sparse.term_counts(texts(spark)).collect()))
    monkeypatch.setattr(sparse, "PART_BYTES", 8)
    held = sum(len((t or "").encode()) for _, t in TEXTS)
    placed = sparse.place_texts(texts(spark), "chunk_id", "text")
    assert placed.rdd.getNumPartitions() == -(-held // 8)
    assert sorted(map(str, sparse.term_counts(texts(spark)).collect())) == whole


def test_settled_tables_leave_no_shuffle_files(spark):
    """What a checkpoint was made of is deleted at once, not when the driver is short of memory."""
    import time

    from corpusloom.functions.memory import settled

    tracker = spark.sparkContext._jsc.sc().env().mapOutputTracker()

    def held():
        return tracker.shuffleStatuses().size()

    settled(lambda: spark.range(1))     # leaves only what something still refers to
    time.sleep(2)
    before = held()
    near = settled(lambda: sparse.term_neighbours(texts(spark)))
    until = time.time() + 10
    while held() > before and time.time() < until:
        time.sleep(0.2)
    assert held() <= before, (held(), before)
    assert near.count() == len(neighbours_by_hand())
