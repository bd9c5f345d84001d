import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import common, jaccard, meeting
from corpusloom.llm.collisions import collision_search, near_duplicates, occurring, signature_sketch
from corpusloom.llm.common import text_slices
from corpusloom.llm.jaccard import bitmap_sketch, keep_one, link_components, tree_search


def brute(rows, words, threshold):
    num, den = threshold
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(
            c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        if not w:
            sets.append(set())
        elif len(w) < words:
            sets.append({tuple(w)})
        else:
            sets.append({tuple(w[i : i + words]) for i in range(len(w) - words + 1)})
    last = float("inf")
    ids = [last if d is None else d for d, _ in rows]
    component = list(range(len(rows)))

    def find(i):
        while component[i] != i:
            i = component[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j]:
                common = len(sets[i] & sets[j])
                if den * common >= num * len(sets[i] | sets[j]):
                    component[find(i)] = find(j)
    smallest = {}
    for i in range(len(rows)):
        smallest[find(i)] = min(smallest.get(find(i), last), ids[i])
    found = [(rows[i][0], len(sets[i]), smallest[find(i)]) for i in range(len(rows))]
    return [(d, n, None if c == last else c) for d, n, c in found]


JOINS = {"trees": link_components, "collisions": near_duplicates}


def check(spark, rows, words=3, threshold=(90, 100), how="trees", **limits):
    frame = spark.createDataFrame(
        [(d, t, 1, "k") for d, t in rows], "doc_id long, text string, node int, keys string"
    )
    for name in "n bucket key root a b slot size kept component_id".split():
        frame = frame.withColumn(name, F.lit("mine"))
    got = JOINS[how](frame, words, threshold, **limits)
    if how == "collisions":
        assert got.filter("kept <> (doc_id <=> component_id)").count() == 0
        got = got.drop("kept")
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    order = lambda r: (r[0] is None, r[0] or 0, r[1], r[2] is None, r[2] or 0)
    want = sorted(brute(rows, words, threshold), key=order)
    assert sorted(map(tuple, got.collect()), key=order) == want
    return want


def corpus(seed, n=120, copies=60):
    rng = random.Random(seed)
    prose = lambda k: [rng.choice("abcdefghijklmnop") * rng.randint(1, 4) for _ in range(k)]
    base = [prose(rng.choice([1, 2, 3, 5, 9, 12, 20, 60, 200, 500])) for _ in range(n)]
    for _ in range(copies):
        words = list(rng.choice(base))
        for _ in range(rng.randint(0, max(1, len(words) // 25))):
            words[rng.randrange(len(words))] = rng.choice("xyz")
        base.append(words)
    ids = list(range(len(base)))
    rng.shuffle(ids)
    return [(i, " ".join(w)) for i, w in zip(ids, base, strict=True)]


@pytest.mark.parametrize(
    "how,words,threshold",
    [("trees", 3, (90, 100)), ("trees", 5, (80, 100)), ("collisions", 5, (85, 100)), ("collisions", 3, (80, 100))],
)
def test_against_brute_force(spark, how, words, threshold):
    want = check(spark, corpus(words), words, threshold, how)
    assert sum(c != d for d, _, c in want) > 20


@pytest.mark.parametrize("how", JOINS)
def test_swollen_buckets_go_row_by_row(spark, how):
    want = check(spark, corpus(7, 60, 40), 3, (85, 100), how, bucket_bytes=1, block=5)
    assert sum(c != d for d, _, c in want) > 10


@pytest.mark.parametrize("how", JOINS)
def test_large_components_in_blocks(spark, how):
    rng = random.Random(8)
    base = [rng.choice("abcdefghijklmnopqrstuvwxyz") + str(rng.randint(0, 99)) for _ in range(300)]
    rows = []
    for i in range(90):
        words = list(base)
        for _ in range(rng.choice([1, 2, 3, 9, 12])):
            words[rng.randrange(300)] = f"new{rng.randint(0, 9999)}"
        rows.append((i, " ".join(words)))
    want = check(spark, rows, how=how, block=8)
    assert len({c for _, _, c in want}) > 1


@pytest.mark.parametrize("how", JOINS)
def test_families_that_share_passages(spark, how):
    """Families of near copies, most of each a passage that all of them share: the
    keys of the passage join everything, the links must not."""
    rng = random.Random(4)
    word = lambda: f"w{rng.randint(0, 10**9)}"
    passage, rows = [word() for _ in range(70)], []
    for _ in range(50):
        own = passage + [word() for _ in range(30)]
        for _ in range(4):
            copy = list(own)
            copy[rng.randrange(100)] = word()
            rows.append((len(rows), " ".join(copy)))
    want = check(spark, rows, 5, (80, 100), how)
    assert len({c for _, _, c in want}) >= 50
    assert len({c for _, _, c in want}) < 100


def test_many_sets_with_one_passage(spark):
    """5,400 sets share a fifth of their words; only 200 pairs link, none through the passage."""
    rng = random.Random(6)
    word = lambda: f"w{rng.randint(0, 10**9)}"
    passage, rows, want = [word() for _ in range(20)], [], 0
    for i in range(5200):
        own = passage + [word() for _ in range(80)]
        rows.append((len(rows), " ".join(own)))
        if i < 200:
            rows.append((len(rows), " ".join([*own, word()])))
            want += 1
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    for join in JOINS.values():
        got = join(frame, 5, (80, 100))
        assert sum(r["doc_id"] != r["component_id"] for r in got.collect()) == want


def test_occurrences_by_prefix_and_skips():
    rng = random.Random(9)
    for _ in range(300):
        lists = [sorted(rng.sample(range(30), rng.randint(0, 12))) for _ in range(rng.randint(0, 9))]
        least = rng.randint(1, 6)
        times = {x: sum(x in y for y in lists) for x in range(30)}
        want = {(x, n) for x, n in times.items() if n >= least}
        found = occurring([np.array(x, int) for x in lists], least)
        assert set(zip(*(x.tolist() for x in found), strict=True)) == want


@pytest.mark.parametrize("search", [tree_search((80, 100)), collision_search])
def test_searches_propose_all_that_link(search):
    """Whatever the sides: no linked pair that may meet is left out."""
    draw = bitmap_sketch if search is not collision_search else signature_sketch
    rows = corpus(11, 40, 80)
    tokens, counts = meeting.token_sets([t for _, t in rows], 3)
    ends = np.cumsum(counts)
    sets = [tokens[e - c : e] for e, c in zip(ends, counts, strict=True)]
    rng = random.Random(2)
    for _ in range(6):
        members = rng.sample([i for i in range(len(sets)) if len(sets[i])], 70)
        roots = [rng.choice("abcdefghijkl") for _ in members]
        sides = rng.choice([None, [rng.randint(0, 1) for _ in members]])
        found = search([draw(sets[m]) for m in members], roots, sides)
        got = {frozenset(x) for x in zip(found[1].tolist(), found[2].tolist(), strict=True)}
        assert all(roots[x] != roots[y] for x, y in map(tuple, got))
        for x in range(70):
            for y in range(x):
                a, b = sets[members[x]], sets[members[y]]
                common = meeting.common_tokens(a, b)
                meets = not sides or sides[x] != sides[y]
                if meets and roots[x] != roots[y] and 100 * common >= 85 * (len(a) + len(b) - common):
                    assert frozenset((x, y)) in got


def test_keep_one_passes_any_columns(spark):
    text = " ".join(f"word{i}" for i in range(30))
    rows = [(1, text), (2, text), (2, text), (3, None), (3, None), (None, "apart"), (4, text + " x"), (5, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for name in "id content document kept_id copies _kept _hash _no node root".split():
        docs = docs.withColumn(name, F.lit("mine"))
    got = keep_one(docs, 5, (80, 100))
    assert got.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in got.collect()) == ["1", "3", "5", "None"]
    assert keep_one(docs.limit(0), 5, (80, 100)).count() == 0


def test_set_ids_tell_sets_apart():
    tokens, counts = meeting.token_sets([f"a{i} b c{i % 7} d e" for i in range(3000)], 3)
    ids = meeting.set_ids(tokens, counts)
    assert len(np.unique(ids[:, 0])) == len(np.unique(ids[:, 1])) == 3000


@pytest.mark.parametrize("how", JOINS)
def test_edges(spark, how):
    check(
        spark,
        [
            (1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "ONE"), (6, "one two"), (7, "two one"),
            (8, "É x y"), (9, "é X Y"), (10, "a b c"), (10, "a b c"), (None, "A b\tc"),
            (None, "only null here now"), (None, "only null here now"), (11, "only null here NOW then"),
            (12, "a a a a a a a a"), (13, "a a a"), (14, "z" * 5000), (15, "z" * 5000),
        ],
        how=how,
    )


@pytest.mark.parametrize("how", JOINS)
def test_no_rows_and_no_links(spark, how):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert JOINS[how](empty).count() == 0
    check(spark, [(1, "a b c d"), (2, "e f g h")], how=how)


def test_keys_travel_short_however_many_buckets(spark):
    # each set once: a task sends the keys of equal sets once
    rows = list({text: (number, text) for number, text in corpus(3, 60, 0)}.values())
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    keys_of = lambda tokens, counts: jaccard.route_keys(tokens, counts, (90, 100))
    scanned = meeting.scan_sets(docs, 3, keys_of, 100_000).filter("bucket is not null").collect()
    keys = sum(len(meeting.unpacked(as_table([r]))[0]) for r in scanned)
    tokens, counts = meeting.token_sets([t for _, t in rows], 3)
    assert keys == len(keys_of(tokens, counts)[0]) > 500
    assert sum(len(r["keys"]) + len(r["counts"]) + len(r["nodes"]) for r in scanned) <= 14 * keys


def as_table(rows):
    names = ["bucket", "keys", "counts", "nodes"]
    return pa.table({n: [r[n] if n == "bucket" else bytes(r[n]) for r in rows] for n in names})


def test_short_keys_differ_between_buckets():
    keys = np.array([1, 1 << 39, (1 << 40) - 1, 0, 2**63 + 5], np.uint64)
    here, there = (meeting.long_keys(meeting.short_keys(keys), b) for b in (0, 70_000))
    assert len(set(here.tolist()) | set(there.tolist())) == 10
    assert (here == keys % np.uint64(1 << 40)).all()
    for counts in ([1, 255], [256, 3], [70_000, 1]):
        assert meeting.long_counts(meeting.short_counts(np.array(counts)), 2).tolist() == counts


def test_halves_that_are_equal_lose_no_list(spark):
    """Two sets whose ids begin alike, in a list with a third one."""
    ids = np.array([[5, 1], [5, 2], [9, 3]], np.uint64)
    keys = np.array([77], np.uint64)
    rows = [(n, 4, bytes(i), None, None, None, None) for n, i in enumerate(ids)] + [
        (None, None, None, 0, meeting.short_keys(keys), meeting.short_counts(np.array([1])), i[0].tobytes())
        for i in ids
    ]
    scanned = spark.createDataFrame(rows, meeting.SCANNED)
    for most in (1 << 20, 1):
        got = meeting.key_lists(scanned, most).collect()
        assert {bytes(r["node"]) for r in got} == {bytes(i) for i in ids}


def test_texts_become_strings_a_slice_at_a_time():
    texts = pa.array(["é" * 40, None, "", "x" * 500, "y", "z" * 30])
    found = list(text_slices(texts, 100))
    assert [i for s in found for i in range(len(texts))[s]] == list(range(6))
    assert all(sum(len((t or "").encode()) for t in texts[s].to_pylist()[:-1]) < 100 for s in found)
    assert list(text_slices(texts[:0], 100)) == []


def test_pairs_of_many_near_copies_stay_small():
    """A list of near copies proposes all of its pairs; they must not become Python objects."""
    rng = np.random.default_rng(1)
    base, own = rng.integers(0, 2**63, 200), rng.integers(0, 2**63, (500, 20))
    sketches = [bitmap_sketch(np.unique(np.append(base, o)).astype(np.uint64)) for o in own]
    search = tree_search((80, 100))
    tracemalloc.start()
    try:
        overlap, x, y = search(sketches, list(range(500)), None)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(set(zip(x.tolist(), y.tolist(), strict=True))) == len(overlap) == 500 * 499 // 2
    assert peak < 50 * len(overlap)


def test_large_lookups_are_not_broadcast(spark):
    """Beyond the bound nothing of the small table goes through the driver, whatever its size."""
    small = common.staged(
        spark.range(4000).selectExpr("id as key", "cast(id % 3 as long) as value"), "small"
    )
    big = spark.range(6000).selectExpr(
        "case when id % 10 = 0 then null when id % 10 < 4 then 7 else id end as at", "id as no"
    )
    for options, broadcasts in (({}, 0), ({"salted_rows": 1000}, 2)):   # 2: of the one frequent key
        got = common.left_lookup(big, small, "at", "key", "no", max_rows=100, **options)
        plan = got._jdf.queryExecution().sparkPlan().toString()
        joins = [x for x in plan.splitlines() if "Join" in x]
        assert "SortMergeJoin" in joins[0] and len(joins) == 1 + broadcasts, plan
        assert got.columns == ["at", "no", "key", "value"]
        rows = {(r["at"], r["no"]): (r["key"], r["value"]) for r in got.collect()}
        assert rows == {
            (a, n): (a, a % 3) if a is not None and a < 4000 else (None, None)
            for a, n in ((r["at"], r["no"]) for r in big.collect())
        }


def test_long_rows_stay_in_place(spark):
    """Up to eight million wanted ids move no text, and the driver gets 9 bytes of each."""
    small = common.staged(
        spark.range(0, 4000, 2).selectExpr("id * 1000003 as key", "id % 3 = 0 as many"), "small"
    )
    big = spark.range(5000).selectExpr("id * 1000003 as at", "cast(id as string) as text").repartition(3)
    found = [
        common.flagged(big, small, "at", "key", "many", "at", max_rows=m, packed_rows=p)
        for m, p in ((5000, 9000), (100, 9000), (100, 200))
    ]
    wanted = {(i * 1000003, str(i), i % 3 == 0) for i in range(0, 4000, 2)}
    for got in found:
        assert got.columns == ["at", "text", "many"]
        rows = [tuple(r) for r in got.collect()]
        assert len(rows) == 2000 and set(rows) == wanted
    plan = found[1]._jdf.queryExecution().sparkPlan().toString()
    assert "Join" not in plan and plan.count("ArrowEvalPython") == 1, plan
