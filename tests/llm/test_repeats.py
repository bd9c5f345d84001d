import hashlib
import random

from corpusloom.llm.repeats import LENGTH, remove_repeats


def brute(rows):
    """Per row: bytes, removed, spans, digest."""
    first = {}
    raws = [(d if d is not None else float("inf"), (t or "").encode()) for d, t in rows]
    for d, raw in raws:
        for i in range(len(raw) - LENGTH + 1):
            w = raw[i : i + LENGTH]
            first[w] = min(first.get(w, float("inf")), d)
    found = []
    for (doc, _), (d, raw) in zip(rows, raws, strict=True):
        gone = [False] * len(raw)
        for i in range(len(raw) - LENGTH + 1):
            if first[raw[i : i + LENGTH]] < d:
                gone[i : i + LENGTH] = [True] * LENGTH
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        found.append((doc, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return found


def check(spark, rows):
    frame = spark.createDataFrame(
        [(d, t, "x", 0) for d, t in rows], "doc_id long, text string, key string, part int"
    )
    got = remove_repeats(frame)
    assert all(
        hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"] for r in got.collect()
    )
    got = [tuple(r)[:5] for r in got.collect()]
    order = lambda r: (r[0] is None, r[0] or 0, r)
    assert sorted(got, key=order) == sorted(brute(rows), key=order)


def test_planted_repeats(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(2, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    shared = [prose(n) for n in (8, 9, 12, 30, 80)]
    rows = []
    for i in range(60):
        text = prose(rng.randint(0, 60))
        for _ in range(rng.randint(0, 3)):
            passage = rng.choice(shared)
            a = rng.randint(0, len(passage) // 2)
            cut = passage[a : a + rng.randint(20, len(passage))]
            at = rng.randint(0, len(text))
            text = text[:at] + cut + text[at:]
        rows.append((i, text))
    rows += [(60 + i, rows[i][1]) for i in range(5)]
    rng.shuffle(rows)
    check(spark, rows)


def test_edges(spark):
    check(
        spark,
        [
            (1, None), (2, ""), (3, "a" * 49), (4, "a" * 49), (5, "b" * 50), (6, "b" * 50),
            (7, "c" * 3000), (8, "xx" + "c" * 700), (9, "ab" * 400), (10, "zab" + "ab" * 300),
            (None, "c" * 80 + "end of it"), (None, "c" * 80 + "end of it"),
            (11, "q" * 60 + "r" * 60), (11, "q" * 60 + "r" * 60), (12, "r" * 55 + "q" * 60),
        ],
    )


def test_long_text_over_segments(spark):
    rng = random.Random(5)
    long_one = "".join(rng.choice("abcdefgh ") for _ in range(1_200_000))
    cut = long_one[999_900:1_000_200]
    frame = spark.createDataFrame([(2, "y" * 40 + cut), (1, long_one)], "doc_id long, text string")
    got = {r["doc_id"]: r["n_removed"] for r in remove_repeats(frame, keep_text=False).collect()}
    assert got == {1: 0, 2: 300}


def test_empty_table(spark):
    assert remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0
