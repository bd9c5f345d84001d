import random
import zlib
from hashlib import sha256

from pyspark.sql import functions as F

from corpusloom.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def digest(text):
    return sha256(text.encode()).hexdigest()


def leaf(row):
    parts = ("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row)
    return digest("".join(parts))


def fold(nodes):
    """Levels of a whole tree."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([digest("".join(last[i : i + 8])) for i in range(0, len(last), 8)])
    return levels


def siblings(levels, at):
    found = []
    for level in levels[:-1]:
        begin = at // 8 * 8
        found.append((level[begin:at], level[at + 1 : begin + 8]))
        at //= 8
    return found


def brute_force(rows, changed):
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append((row[0] is None, row[0] or 0, leaf(row), row))
    names = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {x: fold([entry[2] for entry in sorted(groups[x], key=lambda e: e[:3])]) for x in names}
    top = fold([trees[x][-1][0] for x in names])
    root, out = top[-1][0], []
    for place, name in enumerate(names):
        for at, (_, _, own, row) in enumerate(sorted(groups[name], key=lambda e: e[:3])):
            path = siblings(trees[name], at) + siblings(top, place)
            proof = digest("".join("".join(x + y) for x, y in path))
            value = own
            if changed(row):
                value = leaf((*row[:4], None if row[4] is None else "".join(
                    c.lower() if "A" <= c <= "Z" else c for c in row[4])))
            for before, after in path:
                value = digest("".join(before) + value + "".join(after))
            out.append((row[0], own, trees[name][-1][0], root, proof, value, value == root))
    return sorted(out, key=str)


def third(row):
    return row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0


def manifest(docs):
    changed = F.col("doc_id").isNotNull() & (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0)
    return merkle.merkle_manifest(docs, {"text": merkle.lower_ascii(F.col("text"))}, changed)


def answer(frame):
    names = "doc_id leaf subroot root proof_sha256 folded_root verified".split()
    return sorted((tuple(r[n] for n in names) for r in frame.collect()), key=str)


def test_against_brute_force(spark):
    chance = random.Random(5)
    rows = [(i, "s", chance.choice(["de", "en", "en", None, "é", "zz", ""]), i, f"Text {i} Ä") for i in range(300)]
    rows += [
        (None, None, None, None, None), (None, None, None, None, None), (7, "a", "en", None, ""),
        (7, "a", "en", None, ""), (7, "b", "en", 1, "Other"), (-4, "", "lonely", 0, "A" * 300_000),
    ]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = manifest(docs)
    assert answer(got) == brute_force(rows, third)
    for row in got.collect():
        assert (not row["copied"]) == row["verified"]
        assert not row["copied"] or row["copied"][-1] == row["folded_root"]


def test_group_of_several_blocks(spark):
    rows = [(i, None, "en" if i % 11 else "de", 1, "Aa" if i % 5 else "a") for i in range(9500)]
    assert answer(manifest(spark.createDataFrame(rows, SCHEMA))) == brute_force(rows, third)


def test_one_repeated_row_fills_many_places(spark):
    rows = [(1, "s", "en", 1, "Same")] * 4500
    assert answer(manifest(spark.createDataFrame(rows, SCHEMA))) == brute_force(rows, third)


def test_edges(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert manifest(empty).count() == 0
    rows = [(3, "s", "en", 1, "X")]
    docs = spark.createDataFrame(rows, SCHEMA)
    for name in "grp pos row leaf fresh node task run at block path upper root subroot top".split():
        docs = docs.withColumn(name, F.lit("mine"))
    assert answer(manifest(docs)) == brute_force(rows, third)
    untouched = merkle.merkle_manifest(docs).collect()
    assert untouched[0]["verified"] and untouched[0]["root"] == leaf(rows[0])
