import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from corpusloom.llm import curves, warc


def test_archives(spark, tmp_path):
    big = "<p>" + "é long page " * 20000
    rows = [(5, "http://a", "same"), (3, "http://b", "same"), (9, "http://c", None), (8, None, ""), (7, "u\nv", big),
            (1, "http://d", "x"), (1, "http://d", "x"), (2, "http://e", "x"), (None, "http://f", "same"), (None, "g", "nul")]
    frame = spark.createDataFrame([(*r, "s", 1) for r in rows], "page_id long, url string, html string, sha string, bytes int")
    archives = warc.write_archives(frame)
    got = warc.read_archives(archives).collect()
    assert len(got) == len(rows)
    payload = lambda h: (h or "").encode()
    by_digest = {warc.digest(payload(h)): payload(h) for _, _, h in rows}
    for r in got:
        raw = by_digest[r["payload_digest"]]
        assert r["payload_bytes"] == len(raw)
        same = [p for p, _, h in rows if payload(h) == raw and p is not None]
        if r["record_type"] == "response":
            assert r["payload"] == raw and r["refers_to"] is None
            assert r["page_id"] == (min(same) if same else None)
        else:
            assert r["refers_to"] == min(same)
    assert sum(r["record_type"] == "response" for r in got) == len({payload(h) for _, _, h in rows})
    written = warc.export_archives(archives, f"file://{tmp_path}/out").collect()
    content = (tmp_path / "out" / written[0]["path"].split("/")[-1]).read_bytes()
    assert content[:4] == bytes.fromhex("5d2a4d18")
    assert all(r.startswith(b"WARC/1.1") for r in warc.split_archive(content))
    all_responses = warc.read_archives(warc.write_archives(frame, min_revisit_bytes=5)).collect()
    assert sum(r["record_type"] == "revisit" for r in all_responses) == 0
    with pytest.raises(ValueError):
        list(warc.split_archive(content[:-3]))


def test_no_pages(spark):
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read_archives(warc.write_archives(empty)).count() == 0


def test_hilbert_is_a_curve():
    side, bits = 8, 3
    cells = np.array([(x, y, z) for x in range(side) for y in range(side) for z in range(side)])
    keys = curves.hilbert_keys(cells, bits)
    assert sorted(keys) == list(range(side**3))
    walk = cells[np.argsort(keys)]
    assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()


def exact(rows, top):
    good = {i: np.array(v, float) for i, v in rows
            if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    found = {}
    for q, x in good.items():
        if q % 20 == 0:
            scored = sorted((-float(x @ y), i) for i, y in good.items() if i != q)
            found[q] = [(i, -s) for s, i in scored[:top]]
    return found


def test_neighbours_of_a_small_table_are_exact(spark):
    rng = np.random.default_rng(5)
    rows = [(int(i), [float(np.float32(x)) for x in rng.normal(size=6) * (1 + i % 3)]) for i in range(300)]
    rows += [(i, [1.0, 2.0, 0.5, 0.25, 0.0, 1.0]) for i in range(300, 400)]
    rows += [(500, None), (520, [0.0] * 6), (540, [float("nan")] + [1.0] * 5), (560, [None] + [1.0] * 5),
             (580, [float("inf")] + [1.0] * 5), (None, [1.0] * 6), (600, [])]
    frame = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, rank string")
    got = {}
    for r in curves.nearest_neighbours(frame, lambda v: v % 20 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    want = exact(rows, 20)
    assert got.keys() == want.keys()
    for q in want:
        assert [s for _, s in got[q]] == pytest.approx([s for _, s in want[q]])
        if q >= 300:
            assert [i for i, _ in got[q]] == [i for i, _ in want[q]]
    assert curves.nearest_neighbours(frame.limit(0), lambda v: v % 20 == 0).count() == 0
    few = curves.nearest_neighbours(frame.filter("vec_id in (0, 1, 2)"), lambda v: v % 20 == 0)
    assert few.count() == 2


def test_recall(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(6000, 24)).astype(np.float32)
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = {}
    for r in curves.nearest_neighbours(frame, lambda v: v % 200 == 0).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    scores = x.astype(float) @ x.astype(float).T
    np.fill_diagonal(scores, -np.inf)
    recall = np.mean([len(got[q] & set(np.argsort(-scores[q])[:20].tolist())) / 20 for q in got])
    assert recall >= 0.9


def measured_recall(got, x, queries, top):
    scores = x[queries].astype(float) @ x.astype(float).T
    scores[np.arange(len(queries)), queries] = -np.inf
    best = np.argsort(-scores, axis=1)[:, :top]
    return np.mean([len(got[q] & set(b.tolist())) / top for q, b in zip(queries, best, strict=True)])


def test_recall_where_the_index_prunes(spark, tmp_path):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(10, 64))[rng.integers(0, 10, 50_000)] + 0.5 * rng.normal(size=(50_000, 64))
    x = (x / np.linalg.norm(x, axis=1)[:, None]).astype(np.float32)
    flat = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), 64).cast(pa.list_(pa.float32()))
    pq.write_table(pa.table({"vec_id": np.arange(len(x)), "embedding": flat}), tmp_path / "x.parquet")
    index = curves.build_index(spark.read.parquet(f"{tmp_path}/x.parquet"), lambda v: v % 100 == 0)
    assert index.scored_share() <= 0.25
    got = {}
    for r in curves.search_index(index).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    assert measured_recall(got, x, np.arange(0, 50_000, 100), 20) >= 0.9


def test_repeated_ids_and_odd_lengths(spark):
    rows = [(20, [0.0, 1.0]), (20, [1.0, 0.0]), (40, [0.0, 1.0]), (41, [1.0, 0.0]), (42, [1.0, 0.0]), (42, [1.0, 0.0]),
            (7, [5.0, 5.0, 5.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = curves.nearest_neighbours(frame, lambda v: v % 20 == 0, top=3).collect()
    by_query = {q: [(r["vec_id"], r["score"]) for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == q]
                for q in (20, 40)}
    assert by_query == {20: [(40, 1.0), (41, 0.0), (42, 0.0)], 40: [(20, 1.0), (41, 0.0), (42, 0.0)]}
    assert curves.nearest_neighbours(frame, lambda v: v < 0).count() == 0
