import datetime
import shutil

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import metrics, telemetry
from corpusloom.plans.corpus import ingest, process_corpus
from corpusloom.plans.retrieval import benchmark_sources, search_collection
from corpusloom.sources import collection as store
from corpusloom.sources.files import scan_texts
from corpusloom.streaming.ingest import ingest_stream
from corpusloom.streaming.throttle import throttle_stream

START = datetime.datetime(2024, 1, 1)
READING = (
    "host string, ts timestamp, cpu_percent double, mem_percent double, "
    "mem_available_gb double, cpu_temp_c double, gpu_temp_c double"
)


@pytest.fixture()
def folder(tmp_path):
    docs = tmp_path / "docs"
    docs.mkdir()
    (docs / "a.md").write_text("Spark plans joins. Engines turn gears. Birds sing at dawn.")
    (docs / "b.py").write_text("def run():\n    return 1\n\ndef stop():\n    return 2\n")
    (docs / "c.html").write_text("<h1>Title of page</h1><p>Hash joins</p><p>Hash joins</p>")
    return docs


def readings(spark, cpus, host="h", mem=10.0, temp=None, start=0):
    rows = [
        (host, START + datetime.timedelta(seconds=start + i), float(c), mem, 16.0, temp, None)
        for i, c in enumerate(cpus)
    ]
    return spark.createDataFrame(rows, READING)


def states(df):
    return [r.throttled for r in df.orderBy("ts").collect()]


def test_hysteresis_and_blocks(spark):
    cpus = [50, 81, 70, 64, 63, 70, 90, 65]
    expected = [False, True, True, True, False, False, True, True]
    df = readings(spark, cpus)
    for blocks in (1, 2, 3, 1024):
        assert states(telemetry.throttle_state(df, blocks=blocks)) == expected
    start = spark.createDataFrame([("h", True)], "host string, throttled boolean")
    held = telemetry.throttle_state(readings(spark, [70, 63]), initial=start)
    assert states(held) == [True, False]


def test_rules_in_order(spark):
    rows = [
        ("a", START, 99.0, 99.0, 1.0, 86.0, 84.0),
        ("b", START, 99.0, 99.0, 1.0, 0.0, 84.0),
        ("c", START, 99.0, 99.0, 1.0, None, None),
        ("d", START, 10.0, 71.0, 1.0, None, None),
        ("e", START, 10.0, 10.0, 3.5, None, None),
        ("f", START, 80.0, 70.0, 4.0, 85.0, 83.0),
        ("g", START, 10.0, 10.0, 9.0, 96.0, 91.0),
    ]
    df = spark.createDataFrame(rows, READING)
    got = {r.host: r.reason for r in telemetry.classify_pressure(df).collect()}
    assert got == {
        "a": "CPU Temp High (86.0°C)", "b": "GPU Temp High (84.0°C)", "c": "CPU High (99.0%)",
        "d": "Memory High (71.0%)", "e": "Memory Low (3.5GB)", "f": "",
        "g": "CPU Temp High (96.0°C)",
    }
    alerts = {r.host: r.alert for r in telemetry.critical_alerts(df).collect()}
    assert alerts == {"g": "CPU temp critical: 96.0°C"}


def test_rates_without_time_are_zero(spark):
    rows = spark.createDataFrame([(3, 10, 4.0), (3, 10, 0.0)], "files_processed long, deduped_chunks long, seconds double")
    got = sorted((r.files_per_second, r.chunks_per_second) for r in metrics.rates(rows).collect())
    assert got == [(0.0, 0.0), (0.75, 2.5)]
    seen, counts = metrics.observe_chunks(spark.createDataFrame([("ab",), ("c",)], "text string"))
    seen.collect()
    assert counts.get == {"chunks": 2, "characters": 3}


def test_ingest_append_upsert_search_drop(spark, folder):
    store.drop_collection(spark, "jobs", confirm=True)
    made = store.open_collection(spark, "jobs", buckets=2)
    assert store.open_collection(spark, "jobs", buckets=2).exists()
    row = ingest(spark, str(folder), made, mode="upsert").first()
    assert row.files_processed == 3 and row.initial_chunks == row.deduped_chunks + 1
    n = made.chunks().count()
    assert n == row.deduped_chunks
    ingest(spark, str(folder), made, mode="upsert")
    assert made.chunks().count() == n
    postings = made.postings().count()
    store.compact_collection(made)
    assert (made.chunks().count(), made.postings().count()) == (n, postings)
    assert spark.table(made.chunks_table).count() == n
    ingest(spark, str(folder), made, mode="append")
    assert made.chunks().count() == 2 * n
    queries = spark.createDataFrame([(1, "hash joins")], "query_id long, query string")
    best = search_collection(made, queries, limit=3).orderBy("rank").first()
    assert best.text == "Hash joins" and best.content_type == "markup" and best.file_type == ".html"
    store.refresh_neighbours(made)
    again = search_collection(made, queries, limit=3).orderBy("rank").first()
    assert again.text == "Hash joins"
    assert "jobs" in [r.name for r in store.list_collections(spark).collect()]
    with pytest.raises(ValueError):
        store.drop_collection(spark, "jobs")
    assert store.drop_collection(spark, "jobs", confirm=True) == ["jobs"]
    assert not made.exists()
    fresh = store.recreate_collection(spark, "jobs", buckets=2)
    assert fresh.chunks().isEmpty()
    store.drop_collection(spark, None, confirm=True)
    assert store.list_collections(spark).isEmpty()


def test_chunk_and_posting_reads_need_no_shuffle(spark):
    made = store.recreate_collection(spark, "placed", buckets=2)
    for frame in (made.chunks(), made.postings()):
        assert "Exchange" not in frame._jdf.queryExecution().executedPlan().toString()
    store.drop_collection(spark, "placed", confirm=True)


def test_stream_equals_batch(spark, folder, tmp_path):
    store.drop_collection(spark, "streamed", confirm=True)
    made = store.create_collection(spark, "streamed", buckets=2)
    state = str(tmp_path / "state")
    ingest_stream(spark, str(folder), made, state, max_files=1).awaitTermination()
    batch = process_corpus(scan_texts(spark, str(folder)).select("source", "text"))
    want = {(r.source.split("/")[-1], r.chunk_no, r.text) for r in batch.collect()}

    def stored():
        return {(r.source.split("/")[-1], r.chunk_no, r.text) for r in made.chunks().collect()}

    assert stored() == want
    (folder / "d.txt").write_text("A later file.")
    ingest_stream(spark, str(folder), made, state).awaitTermination()
    assert stored() == want | {("d.txt", 0, "A later file.")}
    store.drop_collection(spark, "streamed", confirm=True)


def test_throttle_stream_equals_batch(spark, tmp_path):
    source, parts = tmp_path / "in", [[50, 81, 70], [64, 63, 70], [90, 65]]
    whole = None
    source.mkdir()
    for n, cpus in enumerate(parts):
        part = readings(spark, cpus, start=10 * n).unionByName(
            readings(spark, cpus[::-1], host="g", start=10 * n)
        )
        whole = part if whole is None else whole.unionByName(part)
        out = tmp_path / f"part{n}"
        part.coalesce(1).write.parquet(str(out))
        name = next(p for p in out.iterdir() if p.suffix == ".parquet")
        shutil.copy(name, source / f"{n}.parquet")
        stream = spark.readStream.schema(READING).option("maxFilesPerTrigger", 1).parquet(str(source))
        throttle_stream(
            stream, str(tmp_path / "state"), str(tmp_path / "out"), str(tmp_path / "check")
        ).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).select("host", "ts", "throttled")
    want = telemetry.throttle_state(whole).select("host", "ts", "throttled")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    late = readings(spark, [99], start=5)
    late.coalesce(1).write.parquet(str(tmp_path / "late"))
    name = next(p for p in (tmp_path / "late").iterdir() if p.suffix == ".parquet")
    shutil.copy(name, source / "late.parquet")
    stream = spark.readStream.schema(READING).parquet(str(source))
    throttle_stream(
        stream, str(tmp_path / "state"), str(tmp_path / "out"), str(tmp_path / "check")
    ).awaitTermination()
    after = spark.read.parquet(str(tmp_path / "out")).select("host", "ts", "throttled")
    assert after.count() == got.count()
    kept = spark.read.parquet(str(tmp_path / "out-late")).select("host", "ts", "cpu_percent")
    assert kept.collect() == late.select("host", "ts", "cpu_percent").collect()


def test_throttle_stream_keeps_equal_times(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    whole = None
    for n, cpus in enumerate([[50, 81], [60, 90], [70]]):
        # each batch starts at the time at which the one before ended
        part = readings(spark, cpus, start=n).withColumn("id", F.col("cpu_percent").cast("int") + 1000 * n)
        whole = part if whole is None else whole.unionByName(part)
        part.coalesce(1).write.parquet(str(tmp_path / f"part{n}"))
        name = next(p for p in (tmp_path / f"part{n}").iterdir() if p.suffix == ".parquet")
        shutil.copy(name, source / f"{n}.parquet")
        stream = spark.readStream.schema(whole.schema).option("maxFilesPerTrigger", 1).parquet(str(source))
        throttle_stream(
            stream, str(tmp_path / "state"), str(tmp_path / "out"), str(tmp_path / "check"),
            order_cols=("ts", "id"),
        ).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).select("id", "throttled")
    want = telemetry.throttle_state(whole, order_cols=("ts", "id")).select("id", "throttled")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert got.count() == 5


def test_benchmark_over_first_sources(spark):
    docs = spark.createDataFrame(
        [(f"/d/{i}.txt", f"Text number {i} about topic {i % 3}. More of topic {i % 5}.") for i in range(25)],
        "source string, text string",
    )
    queries = spark.createDataFrame([(1, "topic 2"), (2, "number 7")], "query_id long, query string")
    assert 0.5 <= benchmark_sources(docs, queries, k=3).first().mean_recall <= 1.0


def test_points_replaced_by_key(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "chunk_id long, text string")
    new = spark.createDataFrame([(2, "c"), (3, "d")], "chunk_id long, text string")
    got = store.merge_points(old, new).orderBy("chunk_id").collect()
    assert [tuple(r) for r in got] == [(1, "a"), (2, "c"), (3, "d")]
    ids = new.withColumn("p", store.point_id("chunk_id", "text")).select(F.countDistinct("p")).first()[0]
    assert ids == 2
