"""Python steps that hold a bounded part of a batch."""

import unicodedata

from corpusloom.functions import memory, text
from corpusloom.operators import ann, search


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_composed_in_small_parts(spark, monkeypatch):
    monkeypatch.setattr(text, "NFC_BYTES", 10)
    given = ["plain", "café", "café", "가", None, "", "ạ̇" * 30, "tail\n", "̀"]
    df = spark.createDataFrame(list(enumerate(given)), "id long, text string").coalesce(1)
    expected = [(i, None if t is None else unicodedata.normalize("NFC", t)) for i, t in enumerate(given)]
    made = text.normalize_nfc(df)
    assert made.schema == df.schema
    assert rows(made) == expected


def test_latin_text_stays_out_of_python(spark, monkeypatch):
    below = "".join(map(chr, range(1, 0x300)))
    assert unicodedata.normalize("NFC", below) == below
    df = spark.createDataFrame([(1, below)], "id long, text string")

    def refused(batches):
        for batch in batches:
            raise AssertionError("not for Python")
        yield from ()

    monkeypatch.setattr(text, "compose_nfc", lambda rows, column: rows.mapInArrow(refused, rows.schema))
    assert rows(text.normalize_nfc(df)) == [(1, below)]


def test_cells_in_small_parts(spark, monkeypatch):
    given = [(i, [float(i % 7) - 3, float(i % 5) - 2]) for i in range(40)] + [(40, None), (41, [1.0])]
    df = spark.createDataFrame(given, "id long, v array<float>").coalesce(1)
    centres = spark.createDataFrame(
        [(i, [float(i), 1.0 - i]) for i in range(6)], "cell int, centre array<double>"
    )
    for count in (1, 4):
        monkeypatch.setattr(ann, "GAPS", 1_000_000)
        whole = rows(ann.nearest_cells(df, centres, count, "v").select("id", "cells"))
        monkeypatch.setattr(ann, "GAPS", 7)
        assert rows(ann.nearest_cells(df, centres, count, "v").select("id", "cells")) == whole
        assert [c is None for _, c in whole] == [
            v is None or len(v) != 2 or not any(v) for _, v in given
        ]
        assert {len(c) for _, c in whole if c is not None} == {count}


def test_memory_is_given_back_by_value():
    memory.memory_returner()()


def test_scores_that_round_alike_tie_by_id(spark):
    # cosines differ in the eighth place only; the largest has the largest id
    corpus = spark.createDataFrame(
        [(9 - i, [1.0, 1e-4 * (i + 1)]) for i in range(9)], "chunk_id long, dense array<double>"
    ).coalesce(1)
    queries = spark.createDataFrame([(1, [1.0, 0.0])], "query_id long, vector array<double>")
    found = search.dense_topk(queries, corpus, 2)
    assert rows(found.select("rank", "chunk_id", "score")) == [(1, 1, 1.0), (2, 2, 1.0)]
