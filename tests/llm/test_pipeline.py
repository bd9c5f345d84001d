import corpus_pipeline
from corpusloom.llm.common import staged

SF = "/root/testdata/sf0.001"


def test_stages_in_a_row(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, SF), name)
        seen[name] = docs.count()
        if name != "sentencepiece":
            assert docs.columns == columns
    assert seen["quality_classifier"] >= seen["near_duplicates"] == seen["personal_data"] > 0
    assert seen["mix_sources"] == seen["sentencepiece"]
    assert docs.filter("not lossless").count() == 0


def test_near_duplicates_leave_one(spark):
    text = " ".join(f"word{i}" for i in range(60))
    rows = [(4, text, "s", "en"), (2, text + " more", "s", "en"), (9, text, "t", "en"), (5, None, "s", "en"),
            (6, "", "s", "en"), (7, "", "s", "en"), (1, "apart from all of these here", "s", "en"),
            (2, text + " more", "s", "en"), (None, "no id but some words in it", "s", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, _kept string")
    got = corpus_pipeline.near_duplicates(spark, docs, SF)
    assert got.columns == docs.columns
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in got.collect()) == [
        (False, 1), (False, 2), (False, 5), (False, 6), (False, 7), (True, 0)]
