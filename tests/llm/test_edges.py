"""Empty tables, nulls, repeated rows and clashing names, for every operator of the pipeline."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from corpusloom.llm import langid, mixing, pii, quality_cnn, queries
from corpusloom.llm.common import staged

SF = "/root/testdata/sf0.001"
NAMES = (
    "size passes blocks taken start_word _words _id _hash _no _kept id content doc document found spans "
    "_found _spans text_2 words again no p_id p_no kept_id copies node root n key score weights extra_blocks"
).split()
ROWS = [
    (1, "plain words of a document that says little", "en", "a", 1),
    (1, "plain words of a document that says little", "en", "a", 1),
    (None, "no id, but mail to someone@example.org here", None, None, None), (2, None, "de", "a", None),
    (3, "", None, "b", 0), (4, " \n ", "en", "b", 3), (5, "word " * 3000, "en", None, 15000),
    (None, None, None, None, None),
]


def documents(spark, rows=ROWS):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name in NAMES:
        docs = docs.withColumn(name, F.lit("mine"))
    return docs


@pytest.mark.parametrize("rows", [ROWS, []], ids=["rows", "empty"])
@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES, ids=[n for n, _ in corpus_pipeline.STAGES])
def test_stage(spark, name, stage, rows):
    docs = documents(spark, rows)
    got = staged(stage(spark, docs, SF), name)
    if name != corpus_pipeline.STAGES[-1][0]:
        assert got.columns == docs.columns
        assert all(r[n] == "mine" for r in got.collect() for n in NAMES)
    if name in ("personal_data", "sentencepiece"):
        assert got.count() == len(rows)
    if not rows:
        assert got.count() == 0


def test_redacted_text(spark):
    texts = [r["text"] for r in pii.redact(documents(spark)).collect()]
    assert "no id, but mail to [EMAIL] here" in texts and texts.count(None) == 2


def test_mixed_rows(spark):
    docs = documents(spark)
    mixed = mixing.mix_documents(docs).collect()
    assert mixed and all(r["text"] and r["text"].strip() for r in mixed)
    # no document is taken more than twice over
    for text in {r[1] for r in ROWS if r[1] and r[1].strip()}:
        rows = sum(r[1] == text for r in ROWS)
        whole = len(text.split())
        same = [r for r in mixed if r["doc_id"] in {x[0] for x in ROWS if x[1] == text}]
        assert sum(len(r["text"].split()) for r in same) <= 2 * rows * whole


def empty_folder(spark, tmp_path, labelled=True):
    for name in ("documents", "labels"):
        frame = spark.read.parquet(f"{SF}/{name}.parquet")
        frame = frame.limit(0) if name == "documents" or not labelled else frame
        frame.coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


@pytest.mark.parametrize(
    "name", [n for n in queries.QUERIES if n not in ("op9_warc", "op10_nearest_neighbours")]
)
def test_query_of_no_documents(spark, tmp_path, name):
    assert queries.QUERIES[name](spark, empty_folder(spark, tmp_path)).count() == 0


def test_pipeline_of_no_documents(spark, tmp_path):
    assert corpus_pipeline.run(spark, empty_folder(spark, tmp_path, False)).count() == 0


def test_models_without_labels(spark):
    docs = documents(spark)
    model = langid.fit_language_model(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {tuple(r)[1:3] for r in langid.detect_languages(docs, model).collect()} == {("und", 0.0)}
    labels = spark.createDataFrame([], "doc_id long, quality int")
    weights = quality_cnn.fit_quality_model(docs, labels)
    assert {r["score"] for r in quality_cnn.score_quality(docs, weights).collect()} == {0.5}


def test_letters_and_long_paths(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.fit_language_model(docs)
    labeller = langid.Labeller(model, langid.SWITCH_PENALTY)
    assert labeller.label(["²½ Ⅷ 12", "_ 9"]) == [("und", 0.0, [])] * 2
    assert langid.lower_words("हिन्दी में Ünë's x2") == ["हिन्दी", "में", "ünë", "s", "x"]
    # a word that says nothing takes the label before it, however long the text is
    (_, _, short), = labeller.label(["the house and the people " * 100 + "a"])
    (_, _, long), = labeller.label(["the house and the people " * 2000 + "a"])
    assert len(short) == len(long)
