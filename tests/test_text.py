from pyspark.sql import functions as F

from corpusloom.functions import text as tx
from corpusloom.sources import files


def one(spark, value, kind, column):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column(F.col("v"))).first()[0]


def test_decode_drops_bad_bytes_and_keeps_real_replacement(spark):
    assert one(spark, bytearray(b"ok \xff b"), "binary", tx.decode_text) == "ok  b"
    assert one(spark, bytearray("a�b".encode()), "binary", tx.decode_text) == "a�b"
    assert one(spark, bytearray(b"a\r\nb\rc"), "binary", tx.decode_text) == "a\nb\nc"


def test_nfc_makes_both_spellings_equal(spark):
    rows = spark.createDataFrame([("é",), ("é",), ("plain",), (None,)], "text string")
    got = {r.text for r in tx.normalize_nfc(rows).collect()}
    assert got == {"é", "plain", None}


def test_blank_rows_are_dropped(spark):
    rows = [("",), ("  ",), (" ",), ("　",), ("\x1c",), (" x ",)]
    assert tx.drop_blank(spark.createDataFrame(rows, "text string")).collect() == [(" x ",)]


def test_token_lengths_and_case(spark):
    text = "a Ab " + "C" * 20 + " " + "d" * 21 + " Été_x2"
    bounded = lambda t: tx.tokenize(t, tx.TOKEN_MIN, tx.TOKEN_MAX)
    assert one(spark, text, "string", bounded) == ["ab", "c" * 20, "été", "x2"]
    assert one(spark, text, "string", tx.tokenize) == ["a", "ab", "c" * 20, "d" * 21, "été", "x2"]


def test_long_and_single_letter_texts_have_tokens(spark):
    for text in ("没有空格的句子", "a b c", "x" * 45):
        assert one(spark, text, "string", tx.tokenize)


def test_words_match_python_split(spark):
    text = " a\tb c　a\x1cd \n"
    assert one(spark, text, "string", tx.whitespace_words) == ["a", "b", "c", "d"]


def test_suffix_rules(spark):
    expected = {
        "/x/A.PY": (".py", "code", "python", "code"),
        "/x/a.h": (".h", "code", "c", "code"),
        "a.htm": (".htm", "markup", None, "html"),
        "a.html": (".html", "markup", None, "html"),
        "a.xhtml": (".xhtml", "markup", None, "xml"),
        "a.svg": (".svg", "markup", None, "xml"),
        "a.md": (".md", "document", None, "document"),
        "/x.y/none": ("", "document", None, "document"),
        ".hidden": ("", "document", None, "document"),
    }
    rows = tx.classify_file(spark.createDataFrame([(p,) for p in expected], "source string"))
    got = {r.source: (r.file_type, r.content_type, r.language, r.splitter) for r in rows.collect()}
    assert got == expected


def test_scan_files_skips_hidden_and_rejects_missing(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    for name in ("a.txt", ".a.txt", "_b.txt", "sub/c.md"):
        (tmp_path / name).write_bytes(b"text")
    found = files.scan_files(spark, str(tmp_path))
    assert sorted(r.source.rsplit("/", 1)[1] for r in found.collect()) == ["a.txt", "c.md"]
    assert files.count_files(files.scan_files(spark, str(tmp_path / "a.txt"))) == 1
    try:
        files.scan_files(spark, str(tmp_path / "missing"))
    except ValueError:
        return
    raise AssertionError("a missing path must be refused")


def test_query_file(spark, tmp_path):
    path = str(tmp_path / "queries.json")
    files.write_queries(path, ["first one", "zweite"])
    assert [tuple(r) for r in files.scan_queries(spark, path).orderBy("query_id").collect()] == [
        (0, "first one"), (1, "zweite"),
    ]
    files.write_queries(path, [])
    try:
        files.scan_queries(spark, path)
    except ValueError:
        return
    raise AssertionError("an empty query list must be refused")


def test_documents_from_elements_skip_missing_text(spark):
    rows = spark.createDataFrame(
        [(1, 2, "b"), (1, 1, "a"), (1, 3, None), (2, 1, "c")], "doc_id long, pos int, text string"
    )
    got = {r.doc_id: r.text for r in files.scan_documents(rows).collect()}
    assert got == {1: "a\n\nb", 2: "c"}
