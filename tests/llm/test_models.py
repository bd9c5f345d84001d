import random
from itertools import product

import numpy as np
import pytest

from corpusloom.llm import langid, pieces, quality_cnn

EN = "the of and to in that is was for with from this have not are"
FR = "les des une est pas que qui dans pour sur avec mais très été où"
RU = "это как все она так его только мне было вот меня еще нет"


def sentence(rng, words, n=40):
    return " ".join(rng.choice(words.split()) for _ in range(n))


def labelled(spark):
    rng = random.Random(1)
    rows = [(sentence(rng, w), lang) for w, lang in ((EN, "en"), (FR, "fr"), (RU, "ru")) for _ in range(30)]
    return spark.createDataFrame([*rows, (None, "en"), ("x", None)], "text string, lang string")


def test_languages(spark):
    rng = random.Random(2)
    model = langid.fit_language_model(labelled(spark))
    assert model.languages == ("en", "fr", "ru")
    mixed = sentence(rng, EN) + " " + sentence(rng, FR) + " " + sentence(rng, RU, 20)
    texts = [None, "", "12 -- !?", sentence(rng, EN), sentence(rng, FR).upper(), "было", "漢字", mixed,
             sentence(rng, EN, 9000), "漢字 " + sentence(rng, FR)]
    frame = spark.createDataFrame([(i, t, "no") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    got = {r["doc_id"]: r for r in langid.detect_languages(frame, model).collect()}
    assert [got[i]["lang_pred"] for i in range(10)] == [
        "und", "und", "und", "en", "fr", "ru", got[6]["lang_pred"], got[7]["lang_pred"], "en", "fr"]
    assert got[6]["lang_pred"] in model.languages
    assert [s["lang"] for s in got[7]["spans"]] == ["en", "fr", "ru"]
    spans = got[7]["spans"]
    assert spans[0]["start"] == 0 and spans[-1]["end"] == len(mixed)
    assert abs(spans[1]["start"] - mixed.index(mixed.split()[40])) < 400
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert langid.detect_languages(frame.limit(0), model).count() == 0
    assert langid.fit_language_model(labelled(spark).limit(0)).languages == ()


def test_viterbi_against_all_paths():
    rng = np.random.default_rng(3)
    scores = rng.normal(size=(11, 3)).astype(np.float32)
    lengths = np.array([5, 0, 4, 2])
    got, at = langid.viterbi(scores, lengths[lengths > 0], 0.7), 0
    for n in lengths[lengths > 0]:
        part = scores[at : at + n]
        value = lambda p: sum(part[i, k] for i, k in enumerate(p)) - 0.7 * sum(a != b for a, b in zip(p, p[1:]))  # noqa: B023, B905, E731
        assert value(got[at : at + n]) == pytest.approx(max(map(value, product(range(3), repeat=int(n)))), abs=1e-5)
        at += n


def test_quality_network(spark):
    rng = random.Random(4)
    good = lambda: sentence(rng, EN, rng.randint(20, 200))
    bad = lambda: " ".join(w.upper() + "!!" for w in sentence(rng, EN, rng.randint(20, 200)).split())
    rows = [(i, good() if i % 3 else bad(), int(i % 3 > 0)) for i in range(240)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, q, 0) for i, _, q in rows] + [(None, 1, 0), (9999, None, 0)],
                                   "doc_id long, quality int, toxic int")
    weights = quality_cnn.fit_quality_model(docs.filter("doc_id < 160"), labels)
    extra = [(1000, None, "s"), (1001, "", "s"), (1002, good() * 300, "s"), (1002, good(), "s"), (None, bad(), "s")]
    frame = spark.createDataFrame([(i, t, "s") for i, t, _ in rows] + extra, "doc_id long, text string, score string")
    got = quality_cnn.score_quality(frame, weights).collect()
    assert len(got) == len(rows) + len(extra)
    score = {r["doc_id"]: r["score"] for r in got}
    assert score[1000] == score[1001]
    held = [(score[i] >= 0.3) == q for i, _, q in rows if i >= 160]
    assert np.mean(held) > 0.95
    kept = quality_cnn.keep_quality(frame, weights)
    assert kept.columns == frame.columns
    assert kept.count() == sum(r["score"] >= quality_cnn.THRESHOLD for r in got)
    assert quality_cnn.score_quality(frame.limit(0), weights).count() == 0


def test_chunks_cover_everything():
    for n in (0, 1, 255, 256, 257, 448, 449, 1000):
        text = bytes(1 + i % 255 for i in range(n))
        chunks, counts = quality_cnn.cut_chunks([text, b"zz"])
        back = bytearray(n + 1000)
        for k in range(counts[0]):
            back[k * quality_cnn.STEP : k * quality_cnn.STEP + quality_cnn.CHUNK] = chunks[k].tobytes()
        assert bytes(back[:n]) == text and len(chunks) == counts.sum()


MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def test_pieces_round_trip(spark):
    vocabulary = pieces.load_vocabulary(MODEL)
    texts = [None, "", " ", "   lead and trail  ", "a▁b ▁", "日本語 🎉\n\t\x00é", "<s> </s> <0x41>", "x" * 5000, "word " * 3000]
    rows = [(i, t, "k") for i, t in enumerate(texts)] + [(3, texts[3], "k"), (None, "null id", "k")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, piece_ids string")
    got = pieces.encode_and_check(frame, vocabulary).collect()
    assert len(got) == len(rows) and all(r["lossless"] for r in got)
    again = pieces.encode_pieces(frame.repartition(3), vocabulary).collect()
    key = lambda r: (str(r["doc_id"]), r["piece_ids"] or [])
    assert sorted(map(key, got)) == sorted(map(key, again))
    other = pieces.encode_pieces(frame, vocabulary, seed=1).collect()
    assert sorted(map(key, other)) != sorted(map(key, again))
    assert pieces.encode_and_check(frame.limit(0), vocabulary).count() == 0


def test_sampling_follows_the_lattice():
    vocabulary = pieces.load_vocabulary(MODEL, sharpness=1.0)
    unit = " their"
    weights = {}

    def walk(at, ids, weight):
        if at == len(unit):
            weights[tuple(ids)] = weight
        for end, start, piece in pieces.unit_edges(unit, vocabulary):
            if start == at:
                raw = [piece] if piece >= 0 else [int(vocabulary.byte_ids[b]) for b in unit[at].encode()]
                walk(end, ids + raw, weight * np.prod(vocabulary.weights[raw]))

    walk(0, [], 1.0)
    n, total = 40000, sum(weights.values())
    for sample in ("short", "long"):
        seen = {}
        if sample == "short":
            ids, counts = pieces.Lattices(vocabulary).sample(
                [unit] * n, np.arange(n).astype(np.uint64), np.zeros(n, np.uint64))
            ends = np.cumsum(counts)
            paths = (tuple(ids[e - c : e].tolist()) for e, c in zip(ends, counts, strict=True))
        else:
            n = 4000
            paths = (tuple(pieces.sample_long(unit, vocabulary, np.uint64(i), np.uint64(0)).tolist()) for i in range(n))
        for path in paths:
            seen[path] = seen.get(path, 0) + 1
        for path, weight in weights.items():
            p = weight / total
            assert abs(seen.get(path, 0) / n - p) < 5 * (p * (1 - p) / n) ** 0.5 + 2e-3
