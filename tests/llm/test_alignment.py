import re
from collections import Counter
from hashlib import sha256

import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from corpusloom.llm import alignment

A = "/opt/tokenizers/byte_bpe_50k.json"
B = "/opt/tokenizers/piece_bpe_32k.model"
COLUMNS = "n_a n_b n_groups n_links n_best count_sum groups_sha256".split()

TEXTS = [
    None, "", " ", "a", "The quick brown fox", "The quick brown fox", "the  two\tspaces\n\nand lines ",
    "<|endoftext|> and </s><unk> are plain <0x41>", "▁ is not a space", "Füße, naïve Ⅷ ½ ²",
    "日本語のテキストです。中文文本", "👩‍👩‍👧 emoji \u0000 zero", "x" * 5000, "1234567890 " * 50,
    "é combining", "﻿mark", "ﬁ ligature", "tab\tand\rreturn",
]


def tokens(text, a, b):
    raw = b" " + text.encode()
    alphabet = alignment.byte_alphabet()
    names = {i: t for t, i in a.get_vocab().items()}
    one = [(i, bytes(alphabet[c] for c in names[i])) for i in a.encode(" " + text, add_special_tokens=False).ids]
    two = []
    for i in b.encode(text):
        piece = b.id_to_piece(i)
        byte = re.fullmatch("<0x(..)>", piece)
        two.append((i, bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode()))
    if not text or any(b"".join(x for _, x in side) != raw for side in (one, two)):
        return [], []
    return one, two


def brute_force(texts):
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    rows, corpus = [], Counter()
    for text in texts:
        one, two = tokens(text or "", a, b)
        spans = []
        for side in (one, two):
            at, found = 0, []
            for i, raw in side:
                found.append((i, at, at + len(raw)))
                at += len(raw)
            spans.append(found)
        links = [(x[0], y[0]) for x in spans[0] for y in spans[1] if x[2] == y[2]]
        cuts = sorted({x[2] for x in spans[0]} & {y[2] for y in spans[1]})
        groups, begin = [], 0
        for cut in cuts:
            groups.append("|".join(
                ",".join(str(x[0]) for x in side if begin < x[2] <= cut) for side in spans))
            begin = cut
        corpus.update(links)
        rows.append((len(one), len(two), links, groups))
    best = {}
    for (_, y), n in corpus.items():
        best[y] = max(best.get(y, 0), n)
    return [
        (n_a, n_b, len(groups), len(links), sum(corpus[x] == best[x[1]] for x in links),
         sum(corpus[x] for x in links), sha256(";".join(groups).encode()).hexdigest() if groups else "")
        for n_a, n_b, links, groups in rows
    ]


def test_against_brute_force(spark):
    rows = list(enumerate(TEXTS)) + [(None, "no id"), (4, TEXTS[4])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for name in "row pairs pair_counts its of total best n pair groups".split():
        docs = docs.withColumn(name, F.lit("mine"))
    got = alignment.alignment_digest(docs, A, B).collect()
    want = brute_force([t for _, t in rows])
    key = lambda r: (str(r[0]), r[1:])
    assert sorted(((r["doc_id"], *(r[c] for c in COLUMNS)) for r in got), key=key) == sorted(
        ((i, *w) for (i, _), w in zip(rows, want, strict=True)), key=key)


def test_rare_pairs_are_joined(spark, monkeypatch):
    monkeypatch.setattr(alignment, "HOT", 5)
    texts = [t for t in TEXTS if t] * 2
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = alignment.alignment_digest(docs, A, B).orderBy("doc_id").collect()
    assert [tuple(r[c] for c in COLUMNS) for r in got] == brute_force(texts)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.alignment_digest(docs, A, B).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=1, max_size=20), st.data())
def test_groups_and_overlaps(sizes, data):
    total, other = sum(sizes), []
    while sum(other) < total:
        other.append(data.draw(st.integers(1, min(5, total - sum(other)))))
    ends = [[sum(x[: i + 1]) for i in range(len(x))] for x in (sizes, other)]
    import numpy as np

    a_group, b_group, over_a, over_b = alignment.coalesce(*(np.array(e) for e in ends))
    cuts = sorted(set(ends[0]) & set(ends[1]))
    assert a_group.tolist() == [sum(c < e for c in cuts) for e in ends[0]]
    assert b_group.tolist() == [sum(c < e for c in cuts) for e in ends[1]]
    want = [
        (i, j) for i, x in enumerate(ends[0]) for j, y in enumerate(ends[1])
        if max(x - sizes[i], y - other[j]) < min(x, y)
    ]
    assert list(zip(over_a.tolist(), over_b.tolist())) == want


def test_words_one_by_one():
    import random

    side = alignment.ByteLevel(alignment.read_bytes(A))
    assert side.words is not None
    chance = random.Random(3)
    chars = [c for c in map(chr, range(0, 0x1FB00, 7)) if not "\ud800" <= c <= "\udfff"]
    chars += list(" \t\n\r\x0b\x0c\x1c\x85\xa0'sdm.,!09aZ") * 300
    texts = ["".join(chance.choices(chars, k=chance.randrange(60))) for _ in range(4000)]
    sure = [c for c in chars if not alignment.UNSURE.search(c)]
    texts += ["".join(chance.choices(sure, k=chance.randrange(60))) for _ in range(4000)]
    texts += [" " * 3000 + "x", "\n" * 3000, "a" * 30_000, "don't we'll 'S  \n x", "Ж" * 3000]
    assert any(not alignment.UNSURE.search(t) for t in texts)
    known = [side.tokenizer.encode(" " + t, add_special_tokens=False).ids for t in texts]
    assert side.encode(texts) == known
