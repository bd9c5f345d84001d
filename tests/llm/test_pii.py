import hashlib
import re

from corpusloom.llm import pii

PATTERNS = {k: re.compile(p) for k, p in pii.BASE.items()}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def brute(text):
    found = []
    for rank, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in pattern.finditer(text or ""):
            digits = re.sub(r"[^0-9]", "", m.group())
            good = {
                "email": True,
                "ip": all(int(x) <= 255 for x in m.group().split(".")) if kind == "ip" else False,
                "card": 14 <= len(digits) <= 19 and luhn(digits),
                "phone": 10 <= len(digits) <= 15,
            }[kind]
            if good:
                found.append((m.start(), rank, f"{kind}:{m.start()}:{m.end()}"))
    return [f[2] for f in sorted(found)]


TEXTS = [
    None, "", "nothing here", "é a.b@c.d, x@y x@y.z_w@q.r.s", "@@ a@.b a@b..c a@b.c.", "1.2.3.4.5.6.7.8",
    "256.1.1.1 0001.2.3.255 1.2.3", "4111 1111 1111 1111 and 4111-1111-1111-1112", "+1 (829) 555-7292 +12 3",
    "call +49 30 1234567890 ( +1+2 ) +1 ()", "𝔘 mail 𝔘@x.yy a@b.cc", "1" * 60000, "a" * 60000, "1 " * 30000,
    "a.b-" * 20000 + "@x.y", "+1" + "(" * 30000, "IBAN DE89370400440532013000 x GB82 WEST 1234 5698 7654 32",
    "DE89370400440532013001", "SSN 123-45-6789", "ref 123-45-6789", 'password=45ac953709720d07d9 token = "8eda45dd6"',
]


def test_spans(spark):
    rows = [(i, t, "x", 1) for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], "y", 2), (None, TEXTS[3], "z", 3)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, spans string, start int")
    got = pii.detect_pii(frame).collect()
    assert len(got) == len(rows)
    extra = {}
    for row in got:
        text = TEXTS[3 if row["doc_id"] is None else row["doc_id"]]
        want = brute(text)
        assert row["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest()
        spans = [s for s in row["spans"].split(",") if s]
        assert [s for s in spans if s.split(":")[0] in PATTERNS] == want
        assert row["n_email"] == sum(s.startswith("email") for s in want)
        assert spans == [f"{s['kind']}:{s['start']}:{s['end']}" for s in row["found"]]
        extra[row["doc_id"]] = [s for s in spans if s.split(":")[0] not in PATTERNS]
    assert [s.split(":")[0] for s in extra[16]] == ["iban", "iban"]
    assert extra[17] == [] and extra[19] == [] and extra[2] == []
    assert extra[18] == ["ssn:4:15"]
    assert [s.split(":")[0] for s in extra[20]] == ["secret", "secret"]


def test_context_adjusts_score(spark):
    frame = spark.createDataFrame([(1, "phone +1 829 555 7292"), (2, "x +1 829 555 7292")], "doc_id long, text string")
    score = {r["doc_id"]: r["found"][0]["score"] for r in pii.detect_pii(frame).collect()}
    assert score[1] > score[2]


def test_redact(spark):
    frame = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)], "doc_id long, text string, spans string")
    got = {r["doc_id"]: r for r in pii.redact(frame).collect()}
    assert got[0]["text"] is None and got[1]["text"] == "" and got[2]["text"] == TEXTS[2]
    assert got[3]["text"] == "é [EMAIL], x@y [EMAIL][EMAIL]"
    assert got[10]["text"] == "𝔘 mail 𝔘@x.yy [EMAIL]"
    assert got[7]["text"] == "[CARD] and 4111-1111-1111-1112"
    assert all(r["spans"] == "x" for r in got.values())
    for row in got.values():
        assert not brute(row["text"])
    assert pii.redact(frame.limit(0)).count() == 0
