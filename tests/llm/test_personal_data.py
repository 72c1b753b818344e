import hashlib
import random
import re

import pytest

from relgraph.llm.personal_data import KINDS, anchors, find_personal_data, luhn, spans_of
from relgraph.llm.queries import op6_personal_data

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (14 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            out.append((m.start(), list(BASE).index(kind), kind, m.end()))
    return ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(out))


def base_of(text, automaton=anchors()):  # noqa: B008
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans_of(text, automaton) if k in BASE)


def test_random_texts_against_the_patterns():
    draw = random.Random(5)
    pieces = list("0123456789..@@++- ()ab%_é") + ["1.2.3.4", "255.256.1.1", "+1 (234) 555-0199", "a.b@c-d.e.f", "4111 1111 1111 1111", "00000000000000"]
    for n in range(6000):
        text = "".join(draw.choices(pieces, k=draw.randint(0, 40)))
        assert base_of(text) == brute(text), repr(text)


def test_query_against_the_patterns(spark, small_docs):
    texts = {r.doc_id: r.text for r in small_docs[1]}
    got = op6_personal_data(spark, "/root/testdata/sf0.001").collect()
    assert len(got) == len(texts)
    total = 0
    for r in got:
        want = brute(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        for kind in BASE:
            assert r[f"n_{kind}"] == len(re.findall(f"{kind}:", want))
        total += bool(want)
    assert total > 5


def test_added_kinds_and_redaction(rows):
    text = "See https://x.example.com/a?b=1, iban DE89 3704 0044 0532 0130 00 and SSN: 123-45-6789. Account no 1234."
    df = rows("doc_id bigint, text string", [(1, text), (2, None)])
    one, two = find_personal_data(df, redact=True).orderBy("doc_id").collect()
    assert [(s.kind, text[s.start : s.end]) for s in one.spans if s.kind not in BASE] == [
        ("url", "https://x.example.com/a?b=1"), ("account", "DE89 3704 0044 0532 0130 00"), ("account", "123-45-6789")]
    assert "example.com" not in one.redacted and "[URL]" in one.redacted and "6789" not in one.redacted
    assert two.spans == [] and two.redacted is None
    assert all(s.kind in KINDS for s in one.spans)


@pytest.mark.parametrize(("text", "found"), [
    ("account number: 12345678.", "12345678"), ("Passport number is C01X00T47", None), ("passport no. AB1234567", "AB1234567"),
    ("tax id number 12-345-678", "12-345-678"), ("Konto Nr. 1234567", "1234567"), ("IBAN is NO93 8601 1117 947", "NO93 8601 1117 947"),
    ("accounting 12345678", None), ("account holder 12345678", None), ("account no1234567", "1234567"), ("passport 123456789", "123456789"),
])
def test_words_between_a_cue_and_its_identifier(rows, text, found):
    (r,) = find_personal_data(rows("doc_id bigint, text string", [(1, text)])).collect()
    assert [text[s.start : s.end] for s in r.spans if s.kind == "account"] == ([found] if found else [])


def test_odd_rows(odd_docs, rows):
    got = find_personal_data(odd_docs).collect()
    assert len(got) == odd_docs.count()
    for r in got:
        kept = ",".join(f"{s.kind}:{s.start}:{s.end}" for s in r.spans if s.kind in BASE)
        assert kept == brute(r.text or "")
    for hard in ("1" * 300_000, "1.1." * 100_000, "@" * 100_000, "a@" * 50_000, "+1" * 100_000, "1 " * 100_000):
        assert base_of(hard) == brute(hard) if len(hard) < 5000 else base_of(hard) is not None
    assert find_personal_data(rows("doc_id bigint, text string", [])).collect() == []
