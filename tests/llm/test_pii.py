import hashlib
import random
import re
import time

import pytest

from tidemark.llm import pii

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def digits(s):
    return re.sub(r"[^0-9]", "", s)


def valid(kind, s):
    if kind == "ip":
        return all(int(p) <= 255 for p in s.split("."))
    if kind == "card":
        d = [int(c) for c in digits(s)][::-1]
        return 12 <= len(d) <= 19 and sum(d[::2] + [x * 2 - 9 if x > 4 else x * 2 for x in d[1::2]]) % 10 == 0
    return kind != "phone" or 9 <= len(digits(s)) <= 15


def plain(text):
    """The base spans as the patterns find them."""
    found = [(m.start(), list(BASE).index(k), m.end(), k) for k, p in BASE.items() for m in re.finditer(p, text) if valid(k, m.group())]
    return [(s, e, k) for s, _, e, k in sorted(found)]


def test_base_spans_are_those_of_the_patterns_on_random_texts():
    rng = random.Random(5)
    pieces = ["a", "b.c", "@", "@x.de", ".", "-", " ", "+", "+1", "(", ")", "7", "42", "255", "256", "0", "192.0.2.1", "4111111111111111", "4111 1111-1111 1111",
              "é", "\U0001f600", "\n", "_", "%", "iban ", "http://", "1.2.3.4.5", "--", "٣", "²"]
    for _ in range(6000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 24)))
        assert [s for s in pii.personal_spans(text) if s[2] in pii.BASE_KINDS] == plain(text), text
    for _ in range(3000):
        text = "".join(rng.choice("01234569.+- ()@ab") for _ in range(rng.randint(0, 60)))
        assert [s for s in pii.personal_spans(text) if s[2] in pii.BASE_KINDS] == plain(text), text


@pytest.mark.parametrize("text, kind, found", [
    ("an müller@firma.de bitte", "mail", "müller@firma.de"),
    ("josé@exämple.com", "mail", "josé@exämple.com"),
    ('"john doe"@example.com!', "mail", '"john doe"@example.com'),
    ("root@[192.0.2.1]", "mail", "root@[192.0.2.1]"),
    ("see https://jane:pw@example.org/x", "url", "https://jane:pw@example.org"),
    ("ftp://192.0.2.7:21/x", "url", "ftp://192.0.2.7:21"),
    ("http://[2001:db8::1]/", "url", "http://[2001:db8::1]"),
    ("IBAN: DE89 3704 0044 0532 0130 00 The", "account", "DE89 3704 0044 0532 0130 00"),
    ("iban GB82WEST12345698765432.", "account", "GB82WEST12345698765432"),
    ("account number: 0012345678", "account", "0012345678"),
    ("SSN 123-45-6789", "account", "123-45-6789"),
])
def test_what_the_anchors_add(text, kind, found):
    assert [(text[s:e], k) for s, e, k in pii.personal_spans(text) if k == kind] == [(found, kind)]


@pytest.mark.parametrize("text", ["", "he@the", "IBAN DE89 3704 0044 0532 0130 01", "accounts 123456789", "myssn 123-45-6789", "SSN 000-12-3456",
                                  "https://example.org/license", "1.2.3", "999.1.1.1", "+1 23", "account of the 19 men", "a @ b.c", "in 2019-2021 and 12"])
def test_clean_texts_have_none(text):
    assert pii.personal_spans(text) == []


def test_very_long_texts_take_linear_time():
    for piece in ("a", "1", "1.", "1 ", "@", "+1", "a@b", "a@b.", "(", "http://", "iban ", "account "):
        start = time.process_time()
        pii.personal_spans(piece * (300_000 // len(piece)))
        assert time.process_time() - start < 20, piece


def test_rows_of_the_frame(spark, docs, by_id):
    texts = [(1, "x@y.org and 10.0.0.1"), (1, "x@y.org and 10.0.0.1"), (2, None), (None, "+1 (743) 555-3824"), (3, ""), (4, "\U0001f600 a@b.cc")]
    frame = docs(texts, extra="spans")
    out = pii.span_digests(pii.find_personal_data(frame)).collect()
    assert len(out) == 6
    rows = {(r["doc_id"], r["spans"]) for r in out}
    assert rows == {(1, "email:0:7,ip:12:20"), (2, ""), (None, "phone:0:17"), (3, ""), (4, "email:2:8")}
    empty = hashlib.sha256(b"").hexdigest()
    for r in out:
        assert r["base_sha256"] == hashlib.sha256(r["spans"].encode()).hexdigest() and (r["spans"] or r["base_sha256"] == empty)
        assert r["n_email"] + r["n_ip"] + r["n_card"] + r["n_phone"] == len(r["spans"].split(",")) - (not r["spans"])
    assert pii.find_personal_data(docs([])).count() == 0
    masked = {r["doc_id"]: r["text"] for r in pii.redacted(frame).collect()}
    assert masked == {1: "<email> and <ip>", 2: "", None: "<phone>", 3: "", 4: "\U0001f600 <email>"}


def test_the_registered_query_against_the_patterns(spark):
    from tidemark.llm.queries import QUERIES
    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    out = QUERIES["op11_pii"](spark, sf).collect()
    assert sorted(r["doc_id"] for r in out) == sorted(texts)
    for r in out:
        spans = plain(texts[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(",".join(f"{k}:{s}:{e}" for s, e, k in spans).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in BASE] == [sum(x[2] == k for x in spans) for k in BASE]
