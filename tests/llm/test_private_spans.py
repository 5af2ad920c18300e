"""Anchor expansion against the base patterns, and the added kinds."""

import hashlib
import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from contrail.llm.private_spans import BASE, Finder, luhn, masked_text, private_spans, without_private
from contrail.llm.queries import op12_private_spans

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain(text):
    def fine(kind, s):
        digits = re.sub("[^0-9]", "", s)
        return {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in s.split(".")),
                "card": 16 <= len(digits) <= 19 and luhn(digits), "phone": 8 <= len(digits) <= 15}[kind]

    return [(k, m.start(), m.end()) for k in BASE for m in re.finditer(PATTERNS[k], text) if fine(k, m.group())]


def base(text):
    return [s[:3] for s in Finder().spans(text) if s[3]]


PIECES = st.lists(st.one_of(st.text("ab@.é-_%", max_size=8), st.text("0123456789 .-", max_size=24), st.text("+() .-12345", max_size=16),
                            st.sampled_from(["4111111111111111", "4111-1111 1111-1111", "1.2.3.4", "255.255.255.256.1.2.3.4", "a@b.c@d.e", "+1 (614) 555-8001",
                                             "00001.2.3.4", "٠.1.2.3", "x@y..z", "a@-.-"])), max_size=6).map("".join)


@settings(max_examples=1500, deadline=None)
@given(PIECES)
def test_base_spans_are_those_of_the_patterns(text):
    assert base(text) == plain(text)


@pytest.mark.parametrize("text, span", [
    ("IBAN DE89 3704 0044 0532 0130 00 ok", ("iban", 5, 32)), ("GB82WEST12345698765432", ("iban", 0, 22)),
    ("see http://ann:secret@host.example/x", ("login", 4, 34)), ("josé@exämple.fr", ("address", 0, 15)),
    ("Account number: 12345678", ("account", 16, 24)), ("KONTO 12 34 56 78", ("account", 6, 17))])
def test_added_kinds(text, span):
    assert span in [s[:3] for s in Finder().spans(text)]


@pytest.mark.parametrize("text", ["DE88 3704 0044 0532 0130 00", "http://host.example/a@b", "on account of 3 things", "xDE89370400440532013000",
                                  "the year 2024, 3.5 of 10", "1.2.3", "a @ b", "+12", "12345678"])
def test_clean_texts_have_no_span(text):
    assert [s for s in Finder().spans(text) if s[0] != "email"] == []


def test_long_texts_take_linear_time():
    f, began = Finder(), time.time()  # the patterns themselves would take hours on some of these
    for text in ("1" * 400_000, "1." * 300_000, "a" * 400_000 + "@", "@" * 300_000, "+1" * 200_000, "1 " * 300_000, "é" * 300_000 + "@a.b"):
        f.spans(text)
    assert time.time() - began < 20


def test_query_edge_cases(spark, make, tmp_path):
    texts = [(1, None), (2, ""), (3, "a@b.c +1 (614) 555-8001"), (3, "a@b.c +1 (614) 555-8001"), (None, "4111111111111111"), (4, "é" * 20000 + " x@y.z"),
             (5, "DE89370400440532013000")]
    make(texts).write.parquet(f"{tmp_path}/documents.parquet")
    got = {(r.doc_id, r.base_sha256): r for r in op12_private_spans(spark, str(tmp_path)).collect()}
    for doc_id, text in texts:
        spans = plain(text or "")
        r = got[doc_id, hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in spans) for k in BASE]
        assert r.spans == ",".join(f"{s[0]}:{s[1]}:{s[2]}" for s in Finder().spans(text or ""))
    assert op12_private_spans(spark, str(tmp_path)).count() == len(texts)
    assert private_spans(make([])).count() == 0


def test_whole_documents(docs, rows):
    got = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans if s.base] for r in private_spans(docs).collect()}
    assert got == {i: plain(t or "") for i, t in rows}


def test_masked_documents(make):
    assert masked_text("to a@b.c, 1.2.3.4", Finder().spans("to a@b.c, 1.2.3.4")) == "to [email], [ip]"
    got = {r.doc_id: r.text for r in without_private(make([(1, "x é@b.c y"), (2, None), (3, "plain")])).collect()}
    assert got == {1: "x [address] y", 2: None, 3: "plain"}
