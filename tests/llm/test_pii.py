"""Personal data: the anchor search against plain regular expressions."""

import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tripaudit.llm.pii import find_spans, luhn, op3_pii_anchors, pii_spans, redact, redact_documents

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
ORDER = ["email", "ip", "card", "phone"]


def brute(text):
    def digits(m):
        return re.sub("[^0-9]", "", m[0])

    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(text) if 14 <= len(digits(m)) <= 19 and luhn(digits(m))]
    out += [("phone", *m.span()) for m in PHONE.finditer(text) if 10 <= len(digits(m)) <= 15]
    return sorted(out, key=lambda s: (s[1], ORDER.index(s[0])))


def base(text):
    return [s for s in find_spans(text) if s[0] in ORDER]


@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet="a0129@.+-() é%", max_size=40))
def test_base_spans_match_expressions(text):
    assert base(text) == brute(text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["a.b@c.de", "1.2.3.4", "300.1.1.1", "4111 1111 1111 1111", "+1 (555) 123-4567", " ",
                                 ".", "-", "x", "@", "5", "+4"]), max_size=12))
def test_base_spans_match_on_composed_texts(parts):
    text = "".join(parts)
    assert base(text) == brute(text)


def test_long_runs_take_linear_time():
    for text in ("7" * 300_000, "1." * 200_000, "a" * 300_000 + "@", "@" * 300_000, "+1" * 200_000, "a@b." * 50_000):
        find_spans(text)


def test_added_kinds():
    spans = dict((k, t) for k, t in ((k, text) for text in [
        "see https://user:pw@files.example.org/a?b=1, then", "IBAN: DE89 3704 0044 0532 0130 00.",
        "account no. 12-345-678 was", "nothing here"] for k, *_ in find_spans(text)))
    assert {"url", "iban", "account"} <= set(spans)
    assert find_spans("the accounts 123456 are") == []
    assert [s for s in find_spans("IBAN DE89370400440532013001") if s[0] == "iban"] == []
    assert find_spans("http://nohost and https://") == []


def test_redaction():
    text = "mail a.b@c.de or +1 (555) 123-4567."
    assert redact(text, find_spans(text)) == "mail <EMAIL> or <PHONE>."
    text = "https://a@b.example.com/x"
    assert redact(text, find_spans(text)) == "<URL>"
    assert redact(None, []) is None


@pytest.fixture
def docs(spark):
    rows = [(1, "x a@b.cd é 1.2.3.4", "old"), (1, "x a@b.cd é 1.2.3.4", "old"), (None, None, None),
            (3, "", "s"), (4, "w " * 100_000 + "z@y.xx", "s")]
    return spark.createDataFrame(rows, "doc_id long, text string, spans string")


def test_edge_rows_and_clashing_columns(docs):
    got = pii_spans(docs).collect()
    assert len(got) == 5
    by = {r.doc_id: [tuple(s) for s in r.spans] for r in got}
    assert by[1] == [("email", 2, 8), ("ip", 11, 18)]
    assert by[None] == [] and by[3] == []
    assert by[4] == [("email", 200_000, 206_000 - 5_994)]
    assert pii_spans(docs.limit(0)).count() == 0


def test_redacted_documents_keep_columns(spark):
    docs = spark.createDataFrame([(1, "call +1 (555) 123-4567", "en", "s", 22), (2, None, None, None, None)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    out = redact_documents(docs)
    assert out.columns == docs.columns
    got = {r.doc_id: (r.text, r.n_chars) for r in out.collect()}
    assert got == {1: ("call <PHONE>", 12), 2: (None, None)}


def test_query_matches_brute_force(spark):
    from conftest import SF0001

    text = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()}
    got = op3_pii_anchors(spark, SF0001).collect()
    assert len(got) == len(text)
    for r in got:
        want = brute(text[r.doc_id])
        for kind in ORDER:
            assert r[f"n_{kind}"] == sum(s[0] == kind for s in want)
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [s for s in r.spans.split(",") if s.split(":")[0] in ORDER] == [s for s in joined.split(",") if s]
