"""Token counts: always what the library says, however the text is cut."""

import pytest
from conftest import SF0001
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tripaudit.llm.tokencount import (
    Counter,
    op12_resync_token_counts,
    token_counts,
    tokenizer_source,
)

SOURCE = tokenizer_source()
EXACT = Tokenizer.from_str(SOURCE)
# Marks that combine, jamo, expanding lower case, contractions, special tokens and odd blanks.
HARD = ["a", "é", "é", "́", "İ", "Σ", "ς", " ", "\n", " ", " ", "。", "日", "한", "ᄒ", "ᅡ",
        "ᆫ", "1", "½", "²", "'", "'s", "'re", "'S", "!", "<|", "<|endoftext|>", "<|startoftext|>", "|>", "🙂", "‍",
        "\x1c", "\x85", "\x00", "ﬁ", "क", "ि", "া", "̸", "=", "K", "Å", "ǅ", "Ⅷ", "ͅ", "ᾳ", "﻿", "‿"]


def exact(text):
    return len(EXACT.encode(text or "", add_special_tokens=False))


@pytest.fixture(scope="module")
def counter():
    return Counter(SOURCE)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(HARD), max_size=150), st.integers(4, 60), st.integers(1, 9))
def test_spliced_counts_equal_the_library(parts, chunk, overlap):
    text = "".join(parts)
    counter = Counter.__new__(Counter)
    counter.__dict__.update(_COUNTER.__dict__, chunk=chunk, overlap=min(overlap, chunk // 2), known={})
    assert counter.spliced(text) == counter.whole([text])[0] == exact(text)


_COUNTER = Counter(SOURCE)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(HARD), min_size=1, max_size=30), st.lists(st.sampled_from(HARD), min_size=1, max_size=30))
def test_stable_places_add_up(before, after):
    text, p = "".join(before + after), len("".join(before))
    if _COUNTER.stable(text, p):
        assert exact(text) == exact(text[:p]) + exact(text[p:])


def test_overlaps_widen_until_an_unbroken_run_ends(counter):
    small = Counter(SOURCE, 64, 8)
    sizes = []
    edge = small.edge
    small.edge = lambda text, start, end: sizes.append(end - start) or edge(text, start, end)
    text = "word " * 30 + "z" * 1000 + " and the rest of it" * 20
    assert small.counts([text]) == [exact(text)]
    assert max(sizes) < 1400 and len(sizes) > 10
    unbroken = "ab" * 5000
    assert small.counts([unbroken]) == counter.counts([unbroken]) == [exact(unbroken)]


def test_special_tokens_and_words_met_before(counter):
    for text in ("x<|endoftext|>y", "<|endoftext|>." * 3, "end. End. END!", "it's 'tis !'s", "a,b. c;;", "Σας. ΣΑΣ."):
        assert counter.counts([text, text]) == [exact(text)] * 2, text


def test_tokens_with_blanks_are_refused():
    held = Tokenizer.from_str(SOURCE)
    held.add_special_tokens(["<a b>"])
    with pytest.raises(ValueError):
        Counter(held.to_str())


@pytest.mark.parametrize("chunk", [16_384, 500])
def test_all_documents(spark, chunk):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    want = {r.doc_id: (len((r.text or "").encode()), exact(r.text)) for r in docs.collect()}
    out = op12_resync_token_counts(spark, SF0001) if chunk == 16_384 else token_counts(docs, chunk=chunk, overlap=32)
    rows = out.collect()
    assert {r.doc_id: (r.n_bytes, r.n_tokens) for r in rows} == want and len(rows) == docs.count()
    assert all(r.over_limit == (r.n_tokens > 2048) for r in rows)


def test_edge_rows(spark):
    rows = [(1, None, 1), (2, "", 1), (3, "é 日本", 1), (3, "é 日本", 1), (None, "n", 1), (4, "long words " * 40_000, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    out = sorted(map(tuple, token_counts(docs).collect()), key=str)
    assert out == sorted(((i, len((t or "").encode()), exact(t), exact(t) > 2048) for i, t, _ in rows), key=str)
    assert token_counts(docs.limit(0)).count() == 0
