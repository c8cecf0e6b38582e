"""Packing: exact tokens, valid sequences, few of them."""

import zlib
from collections import defaultdict

import numpy as np
import pytest
from conftest import SF0001
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tripaudit.llm.packing import (
    Encoder,
    Stock,
    cut,
    dominating_set,
    op8_dominance_packing,
    pack_documents,
    packing_plan,
    reduce_stock,
    tokenizer_json,
)


@pytest.fixture(scope="module")
def exact():
    return Tokenizer.from_str(tokenizer_json())


def test_ids_are_those_of_the_tokenizer_file(exact):
    encoder = Encoder(tokenizer_json())
    for text in ["", " a  b\n\n c", "naïve Straße 日本 🙂", "x<|endoftext|>y", " " * 20_000 + "z", "ab" * 3000,
                 "don't 12345 !!!     x", "\t\t\n \n"]:
        assert encoder.ids(text) == exact.encode(text, add_special_tokens=False).ids, text[:20]


def test_cut_keeps_full_pieces_after_a_shorter_first():
    assert cut(5, 8) == [(0, 5)] and cut(8, 8) == [(0, 8)] and cut(16, 8) == [(0, 8), (8, 8)]
    assert cut(19, 8) == [(0, 3), (3, 8), (11, 8)]


def bins_of(plan):
    out = defaultdict(list)
    for size, start, end, first, each, offset in plan:
        for r in range(end - start):
            out[first + r // each].append((offset + r % each * size, size))
    return out


@settings(max_examples=300, deadline=None)
@given(st.dictionaries(st.integers(1, 24), st.integers(1, 12), max_size=12))
def test_plans_place_every_piece_once_without_gaps(counts):
    bins = bins_of(packing_plan(counts, 24))
    placed = defaultdict(int)
    for pieces in bins.values():
        at = 0
        for offset, size in sorted(pieces):
            assert offset == at
            at += size
            placed[size] += 1
        assert at <= 24
    assert dict(placed) == counts and sorted(bins) == list(range(len(bins)))


def fewest(sizes, capacity):
    """Least number of sequences by exhaustive search."""
    best = [len(sizes)]
    order = sorted(sizes, reverse=True)

    def place(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(order):
            best[0] = len(rooms)
            return
        for k in range(len(rooms)):
            if rooms[k] >= order[i] and rooms.index(rooms[k]) == k:
                place(i + 1, rooms[:k] + [rooms[k] - order[i]] + rooms[k + 1:])
        place(i + 1, [*rooms, capacity - order[i]])

    place(0, [])
    return best[0]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=9))
def test_reduction_loses_nothing_against_the_best_packing(sizes):
    counts = {s: sizes.count(s) for s in sizes}
    stock = Stock(counts)
    fixed = reduce_stock(stock, 20)
    rest = [s for s, n in stock.left.items() for _ in range(n)]
    assert sum(n for _, n in fixed) + (fewest(rest, 20) if rest else 0) == fewest(sizes, 20)


def test_dominating_sets():
    assert dominating_set(Stock({9: 1, 4: 2}), 9, 10) == (9,)
    assert dominating_set(Stock({6: 1, 4: 1, 1: 3}), 6, 10) == (6, 4)
    assert dominating_set(Stock({6: 1, 3: 2, 2: 1}), 6, 10) == (6, 3)
    assert dominating_set(Stock({5: 1, 2: 1, 1: 9}), 5, 10) is None


def packed_ok(rows, capacity, tokens):
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append((r.offset, r.length))
    for doc_id, ids in tokens.items():
        parts = sorted(by_doc[doc_id], key=lambda r: r.piece)
        assert [(r.start, r.length) for r in parts] == cut(len(ids), capacity)
        for r in parts:
            assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start:r.start + r.length], "<u4").tobytes())
    for parts in by_seq.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= capacity
    return len(by_seq)


def test_query_packs_all_tokens(spark, exact):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet").collect()
    tokens = {r.doc_id: [*exact.encode(r.text, add_special_tokens=False).ids, 0] for r in docs}
    used = packed_ok(op8_dominance_packing(spark, SF0001).collect(), 2048, tokens)
    assert used <= -(-sum(map(len, tokens.values())) // 2048) * 1.02 + 1


def test_edge_rows(spark, exact):
    rows = [(1, "a b", "x"), (2, None, "x"), (3, "", "x"), (4, "word " * 9000, "x"), (None, "n", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length string")
    tokens = {i: [*exact.encode(t or "", add_special_tokens=False).ids, 0] for i, t, _ in rows}
    packed_ok(pack_documents(docs, capacity=100).collect(), 100, tokens)
    same = spark.createDataFrame([(7, "same text here")] * 500, "doc_id long, text string")
    got = pack_documents(same, capacity=64).collect()
    per = len(exact.encode("same text here", add_special_tokens=False).ids) + 1
    assert len(got) == 500 and len({r.sequence_id for r in got}) == -(-500 // (64 // per))
    assert pack_documents(docs.limit(0)).count() == 0
