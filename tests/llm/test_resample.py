"""Resampling: CRCs, features, gains and ranks against plain Python."""

import hashlib
import math
import re
import zlib
from collections import Counter

import duckdb
import pytest
from conftest import SF0001
from hypothesis import given, settings
from hypothesis import strategies as st

from tripaudit.llm.resample import (
    ORACLE_OP11,
    WIDE,
    crc_features,
    drawn_documents,
    feature_blocks,
    op11_length_bucketed_resample,
    ranked,
    resample,
)

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(max_size=3 * WIDE + 5), max_size=40))
def test_crcs_equal_the_usual_ones(features):
    assert crc_features(features).tolist() == [zlib.crc32(f) for f in features]


def test_crcs_of_long_features():
    features = [bytes([i % 251]) * n for i, n in enumerate((WIDE - 1, WIDE, WIDE + 1, 50 * WIDE, 100_003))]
    assert crc_features(features).tolist() == [zlib.crc32(f) for f in features]


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def runs(text, low, high):
    w = words(text)
    return [" ".join(w[i:i + k]).encode() for k in range(low, high + 1) for i in range(len(w) - k + 1)]


@settings(max_examples=80, deadline=None)
@given(st.text(alphabet="aB é1. 日", max_size=120), st.integers(1, 3), st.integers(0, 2), st.integers(1, 4))
def test_features_do_not_depend_on_blocks(text, low, more, block):
    blocks = list(feature_blocks(text, low, low + more, block))
    assert Counter(f for _, fs in blocks for f in fs) == Counter(runs(text, low, low + more))
    assert sum(n for n, _ in blocks) == len(words(text))


def brute(docs, target, percent, least, low=1, high=1, k=10_000, seed=2024):
    """(doc_id, n_features, weight, score, rank) in the order of the input."""
    def counted(texts):
        return Counter(zlib.crc32(f) % k for t in texts for f in runs(t, low, high))

    s, t = counted(x for _, x in docs), counted(target)
    all_s, all_t = float(sum(s.values()) + k), float(sum(t.values()) + k)
    rows = []
    for doc_id, text in docs:
        features = runs(text, low, high)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * all_s / ((s[b] + 1) * all_t)))
                     for b in (zlib.crc32(f) % k for f in features))
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))
        rows.append([doc_id, len(words(text)), len(features), weight, score])
    enough = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2]))
    rank = {id(r): i for i, r in enumerate(enough[:len(enough) * percent // 100], 1)}
    return [(r[0], r[2], r[3], r[4], rank.get(id(r))) for r in rows]


def got(df):
    return sorted(map(tuple, df.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=str)


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF0001}/{t}.parquet'")
    return con


def test_query_equals_brute_force_and_sql(spark, tables):
    out = got(op11_length_bucketed_resample(spark, SF0001))
    docs = tables.sql("SELECT doc_id, text FROM documents").fetchall()
    target = [t for t, in tables.sql("SELECT text FROM benchmark").fetchall()]
    assert out == sorted(brute(docs, target, 10, 20), key=str)
    assert out == sorted(tables.sql(ORACLE_OP11).fetchall(), key=str)


@pytest.mark.parametrize("low,high", [(1, 1), (1, 3), (2, 2)])
def test_edge_rows(spark, low, high):
    docs = [(1, None), (2, ""), (3, "... !!"), (4, "One TWO three één " * 9), (5, "日本語" * 4000), (None, "x y z " * 7),
            (6, "tie tie"), (7, "tie tie"), (7, "tie tie"), (8, "w" * 300 + " " + "a " * 50)]
    target = [None, "one two three", "a a a tie"]
    df = spark.createDataFrame([(i, t, "score", 1) for i, t in docs], "doc_id long, text string, score string, n_words int")
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    out = resample(df, goal, 50, 2, low, high)
    assert got(out) == sorted(brute(docs, target, 50, 2, low, high), key=str)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    none = docs.limit(0)
    assert resample(none, docs).count() == 0
    assert got(resample(docs, none, 100, 1)) == brute([(1, "a b c")], [], 100, 1)


def test_repeated_rows_are_spread_over_ranges(spark):
    """A third of all rows may be one row: ranks stay gapless and no range holds them all."""
    rows = [(1, 30, 30, 5, 500)] * 3000 + [(i, 30, 30, 5, i) for i in range(6000)]
    scores = spark.createDataFrame(rows, "doc_id long, n_words long, n_features long, weight long, score long")
    out = ranked(scores, 100, 20, rows_per_range=500).collect()
    assert sorted(r["rank"] for r in out) == list(range(1, 9001))
    assert [r.score for r in sorted(out, key=lambda r: r["rank"])] == sorted((r[4] for r in rows), reverse=True)


def test_drawn_documents_keep_their_columns(spark):
    docs = spark.createDataFrame([(1, "a b", "x"), (2, "c d", "y"), (None, "e f", "z")], "doc_id long, text string, rank string")
    ranks = resample(docs, docs, 100, 1)
    assert sorted(map(tuple, drawn_documents(docs, ranks).collect()), key=str) == sorted(map(tuple, docs.collect()), key=str)
    assert drawn_documents(docs, resample(docs, docs, 0, 1)).count() == 0
