"""Benchmark windows against a plain search at every place."""

import duckdb
from conftest import SF0001
from hypothesis import given, settings
from hypothesis import strategies as st

from tripaudit.llm.decontam import (
    ORACLE_OP6,
    build_tables,
    drop_contaminated,
    find_contamination,
    op6_wu_manber,
    windows,
    words,
)


def brute(text, items, size=10):
    doc, hit, ids = words(text), set(), set()
    for item, t in items:
        for w in windows(words(t), size):
            for i in range(len(doc) - len(w) + 1):
                if doc[i:i + len(w)] == w:
                    hit.update(range(i, i + len(w)))
                    ids.add(item)
    return len(doc), len(hit), sorted(ids)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=40), st.lists(st.lists(st.sampled_from("abc"), max_size=9), max_size=4))
def test_tables_find_every_occurrence(doc, items):
    rows = [(str(i), b" ".join(w)) for i, t in enumerate(items) for w in windows(words(" ".join(t)), 4)]
    text = words(" ".join(doc))
    found, ids = set(), set()
    for t in build_tables(rows):
        for a, b, hit in t.search(text):
            found.update(range(a, b))
            ids.update(hit)
    assert (len(text), len(found), sorted(ids)) == brute(" ".join(doc), [(str(i), " ".join(t)) for i, t in enumerate(items)], 4)


def test_words():
    assert words("It's 5é—Ünder_x,İ") == ["it".encode(), b"s", "5é—Ünder".encode(), b"x", "İ".encode()]
    assert words(None) == words("") == words(" .,") == []


LONG = "one two three four five six seven eight nine ten eleven twelve"
ITEMS = [("b", LONG), ("a", LONG), ("c", "short item"), (None, "solo"), ("d", None), ("e", "..."), ("b", LONG)]
DOCS = [(1, f"x {LONG.upper()} y"), (2, "a Short, item here"), (2, "a Short, item here"), (3, None), (None, ""),
        (4, "solo " * 50_000), (5, LONG.replace("six", "6")), (6, "clean text only")]


def test_edge_rows_in_one_pass_and_in_several(spark):
    docs = spark.createDataFrame([(i, t, "kept") for i, t in DOCS], "doc_id long, text string, n_words string")
    bench = spark.createDataFrame(ITEMS, "item_id string, text string")
    want = sorted(str((i, *brute(t, [(k or "", v) for k, v in ITEMS]))) for i, t in DOCS)
    for size in (1 << 20, 40):
        got = find_contamination(docs, bench, table_bytes=size).collect()
        assert sorted(str((r.doc_id, r.n_words, sum(s.end - s.start for s in r.hit_spans), list(r.hit_items)))
                      for r in got) == want
    left = drop_contaminated(docs, bench)
    assert left.columns == docs.columns
    assert sorted(str((r.doc_id, r.n_words)) for r in left.collect()) == [
        "(3, 'kept')", "(5, 'kept')", "(6, 'kept')", "(None, 'kept')"]
    assert find_contamination(docs.limit(0), bench).count() == 0
    assert drop_contaminated(docs, bench.limit(0)).count() == len(DOCS)


def test_query_matches_sql_and_brute_force(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    df, want = op6_wu_manber(spark, SF0001), con.sql(ORACLE_OP6)
    assert df.columns == want.columns
    rows = df.collect()
    assert sorted(map(tuple, rows)) == sorted(want.fetchall())
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF0001}/benchmark.parquet").collect()]
    hit = [r for r in rows if r.contaminated]
    assert hit
    for r in hit + rows[:20]:
        n, covered, ids = brute(docs[r.doc_id], items)
        assert (r.n_words, r.n_hit, r.n_items) == (n, covered, len(ids))
