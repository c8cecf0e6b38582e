"""Ring sharding against a literal walk of the ring, key by key."""

import zlib
from collections import Counter

from conftest import SF0001

from tripaudit.llm.sharding import document_keys, op5_ring_shards, position, ring_points, ring_shards, walk


def literal_walk(rows, points, room):
    """Keys in ring order; each goes clockwise to the first shard with room."""
    used, out = Counter(), []
    for pos, *key in sorted(rows):
        at = next((i for i, (p, _) in enumerate(points) if p >= pos), 0)
        while used[points[at % len(points)][1]] >= room[points[at % len(points)][1]]:
            at += 1
        shard = points[at % len(points)][1]
        out.append((*key, shard))
        used[shard] += 1
    return sorted(out, key=str)


def keys_of(spark, n):
    return spark.range(n).selectExpr("id as doc_id", "id % 7 as size", "id * 31 as text_crc32")


def test_placement_matches_the_literal_walk(spark):
    keys = keys_of(spark, 500)
    rows = [(r.p, r.doc_id, r.size, r.text_crc32) for r in keys.select(position(*keys.columns).alias("p"), "*").collect()]
    points = ring_points(spark, 6, 8)
    for eps, room in ((0.0, [500 // 6 + (s < 500 % 6) for s in range(6)]), (0.25, [105] * 6)):
        got = ring_shards(keys, 6, 8, eps, rows_per_cell=50).collect()
        assert sorted(((r.doc_id, r.size, r.text_crc32, r.shard) for r in got), key=str) == literal_walk(rows, points, room)
        slots = {}
        for r in got:
            slots.setdefault(r.shard, []).append(r.slot)
        assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_one_more_shard_moves_little(spark):
    keys = keys_of(spark, 2000)
    a = {r.doc_id: r.shard for r in ring_shards(keys, 10, 64, eps=0.25).collect()}
    b = {r.doc_id: r.shard for r in ring_shards(keys, 11, 64, eps=0.25).collect()}
    assert sum(a[k] != b[k] for k in a) < 0.4 * len(a)


def test_walk_splits_an_interval_over_shards():
    assert list(walk([5, 2], [0, 1], [0, 1], [3, 4])) == [(0, 0, 3, 0, 0), (0, 3, 5, 1, 0), (1, 0, 2, 1, 2)]


def test_query_law_and_columns(spark):
    rows = op5_ring_shards(spark, SF0001).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()}
    assert len(rows) == len(docs)
    per = Counter(r.shard for r in rows)
    assert set(per) == set(range(40)) and max(per.values()) - min(per.values()) <= 1
    assert sorted((r.shard, r.slot) for r in rows) == sorted((s, i) for s in per for i in range(per[s]))
    for r in rows:
        text = docs[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(text) + 16, zlib.crc32(text), "rows", None)


def test_null_repeated_and_empty_rows(spark):
    rows = [(1, "a", "x")] * 6000 + [(None, None, "y"), (None, "é" * 100_000, "y"), (2, "", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, size string")
    got = ring_shards(document_keys(docs), 4, 16).collect()
    assert len(got) == 6003
    per = Counter(r.shard for r in got)
    assert max(per.values()) - min(per.values()) <= 1
    assert sorted(r.size for r in got if r.doc_id is None) == [16, 200_016]
    assert {(r.size, r.text_crc32) for r in got if r.doc_id == 2} == {(16, 0)}
    assert ring_shards(document_keys(docs.limit(0)), 4, 16).count() == 0
