"""WARC archives: exact round trip, revisits, hostile payloads."""

import base64
import gzip
import hashlib

import duckdb
import pytest
from conftest import SF0001

from tripaudit.llm.warc import ORACLE_OP7, op7_warc_revisits, parse_records, read_archives, resolved, write_archives


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def archived(spark, rows, tmp_dir, schema="page_id long, url string, html string", **options):
    write_archives(spark.createDataFrame(rows, schema), f"{tmp_dir}/warc", **options)
    return resolved(read_archives(spark, f"{tmp_dir}/warc")).collect()


NASTY = "a\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nb\r\n\r\n"


def test_round_trip_and_revisits(spark, tmp_dir):
    rows = [(1, "u1", "same"), (5, "u5", "same"), (3, "u3", "same"), (2, "u\r\nX: y", NASTY), (4, None, None),
            (6, "u6", ""), (7, "é", "ü" * 200_000), (8, "u8", "\n"), (9, "u9", "\r\n\r\n")]
    got = {int(r.record_id): r for r in archived(spark, rows, tmp_dir)}
    assert {k: (r.record_type, r.refers_to) for k, r in got.items()} == {
        1: ("revisit", "5"), 5: ("response", None), 3: ("revisit", "5"), 2: ("response", None),
        4: ("revisit", "6"), 6: ("response", None), 7: ("response", None), 8: ("response", None), 9: ("response", None)}
    for i, url, html in rows:
        assert (got[i].url, got[i].payload_bytes, got[i].payload_digest) == (url, len((html or "").encode()), digest(html))


def test_short_payloads_can_all_be_responses(spark, tmp_dir):
    rows = [(1, "a", "x"), (2, "b", "x"), (3, "c", "long enough"), (4, "d", "long enough")]
    got = {int(r.record_id): r.record_type for r in archived(spark, rows, tmp_dir, min_bytes=5)}
    assert got == {1: "response", 2: "response", 3: "revisit", 4: "response"}


def test_null_and_repeated_ids_and_extra_columns(spark, tmp_dir):
    rows = [(None, "n", "p", 1), (2, "a", "p", 1), (2, "b", "p", 1), (1, "c", "p", 1), (None, "o", "q", 1), (None, "r", "q", 1)]
    got = archived(spark, rows, tmp_dir, "page_id long, url string, html string, payload long")
    assert sorted((r.record_id or "", r.url, r.record_type, r.refers_to or "") for r in got) == [
        ("", "n", "revisit", "2"), ("", "o", "response", ""), ("", "r", "response", ""),
        ("1", "c", "revisit", "2"), ("2", "a", "response", ""), ("2", "b", "response", "")]


def test_empty_table(spark, tmp_dir):
    assert archived(spark, [], tmp_dir) == []


def test_files_are_warc_and_bounded(spark, tmp_dir):
    pages = spark.read.parquet(f"{SF0001}/pages.parquet")
    write_archives(pages, f"{tmp_dir}/warc", file_bytes=20_000, compression="none")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{tmp_dir}/warc").collect()
    assert len(files) > 5
    heads = [h for f in files for h, _ in parse_records(bytes(f.content))]
    assert len(heads) == pages.count() and {h["WARC-Type"] for h in heads} <= {"response", "revisit"}
    with pytest.raises(ValueError):
        list(parse_records(bytes(files[0].content)[:-3]))


def test_headers_that_other_readers_need(spark, tmp_dir):
    rows = [(1, "http://a/b c", "same"), (2, "http://x\r\ny", "same"), (3, None, "other")]
    write_archives(spark.createDataFrame(rows, "page_id long, url string, html string"), f"{tmp_dir}/warc", compression="none")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{tmp_dir}/warc").collect()
    heads = {h["WARC-Record-ID"]: h for f in files for h, _ in parse_records(bytes(f.content))}
    one, two, three = (heads[f"<urn:record:{i}>"] for i in (1, 2, 3))
    assert one["WARC-Target-URI"] == "http://a/b c" and two["WARC-Target-URI"] == "http://x%0D%0Ay"
    assert "WARC-Target-URI" not in three and three["Content-Type"] == "text/html; charset=utf-8"
    assert (one["WARC-Type"], one["X-Payload-Length"], one["WARC-Refers-To"]) == ("revisit", "4", "<urn:record:2>")


def test_a_hot_digest_is_spread_and_payloads_move_once(spark, tmp_dir, monkeypatch):
    from tripaudit.llm import warc

    monkeypatch.setattr(warc, "HOT", 10)
    rows = [(i, f"u{i}", "hot page") for i in range(400)] + [(1000 + i, "v", f"page {i // 2}") for i in range(400)]
    got = {int(r.record_id): r for r in archived(spark, rows, tmp_dir, file_bytes=20_000)}
    assert len(got) == 800 and {k for k, r in got.items() if r.record_type == "response"} == {399, *range(1001, 1400, 2)}
    assert all(r.refers_to == "399" for k, r in got.items() if k < 399)
    sizes = [len(list(parse_records(gzip.decompress(f.content)))) for f in
             spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{tmp_dir}/warc").collect()]
    assert len(sizes) > 10 and max(sizes) < 100


def test_query_matches_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{SF0001}/pages.parquet')")
    df, want = op7_warc_revisits(spark, SF0001), con.sql(ORACLE_OP7)
    assert df.columns == want.columns
    assert sorted(map(str, (tuple(r) for r in df.collect()))) == sorted(map(str, want.fetchall()))
