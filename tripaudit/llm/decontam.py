"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

The patterns are the windows of ``size`` consecutive words of the benchmark items (an item
with fewer words is one shorter window).  For patterns of one length m, a table of shifts
over blocks of two words tells how far the search may jump when a block ends at the
current word; only where the shift is nothing are the windows with that last block taken
from their bucket, told apart by their first block, and compared word by word.  Most
blocks of a document are in no window, so about one word in nine is looked at.

Documents never shuffle: they stream past the tables.  The tables hold at most
``table_bytes`` of windows; a larger benchmark is dealt by hash into several groups and
the documents pass each group in turn, written in between.

Words are runs of ASCII digits, letters (A-Z lower-cased) and all non-ASCII code points.
Defined results: null or empty text has no words and no hits; an item without words has no
window; null item ids count as one item with an empty id; repeated items or windows count
once; columns of the input that are named like an added one are replaced.
"""

from __future__ import annotations

from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripaudit.llm.tables import aside, pieces, table, written

WINDOW = 10
TABLE_BYTES = 32 << 20
_KEEP = {*b"0123456789abcdefghijklmnopqrstuvwxyz", *range(128, 256)}
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c in _KEEP else 32 for c in range(256))
SPANS = "array<struct<start:int,end:int>>"


def words(text: str | None) -> list[bytes]:
    return text.encode().translate(_FOLD).split() if text else []


def windows(item: list[bytes], size: int = WINDOW) -> list[list[bytes]]:
    if not item:
        return []
    return [item[i:i + size] for i in range(max(1, len(item) - size + 1))]


class ShiftTables:
    """Wu-Manber tables for patterns of one length."""

    def __init__(self, m: int, patterns: dict[tuple[bytes, ...], list[str]]):
        self.m, self.block = m, min(2, m)
        self.longest = m - self.block + 1
        self.shift: dict[tuple[bytes, ...], int] = {}
        self.bucket: dict[tuple[bytes, ...], dict[tuple[bytes, ...], list]] = defaultdict(lambda: defaultdict(list))
        for pattern, ids in patterns.items():
            for end in range(self.block, m + 1):
                at = pattern[end - self.block:end]
                self.shift[at] = min(self.shift.get(at, self.longest), m - end)
            self.bucket[pattern[-self.block:]][pattern[:self.block]].append((list(pattern), ids))

    def search(self, text: list[bytes]):
        """(start, end, ids) of every occurrence."""
        m, b, shift, longest, bucket = self.m, self.block, self.shift, self.longest, self.bucket
        end, n = m, len(text)
        while end <= n:
            last = (text[end - 2], text[end - 1]) if b == 2 else (text[end - 1],)
            jump = shift.get(last, longest)
            if jump:
                end += jump
                continue
            start = end - m
            for pattern, ids in bucket[last].get(tuple(text[start:start + b]), ()):
                if text[start:end] == pattern:
                    yield start, end, ids
            end += 1


def build_tables(rows: list[tuple[str, bytes]]) -> list[ShiftTables]:
    """Tables by pattern length from (item id, words joined by a space)."""
    by_length: dict[int, dict[tuple[bytes, ...], list[str]]] = defaultdict(lambda: defaultdict(list))
    for item, joined in rows:
        pattern = tuple(joined.split(b" "))
        by_length[len(pattern)][pattern].append(item)
    return [ShiftTables(m, patterns) for m, patterns in sorted(by_length.items())]


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def item_windows(bench: DataFrame, size: int = WINDOW) -> DataFrame:
    """Distinct (item_id string, window) rows of the benchmark."""
    def cut(batches):
        for batch in batches:
            for part in pieces(batch):
                ids, out = [], []
                for item, text in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    for w in windows(words(text), size):
                        ids.append(item)
                        out.append(b" ".join(w))
                yield pa.record_batch([pa.array(ids, pa.string()), pa.array(out, pa.binary())], ["item_id", "window"])

    items = bench.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text")
    return items.mapInArrow(cut, "item_id string, window binary").distinct()


def _pass(docs: DataFrame, rows: list[tuple[str, bytes]]) -> DataFrame:
    """Add the hits of one group of windows to ``hit_spans`` and ``hit_items``."""
    def search(batches):
        built = build_tables(rows)
        for batch in batches:
            for part in pieces(batch):
                spans, items, counts = [], [], []
                for text, old_spans, old_items in zip(*(part.column(c).to_pylist() for c in
                                                        ("text", "hit_spans", "hit_items")), strict=True):
                    doc = words(text)
                    found, ids = [(s["start"], s["end"]) for s in old_spans], set(old_items)
                    for t in built:
                        for a, b, hit in t.search(doc):
                            found.append((a, b))
                            ids.update(hit)
                    counts.append(len(doc))
                    spans.append([{"start": a, "end": b} for a, b in merge(found)])
                    items.append(sorted(ids))
                cols = dict(zip(part.schema.names, part.columns, strict=True))
                cols |= {"n_words": pa.array(counts, pa.int64()),
                         "hit_spans": pa.array(spans, part.schema.field("hit_spans").type),
                         "hit_items": pa.array(items, part.schema.field("hit_items").type)}
                yield pa.record_batch(list(cols.values()), list(cols))

    return docs.mapInArrow(search, docs.schema)


def find_contamination(docs: DataFrame, bench: DataFrame, size: int = WINDOW,
                       table_bytes: int = TABLE_BYTES) -> DataFrame:
    """Add ``n_words``, ``hit_spans`` (word ranges covered by benchmark windows) and
    ``hit_items`` (ids of the items they come from, sorted) to ``docs``."""
    wins = item_windows(bench, size)
    total = wins.agg(F.sum(F.octet_length("window") + F.octet_length("item_id"))).first()[0] or 0
    groups = int(1 + total // table_bytes)
    if groups > 1:
        wins = written(wins, "windows")
    out = (docs.withColumn("n_words", F.lit(0).cast("bigint"))
           .withColumn("hit_spans", F.array().cast(SPANS)).withColumn("hit_items", F.array().cast("array<string>")))
    for g in range(groups):
        part = wins.where(F.pmod(F.xxhash64("item_id", "window"), F.lit(groups)) == g)
        # Bounded by table_bytes on average over the hash groups.
        out = _pass(out, sorted((r.item_id, bytes(r.window)) for r in part.collect()))
        if groups > 1:
            out = written(out, "decontam-pass")
    return out


def op6_wu_manber(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in every document."""
    found = find_contamination(table(spark, sf_dir, "documents", "doc_id", "text"),
                               table(spark, sf_dir, "benchmark", "item_id", "text"))
    n_hit = F.aggregate("hit_spans", F.lit(0).cast("bigint"), lambda acc, s: acc + s["end"] - s["start"])
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("hit_items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "hit_items"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, bench: DataFrame) -> DataFrame:
    """Documents that hold no benchmark window, with their own columns."""
    plain, back = aside(docs, "text")
    return back(find_contamination(plain, bench).where(F.size("hit_spans") == 0))


ORACLE_OP6 = r"""
WITH fold AS (SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS up, 'abcdefghijklmnopqrstuvwxyz' AS low),
d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), up, low),
        '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM documents, fold),
b AS (SELECT coalesce(item_id::VARCHAR, '') AS item_id, regexp_extract_all(translate(coalesce(text, ''), up, low),
        '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM benchmark, fold),
win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS m, list_slice(w, i, i + least(len(w), 10) - 1) AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
place AS (
  SELECT r, i, m, list_slice(w, i, i + m - 1) AS win
  FROM (SELECT r, w, m, unnest(range(1, len(w) - m + 2)) AS i
        FROM d, (SELECT DISTINCT m FROM win) WHERE len(w) >= m)),
hit AS (SELECT r, i, m, item_id FROM place JOIN win USING (m, win)),
covered AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + m)) AS p FROM hit) GROUP BY r),
items AS (SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids
          FROM hit GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (r) LEFT JOIN items USING (r)"""
