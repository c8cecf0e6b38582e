"""Importance resampling towards a target distribution, by hashed word runs.

The features of a text are all its runs of ``low`` to ``high`` consecutive words, joined by
one space; the CRC-32 of a feature's bytes picks its bucket.  Every bucket's gain compares
how often the target texts and the documents fall into it; a document's weight is the sum of
its features' gains, its score adds a Gumbel draw that depends on seed and id alone, and the
highest scores are drawn.

CRCs are computed for many features at once: the distinct features of a block of words are
grouped by length, each group is a two-dimensional uint8 array with a feature per row, and
one column after the other updates the CRCs of all rows.  Features longer than ``WIDE`` bytes
(text without spaces) are cut into blocks of that width, which are rows as well; their raw
CRCs are folded into the feature's block by block, as a CRC is linear.  The buckets are then
scattered back to the words.

The texts are read twice and never shuffled: once to count (a task sends at most one row per
bucket) and once to weigh.  The driver holds one count and one gain per bucket, whose number
is a parameter.  Ranks are counted in ranges of the score order, so no task orders all rows.

Words are runs of ASCII digits, letters (A-Z lower-cased) and all non-ASCII code points.
Defined results: a null or empty text has no features and weight 0; a null id counts as an
empty string in the draw and comes last among ties; repeated rows are scored like others and
ranked one after the other; an empty table gives an empty result, an empty target leaves the
target's counts at 0; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripaudit.llm.tables import pieces, table, written

BUCKETS = 10_000
SEED = 2024
PERCENT = 10
LEAST_WORDS = 20
#: Words of a text that are handled at once, and features that are hashed at once.
BLOCK = 200_000
WIDE = 64
ROWS_PER_RANGE = 500_000
# Fixed value: the reversed polynomial of CRC-32.
POLYNOMIAL = 0xEDB88320
_KEEP = {*b"0123456789abcdefghijklmnopqrstuvwxyz", *range(128, 256)}
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c in _KEEP else 32 for c in range(256))
SCORES = "doc_id bigint, n_words bigint, n_features bigint, weight bigint, score bigint"


def _byte_steps() -> np.ndarray:
    steps = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        steps = np.where(steps & 1, (steps >> 1) ^ np.uint32(POLYNOMIAL), steps >> 1)
    return steps


def _advance(state: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """CRC states after one more row of bytes each, column by column."""
    for column in np.ascontiguousarray(matrix.T):
        state = _STEP[(state ^ column) & 0xFF] ^ (state >> 8)
    return state


_STEP = _byte_steps()
#: What WIDE zero bytes make of every byte of a state.
_SKIP = [_advance(np.arange(256, dtype=np.uint32) << (8 * k), np.zeros((256, WIDE), np.uint8)) for k in range(4)]


def crc_rows(matrix: np.ndarray) -> np.ndarray:
    """CRC-32 of every row of a uint8 array."""
    n, size = matrix.shape
    head = size if size <= WIDE else size % WIDE
    state = _advance(np.full(n, 0xFFFFFFFF, np.uint32), matrix[:, :head])
    if head < size:
        blocks = np.ascontiguousarray(matrix[:, head:]).reshape(-1, WIDE)
        for raw in np.ascontiguousarray(_advance(np.zeros(len(blocks), np.uint32), blocks).reshape(n, -1).T):
            state = (_SKIP[0][state & 0xFF] ^ _SKIP[1][(state >> 8) & 0xFF]
                     ^ _SKIP[2][(state >> 16) & 0xFF] ^ _SKIP[3][state >> 24] ^ raw)
    return ~state


def crc_features(features: list[bytes]) -> np.ndarray:
    """CRC-32 of every feature, by groups of equal length."""
    out = np.zeros(len(features), np.uint32)
    lengths = np.fromiter(map(len, features), np.int64, len(features))
    order = np.argsort(lengths, kind="stable")
    cuts = np.flatnonzero(np.diff(lengths[order])) + 1
    for group in np.split(order, cuts):
        if len(group):
            size = int(lengths[group[0]])
            joined = b"".join([features[i] for i in group])
            out[group] = crc_rows(np.frombuffer(joined, np.uint8).reshape(len(group), size))
    return out


def word_blocks(text: str | None, block: int = BLOCK) -> Iterator[list[bytes]]:
    """The words of a whole text, about ``block`` at a time."""
    if not text:
        return
    data = text.encode().translate(_FOLD)
    if len(data) <= 6 * block:
        yield data.split()
        return
    start = 0
    while start < len(data):
        end = data.find(b" ", start + 6 * block)
        end = len(data) if end < 0 else end
        yield data[start:end].split()
        start = end


def feature_blocks(text: str | None, low: int, high: int, block: int = BLOCK) -> Iterator[tuple[int, list[bytes]]]:
    """(number of words, features that end in them) of a whole text, block by block."""
    before: list[bytes] = []
    for new in word_blocks(text, block):
        if high == 1:
            yield len(new), new
            continue
        words = before + new
        yield len(new), [b" ".join(words[i:i + k]) for k in range(low, high + 1)
                         for i in range(max(0, len(before) - k + 1), len(words) - k + 1)]
        before = words[len(words) - high + 1:] if len(words) >= high else words


def hashed_blocks(texts: list[str | None], low: int, high: int, buckets: int):
    """(texts, words of them, texts of features, buckets of features) for blocks of features:
    the distinct ones are hashed and their buckets scattered back."""
    rows, counts, owners, flat = [], [], [], []

    def flush():
        distinct = list(dict.fromkeys(flat))
        at = {f: i for i, f in enumerate(distinct)}
        found = (crc_features(distinct) % np.uint32(buckets)).astype(np.int64)
        ids = np.fromiter(map(at.__getitem__, flat), np.int64, len(flat))
        return (np.array(rows, np.int64), np.array(counts, np.int64),
                np.repeat(np.array(rows, np.int64), np.array(owners, np.int64)), found[ids])

    for row, text in enumerate(texts):
        for n_words, features in feature_blocks(text, low, high):
            rows.append(row)
            counts.append(n_words)
            owners.append(len(features))
            flat += features
            if len(flat) >= BLOCK:
                yield flush()
                rows, counts, owners, flat = [], [], [], []
    if rows:
        yield flush()


def bucket_counts(texts: DataFrame, text: str = "text", low: int = 1, high: int = 1,
                  buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall into every bucket.  Tasks send their sums."""
    def count(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in pieces(batch):
                for *_, found in hashed_blocks(part.column(0).to_pylist(), low, high, buckets):
                    total += np.bincount(found, minlength=buckets)
        hit = np.flatnonzero(total)
        yield pa.record_batch([pa.array(hit), pa.array(total[hit])], ["bucket", "n"])

    sums = texts.select(text).mapInArrow(count, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for row in sums.collect():  # at most one row per bucket
        out[row["bucket"]] = row["n"]
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Integer gain of every bucket from the counts of documents and target texts."""
    k = len(source)
    all_source, all_target = float(source.sum() + k), float(target.sum() + k)
    return np.array([math.floor(1000 * math.log(float(t + 1) * all_source / (float(s + 1) * all_target)))
                     for s, t in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def gumbel(doc_id: int | None, seed: int = SEED) -> int:
    """The draw of one document: a function of seed and id."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def importance_scores(docs: DataFrame, gains: np.ndarray, doc_id: str = "doc_id", text: str = "text",
                      low: int = 1, high: int = 1, seed: int = SEED) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) of every document."""
    buckets = len(gains)

    def score(batches):
        for batch in batches:
            for part in pieces(batch):
                ids = part.column(0).to_pylist()
                n_words, n_features, weight = (np.zeros(len(ids), np.int64) for _ in range(3))
                for rows, counts, owners, found in hashed_blocks(part.column(1).to_pylist(), low, high, buckets):
                    np.add.at(n_words, rows, counts)
                    n_features += np.bincount(owners, minlength=len(ids))
                    np.add.at(weight, owners, gains[found])
                noise = np.array([gumbel(i, seed) for i in ids], np.int64)
                yield pa.record_batch(
                    [pa.array(ids, pa.int64()), *map(pa.array, (n_words, n_features, weight, weight + noise))],
                    ["doc_id", "n_words", "n_features", "weight", "score"])

    return docs.select(F.col(doc_id).cast("bigint"), text).mapInArrow(score, SCORES)


def ranked(scores: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS,
           rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Add ``rank`` to scores: 1, 2, ... for the drawn, null for the others.

    The score order is cut into ranges; a row's rank is its place within its range plus the
    rows of the ranges before it.  The order ends with a number of the row, so ranges are
    even whatever ties or repeats there are; scores and ranges are written tables, as both
    that number and the sampled bounds must not change when a task runs again."""
    spark = scores.sparkSession
    scores = written(scores.withColumn("_row", F.monotonically_increasing_id()), "scores")
    enough = scores.where(F.col("n_words") >= least_words)
    n = enough.count()
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // rows_per_range))
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features"), F.col("_row")]
    spread = written(enough.repartitionByRange(ranges, *order).withColumn("_range", F.spark_partition_id()), "ranges")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    starts = (spread.groupBy("_range").agg(F.count("*").alias("_n"))
              .select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")))
    placed = (spread.withColumn("_in", F.row_number().over(Window.partitionBy("_range").orderBy(*order)))
              .join(starts, "_range").withColumn("_rank", F.col("_start") + F.col("_in")))
    columns = ["doc_id", "n_words", "n_features", "weight", "score"]
    return (placed.select(*columns, F.when(F.col("_rank") <= n * percent // 100, F.col("_rank")).alias("rank"))
            .union(scores.where(F.col("n_words") < least_words)
                   .select(*columns, F.lit(None).cast("bigint").alias("rank"))))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS,
             low: int = 1, high: int = 1, buckets: int = BUCKETS, seed: int = SEED,
             doc_id: str = "doc_id", text: str = "text", target_text: str = "text") -> DataFrame:
    """Scores and ranks of all documents against the texts of ``target``."""
    gains = bucket_gains(bucket_counts(docs, text, low, high, buckets),
                         bucket_counts(target, target_text, low, high, buckets))
    return ranked(importance_scores(docs, gains, doc_id, text, low, high, seed), percent, least_words)


def drawn_documents(docs: DataFrame, ranks: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """The documents, with all their columns, whose id was drawn (every row of that id)."""
    chosen = ranks.where(F.col("rank").isNotNull()).select(F.col("doc_id").alias("_drawn")).distinct()
    return docs.join(chosen, docs[doc_id].eqNullSafe(chosen["_drawn"]), "left_semi")


def op11_length_bucketed_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents weighed against ``benchmark``; a tenth of those with 20 words is drawn."""
    out = resample(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "text"))
    return out.select("doc_id", "n_features", "weight", "score", "rank")


ORACLE_OP11 = r"""
WITH RECURSIVE step(i, k, v) AS (
  SELECT range, 0, range FROM range(256)
  UNION ALL
  SELECT i, k + 1, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END FROM step WHERE k < 8),
steps AS (SELECT list(v ORDER BY i) AS t FROM step WHERE k = 8),
fold AS (SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS up, 'abcdefghijklmnopqrstuvwxyz' AS low),
d AS (SELECT row_number() OVER () AS r, doc_id,
        regexp_extract_all(translate(coalesce(text, ''), up, low), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w
      FROM documents, fold),
b AS (SELECT regexp_extract_all(translate(coalesce(text, ''), up, low), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w
      FROM benchmark, fold),
dw AS (SELECT r, w, count(*) AS n FROM (SELECT r, unnest(w) AS w FROM d) GROUP BY r, w),
bw AS (SELECT w, count(*) AS n FROM (SELECT unnest(w) AS w FROM b) GROUP BY w),
vocabulary AS (SELECT w FROM dw UNION SELECT w FROM bw),
bucket AS (
  SELECT w, xor(list_reduce(
      list_prepend(4294967295, list_transform(range(1, strlen(w) + 1), lambda i: ('0x' || substr(hex(w), 2 * i - 1, 2))::BIGINT)),
      lambda c, x: xor(c // 256, t[xor(c, x) % 256 + 1])), 4294967295) % 10000 AS k
  FROM vocabulary, steps),
s AS (SELECT k, sum(n) AS s FROM dw JOIN bucket USING (w) GROUP BY k),
t AS (SELECT k, sum(n) AS t FROM bw JOIN bucket USING (w) GROUP BY k),
totals AS (SELECT (SELECT coalesce(sum(s), 0) FROM s)::DOUBLE AS all_s, (SELECT coalesce(sum(t), 0) FROM t)::DOUBLE AS all_t),
gain AS (
  SELECT k, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (all_s + 10000)
                            / ((coalesce(s, 0) + 1)::DOUBLE * (all_t + 10000))))::BIGINT AS g
  FROM s FULL JOIN t USING (k), totals),
weighed AS (
  SELECT r, sum(n * g)::BIGINT AS weight FROM dw JOIN bucket USING (w) JOIN gain USING (k) GROUP BY r),
scored AS (
  SELECT r, doc_id, len(w)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
    (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT
                                                  + 0.5::DOUBLE) / 4294967296))))::BIGINT AS score
  FROM d LEFT JOIN weighed USING (r)),
placed AS (
  SELECT r, row_number() OVER (ORDER BY score DESC, doc_id ASC NULLS LAST) AS p, count(*) OVER () AS n
  FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN p <= 10 * n // 100 THEN p END AS rank
FROM scored LEFT JOIN placed USING (r)"""
