"""Near-duplicate documents by a grouped prefix join on word shingles.

Two texts link when ``100 * |A and B| >= percent * |A or B|`` for their sets of distinct
5-word shingles.  If they do, they share a shingle among the first
``n - ceil(percent / 100 * n) + 1`` of both sets under any common order (the prefix filter).

1. A first scan counts the shingles that prefixes consist of, in hash buckets, and finds the
   frequent ones, however thinly they are spread.  The order puts them last; it decides how
   much work there is, never the result.
2. A second scan orders the sets, collapses texts with the same prefix and size into one
   group, and sends the groups' prefix shingles, packed in blocks, to hash buckets.
   A bucket joins the groups of each shingle, filters the pairs by size and counts their
   matches, and hands on the rows of frequent shingles, which were dealt out by group,
   unjoined.  A pair stays when its matches, all frequent shingles of its prefixes and all
   that lies beyond them could make up the overlap that is needed.
3. Groups are expanded and verified on whole sets.  Only components are asked for, so
   rounds verify one pair per group, towards its best connected neighbour; pairs whose two
   sides already share a component need no further look.  Pivots stand in for all pairs
   of a frequent shingle.
4. All pairs that are left between different components are verified one by one,
   those of frequent shingles and of the members of groups included.  No link is lost.
   Where many sets of a frequent shingle are still apart, only those are paired that may
   link by what sets them apart from their middle, the shingles that most of them hold: two
   sets differ in what their differences from a third do not share.  Those near the middle
   link with each other, and any other two that link share some of their differences, which
   a prefix filter on these finds.

Shingles, groups and sets are told apart by 64-bit hashes, sets also by their size.

Defined results: null text and text without words have no shingles and link with nothing;
texts of one to four words have one shingle; equal texts always link; repeated rows keep
their number; a component's id is its smallest ``doc_id`` (null only if all are null).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripaudit.llm.components import connected_components
from tripaudit.llm.tables import aside, in_small_batches, pieces, table, written

SHINGLE = 5
PERCENT = 75
#: Shingles that a task gathers before it looks for frequent ones, and before it deals rows.
CHUNK, DEALT = 2_000_000, 1_000_000
#: Bytes of text taken at once, and hashed at once.
TEXT_BYTES, SEGMENT = 2 << 20, 1 << 19
#: Times a shingle must occur in distinct texts of a chunk if its hash is high, and over all
#: chunks, to count as frequent; and about how many the order can put last (8 bytes each): they
#: grow with the input.
LOCAL, FREQUENT, MOST_FREQUENT = 3, 24, 4_000_000
#: Groups of one shingle that a bucket joins outright.
JOINED = 32
ROWS_PER_BUCKET, SHINGLES_PER_BUCKET = 250_000, 1_000_000
#: Pairs that meet one copy of a set when they are verified.
MET = 500
#: Bytes of sets that are sent to their pairs at once, if this part of the text is not more.
SENT, SENT_PART = 64 << 20, 3
#: Rows of two or three numbers up to which a table is broadcast.
SMALL = 250_000
ROUNDS = 2
#: Sets outside the largest component of a neighbourhood up to which all pairs are looked at.
STRAY = 8
#: Members of a neighbourhood whose majority is its middle.
ASKED = 64

MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]
QUARTER, COUNTED, HALF = np.uint64(1 << 62), np.uint64(3 << 61), np.uint64(1 << 63)
COUNT = np.dtype([("s", "<u8"), ("n", "<u4")])
BUCKET_SCHEMA = "bucket int, kind int, doc_id bigint, a bigint, na int, b bigint, rows binary"
JOIN_SCHEMA = "kind int, doc_id bigint, s bigint, a bigint, na int, b bigint, nb int, h int"


BLANK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


@lru_cache(maxsize=2)
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2^64, and of its inverse, up to n."""
    inverse = np.uint64(pow(int(MIX[2]), -1, 1 << 64))
    return tuple(np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, x, np.uint64)])) for x in (MIX[2], inverse))


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * MIX[1]
    h = (h ^ (h >> np.uint64(27))) * MIX[2]
    return h ^ (h >> np.uint64(31))


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of every word of bytes that end in a blank.  A hash is a difference of
    prefix sums, scaled back to the word's start; segments between blanks bound the memory."""
    starts, hashes, at = [np.empty(0, np.int64)], [np.empty(0, np.uint64)], 0
    while at < len(data):
        stop = min(at + SEGMENT, len(data))
        blanks = np.flatnonzero(BLANK[data[at:stop]])
        while not len(blanks):  # a word longer than the segment
            stop = min(2 * stop - at, len(data))
            blanks = np.flatnonzero(BLANK[data[at:stop]])
        part = data[at:at + int(blanks[-1]) + 1]
        up, down = powers(SEGMENT if len(part) <= SEGMENT else len(part))
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * up[:len(part)], out=sums[1:])
        edge = np.diff(np.concatenate([[True], BLANK[part]]).astype(np.int8))
        start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        starts.append(start + at)
        hashes.append(mixed((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64)))
        at += len(part)
    return np.concatenate(starts), np.concatenate(hashes)


def combined(w: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words."""
    n = len(w) - size + 1
    h = np.full(n, size, np.uint64)
    for k in range(size):
        h = h * MIX[0] + w[k:n + k]
    return mixed(h)


def shingles(texts: list[str | None]) -> list[np.ndarray]:
    """Shingle hashes of every text, unsorted and with repeats: A-Z lower-cased, words
    between blanks."""
    raw = [(t or "").encode() for t in texts]
    start, words = word_hashes(np.frombuffer(b"\n".join([*raw, b""]).lower(), np.uint8))
    ends = np.cumsum([len(r) + 1 for r in raw])
    bound = np.searchsorted(start, np.concatenate([[0], ends]))
    whole = combined(words, SHINGLE) if len(words) >= SHINGLE else words[:0]
    out = []
    for i, j in zip(bound[:-1].tolist(), bound[1:].tolist(), strict=True):
        if j - i >= SHINGLE:
            out.append(whole[i:j - SHINGLE + 1])
        else:
            out.append(combined(words[i:j], j - i) if j > i else words[:0])
    return out


def distinct(h: np.ndarray) -> np.ndarray:
    """Sorted distinct hashes."""
    h = np.sort(h)
    first = np.ones(len(h), bool)
    first[1:] = h[1:] != h[:-1]
    return h[first]


def number(data: bytes) -> int:
    """Signed 64-bit hash."""
    return xxhash.xxh64_intdigest(data) - (1 << 63)


def prefix_size(n, percent: int):
    """Shingles of a set of n that must be looked at: n - ceil(percent * n / 100) + 1."""
    return n - (-(-percent * n // 100)) + 1


def _text_chunks(batches, size):
    """(doc ids, shingles) of chunks of about ``size`` shingles."""
    ids, found, total = [], [], 0
    for batch in batches:
        for part in pieces(batch, TEXT_BYTES):
            ids += part.column(0).to_pylist()
            # Copies: a text's shingles are a view of those of its whole slice.
            found += [h.copy() for h in shingles(part.column(1).to_pylist())]
            total += sum(map(len, found[-part.num_rows:]))
            if total > size:
                yield ids, found
                ids, found, total = [], [], 0
    if ids:
        yield ids, found


def text_bytes(docs: DataFrame) -> int:
    return docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0


def frequent_shingles(docs: DataFrame) -> np.ndarray:
    """Sorted hashes of the most frequent shingles over all texts (equal texts of a chunk
    count once), counted in hash buckets.  All hashes below ``COUNTED`` are counted, which
    prefixes consist of; up to ``HALF`` those met ``LOCAL`` times in a chunk; the others come
    last in the order as it is."""
    # A shingle per word of six bytes, of which a part is counted.
    buckets = int(16 + text_bytes(docs) // 16 // SHINGLES_PER_BUCKET)

    def deal(batches):
        for _, found in _text_chunks(batches, CHUNK):
            texts = {xxhash.xxh64_intdigest(h): h[h < HALF] for h in found}
            seen, n = np.unique(np.concatenate(list(texts.values())), return_counts=True)
            sent = (seen < COUNTED) | (n >= LOCAL)
            seen, n = seen[sent], n[sent]
            for once in (True, False):
                kept = (n == 1) == once
                block = seen[kept] if once else np.rec.fromarrays([seen[kept], n[kept]], COUNT)
                to = seen[kept] % np.uint64(buckets)
                order = np.argsort(to, kind="stable")
                cuts = np.searchsorted(to[order], np.arange(buckets + 1))
                block = block[order]
                full = np.flatnonzero(cuts[1:] > cuts[:-1]).tolist()
                for i in range(0, len(full), 2000):
                    at = full[i:i + 2000]
                    yield pa.record_batch([pa.array(at, pa.int32()), pa.array([once] * len(at), pa.bool_()),
                                           pa.array([block[cuts[k]:cuts[k + 1]].tobytes() for k in at], pa.binary())],
                                          ["bucket", "once", "rows"])

    def count(group: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, n = [], []
        for batch in group:
            for once, rows in zip(batch.column("once").to_pylist(), batch.column("rows").to_pylist(), strict=True):
                block = np.frombuffer(rows, np.uint64 if once else COUNT)
                seen.append(block if once else block["s"])
                n.append(np.ones(len(block), np.uint32) if once else block["n"])
        seen, n = np.concatenate(seen), np.concatenate(n)
        order = np.argsort(seen)
        seen, n = seen[order], n[order]
        start = np.flatnonzero(np.concatenate([[True], seen[1:] != seen[:-1]]))
        total = np.add.reduceat(n, start, dtype=np.int64)
        often = total >= FREQUENT
        yield pa.record_batch([pa.array(seen[start[often]].view(np.int64)), pa.array(total[often])], ["s", "n"])

    counted = written(docs.select("doc_id", "text").mapInArrow(deal, "bucket int, once boolean, rows binary")
                      .groupBy("bucket").applyInArrow(count, "s bigint, n bigint"), "counted")
    # Where they are too many, the least frequent that have room are drawn by their hash.
    top, room = counted, MOST_FREQUENT
    for n, shingles in counted.groupBy("n").agg(F.count("*")).orderBy(F.desc("n")).collect():
        if shingles > room:
            top = counted.where(f"n > {n} or n = {n} and pmod(xxhash64(s), {shingles}) < {room}")
            break
        room -= shingles
    return np.sort(top.select("s").toArrow().column("s").to_numpy().view(np.uint64))


def bucket_rows(docs: DataFrame, frequent: np.ndarray, buckets: int, percent: int) -> DataFrame:
    """Kind 0: a document with its set ``a`` of ``na`` shingles and its group ``b``.  Kind 1:
    prefix rows (shingle, group, size, frequent shingles in the prefix, place in the set's
    order) of one bucket; those of frequent shingles are dealt by group."""
    def deal(batches):
        for ids, found in _text_chunks(batches, DEALT):
            out, parts, met = [], [], set()
            for i, (doc_id, s) in enumerate(zip(ids, map(distinct, found), strict=True)):
                n = len(s)
                if not n:
                    out.append((i % buckets, 0, doc_id, None, 0, None, None))
                    continue
                if len(frequent):
                    at = np.minimum(np.searchsorted(frequent, s), len(frequent) - 1)
                    common = frequent[at] == s
                    order = np.concatenate([s[~common], s[common]])[:prefix_size(n, percent)]
                    first_common = n - int(common.sum())
                else:
                    order, first_common = s[:prefix_size(n, percent)], n
                group = number(order.tobytes() + n.to_bytes(8, "little"))
                out.append((i % buckets, 0, doc_id, number(s.tobytes()), n, group, None))
                if (group, n) in met:
                    continue
                met.add((group, n))
                block = np.empty(len(order), ROW)
                block["s"], block["g"], block["n"] = order, group, n
                block["often"] = np.arange(len(order)) >= first_common
                block["h"] = max(len(order) - first_common, 0)
                block["p"] = np.arange(len(order))
                parts.append(block)
            if parts:
                block = np.concatenate(parts)
                to = np.where(block["often"], block["g"].astype(np.uint64), block["s"]) % np.uint64(buckets)
                order = np.argsort(to, kind="stable")
                block, to = block[order], to[order]
                cuts = np.searchsorted(to, np.arange(buckets + 1))
                out += [(b, 1, None, None, None, None, block[cuts[b]:cuts[b + 1]].tobytes())
                        for b in range(buckets) if cuts[b] < cuts[b + 1]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
            names = ["bucket", "kind", "doc_id", "a", "na", "b", "rows"]
            for i in range(0, len(out), 2000):
                yield pa.record_batch([pa.array(c, k) for c, k in
                                       zip(zip(*out[i:i + 2000], strict=True), kinds, strict=True)], names)

    return docs.select("doc_id", "text").mapInArrow(deal, BUCKET_SCHEMA)


ROW = np.dtype([("s", "<u8"), ("g", "<i8"), ("n", "<u4"), ("h", "<u4"), ("p", "<u4"), ("often", "?")])


def size_fits(na: np.ndarray, nb: np.ndarray, percent: int) -> np.ndarray:
    return 100 * np.minimum(na, nb) >= percent * np.maximum(na, nb)


def join_bucket(block: np.ndarray, percent: int):
    """Pairs of groups of fitting sizes for every shingle they share in the bucket, and the
    rows of shingles with too many groups to join here; both in slices."""
    order = np.lexsort((block["g"], block["s"]))
    block = block[order]
    first = np.ones(len(block), bool)
    first[1:] = (block["s"][1:] != block["s"][:-1]) | (block["g"][1:] != block["g"][:-1])
    block = block[first]
    new = np.ones(len(block), bool)
    new[1:] = block["s"][1:] != block["s"][:-1]
    start = np.flatnonzero(new)
    size = np.diff([*start, len(block)])
    wide = np.repeat((size > JOINED) | block["often"][start], size) if len(block) else np.zeros(0, bool)
    yield 2, block[wide], None
    for m in np.unique(size[(size > 1) & (size <= JOINED) & ~block["often"][start]]):
        at = start[(size == m) & ~block["often"][start]]
        i, j = np.triu_indices(m, 1)
        step = max(1, 100_000 // len(i))
        for k in range(0, len(at), step):
            a = block[(at[k:k + step, None] + i).ravel()]
            b = block[(at[k:k + step, None] + j).ravel()]
            fits = size_fits(a["n"].astype(np.int64), b["n"].astype(np.int64), percent)
            yield 1, a[fits], b[fits]


def joined(rows: DataFrame, percent: int) -> DataFrame:
    """Join every bucket; documents pass through."""
    schema = pa.schema([("kind", pa.int32()), ("doc_id", pa.int64()), ("s", pa.int64()), ("a", pa.int64()),
                        ("na", pa.int32()), ("b", pa.int64()), ("nb", pa.int32()), ("h", pa.int32())])

    def empty(n, kind):
        return pa.nulls(n, kind)

    def join(group: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = []
        for batch in group:
            docs = batch.filter(pc.equal(batch.column("kind"), 0))
            n = docs.num_rows
            if n:
                yield pa.record_batch([docs.column("kind"), docs.column("doc_id"), empty(n, pa.int64()), docs.column("a"),
                                       docs.column("na"), docs.column("b"), empty(n, pa.int32()), empty(n, pa.int32())],
                                      schema=schema)
            blocks += [np.frombuffer(r, ROW) for r in batch.column("rows").to_pylist() if r is not None]
        if blocks:
            for kind, a, b in join_bucket(np.concatenate(blocks), percent):
                n = len(a)
                if not n:
                    continue
                kinds = pa.array(np.full(n, kind, np.int32))
                if kind == 2:
                    yield pa.record_batch([kinds, empty(n, pa.int64()), pa.array(a["s"].astype(np.int64)),
                                           pa.array(a["g"]), pa.array(a["n"].astype(np.int32)),
                                           empty(n, pa.int64()), pa.array((~a["often"]).astype(np.int32)),
                                           pa.array(a["p"].astype(np.int32))], schema=schema)
                    continue
                low = a["g"] < b["g"]
                pairs = np.empty((n, 5), np.int64)
                pairs[:, 0], pairs[:, 1] = np.where(low, a["g"], b["g"]), np.where(low, a["n"], b["n"])
                pairs[:, 2], pairs[:, 3] = np.where(low, b["g"], a["g"]), np.where(low, b["n"], a["n"])
                pairs[:, 4] = np.minimum(a["h"], b["h"])
                pairs, shared = np.unique(pairs, axis=0, return_counts=True)
                n = len(pairs)
                yield pa.record_batch([pa.array(np.full(n, 1, np.int32)), empty(n, pa.int64()), pa.array(shared),
                                       pa.array(pairs[:, 0]), pa.array(pairs[:, 1].astype(np.int32)),
                                       pa.array(pairs[:, 2]), pa.array(pairs[:, 3].astype(np.int32)),
                                       pa.array(pairs[:, 4].astype(np.int32))], schema=schema)

    return rows.groupBy("bucket").applyInArrow(join, JOIN_SCHEMA)


def candidate_pairs(found: DataFrame, percent: int) -> DataFrame:
    """Pairs of groups whose matches allow the overlap that their sizes ask for.  Frequent
    shingles of both prefixes count as matches, those that only turned out to be so in
    their bucket too."""
    def beyond(n):
        return f"({n} - ({n} - (({percent} * {n} + 99) div 100) + 1))"

    need = f"((na + nb) * {percent} + {99 + percent}) div {100 + percent}"
    wide = written(found.where("kind = 2 and nb = 1").select("s", "a").distinct()
                   .groupBy("a").agg(F.count("*").alias("_w")), "wide")
    wide = hinted(wide)
    return (found.where("kind = 1").groupBy("a", "na", "b", "nb", "h").agg(F.sum("s").alias("shared"))
            .join(wide.toDF("a", "_wa"), "a", "left").join(wide.toDF("b", "_wb"), "b", "left")
            .where(f"shared + h + least(coalesce(_wa, 0), coalesce(_wb, 0)) + "
                   f"greatest({beyond('na')}, {beyond('nb')}) >= {need}").select("a", "b"))


def hinted(df: DataFrame) -> DataFrame:
    """A written table of few numbers a row: broadcast when it has few rows, else joined as
    the planner sees fit."""
    return F.broadcast(df) if df.count() <= SMALL else df


class SetTable:
    """Whole shingle sets of the texts that take part in any candidate pair."""

    def __init__(self, docs: DataFrame, wanted: DataFrame, sent: int = SENT):
        """``wanted``: one (doc_id, text hash, a) for every set that is needed; ``sent``: bytes of
        sets that may be on their way to pairs at once."""
        def sets(batches):
            for batch in batches:
                for part in pieces(batch, TEXT_BYTES):
                    found = [distinct(h) for h in shingles(part.column(0).to_pylist())]
                    yield pa.record_batch([pa.array([number(s.tobytes()) for s in found], pa.int64()),
                                           pa.array([s.tobytes() for s in found], pa.binary()),
                                           pa.array([int(np.searchsorted(s, QUARTER)) for s in found], pa.int32()),
                                           pa.array([len(s) for s in found], pa.int32())],
                                          ["a", "members", "head", "n"])

        few = hinted(wanted)
        held = (docs.join(few, docs["doc_id"].eqNullSafe(few["rep"]), "left_semi").select("text")
                .mapInArrow(sets, "a bigint, members binary, head int, n int"))
        self.sets = written(held.join(hinted(wanted.select("a")), "a", "left_semi"), "sets")
        if self.sets.groupBy("a").count().where("count > 1").take(1):  # repeated ids
            self.sets = written(self.sets.dropDuplicates(["a"]), "sets")
        self.sizes, self.sent = hinted(self.sets.select("a", "head", "n")), sent

    def joined(self, pairs: DataFrame, what, *kept: str, others: DataFrame | None = None) -> DataFrame:
        """(a, b, left, right, kept) with the parts ``what`` of both sets of written pairs, the second
        one of ``others`` if given.  A set that is the ``b`` of many pairs is met in parts of about ``MET`` pairs, none of them
        larger than a task can sort in little memory."""
        ends = hinted(written(pairs.groupBy("b").agg(F.ceil(F.count("*") / MET).cast("int").alias("parts")), "ends"))
        dealt = written(pairs.join(ends, "b").select("a", "b", *kept, F.expr("cast(pmod(xxhash64(a, b), parts) as int)").alias("part")),
                        "dealt")
        left = self.sets.join(hinted(dealt), "a").select("a", "b", *kept, "part", what.alias("left"))
        right = ((self.sets if others is None else others).join(ends.withColumnRenamed("b", "a"), "a")
                 .select(F.col("a").alias("b"), F.explode(F.expr("sequence(0, parts - 1)")).alias("part"), what.alias("right")))
        return left.join(right, ["b", "part"]).select("a", "b", "left", "right", *kept)

    def portions(self, pairs: DataFrame, size: str) -> list[DataFrame]:
        """Written pairs in portions, for each of which sets of about ``sent`` bytes go out, so that
        disk does not grow with the pairs; ``size``: what counts of a set's numbers."""
        total = pairs.join(self.sizes, "a").agg(F.sum(size)).first()[0] or 0
        n = -(-8 * total // self.sent)
        return [pairs.where(f"pmod(xxhash64(a, b, 3), {n}) = {i}") for i in range(n)] if n > 1 else [pairs]

    def compared(self, pairs: DataFrame, what, size: str, compare, schema: str, name: str, *kept: str,
                 others: DataFrame | None = None) -> DataFrame:
        """Written pairs joined and compared, portion by portion; what was shuffled for one is deleted
        before the next."""
        return reduce(DataFrame.union, [
            written(self.joined(part, what, *kept, others=others).mapInArrow(compare, schema), name)
            for part in self.portions(pairs, size)])

    def plausible(self, pairs: DataFrame, percent: int) -> DataFrame:
        """Written pairs without those that a quarter of the hash space already rules out:
        their matches there and all that lies beyond cannot make up the overlap needed."""
        quarter = F.struct(F.expr("substring(members, 1, 8 * head)").alias("m"),
                           F.expr("length(members) div 8 - head").alias("rest"))

        def check(batches):
            for batch in batches:
                left, right = (batch.column(i).to_pylist() for i in (2, 3))
                ok = []
                for x, y in zip(left, right, strict=True):
                    p, q = np.frombuffer(x["m"], np.uint64), np.frombuffer(y["m"], np.uint64)
                    most = len(np.intersect1d(p, q, assume_unique=True)) + min(x["rest"], y["rest"])
                    total = len(p) + x["rest"] + len(q) + y["rest"]
                    ok.append(100 * most >= percent * (total - most))
                yield pa.record_batch([c.filter(pa.array(ok, pa.bool_())) for c in batch.columns[:2]], ["a", "b"])

        return self.compared(pairs, quarter, "head", check, "a bigint, b bigint", "plausible")

    def verify(self, pairs: DataFrame, percent: int) -> DataFrame:
        """(a, b, linked) of written candidate pairs (a, b)."""
        def check(batches):
            for batch in (part for whole in batches for part in pieces(whole)):
                left, right = (batch.column(i).to_pylist() for i in (2, 3))
                ok = []
                for x, y in zip(left, right, strict=True):
                    x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    ok.append(100 * both >= percent * (len(x) + len(y) - both))
                yield pa.record_batch([*batch.columns[:2], pa.array(ok, pa.bool_())], ["a", "b", "linked"])

        return self.compared(pairs, F.col("members"), "n", check, "a bigint, b bigint, linked boolean", "verified")

    def middles(self, members: DataFrame) -> DataFrame:
        """(a, members): for every neighbourhood ``p`` of written members ``a``, under the name of
        ``p``, the shingles that most of about ``ASKED`` of its members hold.  Which members are
        asked decides how much work there is, never the result."""
        def majority(rows: pa.Table) -> pa.Table:
            held = [np.frombuffer(x, np.uint64) for x in rows.column("members").to_pylist()]
            seen, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.table([rows.column("p").slice(0, 1), pa.array([seen[2 * n > len(held)].tobytes()], pa.binary())], ["a", "members"])

        one_in = members.groupBy("p").agg(F.expr(f"ceil(count(*) / {ASKED})").alias("_n"), F.max("a").alias("_top"))
        asked = (members.join(hinted(written(one_in, "asked")), "p")
                 .where("a = _top or pmod(xxhash64(a, 2), _n) = 0").select("p", "a").distinct())
        return written(self.sets.join(hinted(written(asked, "asked")), "a").select("p", "members")
                       .groupBy("p").applyInArrow(majority, "a bigint, members binary"), "middles")

    def differences(self, members: DataFrame, middles: DataFrame, frequent: np.ndarray, percent: int) -> DataFrame:
        """(a, b, n, d, own, beside, from, apart) of written members ``a`` of neighbourhoods ``b``, in
        which they have their first place ``i``: a set of ``n`` shingles that differs in ``d`` from
        the middle, and these differences, the ``own`` ones in its order before those that it
        lacks.  None is before place ``i``, as two sets of a neighbourhood share nothing before it
        that is not paired elsewhere; ``from`` counts those left out.  ``beside`` bounds how many
        more a set may hold from there that another does not, if they link."""
        def compare(batches):
            for batch in (part for whole in batches for part in pieces(whole)):
                rows, found = [], []
                for x, y, i in zip(*(batch.column(k).to_pylist() for k in (2, 3, 4)), strict=True):
                    x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                    n, order = len(x), x
                    if len(frequent):
                        common = frequent[np.minimum(np.searchsorted(frequent, x), len(frequent) - 1)] == x
                        order = np.concatenate([x[~common], x[common]])
                    new = ~np.isin(order, y, assume_unique=True)
                    own, lost = order[i:][new[i:]], np.setdiff1d(y, x, assume_unique=True)
                    d = int(new.sum()) + len(lost)
                    found.append(np.concatenate([own, lost]).view(np.int64))
                    rows.append((n, d, len(own), prefix_size(n, percent) - i, d - len(own) - len(lost)))
                ends = np.cumsum([0, *map(len, found)])
                yield pa.record_batch([*batch.columns[:2], *(pa.array(c, pa.int32()) for c in zip(*rows, strict=True)),
                                       pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(found)))],
                                      ["a", "b", "n", "d", "own", "beside", "from", "apart"])

        return self.compared(members, F.col("members"), "n", compare, "a bigint, b bigint, n int, d int, own int, beside int, "
                             "from int, apart array<bigint>", "differences", "i", others=middles)


def ordered(pairs: DataFrame) -> DataFrame:
    """Distinct pairs (a, b) with a < b."""
    return (pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
            .where("a < b").distinct())


@in_small_batches
def jaccard_components(docs: DataFrame, percent: int = PERCENT, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs`` (doc_id, text)."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    frequent = frequent_shingles(docs)
    # About one prefix row per 24 bytes of text (a shingle per word, a quarter of them).
    text = text_bytes(docs)
    buckets = int(16 + text // 24 // rows_per_bucket)
    found = written(joined(bucket_rows(docs, frequent, buckets, percent), percent), "jaccard")
    members = found.where("kind = 0").select("doc_id", "a", "na", F.col("b").alias("g"))
    sets = written(members.where("a is not null").groupBy("a", "na", "g")
                   .agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies")), "sets")
    # A group's leading set stands in for the group.
    leads = written(sets.groupBy("g").agg(F.min("a").alias("lead"), F.count("*").alias("sets")), "groups")
    lead = leads.select("g", "lead")
    pairs = candidate_pairs(found, percent)
    hot = written(found.where("kind = 2").select("s", F.col("a").alias("g"), "na", F.col("h").alias("i")).distinct()
                  .join(lead, "g").select("s", F.col("lead").alias("a"), "na", "i"), "frequent")

    def reachable(na, i, nb, j):
        """Sizes fit, and a first match at these places leaves room for the overlap needed."""
        return (f"100 * least({na}, {nb}) >= {percent} * greatest({na}, {nb}) and least({na} - {i}, {nb} - {j}) >= "
                f"(({na} + {nb}) * {percent} + {99 + percent}) div {100 + percent}")

    def led(p):
        return (p.join(lead.toDF("a", "_a"), "a").join(lead.toDF("b", "_b"), "b")
                .select(F.col("_a").alias("a"), F.col("_b").alias("b")))

    # One pivot for every frequent shingle, the set that holds most of them.  Shingles with the
    # same pivot are one neighbourhood: its members, each with its first place in it.
    width = hot.groupBy("a").agg(F.count("*").alias("_w"))
    pivots = (hot.join(width, "a").groupBy("s").agg(F.max(F.struct("_w", "a")).alias("m"))
              .select("s", F.col("m.a").alias("p")))
    hot = written(hot.join(pivots, "s").groupBy("p", "a", "na").agg(F.min("i").alias("i")), "neighbourhoods")

    def star(rank):
        """Pairs of the members of every neighbourhood with its first by ``rank``."""
        first = hot.groupBy("p").agg(F.max(F.struct(rank.alias("r"), "a", "na", "i")).alias("f"))
        return (hot.join(first, "p").where(reachable("na", "i", "f.na", "f.i")).select("a", F.col("f.a").alias("b")))

    in_group = (sets.join(leads.where("sets > 1"), "g").where("a <> lead").select("a", F.col("lead").alias("b")))
    todo = written(ordered(led(pairs).union(star(F.col("a") == F.col("p"))).union(star(F.xxhash64("a", F.lit(1))))
                           .union(in_group)), "pairs")
    parted = leads.where("sets > 1").join(sets, "g").select("lead", "a", "na")
    involved = written(todo.select("a").union(todo.select("b")).union(parted.select("a")).union(hot.select("a"))
                       .distinct().join(sets.select("a", "rep"), "a"), "involved")
    whole = SetTable(docs, involved, max(SENT, text // SENT_PART))
    links = done = None

    def labels():
        if links is None:
            return None
        return hinted(connected_components(links, "jaccard-components"))

    def apart(p, label):
        """Pairs not yet verified whose sides are in different components."""
        if done is not None:
            p = p.join(done.select("a", "b"), ["a", "b"], "left_anti")
        if label is not None:
            la, lb = label.toDF("a", "_la"), label.toDF("b", "_lb")
            p = (p.join(la, "a", "left").join(lb, "b", "left")
                 .where(F.coalesce("_la", "a") != F.coalesce("_lb", "b")).select("a", "b"))
        return p

    def run(p):
        nonlocal links, done
        checked = whole.verify(p, percent)
        done = checked if done is None else done.union(checked)
        links = done.where("linked").select("a", "b")

    label = None
    for _ in range(ROUNDS):
        left = written(apart(todo, label), "left")
        if left.isEmpty():
            break
        both = left.union(left.select("b", "a"))
        degree = both.groupBy("a").agg(F.count("*").alias("_d"))
        best = (both.join(degree.toDF("b", "_d"), "b").groupBy("a")
                .agg(F.max(F.struct("_d", "b")).alias("m")).select("a", F.col("m.b").alias("b")))
        run(written(ordered(best), "round"))
        label = labels()

    # What is left: pairs of leads, of the other members of their groups, and of frequent shingles.
    at = label if label is not None else sets.select("a", F.col("a").alias("label")).toDF("node", "label")

    def labelled(df):
        return (df.join(at.toDF("a", "_l"), "a", "left").withColumn("_l", F.coalesce("_l", "a")))

    def told_apart(placed):
        """Pairs of the sets of neighbourhoods that their differences from the middle leave.

        Sets of sizes n and m, d and e differences from the middle, link if they differ in
        ``(n + m) * less / more`` at most.  With ``w = more * d - less * n``, so do those whose w
        sum to 0 or less, and others if they share ``(w + w') / (2 * more)`` differences.  Of all
        pairs of the former kind, both sides link with the set of the smallest w.  Sets that do
        not are far.  Of two others that link without both linking with it, one is far: next to
        a far set, a set has the first difference that they share among ``short``; next to a near
        one, a far set has it in ``whole``.  By their sizes two that link share
        ``d - n * less / percent``.  Where a set has more of its own than it may hold beside the
        other, the first is one of these."""
        nonlocal links, done
        more, less = 100 + percent, 100 - percent
        apart = whole.differences(placed.select("a", F.col("p").alias("b"), "i"), whole.middles(placed), frequent, percent)
        weight = F.expr(f"{more} * d - {less} * n")
        nearest = hinted(written(apart.groupBy("b").agg(F.min(F.struct(weight.alias("w"), "a")).alias("m"))
                                 .select("b", F.expr("-m.w").alias("room"), F.col("m.a").alias("to")), "nearest"))
        apart = apart.join(nearest, "b").withColumn("w", weight).withColumn("far", F.expr("w > room"))
        near = apart.where("not far and a <> to").select(
            F.least("a", "to").alias("a"), F.greatest("a", "to").alias("b"), F.lit(True).alias("linked"))
        near = written(near.distinct(), "near")
        done = near if done is None else done.union(near)
        links = done.where("linked").select("a", "b")
        least = f"d - n * {less} div {percent}"
        apart = (apart.withColumn("short", F.expr(f"d - greatest((w + room) div {2 * more} + 1, {least}) + 1 - from"))
                 .withColumn("whole", F.expr(f"if(far, d - greatest((w - room + {2 * more - 1}) div {2 * more}, {least}) + 1 - from, short)"))
                 .withColumns({c: F.expr(f"if(own >= beside, least({c}, beside), {c})") for c in ("short", "whole")}))
        firsts = (apart.join(hinted(placed.select("a", F.col("p").alias("b"), "_l")), ["a", "b"])
                  .select("a", "b", "_l", "n", "d", "w", "far", "short", "from", F.posexplode(F.expr("slice(apart, 1, greatest(whole, 0))")).alias("i", "s"))
                  .select(F.xxhash64("b", "s").alias("s"), "a", "_l", "n", "d", "w", "far", F.expr("i < short").alias("short"),
                          F.expr("i + from").alias("i")))
        # All that are far meet those in whose short prefix a difference is.
        met = (firsts.groupBy("s").agg(F.count("*").alias("_n"), F.count_if("far").alias("_far"), F.count_if("short").alias("_short"))
               .where("_n > 1 and _far > 0 and _short > 0").select("s"))
        firsts = written(firsts.join(met, "s"), "firsts")
        return (firsts.where("far").alias("l").join(firsts.where("short").alias("r"), F.expr(
            f"l.s = r.s and l.a <> r.a and (l.short or not r.far) and l._l <> r._l "
            f"and 100 * least(l.n, r.n) >= {percent} * greatest(l.n, r.n) "
            f"and {2 * more} * least(l.d - l.i, r.d - r.i) >= l.w + r.w"))
            .select(F.col("l.a").alias("a"), F.col("r.a").alias("b")))

    rest = todo
    if not parted.isEmpty():
        # Sets of groups with several, and the pairs of their leads, widened to members.
        mine = sets.join(leads, "g").select(F.col("lead"), F.col("a").alias("x"))
        wide = (todo.join(mine.toDF("a", "_x"), "a").join(mine.toDF("b", "_y"), "b")
                .select(F.col("_x").alias("a"), F.col("_y").alias("b")))
        within = labelled(parted)
        inside = (within.alias("l").join(within.alias("r"), F.expr("l.lead = r.lead and l._l <> r._l"))
                  .select(F.col("l.a").alias("a"), F.col("r.a").alias("b")))
        rest = rest.union(wide).union(inside)
    if not hot.isEmpty():
        placed = hot
        if not parted.isEmpty():
            mine = sets.join(leads, "g").select(F.col("lead").alias("a"), F.col("a").alias("x"))
            placed = hot.join(mine, "a").select("p", F.col("x").alias("a"), "na", "i")
        placed = written(labelled(placed), "frequent-placed")
        # Of every neighbourhood, the sets outside its largest component against all others.
        largest = (placed.groupBy("p", "_l").count().groupBy("p")
                   .agg(F.max(F.struct("count", "_l")).alias("m")).select("p", F.col("m._l").alias("_top")))
        stray = written(placed.join(largest, "p").where("_l <> _top").select("p", "a", "na", "i", "_l"), "stray")
        many = hinted(written(stray.groupBy("p").count().where(F.col("count") > STRAY).select("p"), "many"))
        cross = (stray.join(many, "p", "left_anti").alias("l").join(placed.alias("r"), F.expr(
            f"l.p = r.p and l._l <> r._l and {reachable('l.na', 'l.i', 'r.na', 'r.i')}"))
            .select(F.col("l.a").alias("a"), F.col("r.a").alias("b")))
        rest = rest.union(cross)
        if not many.isEmpty():
            rest = rest.union(told_apart(written(placed.join(many, "p", "left_semi"), "many-placed")))
    last = whole.plausible(written(apart(ordered(rest), label), "last"), percent)
    if not last.isEmpty():
        run(last)
    label = labels()

    # Components to documents: only sets with links or copies differ from their own document.
    named = sets.select("a", "rep", "copies")
    if label is not None:
        named = named.join(label.toDF("a", "label"), "a", "left").withColumn("label", F.coalesce("label", "a"))
    else:
        named = named.withColumn("label", F.col("a"))
    smallest = named.groupBy("label").agg(F.min("rep").alias("component_id"), F.sum("copies").alias("_n"))
    ids = (named.join(smallest.where("_n > 1"), "label").select("a", "component_id"))
    return (members.join(ids, "a", "left")
            .select("doc_id", F.col("na").cast("bigint").alias("n_shingles"),
                    F.coalesce("component_id", "doc_id").alias("component_id")))


def op9_grouped_prefix_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document."""
    return jaccard_components(table(spark, sf_dir, "documents", "doc_id", "text"))


def one_per_component(docs: DataFrame) -> DataFrame:
    """One document of every component, the one with the smallest id, with its own columns.

    A document is a row's id and text together: another text under an id that goes stays or
    goes with its own component, of equal rows with words one stays, and a null id comes last.
    Rows without words are linked with nothing and stay as they are."""
    plain, back = aside(docs, "doc_id", "text")
    keyed = plain.withColumn("_k", F.xxhash64("doc_id", "text"))
    parts = written(jaccard_components(keyed.select(F.col("_k").alias("doc_id"), "text")), "components")
    each = (parts.where("n_shingles > 0").groupBy(F.col("doc_id").alias("_k"), F.col("component_id").alias("_c"))
            .agg(F.count("*").alias("_n")))
    ids = keyed.select("_k", "doc_id").distinct()
    told = written(each.join(ids, "_k").withColumn("_order", F.struct(F.isnull("doc_id").alias("null"), "doc_id", "_k")),
                   "told")
    # Components of one document, by far the most, have no part in what follows.
    first = told.groupBy("_c").agg(F.min("_order").alias("_first"))
    gone = written(told.join(first, "_c").where("_k <> _first._k").select("_k").distinct(), "gone")
    copied = written(told.where("_n > 1").select("_k").distinct().join(gone, "_k", "left_anti"), "copied")
    left = keyed.join(hinted(gone), "_k", "left_anti")
    if copied.isEmpty():
        return back(left)
    # Equal ids and texts may still differ in other columns: any one of the rows stands for all.
    whole = F.struct(*[F.col(c) for c in plain.columns])
    one = (left.join(hinted(copied), "_k", "left_semi").groupBy("_k").agg(F.min_by(whole, F.xxhash64(whole)).alias("_r"))
           .select("_r.*"))
    return back(left.join(hinted(copied), "_k", "left_anti").select(*plain.columns).unionByName(one))
