"""Best-fit packing after Martello-Toth dominance reduction.

Texts are tokenised into pieces of at most ``capacity`` tokens.  Only the number of pieces
of every length matters to the packing, so the plan is made on that histogram (at most
``capacity`` numbers) and every piece then finds its place by its rank among the pieces of
its length:

1. Reduction.  For a length, a small set of pieces that provably dominates every other set
   the length could share a sequence with is fixed for good: the length alone when nothing
   fits beside it; a pair that fills the sequence, or with the largest fitting partner when
   no two fit; a triple when no three fit and the best two beat every other pair.
2. Best-fit decreasing for what remains, many equal sequences at a time.

Ranks are counted per (length, hash bucket) and added up, so a length that holds a third of
all pieces is still dealt over many tasks.

Token ids are those of the ``tokenizers`` file; texts without its special tokens go through
the same vocabulary and merges in ``tiktoken``, which yields the same ids several times
faster.  Defined results: null or empty text is one piece with the end id alone; repeated
rows are packed like others; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

import json
import re
import zlib
from bisect import bisect_right
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripaudit.llm.tables import pieces, table, written

CAPACITY = 2048
END_ID = 0
ROWS_PER_BUCKET = 250_000
PIECE_SCHEMA = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
# Fixed value: the word pattern of byte-level BPE vocabularies of this family.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Runs of white space that a backtracking matcher should not be given.
LONG_BLANK = re.compile(r"\s{5000}")


def tokenizer_json(path: str | None = None) -> str:
    """The tokenizer file's text; it is shipped to the tasks, which need no such file."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    with open(path, encoding="utf-8") as f:
        return f.read()


class Encoder:
    """Token ids of a byte-level BPE tokenizer file."""

    def __init__(self, source: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_str(source)
        spec = json.loads(source)
        special = [t["content"] for t in spec.get("added_tokens", [])]
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        vocab = spec["model"]["vocab"]
        # Byte-level vocabularies write bytes that do not print as code points from 256 on.
        shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
        hidden = [b for b in range(256) if b not in set(shown)]
        byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
        ranks = {bytes(byte[c] for c in t): i for t, i in vocab.items() if t not in special}
        self.fast = tiktoken.Encoding("corpus", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> list[int]:
        if self.special and self.special.search(text) or LONG_BLANK.search(text):
            return self.exact.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens: full ones, but for a shorter first."""
    first = n % capacity or capacity
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


def token_pieces(docs: DataFrame, source: str, capacity: int = CAPACITY, text: str = "text") -> DataFrame:
    """Rows (doc_id, piece, start, length, ids_crc32) of all documents."""
    def encode(batches):
        encoder = Encoder(source)
        for batch in batches:
            for part in pieces(batch):
                out = []
                for doc_id, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    ids = np.array([*encoder.ids(t or ""), END_ID], dtype="<u4")
                    for i, (start, n) in enumerate(cut(len(ids), capacity)):
                        out.append((doc_id, i, start, n, zlib.crc32(ids[start:start + n].tobytes())))
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

    return docs.select("doc_id", text).mapInArrow(encode, PIECE_SCHEMA)


class Stock:
    """How many pieces of every length are left, with the lengths in order."""

    def __init__(self, counts: dict[int, int]):
        self.left = {s: n for s, n in counts.items() if n > 0}
        self.sizes = sorted(self.left)

    def take(self, size: int, n: int) -> None:
        self.left[size] -= n
        if not self.left[size]:
            del self.left[size]
            self.sizes.remove(size)

    def largest(self, limit: int, without: tuple[int, ...] = ()) -> int | None:
        """Largest length up to ``limit`` with a piece beyond those in ``without``."""
        i = bisect_right(self.sizes, limit) - 1
        while i >= 0 and self.left[self.sizes[i]] <= without.count(self.sizes[i]):
            i -= 1
        return self.sizes[i] if i >= 0 else None

    def smallest(self, k: int, without: int) -> list[int]:
        """The k smallest pieces beside one of length ``without``."""
        out: list[int] = []
        for s in self.sizes:
            out += [s] * min(k - len(out), self.left[s] - (s == without))
            if len(out) == k:
                break
        return out


def dominating_set(stock: Stock, j: int, capacity: int) -> tuple[int, ...] | None:
    """A set with one piece of length j that dominates all others with it, if one is known."""
    room = capacity - j
    if (best := stock.largest(room, (j,))) is None:
        return (j,)
    if best == room:
        return j, best
    low = stock.smallest(3, j)
    if len(low) < 2 or low[0] + low[1] > room:
        return j, best
    if len(low) < 3 or sum(low) > room:
        second = stock.largest(room - best, (j, best))
        # In any other pair the smaller one is at most half the room.
        rival = stock.largest(room // 2, (j,))
        if second is not None and rival is not None and rival <= second:
            return j, best, second
    return None


def reduce_stock(stock: Stock, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Take dominating sets out of ``stock`` until none is found; (set, number) pairs."""
    out = []
    changed = True
    while changed:
        changed = False
        for j in sorted(stock.left, reverse=True):
            while j in stock.left and (found := dominating_set(stock, j, capacity)):
                need = Counter(found)
                n = min(stock.left[s] // k for s, k in need.items())
                if len(found) == 3 and len(need) > 1:
                    n = 1 if n < 4 else n // 2  # the second best is looked up anew as stock runs down
                for s, k in need.items():
                    stock.take(s, n * k)
                out.append((found, n))
                changed = True
    return out


def best_fit(stock: Stock, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing on what is left; (lengths in a sequence, number) pairs."""
    open_bins: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)
    rooms: list[int] = []

    def put(room, pattern, n):
        if room not in open_bins:
            rooms.insert(bisect_right(rooms, room), room)
        open_bins[room].append((pattern, n))

    for size in sorted(stock.left, reverse=True):
        todo = stock.left[size]
        while todo:
            i = bisect_right(rooms, size - 1)
            if i < len(rooms):
                room = rooms[i]
                pattern, n = open_bins[room].pop()
                if not open_bins[room]:
                    del open_bins[room]
                    rooms.pop(i)
            else:
                room, pattern, n = capacity, (), todo
            each = room // size
            if full := min(n, todo // each):
                put(room - each * size, pattern + (size,) * each, full)
                todo, n = todo - full * each, n - full
            if todo and n:  # fewer than fill one sequence
                put(room - todo * size, pattern + (size,) * todo, 1)
                todo, n = 0, n - 1
            if pattern and n:
                put(room, pattern, n)
    return [x for group in open_bins.values() for x in group]


def packing_plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Where the pieces of every length go: (length, from_rank, to_rank, first_sequence,
    pieces_each, offset); ``to_rank`` is exclusive."""
    stock = Stock(counts)
    patterns = reduce_stock(stock, capacity) + best_fit(stock, capacity)
    used: dict[int, int] = defaultdict(int)
    rows, sequence = [], 0
    for pattern, n in patterns:
        offset = 0
        for size, each in sorted(Counter(pattern).items(), reverse=True):
            rows.append((size, used[size], used[size] + n * each, sequence, each, offset))
            used[size] += n * each
            offset += size * each
        sequence += n
    return rows


def pack(placed: DataFrame, capacity: int = CAPACITY, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to a written table of pieces with a unique ``_row``."""
    spark = placed.sparkSession
    n = placed.count()
    buckets = max(16, 1 + n // rows_per_bucket)
    rows = placed.withColumn("_bucket", F.pmod(F.xxhash64("_row"), F.lit(buckets)))
    counts = rows.groupBy("length", "_bucket").agg(F.count("*").alias("_n"))
    # At most ``capacity`` lengths: a small table.
    by_length = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    plan = F.broadcast(spark.createDataFrame(
        packing_plan(by_length, capacity),
        "length bigint, _from bigint, _to bigint, _first bigint, _each bigint, _offset bigint"))
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("length", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("length", "_bucket").orderBy("_row")
    ranked = (rows.withColumn("_in", F.row_number().over(inside) - 1)
              .join(starts, ["length", "_bucket"])
              .withColumn("_rank", F.col("_start") + F.col("_in")))
    return (ranked.join(plan, "length").where("_rank >= _from and _rank < _to")
            .withColumn("sequence_id", F.expr("_first + (_rank - _from) div _each"))
            .withColumn("offset", F.expr("_offset + (_rank - _from) % _each * length"))
            .drop("_bucket", "_in", "_start", "_rank", "_from", "_to", "_first", "_each", "_offset", "_row"))


def pack_documents(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Tokenise and pack whole documents."""
    cut_up = token_pieces(docs, tokenizer_json(tokenizer), capacity)
    return pack(written(cut_up.withColumn("_row", F.monotonically_increasing_id()), "pieces"), capacity)


def op8_dominance_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 tokens."""
    out = pack_documents(table(spark, sf_dir, "documents", "doc_id", "text"))
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
