"""Token counts of whole texts; huge ones by overlapping chunks that are spliced.

A text of up to ``chunk`` characters is encoded as it is.  A longer one is encoded in chunks
that overlap.  Two neighbours are spliced at a common boundary inside their overlap: a place
that is proven stable and at which both encodings, compared by offsets, begin the same token.
Where they have none, the overlap is doubled, at first towards the left chunk's start and then
by lengthening that chunk, at the longest until the text's end, so every text is counted whole
and a chunk is no longer than an unbroken run needs.

A place is stable when no rule of the tokenizer looks across it, whatever stands around:

* next to a blank, tab or line end: the pattern that cuts out words never matches white space,
  a special token holds none, and it neither composes nor reorders with its neighbours;
* from a letter to another kind of character, from any but the apostrophe to a letter, and on
  both sides of a number, as the pattern's words are runs of letters, single numbers and runs
  of the rest, and only a contraction mixes two of them.  Both characters must keep their kind
  under lower-casing and composition, the second must not combine with the first, and the
  place must not lie inside the string of a special token.

By the same proof the tokens of a chunk are the sum of those of the words between its blanks,
and a word met before need not be encoded again; offsets are only needed inside overlaps.

Defined results: null or empty text has no bytes and no tokens; repeated rows are counted like
others; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import os
import re
import unicodedata

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripaudit.llm.tables import pieces, table

CHUNK = 16_384
OVERLAP = 256
LIMIT = 2048
#: Words whose counts a task remembers, and the longest such word.
REMEMBERED, LONGEST = 400_000, 64
# Fixed value: white space that Unicode and every regular expression library agree on.
BLANKS = " \t\n\r"
_BLANK = re.compile(f"[{BLANKS}]+")
_LAST_BLANK = re.compile(f"(?s:.*)[{BLANKS}]")
#: Punctuation that is split off a word before it is looked up.
CLOSING = ".,;:!?"


def tokenizer_source(path: str | None = None) -> str:
    """The tokenizer file's text; it is shipped to the tasks, which need no such file."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    with open(path, encoding="utf-8") as f:
        return f.read()


def kind(c: str) -> str | None:
    """L, N or O for a character that lower-casing and composition leave in its kind."""
    low = c.lower()
    if len(low) != 1 or unicodedata.combining(c) or unicodedata.normalize("NFC", c) != c:
        return None
    major = unicodedata.category(c)[0]
    if major in "LN":
        return major if unicodedata.category(low)[0] == major else None
    # Marks combine; separators, controls and unassigned ones are kinds on which tables differ.
    return "O" if major in "PS" else None


def joins_left(c: str) -> bool:
    """Whether a character can combine with the one before it."""
    return unicodedata.category(c)[0] == "M" or "ᅠ" <= c <= "ᇿ" or unicodedata.combining(c) != 0


class Counter:
    """Numbers of tokens under one tokenizer file."""

    def __init__(self, source: str, chunk: int = CHUNK, overlap: int = OVERLAP):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task for every core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(source)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # Blanks prove nothing about a tokenizer that keeps them or has tokens with them.
        if any(_BLANK.search(s) for s in self.special):
            raise ValueError("a special token holds white space")
        self.chunk, self.overlap = chunk, max(1, min(overlap, chunk // 2))
        self.known: dict[str, int] = {}

    def tokens(self, text: str) -> list[tuple[int, int, int]]:
        """(id, start, end) of every token."""
        encoded = self.tokenizer.encode(text, add_special_tokens=False)
        return [(i, *span) for i, span in zip(encoded.ids, encoded.offsets, strict=True)]

    def stable(self, text: str, p: int) -> bool:
        """Whether no rule of the tokenizer looks across the place before text[p]."""
        if not 0 < p < len(text):
            return True
        a, b = text[p - 1], text[p]
        if a in BLANKS or b in BLANKS:
            return True
        left, right = kind(a), kind(b)
        if left is None or right is None or joins_left(b):
            return False
        if not (left == "N" or right == "N" or left == "L" and right == "O" or left == "O" != right and a != "'"):
            return False
        return not any(s in text[max(0, p - len(s) + 1):p + len(s) - 1] for s in self.special)

    def edge(self, text: str, start: int, end: int) -> dict[int, tuple[int, int]]:
        """The encoding of text[start:end]: place of a token -> (id, end).  Of tokens that
        begin inside one character the first counts."""
        out: dict[int, tuple[int, int]] = {}
        for i, s, e in self.tokens(text[start:end]):
            out.setdefault(s + start, (i, e + start))
        return out

    def common(self, text: str, at: int, end: int, start: int, stop: int) -> int | None:
        """Last place in the overlap [start, end) of the chunks [at, end) and [start, stop)
        that is stable and at which both begin the same token."""
        # A chunk's tokens between two blanks are those of that stretch alone.
        left = self.edge(text, max(at, before.end() if (before := _LAST_BLANK.match(text, at, start)) else at), end)
        after = _BLANK.search(text, end, stop)
        right = self.edge(text, start, after.start() if after else stop)
        for place in sorted(left, reverse=True):
            if place <= start:
                return None
            # The left chunk's end may have cut its last token.
            if left[place][1] < end and right.get(place) == left[place] and self.stable(text, place):
                return place
        return None

    def spliced(self, text: str) -> int:
        """Tokens of a huge text by overlapping chunks."""
        total = 0
        at, end = 0, min(self.chunk, len(text))
        while end < len(text):
            overlap, place = self.overlap, None
            while place is None and end < len(text):
                start = end - overlap
                if start <= at:  # as wide as the chunk: lengthen the chunk instead
                    end = min(len(text), end + max(end - at, self.chunk))
                    overlap = self.overlap
                    continue
                stop = min(len(text), end + self.chunk)
                place = self.common(text, at, end, start, stop)
                overlap *= 2
            if place is not None:
                total += self.whole([text[at:place]])[0]
                at, end = place, stop
        return total + self.whole([text[at:]])[0]

    def parts(self, word: str) -> tuple[str, ...]:
        """A word without blanks, cut at the stable place before closing punctuation."""
        stem = word.rstrip(CLOSING)
        if stem == word or not stem or kind(stem[-1]) != "L" or any(s in word for s in self.special):
            return (word,)
        return stem, word[len(stem):]

    def whole(self, texts: list[str]) -> list[int]:
        """Tokens of texts: the sums of those of their words."""
        if len(self.known) > REMEMBERED:
            self.known.clear()
        known = self.known
        words = [_BLANK.split(t) for t in texts]
        cut = {w: self.parts(w) for w in {w for ws in words for w in ws if w not in known}}
        new = list({p for ps in cut.values() for p in ps if p not in known})
        found = dict(zip(new, map(len, self.tokenizer.encode_batch_fast(new, add_special_tokens=False)), strict=True))
        known.update((p, n) for p, n in found.items() if len(p) <= LONGEST)
        found.update((w, sum(found[p] if p in found else known[p] for p in ps)) for w, ps in cut.items())
        known.update((w, n) for w, n in found.items() if len(w) <= LONGEST)
        return [sum([known[w] if w in known else found[w] for w in ws]) for ws in words]

    def counts(self, texts: list[str | None]) -> list[int]:
        short = [t or "" for t in texts if len(t or "") <= self.chunk]
        rest = iter(self.whole(short))
        return [next(rest) if len(t or "") <= self.chunk else self.spliced(t) for t in texts]


def token_counts(docs: DataFrame, tokenizer: str | None = None, limit: int = LIMIT, chunk: int = CHUNK,
                 overlap: int = OVERLAP, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every document."""
    source = tokenizer_source(tokenizer)

    def count(batches):
        counter = Counter(source, chunk, overlap)
        for batch in batches:
            for part in pieces(batch):
                n = counter.counts(part.column(2).to_pylist())
                yield pa.record_batch([part.column(0), part.column(1), pa.array(n, pa.int64())],
                                      ["doc_id", "n_bytes", "n_tokens"])

    kind = docs.schema[doc_id].dataType.simpleString()
    sized = docs.select(F.col(doc_id).alias("doc_id"),
                        F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint").alias("n_bytes"), F.col(text))
    return (sized.mapInArrow(count, f"doc_id {kind}, n_bytes bigint, n_tokens bigint")
            .withColumn("over_limit", F.col("n_tokens") > limit))


def op12_resync_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of all documents as the library counts them."""
    return token_counts(table(spark, sf_dir, "documents", "doc_id", "text"))
