"""Quality rules and n-gram perplexity bands.

A modified Kneser-Ney model over the letters of words, one per language, is counted by
Spark over all texts and scores every text; texts whose perplexity lies outside the band of
their language are rejected, as are those that fail the plain rules.

* Symbols: the letters themselves, as 16-bit units of UTF-16, with the blank, which no word
  holds, as word end; A-Z count as a-z, as the start of a sentence says nothing.  No other
  characters are taken for one another, in whatever script, and an n-gram of order 4 is a
  64-bit number.  A model has all n-grams that occur, without a limit.  (The helpers can also
  fold letters into 64 classes, for models of a fixed size; no query does.)
* Counting: tasks fold their words, then their n-grams, before the shuffle.
* Model: three discounts per order from the counts of counts, continuation counts below
  the highest order.  What occurs once at orders 3 and 4 gives its whole count to the order
  below, so that an odd text does not vouch for itself and need not be held: it costs what an
  unseen one does.  Every order is a sorted array of n-gram numbers with their log
  probabilities and one of their histories with its backoff, found by binary search.
* Scoring: a word's cost depends on the word alone, so distinct words are scored once and
  kept in a cache of bounded size.
* Segments: a text is scored in segments of ``SEGMENT`` words.  In one that does not fit the
  text's language, the pieces of ``PIECE`` words that fit another language, and better, are
  foreign; as long as a quarter of the text is not, its perplexity is that of the rest.
* Bands: median of log perplexity plus or minus ``width`` times the interquartile range and
  what the length of the text adds to it, both measured per language over all texts that
  have ``MIN_WORDS`` words (over all texts where none has).  There is no fixed least width.

Defined results: null text has no words; a text without words has no perplexity and fails
the rule on few words; null ``lang`` is a language of its own; repeated rows count as often
as they occur; extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripaudit.llm.tables import pieces, table, written

ORDER = 4
#: Classes of letters, and bits of one; bits of a letter as it is.
SYMBOLS = 64
BITS = 6
EXACT = 16
#: Distinct words held by a task before they are folded into n-grams, or whose costs it keeps.
CACHE = 200_000
MIN_WORDS = 50
SYMBOL_CHARS = "#*$%&|<>"
BLANKS = " \t\n\r\x0b\x0c"
SEGMENT, PIECE = 25, 5
#: A text that is foreign but for less than one part in so many is not one of its language.
LEAST_OWN = 4
#: Standard errors by which a segment may be costlier than its language and still fit it.
FIT = 3.0
WIDTH = 4.0
FEATURES = ("doc_id bigint, lang string, n_words bigint, word_chars bigint, n_symbols bigint, "
            "n_dup_lines bigint, n_repeat_words bigint, log_ppl double")

_ASCII = np.array([c - 21 if 48 <= c <= 57 else c - 96 if 97 <= c <= 122 else c - 64 if 65 <= c <= 90 else 37 + c % 8
                   for c in range(128)], dtype=np.uint32)


def words(text: str | None) -> list[bytes]:
    """Runs of characters other than blanks (ASCII 9 to 13 and 32)."""
    return text.encode().split() if text else []


def symbols(points: np.ndarray) -> np.ndarray:
    """Classes of code points: word end, a-z, 10 digits, 8 of other ASCII, 19 of the rest."""
    return np.where(points < 128, _ASCII[np.minimum(points, 127)], 45 + points % 19).astype(np.uint32)


def letters(texts: list[str], bits: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Symbols of all words, one after the other, each word's number of them, and the symbol
    of a word's end: UTF-16 units, or classes of code points."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    whole = "".join(texts)
    if bits != EXACT:
        return symbols(np.frombuffer(whole.encode("utf-32-le"), np.uint32)), lengths, 0
    units = np.frombuffer(whole.encode("utf-16-le"), np.uint16)
    if len(units) > len(whole):  # characters of two units
        lengths = np.fromiter((len(t.encode("utf-16-le")) // 2 for t in texts), np.int64, len(texts))
    return units, lengths, ord(" ")


def word_grams(distinct: list[bytes], bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """n-gram numbers of all words, one after the other, and each word's number of them.
    A word is framed by ORDER - 1 word ends before and one after."""
    texts = [(w.lower() if bits == EXACT else w).decode() for w in distinct]  # bytes: A-Z only
    units, lengths, end = letters(texts, bits)
    pad = ORDER - 1
    framed = np.full(int(lengths.sum()) + (pad + 1) * len(texts), end, np.uint64)
    starts = np.cumsum(lengths + pad + 1) - (lengths + pad + 1)
    at = np.arange(len(units)) + np.repeat((np.arange(len(texts)) + 1) * pad + np.arange(len(texts)), lengths)
    framed[at] = units
    grams = np.zeros(max(len(framed) - pad, 0), np.uint64)
    for k in range(ORDER):
        grams |= framed[k:len(framed) - pad + k] << np.uint64(bits * (pad - k))
    n = lengths + 1
    keep = np.repeat(starts - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    return grams[keep], n


def gram_counts(docs: DataFrame, bits: int = BITS) -> DataFrame:
    """(lang, gram, n) over all words of all texts; numbers beyond 63 bits are negative."""
    schema = pa.schema([("lang", pa.string()), ("gram", pa.int64()), ("n", pa.int64())])

    def fold(lang, counted):
        grams, n = word_grams(list(counted), bits)
        weight = np.repeat(np.fromiter(counted.values(), np.int64, len(counted)), n)
        distinct, at = np.unique(grams, return_inverse=True)
        return pa.record_batch([pa.array([lang] * len(distinct), pa.string()), pa.array(distinct.view(np.int64)),
                                pa.array(np.bincount(at, weight).astype(np.int64))], schema=schema)

    def count(batches):
        seen: dict[str | None, Counter] = {}
        for batch in batches:
            for part in pieces(batch):
                for lang, text in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    seen.setdefault(lang, Counter()).update(words(text))
                if sum(map(len, seen.values())) > CACHE:
                    yield from (fold(k, c) for k, c in seen.items() if c)
                    seen = {}
        yield from (fold(k, c) for k, c in seen.items() if c)

    return (docs.select("lang", "text").mapInArrow(count, "lang string, gram bigint, n bigint")
            .groupBy("lang", "gram").agg(F.sum("n").alias("n")))


def discounts(counts: np.ndarray) -> np.ndarray:
    """Discount by count (0, 1, 2, 3 or more) from the counts of counts."""
    n1, n2, n3, n4 = (float((counts == k).sum()) for k in (1, 2, 3, 4))
    if not (n1 and n2 and n3):
        return np.array([0.0, 0.5, 0.75, 0.9])
    y = n1 / (n1 + 2 * n2)
    raw = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    return np.array([0.0, *(min(max(d, 0.05), k) for k, d in enumerate(raw, 1))])


def found(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in sorted ``keys`` and whether they hold what is wanted."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


class Model:
    """Interpolated modified Kneser-Ney model of one language."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray, bits: int = BITS):
        self.bits = bits
        order = np.argsort(grams := grams.astype(np.uint64))
        seen, n = grams[order], counts[order]
        # Continuation counts: distinct symbols seen before an n-gram of the order below.
        counted = [(seen, n)]
        for k in range(ORDER - 1, 0, -1):
            counted.append(np.unique(seen & self.mask(k), return_counts=True))
            seen = counted[-1][0]
        self.levels, below, p = [], None, None
        for k, (seen, n) in enumerate(reversed(counted), 1):  # p over (history, symbol)
            d = discounts(n)
            if k >= 3:
                d[1] = 1.0
            history = seen >> np.uint64(bits)
            start = np.flatnonzero(np.concatenate([[True], history[1:] != history[:-1]]))
            size = np.diff(np.append(start, len(seen)))
            off, total = d[np.minimum(n, 3)], np.add.reduceat(n, start)
            rest = np.add.reduceat(off, start) / total
            lower = 1 / (1 << bits) if k == 1 else p[np.searchsorted(below, seen & self.mask(k - 1))]
            below, p = seen, (n - off) / np.repeat(total, size) + np.repeat(rest, size) * lower
            held = n > 1 if k >= 3 else np.ones(len(n), bool)
            self.levels.append((seen[held], -np.log(p[held]).astype(np.float32), history[start],
                                -np.log(np.maximum(rest, 1e-9)).astype(np.float32)))
        # Cost of a symbol over the counted texts: mean and standard deviation.
        own = -np.log(p)
        self.mean = float(np.average(own, weights=counts[order]))
        self.spread = float(np.sqrt(np.average((own - self.mean) ** 2, weights=counts[order])))

    @property
    def grams(self) -> np.ndarray:
        return self.levels[-1][0]

    def mask(self, k: int) -> np.uint64:
        return np.uint64((1 << self.bits * k) - 1)

    def fits(self, cost: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Whether segments of ``n`` symbols and total ``cost`` may be of this language."""
        return cost / n <= self.mean + FIT * self.spread / np.sqrt(n)

    def costs(self, grams: np.ndarray) -> np.ndarray:
        """Negative log probability of the last symbol of every n-gram: that of the highest
        order that holds it, and what backing off to it costs."""
        grams = grams.astype(np.uint64)
        out, left = np.zeros(len(grams)), np.arange(len(grams))
        for k in range(ORDER, 0, -1):
            keys, cost, histories, backoff = self.levels[k - 1]
            wanted = grams[left] & self.mask(k)
            at, hit = found(keys, wanted)
            out[left[hit]] += cost[at[hit]]
            left = left[~hit]
            if not len(left):
                return out
            at, known = found(histories, wanted[~hit] >> np.uint64(self.bits))
            out[left] += np.where(known, backoff[at], 0.0)
        out[left] += np.log(1 << self.bits)
        return out


def build_models(counts: DataFrame, bits: int = BITS) -> dict[str | None, Model]:
    """Models of all languages from counted n-grams."""
    arrow = counts.toArrow()
    lang = arrow.column("lang")
    grams, n = arrow.column("gram").to_numpy().view(np.uint64), arrow.column("n").to_numpy()
    out = {}
    for x in pc.unique(lang).to_pylist():
        mine = (pc.is_null(lang) if x is None else pc.fill_null(pc.equal(lang, x), False)).to_numpy()
        out[x] = Model(grams[mine], n[mine], bits)
    return out


def text_features(text: str | None, doc: list[bytes]) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    if not doc:
        return 0, 0, sum(text.count(c) for c in SYMBOL_CHARS) if text else 0, 0, 0
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    triples = list(zip(doc, doc[1:], doc[2:]))
    repeated = 0
    if len(set(triples)) < len(triples):
        often = Counter(triples)
        end = 0
        for i, x in enumerate(triples):
            if often[x] > 1:
                repeated += i + 3 - max(i, end)
                end = i + 3
    return (len(doc), len(text) - sum(text.count(c) for c in BLANKS), sum(text.count(c) for c in SYMBOL_CHARS),
            len(lines) - len(set(lines)), repeated)


def word_costs(model: Model, distinct: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Cost and number of symbols of every word, its end included."""
    grams, n = word_grams(distinct, model.bits)
    return np.add.reduceat(model.costs(grams), np.cumsum(n) - n), n


def log_perplexity(doc: list[bytes], cost: np.ndarray, n: np.ndarray, lang: str | None,
                   models: dict[str | None, Model]) -> float:
    """Log perplexity per symbol of a text without its foreign passages."""
    if len(models) == 1:
        return float(cost.sum() / n.sum())
    starts = np.arange(0, len(doc), PIECE)
    cost, n = np.add.reduceat(cost, starts), np.add.reduceat(n, starts)
    # The last segment takes the remainder, so that none is too short to tell.
    wide = np.arange(0, max(len(doc) - SEGMENT + 1, 1), SEGMENT) // PIECE
    odd = ~models[lang].fits(np.add.reduceat(cost, wide), np.add.reduceat(n, wide))
    foreign = np.zeros(len(starts), bool)
    for i, j in zip(wide[odd], np.append(wide[1:], len(starts))[odd]):
        segment = doc[starts[i]:j * PIECE]
        for other, model in models.items():
            if other != lang:
                theirs = np.add.reduceat(word_costs(model, segment)[0], starts[i:j] - starts[i])
                foreign[i:j] |= (theirs < cost[i:j]) & model.fits(theirs, n[i:j])
    if LEAST_OWN * n[~foreign].sum() < n.sum():
        foreign[:] = False
    return float(cost[~foreign].sum() / n[~foreign].sum())


def scored(docs: DataFrame, models: dict[str | None, Model]) -> DataFrame:
    """Rule features and log perplexity per symbol of every text."""
    def score(batches):
        cache: dict[str | None, dict[bytes, tuple[float, int]]] = {k: {} for k in models}
        for batch in batches:
            for part in pieces(batch):
                ids, langs, texts = (part.column(i).to_pylist() for i in range(3))
                docs_words = [words(t) for t in texts]
                fresh: dict[str | None, set[bytes]] = {}
                for lang, doc in zip(langs, docs_words, strict=True):
                    if doc:
                        fresh.setdefault(lang, set()).update(doc)
                if sum(map(len, cache.values())) > CACHE:
                    cache = {k: {} for k in models}
                for lang, new in fresh.items():
                    known = cache[lang]
                    if missing := [w for w in new if w not in known]:
                        cost, n = word_costs(models[lang], missing)
                        known.update(zip(missing, zip(cost.tolist(), n.tolist(), strict=True), strict=True))
                rows = []
                for doc_id, lang, text, doc in zip(ids, langs, texts, docs_words, strict=True):
                    facts = text_features(text, doc)
                    ppl = None
                    if doc:
                        cost, n = zip(*map(cache[lang].__getitem__, doc))
                        ppl = log_perplexity(doc, np.array(cost), np.array(n), lang, models)
                    rows.append((doc_id, lang, *facts, ppl))
                kinds = [pa.int64(), pa.string(), *[pa.int64()] * 5, pa.float64()]
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                                      ["doc_id", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                                       "n_repeat_words", "log_ppl"])

    return docs.select("doc_id", "lang", "text").mapInArrow(score, FEATURES)


def perplexity_rules(docs: DataFrame, width: float = WIDTH) -> DataFrame:
    """Rule features, perplexity, band and verdict of every document."""
    models = build_models(gram_counts(docs, EXACT), EXACT)
    rows = written(scored(docs, models), "perplexity")
    long = F.col("n_words") >= MIN_WORDS
    symbols_of = F.col("word_chars") + F.col("n_words")
    known = rows.where("log_ppl is not null")

    def quartiles(value):
        return [F.percentile_approx(x, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), 10_000)
                for x in (F.when(long, value), value)]

    mids = (known.groupBy("lang").agg(F.coalesce(*quartiles(F.col("log_ppl"))).alias("q"))
            .select(F.col("lang").alias("_lang"), F.col("q")[1].alias("_mid"), (F.col("q")[2] - F.col("q")[0]).alias("_iqr")))
    # Deviations shrink with the root of a text's length: their spread at length 1.
    scaled = (F.col("log_ppl") - F.col("_mid")) * F.sqrt(symbols_of)
    bands = (known.join(F.broadcast(mids), F.col("lang").eqNullSafe(F.col("_lang")))
             .groupBy("_lang", "_mid", "_iqr").agg(F.coalesce(*quartiles(scaled)).alias("q"))
             .select("_lang", "_mid", "_iqr", (F.col("q")[2] - F.col("q")[0]).alias("_unit")))
    failed = ((F.col("n_words") < MIN_WORDS)
              | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
    reach = width * (F.col("_iqr") + F.col("_unit") / F.sqrt(symbols_of))
    inside = F.col("log_ppl").between(F.col("_mid") - F.col("_reach"), F.col("_mid") + F.col("_reach"))
    return (rows.join(bands, F.col("lang").eqNullSafe(F.col("_lang")), "left")
            .withColumn("_reach", F.when(F.col("log_ppl").isNotNull(), reach))
            .withColumn("perplexity", F.exp("log_ppl"))
            .withColumn("low", F.exp(F.col("_mid") - F.col("_reach")))
            .withColumn("high", F.exp(F.col("_mid") + F.col("_reach")))
            .withColumn("base_failed", failed)
            .withColumn("kept", ~failed & F.coalesce(inside, F.lit(False)))
            .drop("_lang", "_mid", "_iqr", "_unit", "_reach", "log_ppl"))


def op10_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality features and verdict of every document."""
    out = perplexity_rules(table(spark, sf_dir, "documents", "doc_id", "lang", "text"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept", "perplexity", "low", "high")
