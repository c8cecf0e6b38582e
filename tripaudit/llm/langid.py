"""Language ID with a linear-chain conditional random field over the words of a text.

Every word has binary features (affixes, character n-grams, the word itself, and membership
in the lexicon of each language), the chain has learned transitions, and forward-backward
gives every word a distribution over languages, so code-switched text is labelled word by
word.  A text's language is the one with the largest sum of word marginals, its score that
sum divided by the number of words.

Training: at most ``per_lang`` runs of ``run_words`` consecutive words per language, drawn by
hash over all labelled training rows and places in their texts; runs of different languages
are spliced into chains, so that transitions between languages are seen.  The weights are
fitted by averaged gradient steps on the exact conditional likelihood.

Prediction: emission scores are looked up per distinct word.  Forward and backward passes
run over all texts of a slice at once: texts are cut into blocks, a block's operator is the
product of its 'transition times emission' matrices, and blocks are chained by these
products, which is exact.

Defined results: null text or text without letters is ``und`` with score 0; equal sums go to
the first language in order; repeated rows get equal answers; without any labelled row every
text is ``und``; extra columns are ignored or replaced when they clash.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripaudit.llm.tables import aside, pieces, table

HASH = 1 << 15
PER_LANG = 400
RUN_WORDS = 48
RUN_LETTERS = 64
LEXICON = 400
CHAIN = 4
EPOCHS = 12
BLOCK = 64
CACHE = 60_000
UND = "und"
MIX = np.uint64(0x9E3779B97F4A7C15)


@cache
def letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter(map(str.isalpha, map(chr, range(0x110000))), bool, 0x110000)


def hashed(*parts: np.ndarray, tag: int) -> np.ndarray:
    """Feature numbers below HASH of tuples of numbers of one kind."""
    h = np.full(len(parts[0]), tag, np.uint64)
    for x in parts:
        h = (h ^ x) * MIX
        h ^= h >> np.uint64(29)
    return (h >> np.uint64(17)).astype(np.int64) % HASH


@dataclass
class Features:
    """Binary features of distinct words: ``ids[i]`` holds for word ``rows[i]``."""

    rows: np.ndarray
    ids: np.ndarray
    lettered: np.ndarray
    whole: np.ndarray


def word_features(distinct: list[str]) -> Features:
    """Of every word, in lower case and without marks at its ends: affixes of 1 to 4 letters,
    n-grams of 2 and 3 within the word's ends, and the word itself."""
    n = len(distinct)
    points = np.frombuffer("".join(f"{w}\n" for w in distinct).lower().encode("utf-32-le"), np.uint32)
    ends = np.flatnonzero(points == 10)
    starts = np.concatenate([[0], ends[:-1] + 1])
    at = np.arange(len(points))
    is_letter = letters()[points]
    first = np.minimum.reduceat(np.where(is_letter, at, len(points)), starts)
    last = np.maximum.reduceat(np.where(is_letter, at, -1), starts)
    lettered = last >= 0
    rows = np.flatnonzero(lettered)
    first, size = first[rows], (last - first + 1)[rows]
    # The words end to end, each between two zeros.
    begin = np.cumsum(size + 2) - (size + 2)
    word = np.repeat(np.arange(len(rows)), size)
    inner = np.arange(len(word)) - np.repeat(np.cumsum(size) - size, size)
    framed = np.zeros(int((size + 2).sum()), np.uint64)
    framed[begin[word] + 1 + inner] = points[first[word] + inner]
    of = np.repeat(np.arange(len(rows)), size + 2)
    out_rows, out_ids = [], []

    def add(which, ids):
        out_rows.append(rows[which])
        out_ids.append(ids)

    for k in (2, 3):
        here = np.flatnonzero(of[k - 1:] == of[:len(of) - k + 1])
        add(of[here], hashed(*(framed[here + j] for j in range(k)), tag=k))
    for k in range(1, 5):
        w = np.flatnonzero(size >= k)
        add(w, hashed(*(framed[begin[w] + 1 + j] for j in range(k)), tag=10 + k))
        add(w, hashed(*(framed[begin[w] + size[w] - j] for j in range(k)), tag=20 + k))
    power = np.cumprod(np.full(int(size.max(initial=0)) + 1, MIX, np.uint64))
    sums = (np.add.reduceat(framed[begin[word] + 1 + inner] * power[inner], np.cumsum(size) - size)
            if len(rows) else np.empty(0, np.uint64))
    add(np.arange(len(rows)), hashed(sums, tag=30))
    whole = np.zeros(n, np.uint64)
    whole[rows] = sums
    return Features(np.concatenate(out_rows), np.concatenate(out_ids), lettered, whole)


@dataclass
class Crf:
    """Weights: (features, languages) emissions and (languages, languages) transitions;
    lexicons as sorted hashes of words."""

    langs: list[str]
    lexicons: list[np.ndarray]
    weights: np.ndarray
    transitions: np.ndarray

    def with_lexicons(self, f: Features) -> tuple[np.ndarray, np.ndarray]:
        rows, ids = [f.rows], [f.ids]
        for k, lex in enumerate(self.lexicons):
            if len(lex):
                at = np.minimum(np.searchsorted(lex, f.whole), len(lex) - 1)
                hit = np.flatnonzero((lex[at] == f.whole) & f.lettered)
                rows.append(hit)
                ids.append(np.full(len(hit), HASH + k))
        return np.concatenate(rows), np.concatenate(ids)

    def scores(self, rows: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
        """exp(score) of every label, largest 1."""
        score = np.stack([np.bincount(rows, self.weights[ids, c], minlength=n) for c in range(len(self.langs))], 1)
        score -= score.max(1, keepdims=True)
        return np.exp(np.maximum(score, -30)).astype(np.float32)

    def emissions(self, distinct: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Emission weights of words, and which of them have a letter."""
        if not distinct or not self.langs:
            return np.ones((len(distinct), len(self.langs)), np.float32), np.zeros(len(distinct), bool)
        f = word_features(distinct)
        return self.scores(*self.with_lexicons(f), len(distinct)), f.lettered


def marginals(emit: np.ndarray, lengths: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """Posterior label distributions of all words of consecutive texts (lengths >= 1).

    ``emit`` is (words, labels), ``trans`` holds exp(transition).  Exact for any length:
    BLOCK words are one step of the chain over blocks.
    """
    k = emit.shape[1]
    blocks = -(-lengths // BLOCK)
    n = int(blocks.sum())
    first = np.cumsum(blocks) - blocks
    # Words of block b, place j: pad[b, j]; places after a text's end emit 1 and keep labels.
    start = np.cumsum(lengths) - lengths
    text_of = np.repeat(np.arange(len(lengths)), blocks)
    inner = np.arange(n) - first[text_of]
    begin = start[text_of] + inner * BLOCK
    size = np.minimum(lengths[text_of] - inner * BLOCK, BLOCK)
    j = np.arange(BLOCK)
    live = j < size[:, None]
    at = np.where(live, begin[:, None] + j, 0)
    e = np.where(live[:, :, None], emit[at], 1.0).astype(np.float64)

    def scaled(x):
        return x / x.max(axis=tuple(range(1, x.ndim)), keepdims=True)

    step = np.eye(k)
    prod = np.broadcast_to(np.eye(k), (n, k, k)).copy()
    for p in range(BLOCK):
        m = np.where(live[:, p, None, None], trans, step)
        prod = scaled(np.matmul(prod, m) * e[:, p, None, :])
    # Chain the blocks: label weights before each block and after it.
    enter = np.ones((n, k))
    leave = np.ones((n, k))
    for i in range(1, int(blocks.max(initial=0))):
        b = first[blocks > i] + i
        enter[b] = scaled(np.einsum("nk,nkl->nl", enter[b - 1], prod[b - 1]))
    last = first + blocks - 1
    for i in range(1, int(blocks.max(initial=0))):
        b = last[blocks > i] - i
        leave[b] = scaled(np.einsum("nkl,nl->nk", prod[b + 1], leave[b + 1]))
    alpha = np.empty((BLOCK, n, k))
    a = enter
    for p in range(BLOCK):
        a = scaled(np.where(live[:, p, None], (a @ trans) * e[:, p], a))
        alpha[p] = a
    beta = leave
    for p in range(BLOCK - 1, -1, -1):
        alpha[p] *= beta
        beta = scaled(np.where(live[:, p, None], (e[:, p] * beta) @ trans.T, beta))
    gamma = alpha.transpose(1, 0, 2)[live]
    return gamma / gamma.sum(1, keepdims=True)


def fit(runs: list[tuple[str, list[str]]], lexicon: int = LEXICON, epochs: int = EPOCHS, rate: float = 0.5) -> Crf:
    """Fit the field on runs of words with one language each."""
    langs = sorted({lang for lang, _ in runs})
    tokens = [w for _, run in runs for w in run]
    if not tokens:
        return Crf(langs, [np.empty(0, np.uint64)] * len(langs), np.zeros((HASH + len(langs), len(langs))),
                   np.zeros((len(langs), len(langs))))
    distinct, token_at = np.unique(np.array(tokens, dtype=object), return_inverse=True)
    found = word_features(distinct.tolist())
    run_of = np.repeat(np.arange(len(runs)), [len(run) for _, run in runs])
    lang_of = np.array([langs.index(lang) for lang, _ in runs])[run_of]
    lexicons = []
    for c in range(len(langs)):
        mine = token_at[(lang_of == c) & found.lettered[token_at]]
        hashes, n = np.unique(found.whole[mine], return_counts=True)
        lexicons.append(np.sort(hashes[np.lexsort((hashes, -n))[:lexicon]]))
    # Chains of CHAIN runs each, in a fixed random order, of words with letters.
    chain_of = np.empty(len(runs), np.int64)
    place_of = np.random.default_rng(0).permutation(len(runs))
    chain_of[place_of] = np.arange(len(runs))
    order = np.lexsort((np.arange(len(tokens)), chain_of[run_of]))
    order = order[found.lettered[token_at[order]]]
    word_at, labels = token_at[order], lang_of[order]
    lengths = np.bincount(chain_of[run_of[order]] // CHAIN)
    lengths = lengths[lengths > 0]
    k = len(langs)
    model = Crf(langs, lexicons, np.zeros((HASH + k, k), np.float32), np.zeros((k, k)))
    if not len(labels):
        return model
    rows, ids = model.with_lexicons(found)
    gold = np.zeros((len(labels), k))
    gold[np.arange(len(labels)), labels] = 1
    # Transitions inside chains: pairs of neighbours that are not at a chain's end.
    inside = np.ones(len(labels), bool)
    inside[np.cumsum(lengths) - 1] = False
    left = np.flatnonzero(inside)
    seen = np.zeros((k, k))
    np.add.at(seen, (labels[left], labels[left + 1]), 1)
    sums_w, sums_t = np.zeros_like(model.weights), np.zeros_like(model.transitions)
    square_w, square_t = np.full_like(model.weights, 1e-8), np.full_like(model.transitions, 1e-8)
    for _ in range(epochs):
        emit = model.scores(rows, ids, len(distinct))[word_at]
        trans = np.exp(model.transitions)
        post = marginals(emit, lengths, trans)
        by_word = np.zeros((len(distinct), k))
        np.add.at(by_word, word_at, gold - post)
        grad = np.stack([np.bincount(ids, by_word[rows, c], minlength=HASH + k) for c in range(k)], 1)
        # Expected transitions from neighbouring marginals under the current field.
        pair = post[left][:, :, None] * trans * (post[left + 1] / (post[left] @ trans))[:, None, :]
        expected = (pair / pair.sum((1, 2), keepdims=True)).sum(0)
        # AdaGrad steps on the mean gradient, with a pull to zero.
        grad_w = grad / len(labels) - 1e-6 * model.weights
        grad_t = (seen - expected) / max(len(left), 1)
        square_w += grad_w ** 2
        square_t += grad_t ** 2
        model.weights += (rate * grad_w / np.sqrt(square_w)).astype(np.float32)
        model.transitions += rate * grad_t / np.sqrt(square_t)
        sums_w += model.weights
        sums_t += model.transitions
    model.weights, model.transitions = sums_w / epochs, sums_t / epochs
    return model


def training_runs(labelled: DataFrame, per_lang: int = PER_LANG, run_words: int = RUN_WORDS) -> list[tuple[str, list[str]]]:
    """At most ``per_lang`` runs of ``run_words`` words per language, drawn by hash from all
    rows of (key, text, lang).  The driver receives these runs only, of at most ``RUN_LETTERS``
    characters a word.

    A row is drawn by its key and text together and repeated rows count once, so null or
    repeated keys neither leave a language out nor take it in whole."""
    rows = labelled.withColumn("_h", F.xxhash64("key", "text", F.lit("draw")))
    spread = F.pmod("_h", F.lit(1 << 30))
    sizes = {r["lang"]: r["count"] for r in rows.select("lang", "_h").distinct().groupBy("lang").count().collect()}
    wanted = F.lit(False)
    for lang, n in sorted(sizes.items()):
        limit = (1 << 30) if n <= 2 * per_lang else (1 << 30) * 2 * per_lang // n
        wanted = wanted | ((F.col("lang") == lang) & (spread < limit))
    parts = F.split(F.trim(F.regexp_replace("text", r"(?U)\s+", " ")), " ")
    place = F.pmod(F.xxhash64("key", "text", F.lit("place")), F.greatest(F.size("_w") - run_words + 1, F.lit(1)))
    run = F.transform(F.slice("_w", place.cast("int") + 1, run_words), lambda w: F.left(w, F.lit(RUN_LETTERS)))
    runs = (rows.where(wanted).withColumn("_w", parts)
            .select("lang", spread.alias("_at"), run.alias("run")).distinct().collect())
    out = []
    for lang in sorted(sizes):
        mine = sorted((r for r in runs if r["lang"] == lang), key=lambda r: (r["_at"], r["run"]))
        out += [(lang, list(r["run"])) for r in mine[:per_lang]]
    return out


def predict(docs: DataFrame, model: Crf, text: str = "text") -> DataFrame:
    """Add ``lang_pred`` and ``score`` to every row."""
    def label(batches):
        trans = np.exp(model.transitions)
        place: dict[str, int] = {}
        emit = np.empty((0, len(model.langs)), np.float32)
        lettered = np.empty(0, bool)
        for batch in batches:
            for part in pieces(batch, 1 << 19):
                texts = part.column(part.schema.get_field_index(text))
                split = pc.utf8_split_whitespace(pc.fill_null(texts, ""))
                n = np.asarray(pc.list_value_length(split)).astype(np.int64)
                codes = pc.list_flatten(split).dictionary_encode()
                distinct = codes.dictionary.to_pylist()
                if len(place) > CACHE:
                    place, emit, lettered = {}, emit[:0], lettered[:0]
                if fresh := [w for w in distinct if w not in place]:
                    place.update(zip(fresh, range(len(place), len(place) + len(fresh)), strict=True))
                    new, new_lettered = model.emissions(fresh)
                    emit = np.concatenate([emit, new])
                    lettered = np.concatenate([lettered, new_lettered])
                rows = np.fromiter(map(place.__getitem__, distinct), np.int64, len(distinct))
                word = rows[codes.indices.to_numpy()] if len(rows) else rows
                # Words without letters tell nothing and leave the chain.
                counts = lettered[word] if len(rows) else np.zeros(0, bool)
                doc = np.repeat(np.arange(len(n)), n)[counts]
                word = word[counts]
                lengths = np.bincount(doc, minlength=len(n))
                sums = np.zeros((len(n), max(len(model.langs), 1)))
                if len(word) and model.langs:
                    full = lengths > 0
                    post = marginals(emit[word], lengths[full], trans)
                    sums[full] = np.add.reduceat(post, (np.cumsum(lengths) - lengths)[full], axis=0)
                best = sums.argmax(1)
                known = (lengths > 0) & bool(model.langs)
                share = np.where(known, sums.max(1) / np.maximum(lengths, 1), 0.0)
                cols = dict(zip(part.schema.names, part.columns, strict=True))
                cols |= {"lang_pred": pa.array([model.langs[b] if ok else UND for b, ok in zip(best, known, strict=True)],
                                               pa.string()),
                         "score": pa.array(np.clip(share, 0.0, 1.0))}
                yield pa.record_batch(list(cols.values()), list(cols))

    blank = docs.withColumn("lang_pred", F.lit("")).withColumn("score", F.lit(0.0))
    out = blank.mapInArrow(label, blank.schema)
    return out


def held_out(doc_id="doc_id"):
    """Rows that no model may learn from: crc32 of the id, as text, has remainder 2 by 4."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def train_on(docs: DataFrame, **bounds) -> Crf:
    """Fit on the documents with a language that are not held out."""
    rows = (docs.where(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull())
            .select(F.col("doc_id").alias("key"), "text", "lang"))
    return fit(training_runs(rows, **bounds))


def op2_crf_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the rows that are not held out."""
    model = train_on(table(spark, sf_dir, "documents", "doc_id", "text", "lang"))
    out = predict(table(spark, sf_dir, "documents", "doc_id", "text"), model)
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, least: float = 0.35) -> DataFrame:
    """Documents of which one language has ``least`` or more of the words' marginals; the
    others, and those without letters, are rejected.  Where no row has a language to learn
    from, nothing tells against a text, and all that have letters stay."""
    model = train_on(docs)
    plain, back = aside(docs, "text")
    if not model.langs:
        return back(plain.where(F.col("text").rlike(r"\p{L}")))
    found = predict(plain, model)
    return back(found.where((F.col("lang_pred") != UND) & (F.col("score") >= least)))
