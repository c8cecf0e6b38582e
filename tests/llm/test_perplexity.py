"""Quality rules by brute force, and the model's probabilities."""

import re
from collections import Counter

import numpy as np
import pytest
from conftest import SF0001
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tripaudit.llm.perplexity import (
    EXACT,
    SYMBOLS,
    Model,
    build_models,
    discounts,
    gram_counts,
    op10_kneser_ney,
    perplexity_rules,
    symbols,
    text_features,
    word_grams,
    words,
)


def brute(text):
    text = text or ""
    found = re.findall(r"[^\x20\x09-\x0D]+", text)
    often = Counter(zip(found, found[1:], found[2:]))
    repeated = {j for i in range(len(found) - 2) if often[tuple(found[i:i + 3])] > 1 for j in range(i, i + 3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(found), sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(repeated)


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet="ab é\n\t\x0b\x1c\xa0#|", max_size=60))
def test_features_match_brute_force(text):
    assert text_features(text, words(text)) == brute(text)


def literal_grams(word):
    codes = [0, 0, 0, *symbols(np.array([ord(c) for c in word], np.uint32)).tolist(), 0]
    return [int(sum(c << (6 * (3 - k)) for k, c in enumerate(codes[i:i + 4]))) for i in range(len(codes) - 3)]


def test_word_grams():
    given_words = ["a", "Hello", "ñandú", "x1%", "日本"]
    grams, n = word_grams([w.encode() for w in given_words])
    assert grams.tolist() == [g for w in given_words for g in literal_grams(w)]
    assert n.tolist() == [len(w) + 1 for w in given_words]


def test_counts_cover_all_words(spark):
    rows = [(1, "en", "the cat the hat"), (2, None, "the"), (3, "en", None), (1, "en", "the cat the hat")]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    want = Counter()
    for _, lang, text in rows:
        for w in (text or "").split():
            want.update((lang, g) for g in literal_grams(w))
    assert {(r.lang, r.gram): r.n for r in gram_counts(docs).collect()} == dict(want)


def test_probabilities_sum_to_one():
    rng = np.random.default_rng(3)
    text = ["".join(rng.choice(list("abcde"), rng.integers(1, 9))) for _ in range(4000)]
    counted = Counter(g for w in text for g in literal_grams(w))
    model = Model(np.array(list(counted), np.uint32), np.array(list(counted.values())))
    assert (np.diff(model.grams.astype(np.int64)) > 0).all()  # sorted for the search
    for history in [0, 1, 1 << 6 | 2, (3 << 12) | (1 << 6) | 5, (9 << 12) | (9 << 6) | 9]:
        p = np.exp(-model.costs(np.arange(SYMBOLS, dtype=np.uint32) + np.uint32(history << 6)))
        assert p.sum() == pytest.approx(1, abs=1e-4)


def test_discounts_are_those_of_the_counts_of_counts():
    counts = np.array([1] * 50 + [2] * 20 + [3] * 10 + [4] * 5)
    y = 50 / 90
    assert discounts(counts)[1:] == pytest.approx([1 - 2 * y * 20 / 50, 2 - 3 * y * 10 / 20, 3 - 4 * y * 5 / 10])


def test_noise_falls_outside_its_language(spark):
    base = spark.read.parquet(f"{SF0001}/documents.parquet").select("doc_id", "lang", "text")
    rng = np.random.default_rng(1)
    noise = " ".join("".join(rng.choice(list("qxzjkvw#@!~^+=éøžßþжшфд漢字仮名"), 7)) for _ in range(80))
    flat = " ".join(f"aaaa{'a' * (i % 9)}" for i in range(80))
    docs = base.unionByName(spark.createDataFrame([(-1, "en", noise), (-2, "en", flat)], base.schema))
    got = {r.doc_id: r for r in perplexity_rules(docs).collect()}
    assert not got[-1].kept and got[-1].perplexity > got[-1].high
    clean = [r for i, r in got.items() if i >= 0 and not r.base_failed]
    assert sum(r.kept for r in clean) > 0.95 * len(clean)


def test_edge_rows(spark):
    rows = [(1, "en", None, "x"), (2, None, "", "x"), (None, None, "word " * 60_000, "x"), (3, "xx", "one two", "x"),
            (3, "xx", "one two", "x"), (4, "en", " \n\t ", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string, perplexity string")
    got = perplexity_rules(docs).collect()
    assert len(got) == 6 and not any(r.kept for r in got)
    assert sorted((r.doc_id or 0, r.n_words, r.perplexity is None) for r in got) == [
        (0, 60_000, False), (1, 0, True), (2, 0, True), (3, 2, False), (3, 2, False), (4, 0, True)]
    assert perplexity_rules(docs.limit(0)).count() == 0
    assert build_models(gram_counts(docs.limit(0))) == {}


def test_query_matches_brute_force(spark):
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()}
    rows = op10_kneser_ney(spark, SF0001).collect()
    assert len(rows) == len(text)
    for r in rows:
        n, chars, marks, dup, rep = brute(text[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, marks, dup, rep)
        failed = n < 50 or 100 * rep > 50 * n
        assert r.base_failed == failed
        assert r.kept == (not failed and r.low <= r.perplexity <= r.high)


def test_noise_of_every_kind_falls_outside_and_foreign_passages_stay(spark):
    base = spark.read.parquet(f"{SF0001}/documents.parquet").select("doc_id", "lang", "text")
    rng = np.random.default_rng(1)
    texts = {k: [r.text.split() for r in base.where(F.col("lang") == k).orderBy("doc_id").collect()
                 if 100 < len(r.text.split()) < 400 and len(set(r.text.split())) > 60] for k in ("en", "de")}
    clean, foreign = texts["en"][0][:100], texts["de"][0]

    def random(letters, n):
        return ["".join(rng.choice(list(letters), 7)) for _ in range(n)]

    noise = {-1: random("qxzjkvw0123456789", 80),  # rare letters and digits
             -2: random("0123456789", 80),
             -3: random("abcdefghijklmnopqrstuvwxyz", 80),
             -4: clean[:50] + random("qxzjkvw0123456789", 25) + clean[50:],  # a fifth of the text
             -5: [w if i % 5 else random("abcdefghijklmnopqrstuvwxyz", 1)[0] for i, w in enumerate(clean)],
             -6: ["a" * k for k in rng.integers(4, 60, 200)]}  # far too cheap
    mixed = {-7: clean[:50] + foreign[:50] + clean[50:], -8: foreign[:30] + clean}
    docs = base.unionByName(spark.createDataFrame([(k, "en", " ".join(v)) for k, v in (noise | mixed).items()], base.schema))
    got = {r.doc_id: r for r in perplexity_rules(docs).collect()}
    assert all(not got[k].base_failed for k in [*noise, *mixed])
    assert {k: got[k].kept for k in noise} == dict.fromkeys(noise, False)
    assert all(got[k].perplexity > got[k].high for k in (-1, -2, -3, -4, -5)) and got[-6].perplexity < got[-6].low
    assert {k: got[k].kept for k in mixed} == dict.fromkeys(mixed, True)
    kept = [r.kept for i, r in got.items() if i >= 0 and not r.base_failed]
    assert sum(kept) > 0.95 * len(kept)


def test_no_two_characters_are_one_symbol():
    """Code points of several scripts, controls and pairs of units included; only A-Z are a-z."""
    given_chars = [chr(c) for c in [*range(1, 9), *range(33, 0x3000, 7), *range(0x4E00, 0x9FFF, 97), 0xFFFF, 0x1F600, 0x20000, 0x10FFFF]
                   if not 65 <= c <= 90]
    seen = {}
    for c in given_chars:
        grams, n = word_grams([c.encode()], EXACT)
        assert n.tolist() == [len(c.encode("utf-16-le")) // 2 + 1] and len(grams) == n[0]
        seen.setdefault(tuple(grams.tolist()), []).append(c)
    assert all(len(v) == 1 for v in seen.values()) and len(seen) == len(given_chars)
    # Kinds that the rules of 64 classes merge: 19 code points apart, # and +, É and what lies 19 from it.
    told = [tuple(word_grams([w.encode()], EXACT)[0].tolist()) for w in ("的", chr(ord("的") + 19), "É", "Ü", "#", "+", "A", "a")]
    assert len(set(told)) == 7 and told[-1] == told[-2]


def literal_probability(counted, history, symbol):
    """Interpolated modified Kneser-Ney by its definition, over strings of four letters."""
    tables = [counted]
    for _ in range(3):
        tables.append(Counter(g[1:] for g in tables[-1]))

    def p(k, h, x):
        if k == 0:
            return 1 / (1 << EXACT)
        table = tables[4 - k]
        d = discounts(np.array(list(table.values())))
        if k >= 3:
            d[1] = 1.0
        after = {g[-1]: n for g, n in table.items() if g[:-1] == h}
        if not after:
            return p(k - 1, h[1:], x)
        total, off = sum(after.values()), sum(d[min(n, 3)] for n in after.values())
        n = after.get(x, 0)
        return (n - d[min(n, 3)]) / total + off / total * p(k - 1, h[1:], x)

    return p(4, history, symbol)


def test_costs_of_exact_letters_are_those_of_the_definition():
    rng = np.random.default_rng(4)
    given_words = ["".join(rng.choice(list("abcé的目#"), rng.integers(1, 6))) for _ in range(1500)]
    counted = Counter(f"   {w} "[i:i + 4] for w in given_words for i in range(len(w) + 1))
    number = {g: int(sum(ord(c) << 16 * (3 - k) for k, c in enumerate(g))) for g in counted}
    model = Model(np.array([number[g] for g in counted], np.uint64), np.array(list(counted.values())), EXACT)
    asked = [*list(counted)[:60], "zzzz", "   的", "的#ca", "b的目é", "aZba", "éé z"]
    got = model.costs(np.array([sum(ord(c) << 16 * (3 - k) for k, c in enumerate(g)) for g in asked], np.uint64))
    assert np.exp(-got) == pytest.approx([literal_probability(counted, g[:3], g[3]) for g in asked], rel=1e-4)


def test_another_script_of_the_same_classes_is_not_kept(spark):
    """Letters moved by a multiple of 19 had the same classes, so the same perplexity."""
    rng = np.random.default_rng(6)
    stock = ["".join(chr(0x0430 + x) for x in rng.integers(0, 32, rng.integers(3, 9))) for _ in range(150)]
    rows = [(i, "ru", " ".join(rng.choice(stock, 90))) for i in range(120)]
    moved = "".join(c if c == " " else chr(ord(c) + 19 * 60) for c in rows[0][2])
    docs = spark.createDataFrame([*rows, (-1, "ru", moved)], "doc_id long, lang string, text string")
    got = {r.doc_id: r for r in perplexity_rules(docs).collect()}
    assert not got[-1].base_failed and not got[-1].kept and got[-1].perplexity > got[-1].high
    assert sum(r.kept for r in got.values()) >= 110
