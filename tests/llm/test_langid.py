"""Language ID: exact marginals, held-out accuracy, code-switched text."""

import itertools
import zlib

import numpy as np
import pytest
from conftest import SF001

from tripaudit.llm.langid import (
    BLOCK,
    HASH,
    fit,
    held_out,
    keep_identified,
    marginals,
    op2_crf_language,
    predict,
    train_on,
    training_runs,
    word_features,
)


def brute_marginals(emit, trans):
    n, k = emit.shape
    out = np.zeros((n, k))
    for path in itertools.product(range(k), repeat=n):
        w = emit[0, path[0]] * trans[:, path[0]].sum()
        for i in range(1, n):
            w *= trans[path[i - 1], path[i]] * emit[i, path[i]]
        for i, c in enumerate(path):
            out[i, c] += w
    return out / out.sum(1, keepdims=True)


def test_marginals_match_all_paths():
    rng = np.random.default_rng(0)
    lengths = np.array([1, 5, 3])
    emit, trans = rng.random((9, 3)) + 0.1, rng.random((3, 3)) + 0.1
    got = marginals(emit, lengths, trans)
    want = np.concatenate([brute_marginals(e, trans) for e in np.split(emit, [1, 6])])
    assert np.allclose(got, want)


def test_blocks_are_chained_exactly():
    rng = np.random.default_rng(1)
    n = 3 * BLOCK + 7
    emit, trans = rng.random((n, 3)) + 0.01, rng.random((3, 3)) + 0.1
    alpha, beta = np.zeros((n, 3)), np.ones((n, 3))
    a = np.ones(3)
    for i in range(n):
        a = (a @ trans) * emit[i]
        a /= a.sum()
        alpha[i] = a
    for i in range(n - 2, -1, -1):
        b = trans @ (emit[i + 1] * beta[i + 1])
        beta[i] = b / b.sum()
    want = alpha * beta
    assert np.allclose(marginals(emit, np.array([n]), trans), want / want.sum(1, keepdims=True))


def test_features_ignore_case_and_marks():
    f = word_features(["The", "the,", "(THE)", "12", "ñ", "--", "x" * 100_000])
    sets = [set(f.ids[f.rows == i].tolist()) for i in range(7)]
    assert sets[0] == sets[1] == sets[2] and len(sets[0]) == 14 and max(map(max, filter(None, sets))) < HASH
    assert f.lettered.tolist() == [True, True, True, False, True, False, True]
    assert not sets[3] and not sets[5] and sets[4]


RUNS = [("aa", ["foo", "bar", "baz", "bazoo"] * 6), ("bb", ["ñul", "ñik", "tñe", "ulñ"] * 6)] * 40


@pytest.fixture(scope="module")
def model():
    return fit(RUNS)


def test_transitions_prefer_the_same_language(model):
    assert model.transitions[0, 0] > model.transitions[0, 1] and model.transitions[1, 1] > model.transitions[1, 0]


def test_code_switched_and_edge_rows(spark, model):
    rows = [(1, "foo bar baz", "x"), (2, "foo bar ñul", "x"), (3, None, "x"), (4, "", "x"), (5, "123 -- 4!", "x"),
            (None, "ÑIK 1 tñe,", "x"), (7, "foo " * 100_000, "x"), (1, "foo bar baz", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    got = sorted(((r.doc_id or 0, r.lang_pred, r.score) for r in predict(docs, model).collect()))
    assert [g[:2] for g in got] == [(0, "bb"), (1, "aa"), (1, "aa"), (2, "aa"), (3, "und"), (4, "und"), (5, "und"), (7, "aa")]
    score = {g[0]: g[2] for g in got}
    assert score[1] > 0.9 and 0.5 < score[2] < 0.8 and score[3] == score[5] == 0
    assert predict(docs.limit(0), model).count() == 0


def test_no_labels_and_no_words(spark):
    empty = fit([])
    docs = spark.createDataFrame([(1, "some text")], "doc_id long, text string")
    assert [(r.lang_pred, r.score) for r in predict(docs, empty).collect()] == [("und", 0.0)]
    blank = fit([("aa", ["1", "2"])])
    assert predict(docs, blank).first().lang_pred == "aa"


def test_training_is_bounded_and_leaves_held_out_rows_out(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = docs.where(~held_out()).selectExpr("doc_id as key", "text", "lang")
    runs = training_runs(rows, per_lang=20, run_words=10)
    assert len(runs) == 80 and max(len(run) for _, run in runs) <= 10
    assert runs == training_runs(rows.repartition(3), per_lang=20, run_words=10)
    kept = {r.doc_id for r in docs.where(~held_out()).select("doc_id").collect()}
    assert all((i in kept) == (zlib.crc32(str(i).encode()) % 4 != 2) for i in range(1000))
    hidden = docs.selectExpr("doc_id", "text", "case when crc32(string(doc_id)) % 4 = 2 then 'zz' else lang end as lang")
    assert "zz" not in train_on(hidden).langs


def test_held_out_accuracy(spark):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    rows = op2_crf_language(spark, SF001).collect()
    assert len(rows) == len(lang)
    test = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in test) >= 0.98 * len(test)
    assert all(0 <= r.score <= 1 for r in rows)


def test_rejection_keeps_columns_and_clean_rows(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    extra = docs.limit(1).selectExpr("-1L as doc_id", "'12 34 !!' as text", "lang", "source", "n_chars")
    odd = docs.unionByName(extra).withColumn("score", docs["n_chars"])
    out = keep_identified(odd)
    assert out.columns == odd.columns
    assert sorted(r.doc_id for r in out.collect()) == list(range(1000))


def test_null_and_repeated_keys_leave_no_language_out(spark):
    texts = [("en", f"the quick fox {i} jumps over the lazy dog") for i in range(300)]
    texts += [("de", f"der schnelle fuchs {i} springt") for i in range(40)]
    # a third of all rows is one row
    texts += [("en", "one row again")] * 170
    rows = spark.createDataFrame([(None, t, lang) for lang, t in texts], "key long, text string, lang string")
    runs = training_runs(rows, per_lang=20, run_words=10)
    assert {lang for lang, _ in runs} == {"en", "de"}
    assert len([1 for lang, _ in runs if lang == "en"]) == 20 == len([1 for lang, _ in runs if lang == "de"])
    assert len({tuple(run) for lang, run in runs if lang == "en"}) == 20
    unspaced = spark.createDataFrame([(i, "日本語" * 50_000 + str(i), "ja") for i in range(3)], "key long, text string, lang string")
    assert max(sum(map(len, run)) for _, run in training_runs(unspaced)) <= 48 * 64


def test_blanks_of_all_scripts_part_training_words(spark):
    rows = spark.createDataFrame([(1, "un\u00a0deux\u3000trois\u2003quatre", "fr")], "key long, text string, lang string")
    assert training_runs(rows) == [("fr", ["un", "deux", "trois", "quatre"])]


def test_unlabelled_corpora_keep_lettered_texts(spark):
    rows = [(1, "some words", None), (2, "12 34 !", None), (3, None, None), (4, "слово", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert sorted(r.doc_id for r in keep_identified(docs).collect()) == [1, 4]
