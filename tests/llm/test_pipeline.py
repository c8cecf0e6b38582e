"""The pipeline, stage by stage, against plain Python on each stage's own input."""

import re
import zlib

import pytest
from conftest import SF0001
from test_decontam import brute as hits
from test_jaccard import brute as near
from test_langid import held_out
from test_packing import packed_ok
from tokenizers import Tokenizer

import corpus_pipeline as P
from tripaudit.llm.langid import predict, train_on
from tripaudit.llm.packing import tokenizer_json
from tripaudit.llm.pii import find_spans, redact
from tripaudit.llm.tables import written


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    out = [docs]
    for name, stage in P.STAGES:
        out.append(written(stage(spark, out[-1], SF0001), f"test-{name}"))
    return out


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages_keep_the_columns(stages):
    assert [name for name, _ in P.STAGES] == ["language_id", "near_duplicates", "decontaminate", "redact_pii", "pack"]
    for df in stages[1:-1]:
        assert df.schema.fieldNames() == stages[0].columns and df.dtypes == stages[0].dtypes


def test_language_id_rejects_what_its_model_cannot_tell(spark, stages):
    labels = predict(stages[0].select("doc_id", "text"), train_on(stages[0]))
    want = {r.doc_id for r in labels.collect() if r.lang_pred != "und" and r.score >= 0.35}
    assert set(rows(stages[1])) == want and len(want) > 0.95 * stages[0].count()
    assert stages[0].where(held_out()).count() > 0


def test_one_document_of_each_group_stays(stages):
    before = [(r.doc_id, r.text) for r in stages[1].collect()]
    groups = [re.match(r"\((\d+), \d+, (\d+)\)", x).groups() for x in near(before)]
    assert set(rows(stages[2])) == {int(c) for _, c in groups}


def test_contaminated_documents_go(spark, stages):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF0001}/benchmark.parquet").collect()]
    want = {i for i, r in rows(stages[2]).items() if not hits(r.text, items)[1]}
    assert set(rows(stages[3])) == want and want < set(rows(stages[2]))


def test_personal_data_is_replaced(stages):
    before, after = rows(stages[3]), rows(stages[4])
    assert set(before) == set(after)
    changed = 0
    for i, r in after.items():
        text = redact(before[i].text, find_spans(before[i].text))
        assert (r.text, r.n_chars, r.lang, r.source) == (text, len(text), before[i].lang, before[i].source)
        assert not find_spans(r.text)
        changed += r.text != before[i].text
    assert changed


def test_all_tokens_are_packed(stages):
    exact = Tokenizer.from_str(tokenizer_json())
    tokens = {i: [*exact.encode(r.text, add_special_tokens=False).ids, 0] for i, r in rows(stages[4]).items()}
    used = packed_ok(stages[5].collect(), 2048, tokens)
    assert used <= -(-sum(map(len, tokens.values())) // 2048) * 1.02 + 1


def test_run_gives_the_last_stage(spark, stages):
    def pieces(df):
        return sorted(tuple(r) for r in df.select("doc_id", "piece", "start", "length", "ids_crc32").collect())

    got = P.run(spark, SF0001)
    assert got.columns == stages[-1].columns and pieces(got) == pieces(stages[-1])
    assert zlib.crc32(b"") == 0 and P.ORACLE_SQL is None


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, hit_spans int, a int"


def test_edge_tables_pass_every_stage(spark):
    odd = [(None, "some words that are read", "en", None, 3, "x", 1, 2), (1, None, None, "s", None, None, None, None),
           (2, "", "en", "s", 0, "x", 1, 2), (3, "des mots a b c d", "fr", "s", 9, "x", 1, 2),
           (3, "des mots a b c d", "fr", "s", 9, "x", 1, 2), (4, "word " * 30_000, "en", "s", 9, "x", 1, 2)]
    for data in (odd, []):
        docs = spark.createDataFrame(data, SCHEMA)
        for name, stage in P.STAGES[:-1]:
            docs = written(stage(spark, docs, SF0001), f"edge-{name}")
            assert docs.columns == [c.split()[0] for c in SCHEMA.split(", ")]
        packed = P.pack(spark, docs, SF0001).collect()
        assert {r.doc_id for r in packed} == ({None, 3, 4} if data else set())
