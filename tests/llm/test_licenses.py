"""Licence sentences on real notices, and the scan against its SQL."""

import duckdb
import pytest
from conftest import SF0001

from tripaudit.llm.licenses import RULES, SENTENCES, known_sentences, license_scan, op4_license_sentences, oracle_op4


def found(spark, *texts):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    return [(list(r.sentence_ids), list(r.license_ids)) for r in license_scan(docs).orderBy("doc_id").collect()]


def wrapped(text, width=60):
    out, line = [], ""
    for w in text.split():
        if len(line) + len(w) > width:
            out.append(line)
            line = ""
        line = f"{line} {w}".strip()
    return "\n".join([*out, line])


def test_notices(spark):
    got = found(spark, "Foo bar.\nReleased under the MIT License.", "a b\nLicensed under CC BY-NC 4.0.\nc",
                "This work is licensed under the GNU General Public License, version 3.",
                "// SPDX-License-Identifier: Apache-2.0\nint x;", "the license was revoked", "plain prose here")
    assert got == [(["mit-notice"], ["MIT"]), (["cc-by-nc-notice"], ["CC-BY-NC-4.0"]),
                   (["gpl3-notice"], ["GPL-3.0-only"]), (["apache-notice"], ["Apache-2.0"]), ([], []), ([], [])]


@pytest.mark.parametrize("rule", range(len(RULES)))
def test_every_rule_by_its_own_sentences(spark, rule):
    name, ids = RULES[rule]
    text = ". ".join(SENTENCES[i][0] for i in ids) + "."
    whole, folded = found(spark, text, wrapped(text))
    assert whole == (ids, [name]) and folded == (ids, [name])


def test_longer_rules_come_first_and_order_counts(spark):
    full = ["mit-grant", "mit-keep", "as-is"]
    text = ".\n\n".join(SENTENCES[i][0] for i in full) + "."
    assert found(spark, text + "\n\nReleased under the MIT License.") == [(full + ["mit-notice"], ["MIT"])]
    back = ".\n\n".join(SENTENCES[i][0] for i in reversed(full)) + "."
    assert found(spark, back) == [(full[::-1], [])]
    assert all(rule in known_sentences().values() for _, ids in RULES for rule in ids)


def test_sentences_come_in_text_order(spark):
    """A list that starts right after its introduction, numbered or marked in several ways, and
    sentences that are only seen as lines between wrapped ones."""
    names = ["bsd-grant", "bsd-source", "bsd-binary", "bsd-names"]
    intro, *items = (SENTENCES[i][0] for i in names)
    for marks in (("1. ", "2. ", "3. "), ("   1. ", "   2. ", "   3. "), ("* ", "* ", "* "), ("(1) ", "(2) ", "(3) "),
                  ("a) ", "b) ", "c) "), (" * 1. ", " * 2. ", " * 3. ")):
        text = wrapped(intro) + ":\n" + "\n".join(m + wrapped(x) + "." for m, x in zip(marks, items, strict=True))
        assert found(spark, text) == [(names, ["BSD-3-Clause"])], marks
    header = ('Licensed under the Apache License, Version 2.0 (the "License");\nyou may not use this file except in '
              "compliance with the License.\nYou may obtain a copy of the License at\n\n    http://www.apache.org/licenses/LICENSE-2.0\n")
    assert found(spark, header) == [(["apache-header", "apache-copy"], ["Apache-2.0"])]
    mixed = "a line\nReleased under the MIT License\n" + wrapped(SENTENCES["mit-grant"][0]) + ".\nx\nLicensed under CC BY-NC 4.0"
    assert found(spark, mixed)[0][0][0] == "mit-notice" and found(spark, mixed)[0][0][-1] == "cc-by-nc-notice"


def test_edge_rows(spark):
    rows = [(None, None, "x"), (1, "", "x"), (2, "licen " * 50_000 + "\nReleased under the MIT License.", "x"),
            (2, "licen " * 50_000 + "\nReleased under the MIT License.", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, sentence_ids string")
    got = sorted((r.doc_id or 0, list(r.license_ids)) for r in license_scan(docs).collect())
    assert got == [(0, []), (1, []), (2, ["MIT"]), (2, ["MIT"])]
    assert license_scan(docs.limit(0)).count() == 0


def test_query_matches_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF0001}/documents.parquet')")
    df = op4_license_sentences(spark, SF0001)
    want = con.sql(oracle_op4())
    assert df.columns == want.columns
    assert sorted(map(tuple, df.collect())) == sorted(want.fetchall())


def test_common_licences_and_tags(spark):
    tags = sorted({name for name, _ in RULES} | {"LGPL-2.1-only", "AGPL-3.0-only", "MPL-2.0", "ISC", "Unlicense", "CC0-1.0",
                                                 "CC-BY-3.0", "CC-BY-NC-ND-2.5"})
    assert found_licences(spark, *[f"x = 1\n# SPDX-License-Identifier: {t}\ny" for t in tags]) == [[t] for t in tags]
    header = ("Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
              "compliance with the License. You may obtain a copy of the License at "
              "http://www.apache.org/licenses/LICENSE-2.0.")
    mpl = ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
           "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.")
    lgpl = ("This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
            "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or "
            "(at your option) any later version.")
    cc = "This work is licensed under a Creative Commons Attribution-ShareAlike 3.0 Unported License."
    free = "This is free and unencumbered software released into the public domain."
    assert found_licences(spark, header, mpl, wrapped(lgpl), cc, free) == [
        ["Apache-2.0"], ["MPL-2.0"], ["LGPL-2.1-or-later"], ["CC-BY-SA-3.0"], ["Unlicense"]]


def found_licences(spark, *texts):
    return [licences for _, licences in found(spark, *texts)]
