"""Licence scan by sentence rules.

Texts are cut into sentences, sentences are normalised and mapped to the identifiers
of known licence sentences, and the sequence of identifiers of a text is matched
against an ordered list of licence rules.  A rule that matches takes its identifiers
out of the sequence, so a longer rule, listed first, keeps a shorter one from
claiming the same sentences.

Everything is DataFrame functions over one row at a time: no shuffle, no Python on the
executors.  Defined results: null or empty text has no sentences and no licence;
repeated rows are scanned alike; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripaudit.llm.tables import table

# Wording of public licences and licence notices, one sentence each.
SENTENCES: dict[str, list[str]] = {
    "mit-notice": ["Released under the MIT License", "Licensed under the MIT License",
                   "This project is licensed under the MIT License", "SPDX-License-Identifier: MIT"],
    "mit-grant": ["Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                  "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
                  "including without limitation the rights to use, copy, modify, merge, publish, distribute, "
                  "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
                  "furnished to do so, subject to the following conditions:"],
    "mit-keep": ["The above copyright notice and this permission notice shall be included in all copies or "
                 "substantial portions of the Software"],
    "as-is": ["THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT "
              "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT"],
    "apache-notice": ["Licensed under the Apache License, Version 2.0", "SPDX-License-Identifier: Apache-2.0",
                      "Licensed under the Apache License, Version 2.0 (the \"License\")"],
    "apache-comply": ["you may not use this file except in compliance with the License"],
    "apache-copy": ["You may obtain a copy of the License at",
                    "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
                    "You may obtain a copy of the License at https://www.apache.org/licenses/LICENSE-2.0"],
    # The header with its line breaks collapsed: no sentence ends at a semicolon, as the GPL's hold some.
    "apache-header": ["Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
                      "except in compliance with the License"],
    "gpl3-notice": ["This work is licensed under the GNU General Public License, version 3",
                    "Licensed under the GNU General Public License, version 3", "SPDX-License-Identifier: GPL-3.0-only"],
    "gpl-grant": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                  "General Public License as published by the Free Software Foundation, either version 3 of the "
                  "License, or (at your option) any later version"],
    "gpl2-grant": ["This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
                   "General Public License as published by the Free Software Foundation; either version 2 of the "
                   "License, or (at your option) any later version"],
    "gpl-warranty": ["This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
                     "even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE"],
    "bsd-grant": ["Redistribution and use in source and binary forms, with or without modification, are permitted "
                  "provided that the following conditions are met:"],
    "bsd-source": ["Redistributions of source code must retain the above copyright notice, this list of conditions "
                   "and the following disclaimer"],
    "bsd-binary": ["Redistributions in binary form must reproduce the above copyright notice, this list of conditions "
                   "and the following disclaimer in the documentation and/or other materials provided with the "
                   "distribution"],
    "bsd-names": ["Neither the name of the copyright holder nor the names of its contributors may be used to endorse "
                  "or promote products derived from this software without specific prior written permission"],
    "cc-by-nc-notice": ["Licensed under CC BY-NC 4.0", "This work is licensed under CC BY-NC 4.0",
                        "SPDX-License-Identifier: CC-BY-NC-4.0"],
    "cc-by-sa-notice": ["Licensed under CC BY-SA 4.0", "This work is licensed under CC BY-SA 4.0",
                        "SPDX-License-Identifier: CC-BY-SA-4.0"],
    "cc-by-notice": ["Licensed under CC BY 4.0", "This work is licensed under CC BY 4.0",
                     "SPDX-License-Identifier: CC-BY-4.0"],
}
_GPL_FORM = ("This {} is free software{} you can redistribute it and/or modify it under the terms of the GNU {} Public "
             "License as published by the Free Software Foundation{} either version {} of the License, or (at your "
             "option) any later version")


def _gnu(what: tuple[str, ...], family: str, version: str) -> list[str]:
    """The grant with colon and comma or with semicolons, which are blanks once normalised."""
    return [_GPL_FORM.format(w, a, family, b, version) for w in what for a, b in ((":", ","), (";", ";"))]


SENTENCES |= {
    "lgpl21-grant": _gnu(("library", "program", "software"), "Lesser General", "2.1"),
    "lgpl3-grant": _gnu(("library", "program", "software"), "Lesser General", "3"),
    "agpl3-grant": _gnu(("program", "software"), "Affero General", "3"),
    # The abbreviated "v." ends a sentence; the address tells the version.
    "mpl-subject": ["This Source Code Form is subject to the terms of the Mozilla Public License, v"],
    "mpl2-copy": ["If a copy of the MPL was not distributed with this file, You can obtain one at "
                  "https://mozilla.org/MPL/2.0/",
                  "If a copy of the MPL was not distributed with this file, You can obtain one at "
                  "http://mozilla.org/MPL/2.0/"],
    "isc-grant": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
                  "is hereby granted, provided that the above copyright notice and this permission notice appear in "
                  "all copies",
                  "Permission to use, copy, modify, and distribute this software for any purpose with or without fee "
                  "is hereby granted, provided that the above copyright notice and this permission notice appear in "
                  "all copies"],
    "unlicense-grant": ["This is free and unencumbered software released into the public domain"],
    "cc0-grant": ["To the extent possible under law, the author(s) have dedicated all copyright and related and "
                  "neighboring rights to this software to the public domain worldwide"],
}
#: Licences by the names that notices of one sentence give them; each also has its SPDX tag.
NAMES: dict[str, list[str]] = {
    "MIT": [], "Apache-2.0": [],
    "BSD-2-Clause": ["BSD 2-Clause License"], "BSD-3-Clause": ["BSD 3-Clause License"],
    "GPL-2.0-only": ["GNU General Public License, version 2"], "GPL-2.0-or-later": [],
    "GPL-3.0-only": [], "GPL-3.0-or-later": [],
    "LGPL-2.1-only": ["GNU Lesser General Public License, version 2.1"], "LGPL-2.1-or-later": [],
    "LGPL-3.0-only": ["GNU Lesser General Public License, version 3"], "LGPL-3.0-or-later": [],
    "AGPL-3.0-only": ["GNU Affero General Public License, version 3"], "AGPL-3.0-or-later": [],
    "MPL-2.0": ["Mozilla Public License, version 2.0", "Mozilla Public License 2.0"],
    "ISC": ["ISC License"], "Unlicense": ["Unlicense"], "CC0-1.0": ["CC0 1.0", "CC0 1.0 Universal"],
}
_PARTS = {"BY": "Attribution", "NC": "NonCommercial", "SA": "ShareAlike", "ND": "NoDerivatives"}
_PORTS = {"4.0": "International", "3.0": "Unported", "2.5": "Generic", "2.0": "Generic", "1.0": "Generic"}
for _kind in ("BY-NC-ND", "BY-NC-SA", "BY-NC", "BY-ND", "BY-SA", "BY"):
    for _version, _port in _PORTS.items():
        _long = "-".join(_PARTS[x] for x in _kind.split("-"))
        NAMES[f"CC-{_kind}-{_version}"] = [
            f"CC {_kind} {_version}", f"a Creative Commons {_long} {_version} {_port} License",
            f"the Creative Commons {_long} {_version} {_port} License"]

#: Ordered: a licence and the sentence identifiers that show it, in text order.
RULES: list[tuple[str, list[str]]] = [
    ("MIT", ["mit-grant", "mit-keep", "as-is"]),
    ("Apache-2.0", ["apache-notice", "apache-comply", "apache-copy"]),
    ("GPL-3.0-or-later", ["gpl-grant", "gpl-warranty"]),
    ("GPL-2.0-or-later", ["gpl2-grant", "gpl-warranty"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-names"]),
    ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary"]),
    ("MIT", ["mit-notice"]),
    ("Apache-2.0", ["apache-notice"]),
    ("GPL-3.0-only", ["gpl3-notice"]),
    ("GPL-3.0-or-later", ["gpl-grant"]),
    ("GPL-2.0-or-later", ["gpl2-grant"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-notice"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-notice"]),
    ("CC-BY-4.0", ["cc-by-notice"]),
    ("Apache-2.0", ["apache-header", "apache-copy"]),
    ("Apache-2.0", ["apache-header"]),
    ("LGPL-2.1-or-later", ["lgpl21-grant"]),
    ("LGPL-3.0-or-later", ["lgpl3-grant"]),
    ("AGPL-3.0-or-later", ["agpl3-grant"]),
    ("MPL-2.0", ["mpl-subject", "mpl2-copy"]),
    ("MPL-2.0", ["mpl2-copy"]),
    ("ISC", ["isc-grant"]),
    ("Unlicense", ["unlicense-grant"]),
    ("CC0-1.0", ["cc0-grant"]),
]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Sentences end at closing punctuation before white space, at a colon that ends a line or at an
#: empty line; one that is not known may hold notices on lines of their own.
SENTENCE = r"[.!?]+[ \t\r\n]+|:[ \t\r]*\n|\n[ \t\r]*\n"
LINE = r"\n+"
#: The number of a list's next item, whose point has ended the sentence before it, and the mark
#: in front of an item.
NEXT_ITEM = r"\n[ \t*/#;-]*\(?([0-9]{1,2}|[a-z])\z"
ITEM = r"^[^a-z0-9]*([0-9]{1,2}|[a-z])\)[ \t]+"


def normalised(s: str) -> str:
    """Lower-case A-Z; everything but letters and digits is one space."""
    return " ".join("".join(c if c.isascii() and c.isalnum() else " " for c in s.lower()).split())


def known_sentences() -> dict[str, str]:
    """Normalised sentence -> identifier."""
    return {normalised(s): k for k, group in SENTENCES.items() for s in group}


# Notices and tags of NAMES that are not listed above already.
_listed = set(known_sentences())
for _licence, _names in NAMES.items():
    _new = [x for n in _names for v in ("Licensed", "Released", "This work is licensed", "This project is licensed")
            for x in ([f"{v} under {n}"] if n.startswith(("CC", "a ", "the ")) else [f"{v} under the {n}"])]
    _new = [x for x in [*_new, f"SPDX-License-Identifier: {_licence}"] if normalised(x) not in _listed]
    if _new:
        SENTENCES[f"{_licence.lower()}-named"] = _new
        RULES.append((_licence, [f"{_licence.lower()}-named"]))

#: Words of which every known sentence holds one; texts without any are not cut up.
CUES = ["licen", "permi", "warranty", "copyright", "general public", "public domain", "of the mpl", "released under"]


def license_scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add ``sentence_ids`` and ``license_ids`` (arrays of strings, in text and rule order)."""
    known = known_sentences()
    if loose := [s for s in known if not any(c in s for c in CUES)]:
        raise ValueError(f"no cue for {loose}")
    low = F.translate(F.col(text), UPPER, LOWER)
    # One literal, folded to a map: normalised sentences hold neither "=" nor line ends.
    lookup = F.str_to_map(F.lit("\n".join(f"{k}={v}" for k, v in known.items())), F.lit("\n"), F.lit("="))

    def known_id(piece):
        bare = F.regexp_replace(F.regexp_replace(piece, NEXT_ITEM, ""), ITEM, "")
        return F.try_element_at(lookup, F.trim(F.regexp_replace(bare, "[^a-z0-9]+", " ")))

    def in_order(sentence):
        """The identifier of a sentence, or those of its lines: either way in its place."""
        whole = known_id(sentence)
        lines = F.filter(F.transform(F.split(sentence, LINE), known_id), lambda x: x.isNotNull())
        return F.when(whole.isNotNull(), F.array(whole)).otherwise(lines)

    ids = F.flatten(F.transform(F.split(low, SENTENCE), in_order))
    none = F.array().cast("array<string>")
    cue = F.lit(False)
    for c in CUES:
        cue = cue | F.contains(low, F.lit(c))
    out = docs.withColumn("sentence_ids", F.when(cue, ids).otherwise(none))
    # Sequences are written as |a|b|, so that identifiers only match whole.
    seq = F.concat(F.lit("|"), F.concat_ws("||", "sentence_ids"), F.lit("|"))
    rules = F.array(*[F.struct(F.lit(name).alias("name"), F.lit("".join(f"|{x}|" for x in ids)).alias("ids"))
                      for name, ids in RULES])
    found = F.aggregate(
        rules, F.struct(seq.alias("seq"), none.alias("found")),
        lambda acc, r: F.struct(
            F.replace(acc["seq"], r["ids"], F.lit("#")).alias("seq"),
            F.when(F.contains(acc["seq"], r["ids"]), F.array_append(acc["found"], r["name"]))
            .otherwise(acc["found"]).alias("found")),
        lambda acc: F.array_distinct(acc["found"]))
    return out.withColumn("license_ids", F.when(F.size("sentence_ids") > 0, found).otherwise(none))


def op4_license_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known licence sentences and licences of every document."""
    found = license_scan(table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select(
        "doc_id", F.size("sentence_ids").cast("bigint").alias("n_sentences"),
        F.concat_ws(",", "sentence_ids").alias("sentence_ids"),
        F.concat_ws(",", "license_ids").alias("license_ids"),
        (F.size("license_ids") > 0).alias("licensed"))


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _norm(piece: str) -> str:
    bare = f"regexp_replace(regexp_replace({piece}, '{NEXT_ITEM}', ''), '{ITEM}', '')"
    return f"trim(regexp_replace({bare}, '[^a-z0-9]+', ' ', 'g'))"


def oracle_op4() -> str:
    """The same scan in DuckDB: one joined sentence table, then one step per rule."""
    rows = ", ".join(f"({_quoted(s)}, {_quoted(k)})" for s, k in known_sentences().items())
    steps: list[str] = []
    at = "s0"
    for i, (name, ids) in enumerate(RULES, 1):
        pat = _quoted("".join(f"|{x}|" for x in ids))
        steps.append(f"s{i} AS (SELECT doc_id, ids, replace(seq, {pat}, '#') AS seq, CASE WHEN contains(seq, {pat}) "
                     f"AND NOT list_contains(found, {_quoted(name)}) THEN list_append(found, {_quoted(name)}) "
                     f"ELSE found END AS found FROM {at})")
        at = f"s{i}"
    return f"""
WITH known(sentence, id) AS (VALUES {rows}),
low AS (SELECT row_number() OVER () AS r, doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS low FROM documents),
cut AS (SELECT r, i, piece FROM (
  SELECT r, unnest(p) AS piece, unnest(range(len(p))) AS i FROM (SELECT r, string_split_regex(low, '{SENTENCE}') AS p FROM low))),
whole AS (SELECT r, i, 0 AS j, id FROM cut JOIN known ON sentence = {_norm("piece")}),
lines AS (SELECT r, i, j, id FROM (
  SELECT r, i, unnest(q) AS line, unnest(range(len(q))) AS j
  FROM (SELECT r, i, string_split_regex(piece, '{LINE}') AS q FROM cut ANTI JOIN whole USING (r, i)))
  JOIN known ON sentence = {_norm("line")}),
told AS (SELECT r, list(id ORDER BY i, j) AS ids FROM (SELECT * FROM whole UNION ALL SELECT * FROM lines) GROUP BY r),
named AS (SELECT doc_id, coalesce(ids, []::VARCHAR[]) AS ids FROM low LEFT JOIN told USING (r)),
s0 AS (SELECT doc_id, ids, '|' || array_to_string(ids, '||') || '|' AS seq, []::VARCHAR[] AS found FROM named),
{", ".join(steps)}
SELECT doc_id, len(ids)::BIGINT AS n_sentences, array_to_string(ids, ',') AS sentence_ids,
  array_to_string(found, ',') AS license_ids, len(found) > 0 AS licensed
FROM {at}"""
