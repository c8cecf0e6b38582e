"""String expressions for link harvesting.

Anchors are read the way an HTML parser reports them: comments, scripts and styles are
skipped (an unclosed one swallows the rest of the page), attribute values may be quoted
either way or bare and may hold ``>`` when quoted, the last ``href`` of a tag counts, a
bare ``href`` is empty, and character references are decoded once, left to right.

A page is cut in one pass by one pattern, and so is a tag into its attributes.  Every pattern
is possessive: it never gives back what it has read, so its time is linear in the page and its
stack depth does not depend on the length of a value.  A tag that is never closed is read to
the end of the page once and is no anchor.
"""

from __future__ import annotations

import html
import json
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What a page is cut into, in one pass: skipped markup, and the tags of anchors.
SKIPPED = r"<(?:!--(?s:.*?)(?:-->|\z)|script\b(?s:.*?)(?:</script\s*+>|\z)|style\b(?s:.*?)(?:</style\s*+>|\z))"
ATTRIBUTE = r"""[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s"'>][^\s>]*+)?+)?+"""
TOKEN = rf"(?i){SKIPPED}|<a(?:[\s/]++(?:{ATTRIBUTE})?+)*+(?:>|\z)"
REFERENCE = r"&(?:#[0-9]++;?+|#[xX][0-9a-fA-F]++;?+|[^\t\n\f <&#;]{1,32}+;?+)"
#: Names that are decoded without a closing semicolon too, longest first.
OPEN_NAMES = "|".join(sorted((n for n in html.entities.html5 if not n.endswith(";")), key=lambda n: (-len(n), n)))
#: References that pages are full of; they are told before the whole list is looked through.
USUAL = {"&amp;": "&", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&nbsp;": "\xa0", "&#39;": "'"}
#: Characters that the numbers 128 to 159 stand for, those of an older code page.
OLD_NUMBERS = [bytes([n]).decode("cp1252", "ignore") or chr(n) for n in range(0x80, 0xA0)]
#: What ``str.strip`` takes off: white space of all scripts.
STRIP_CHARS = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())


def quoted(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


# The expressions below are SQL texts: as Column calls, each would take hundreds of round trips
# to the JVM whenever a query is built.

def _raw_hrefs(col: str) -> str:
    """SQL of the raw (possibly quoted) href values of all anchors that have one, in document
    order; an empty string for a bare ``href``."""
    attributes = f"regexp_extract_all(substring(t, 3, length(t) - 3), {quoted(ATTRIBUTE)}, 0)"
    last = f"try_element_at(filter({attributes}, a -> a rlike {quoted(r'(?i)^href(?=[\s=]|\z)')}), -1)"
    value = f"regexp_replace({last}, {quoted(r'(?i)^href\s*+(?:=\s*+)?+')}, '')"
    tags = (f"filter(regexp_extract_all({col}, {quoted(TOKEN)}, 0), "
            f"t -> lower(left(t, 2)) = '<a' AND endswith(t, '>') AND t ilike '%href%')")
    return f"filter(transform({tags}, t -> {value}), v -> v IS NOT NULL)"


def _bound(name: str, value: str, body: str) -> str:
    """SQL of ``body`` with ``name`` standing for ``value``, worked out once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _character(code: str) -> str:
    """SQL of the character of a code point, as an HTML parser reads a numeric reference."""
    dropped = (f"{code} < 9 OR {code} = 11 OR {code} BETWEEN 14 AND 31 OR {code} = 127 "
               f"OR {code} BETWEEN 64976 AND 65007 OR {code} % 65536 >= 65534")
    old = ", ".join(quoted(c) for c in OLD_NUMBERS)
    return (f"CASE WHEN {code} IS NULL OR {code} = 0 OR {code} BETWEEN 55296 AND 57343 OR {code} > 1114111 THEN '\ufffd' "
            f"WHEN {code} BETWEEN 128 AND 159 THEN element_at(array({old}), CAST({code} - 127 AS INT)) "
            f"WHEN {dropped} THEN '' ELSE decode(unhex(lpad(hex({code}), 8, '0')), 'UTF-32') END")


def _decoded(ref: str) -> str:
    """SQL of one character reference, decoded; unknown ones are left as they are."""
    names = f"from_json({quoted(json.dumps(html.entities.html5))}, 'map<string,string>')"
    number = f"rtrim(';', {ref})"
    code = (f"try_cast(CASE WHEN lower(substring({ref}, 3, 1)) = 'x' THEN conv(substring({number}, 4), 16, 10) "
            f"ELSE substring({number}, 3) END AS BIGINT)")
    usual = " ".join(f"WHEN {quoted(r)} THEN {quoted(c)}" for r, c in USUAL.items())
    name = f"substring({ref}, 2)"
    opened = _bound("s", f"regexp_extract({name}, {quoted(f'^({OPEN_NAMES})')}, 1)",
                    f"if(s = '', {ref}, concat(try_element_at(n, s), substring({name}, length(s) + 1)))")
    return (f"CASE {ref} {usual} ELSE if(substring({ref}, 2, 1) = '#', {_bound('c', code, _character('c'))}, "
            f"{_bound('n', names, f'coalesce(try_element_at(n, {name}), {opened})')}) END")


def _attribute_value(raw: str) -> str:
    """SQL that unquotes a raw attribute value and decodes its character references."""
    ref = quoted(REFERENCE)
    joined = (f"array_join(flatten(zip_with(split(v, {ref}, -1), transform(regexp_extract_all(v, {ref}, 0), r -> {_decoded('r')}), "
              "(t, d) -> array(t, coalesce(d, '')))), '')")
    plain = f"if(left({raw}, 1) IN ('\"', '\\''), substring({raw}, 2, length({raw}) - 2), {raw})"
    return _bound("v", plain, f"if(contains(v, '&'), {joined}, v)")


def hrefs(col: str = "html") -> Column:
    """Array of the href values of all anchors that have one, in document order: unquoted,
    decoded, without white space around them; an empty string for a bare ``href``.

    The values leave the page as an array, so a filter on them sees finished values and the
    planner cannot copy their parsing into each of its terms."""
    return F.expr(f"transform({_raw_hrefs(col)}, h -> btrim({_attribute_value('h')}, {quoted(STRIP_CHARS)}))")


def last_segment(c: Column) -> Column:
    """Text after the last '/', the whole value when there is none."""
    return F.substring_index(c, "/", -1)


def contains_any(c: Column, tokens: Iterable[str]) -> Column:
    """TRUE when ``c`` contains at least one token (OR of ``contains``)."""
    toks = [str(t) for t in tokens]
    if not toks:
        return F.lit(False)
    out = c.contains(toks[0])
    for t in toks[1:]:
        out = out | c.contains(t)
    return out
