"""Personal data by anchor expansion.

An Aho-Corasick automaton finds short anchors in one pass over a text: at-signs, plus
signs before digits, digits joined by a dot, blank or hyphen, schemes and identifier cues.
At each anchor a small deterministic parser expands to the boundaries of the candidate and
validates it.  A parser looks no further than the candidate it reads, and the text it has
read is not read again for the same kind.

Kinds ``email``, ``ip``, ``card`` and ``phone`` follow fixed grammars, leftmost and
without overlap per kind: an ip has four parts of at most 255, a card 14 to 19 digits with
a valid Luhn sum, a phone 10 to 15 digits.  The method adds ``url`` (a scheme and a
validated host), ``iban`` (mod-97 check) and ``account`` (a cue and an identifier).

Defined results: null or empty text has no spans; offsets are code points, end exclusive;
repeated rows give the same spans; columns of the input named ``spans`` are replaced.
"""

from __future__ import annotations

import re
from functools import cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripaudit.llm.tables import pieces, table

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "url", "iban", "account")
RANK = {k: i for i, k in enumerate(KINDS)}
SPANS = "array<struct<kind:string,start:int,end:int>>"

# Fixed values of the grammars.
DIGITS = frozenset("0123456789")
LETTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
LOCAL = DIGITS | LETTERS | frozenset("._%+-")
LABEL = DIGITS | LETTERS | frozenset("-")
PHONE = DIGITS | frozenset(" ().-")
URL_STOP = frozenset(" \t\r\n\x0b\x0c<>\"'`{}|\\^")
SCHEMES = ("http://", "https://", "ftp://", "ssh://")
CUES = ("account", "acct", "konto", "compte", "cuenta", "passport", "ssn")


@cache
def automaton() -> ahocorasick.Automaton:
    """Anchor string -> (parser, length), built once per worker."""
    a = ahocorasick.Automaton()
    digits = sorted(DIGITS)
    anchors = {"@": "email"} | {f"+{d}": "phone" for d in digits}
    anchors |= {f"{x}.{y}": "ip" for x in digits for y in digits}
    anchors |= {f"{x}{gap}{y}": "card" for x in digits for y in digits for gap in ("", " ", "-")}
    anchors |= {form: "url" for s in SCHEMES for form in (s, s.upper())}
    for cue, kind in [("iban", "iban"), *((c, "account") for c in CUES)]:
        anchors |= {form: kind for form in (cue, cue.title(), cue.upper())}
    for text, kind in anchors.items():
        a.add_word(text, (kind, len(text)))
    a.make_automaton()
    return a


def run_right(t: str, i: int, allowed: frozenset[str]) -> int:
    n = len(t)
    while i < n and t[i] in allowed:
        i += 1
    return i


def run_left(t: str, i: int, floor: int, allowed: frozenset[str]) -> int:
    while i > floor and t[i - 1] in allowed:
        i -= 1
    return i


# A parser takes the text, the anchor's start and the end of what was read before for its
# kind; it returns (start, end, valid) of the candidate, or None.

def parse_email(t: str, i: int, floor: int):
    start = run_left(t, i, floor, LOCAL)
    end = run_right(t, i + 1, LABEL)
    if start == i or end == i + 1:
        return None
    labels = 1
    while end < len(t) and t[end] == "." and (more := run_right(t, end + 1, LABEL)) > end + 1:
        end, labels = more, labels + 1
    return (start, end, True) if labels > 1 else None


def parse_ip(t: str, i: int, floor: int):
    start = run_left(t, i, floor, DIGITS)
    at, parts = run_right(t, i, DIGITS), 1
    small = len(t[start:at].lstrip("0")) <= 3 and int(t[start:at][-3:]) <= 255
    while parts < 4:
        if at >= len(t) or t[at] != "." or (end := run_right(t, at + 1, DIGITS)) == at + 1:
            return start, at, False
        small = small and len(t[at + 1:end].lstrip("0")) <= 3 and int(t[at + 1:end][-3:]) <= 255
        at, parts = end, parts + 1
    return start, at, small


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def parse_card(t: str, i: int, floor: int):
    end = i + 1
    digits = [t[i]]
    while end < len(t):
        if t[end] in DIGITS:
            at = end
        elif t[end] in " -" and end + 1 < len(t) and t[end + 1] in DIGITS:
            at = end + 1
        else:
            break
        digits.append(t[at])
        end = at + 1
    return i, end, 14 <= len(digits) <= 19 and luhn("".join(digits))


def parse_phone(t: str, i: int, floor: int):
    end = run_right(t, i + 2, PHONE)
    while end > i + 2 and t[end - 1] not in DIGITS:
        end -= 1
    if end < i + 4:
        return None
    return i, end, 10 <= sum(c in DIGITS for c in t[i:end]) <= 15


def parse_url(t: str, i: int, floor: int):
    host = t.index("://", i) + 3
    end = host
    while end < len(t) and t[end] not in URL_STOP:
        end += 1
    while end > host and t[end - 1] in ".,;:!?)]":
        end -= 1
    name = re.split(r"[/?#]", t[host:end], maxsplit=1)[0].rsplit("@", 1)[-1].split(":", 1)[0]
    valid = "." in name and all(x and x[0] != "-" and x[-1] != "-" for x in name.split("."))
    return i, end, valid


def after_cue(t: str, i: int) -> int:
    """First place after a cue and its separators ("no.", "number", ":", "#", blanks)."""
    return re.compile(r"(?:[ \t]*(?:number|num|no|nr)\b\.?)?[ \t]*[:#=]?[ \t]*", re.I).match(t, i).end()


def parse_iban(t: str, i: int, floor: int):
    start = after_cue(t, i + 4)
    m = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}").match(t, start)
    if not m:
        return None
    value = m[0].replace(" ", "")
    return start, m.end(), int("".join(str(int(c, 36)) for c in value[4:] + value[:4])) % 97 == 1


def parse_account(t: str, i: int, floor: int):
    cue = run_right(t, i, LETTERS)
    if i and t[i - 1] in LETTERS or t[i:cue].lower() not in CUES:
        return None
    start = after_cue(t, cue)
    m = re.compile(r"[A-Z]{0,3}[0-9](?:-?[0-9A-Z]){4,33}(?![A-Za-z0-9])").match(t, start)
    if not m:
        return None
    return start, m.end(), sum(c in DIGITS for c in m[0]) >= 5


PARSERS = {"email": parse_email, "ip": parse_ip, "card": parse_card, "phone": parse_phone,
           "url": parse_url, "iban": parse_iban, "account": parse_account}


def find_spans(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) of all personal data in a text, by start and kind."""
    if not text:
        return []
    read = dict.fromkeys(KINDS, 0)
    out = []
    for last, (kind, size) in automaton().iter(text):
        start = last + 1 - size
        if start < read[kind]:
            continue
        if found := PARSERS[kind](text, start, read[kind]):
            begin, end, valid = found
            read[kind] = end
            if valid:
                out.append((kind, begin, end))
    out.sort(key=lambda s: (s[1], RANK[s[0]]))
    return out


def redact(text: str | None, spans: list[tuple[str, int, int]]) -> str | None:
    """Replace every span, overlapping ones together, by the kind of the first."""
    if not spans:
        return text
    out, at, i = [], 0, 0
    while i < len(spans):
        kind, start, end = spans[i]
        while i + 1 < len(spans) and spans[i + 1][1] < end:
            i += 1
            end = max(end, spans[i][2])
        out += [text[at:start], f"<{kind.upper()}>"]
        at, i = end, i + 1
    return "".join([*out, text[at:]])


def pii_spans(docs: DataFrame) -> DataFrame:
    """Add ``spans`` (kind, start, end) to every document."""
    def scan(batches):
        for batch in batches:
            for part in pieces(batch):
                spans = [[{"kind": k, "start": a, "end": b} for k, a, b in find_spans(t)]
                         for t in part.column("text").to_pylist()]
                cols = dict(zip(part.schema.names, part.columns, strict=True))
                cols["spans"] = pa.array(spans, part.schema.field("spans").type)
                yield pa.record_batch(list(cols.values()), list(cols))

    blank = docs.withColumn("spans", F.array().cast(SPANS))
    return blank.mapInArrow(scan, blank.schema)


def redact_documents(docs: DataFrame) -> DataFrame:
    """Documents with personal data replaced by its kind, and ``n_chars`` brought up to date."""
    def scan(batches):
        for batch in batches:
            for part in pieces(batch):
                texts = part.column("text").to_pylist()
                cols = dict(zip(part.schema.names, part.columns, strict=True))
                cols["text"] = pa.array([redact(t, find_spans(t)) for t in texts], pa.string())
                yield pa.record_batch(list(cols.values()), list(cols))

    out = docs.mapInArrow(scan, docs.schema)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def op3_pii_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    found = pii_spans(table(spark, sf_dir, "documents", "doc_id", "text"))

    def joined(spans):
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))

    def number(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    return found.select("doc_id", *[number(k) for k in BASE], F.sha2(joined(base), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"))
