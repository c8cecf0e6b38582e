"""Conversation structure repair by a shortest path over scalar big-integer weights.

A conversation is well formed when the initials of its roles spell ``(s?(ua)+)?``.  Reading
them is an automaton of four states, and a repair is a path through rows and states: a row is
kept, given the role that the state asks for, or deleted, and turns with an empty text may be
inserted anywhere.  Among the cheapest repairs the one with the least string of edit letters
(D, I, K, R) wins.

Both are one integer: the high digits carry the cost, the low ones hold one letter per digit
in the order of the edits, in a fixed number of places, filled with zeros at the end, so a
string counts as less than any that goes on.  Going back from the end, putting a letter in
front is one shift and one sum, and the minimum of plain integers settles cost and ties at
once.  At most two insertions in a row can be part of a cheapest path, which keeps the graph
acyclic.  Every state asks for one role only, so the letters alone tell the repaired rows.

Spark does the rest: damage, faults and duplicates are column expressions and a window; rows
without their texts meet by conversation for the path, and rows with texts are then streamed
in order behind their conversation's edits into the hash.  A task holds a few bytes per row
of one conversation, and no texts beyond an Arrow batch.  A path of n rows costs n * n / 16
machine words of arithmetic (6 s for 20,000 rows); a conversation is one string of
edits and one hash, so it stays one task's work however long it is.

Defined results: nulls in role and text read as one blank, also in the number that decides the
damage; rows whose conversation is null are one conversation; a null turn sorts first; rows of
one turn are ordered by role and then text (both by hash); gaps beyond a long are cut to it; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripaudit.llm.tables import table

# Costs of the edits, and of leaving a truncated row in place.
RETAG, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
# White space of a blank text, and the marks that end a sentence.
BLANK, ENDS = r"\x20\x09-\x0D", ".!?"
#: Letters in order; a digit of 0 is the end.
LETTERS = "DIKR"
BITS = 3
D, I, K, R = range(1, 5)
START, AFTER_S, AFTER_U, AFTER_A = range(4)
#: Role that a state asks for, and the state after it.
ASKED = {START: ("u", AFTER_U), AFTER_S: ("u", AFTER_U), AFTER_U: ("a", AFTER_A), AFTER_A: ("u", AFTER_U)}
ROLES = {"u": "user", "a": "assistant"}
ACCEPTED = (START, AFTER_A)
LEGAL = {"su", "ua", "au"}
# A row's code: its role's initial (s, u, a or another) and fault, as one byte.
INITIALS = "sua?"
FAULTS = ("", "blank", "duplicate", "truncated")
#: Paths that a task remembers, of conversations of up to so many rows.
REMEMBERED, LONGEST = 100_000, 64


def after(state: int, initial: str) -> int | None:
    """State after a row, or None where it is not allowed."""
    if initial == "s":
        return AFTER_S if state == START else None
    asked, then = ASKED[state]
    return then if initial == asked else None


def cheapest(rows: list[tuple[str, str]]) -> tuple[int, str]:
    """Cost and edit letters of the best repair of rows (initial, fault)."""
    places = 3 * len(rows) + 2  # a letter for every row, two insertions before each and at the end
    low = BITS * places
    first = low - BITS
    mask = (1 << low) - 1

    def put(cost: int, letter: int, rest: int | None) -> int | None:
        """The weight of a path that begins with an edit."""
        if rest is None:
            return None
        return ((rest >> low) + cost << low) | letter << first | (rest & mask) >> BITS

    def least(*weights: int | None) -> int | None:
        return min((w for w in weights if w is not None), default=None)

    def with_insertions(plain: list[int | None]) -> list[int | None]:
        best = plain
        for _ in range(2):
            best = [least(plain[q], put(INSERT, I, best[ASKED[q][1]])) for q in range(4)]
        return best

    best = with_insertions([0 if q in ACCEPTED else None for q in range(4)])
    for initial, fault in reversed(rows):
        extra = TRUNCATED if fault == "truncated" else 0
        plain = []
        for q in range(4):
            w = put(DELETE, D, best[q])
            if fault not in ("blank", "duplicate"):
                if (then := after(q, initial)) is not None:
                    w = least(w, put(extra, K, best[then]))
                w = least(w, put(RETAG + extra, R, best[ASKED[q][1]]))
            plain.append(w)
        best = with_insertions(plain)
    weight = best[START]
    letters = []
    for at in range(first, -1, -BITS):
        if not (digit := weight >> at & (1 << BITS) - 1):
            break
        letters.append(LETTERS[digit - 1])
    return weight >> low, "".join(letters)


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations (conv_id, turn, role, text) after damage, with ``_alive`` false for the
    rows that it dropped, so that no conversation is forgotten."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    text = F.coalesce("text", F.lit(" "))
    kind = F.crc32(key.cast("binary")) % 20
    return (rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), text.alias("text"),
                        kind.alias("_kind"))
            .select("conv_id", "turn", F.when(F.col("_kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
                    F.when(F.col("_kind") == 1, F.lit(""))
                    .when(F.col("_kind") == 2, F.regexp_replace("text", f"[{ENDS}]", ""))
                    .otherwise(F.col("text")).alias("text"),
                    (F.col("_kind") != 0).alias("_alive"),
                    F.explode(F.when(F.col("_kind") == 3, F.array(F.lit(0), F.lit(1)))
                              .otherwise(F.array(F.lit(0)))).alias("_copy")))


def coded(rows: DataFrame) -> DataFrame:
    """Rows with what their faults and order depend on: ``_initial``, ``_blank``,
    ``_truncated`` and ``_order`` (a hash of role and text)."""
    said = F.concat_ws(":", F.length("role").cast("string"), "role", "text")
    return (rows.withColumn("_initial", F.substring("role", 1, 1))
            .withColumn("_blank", ~F.col("text").rlike(f"[^{BLANK}]"))
            .withColumn("_truncated", ~F.col("text").rlike(f"[{ENDS}][{BLANK}]*\\z"))
            .withColumn("_order", F.unhex(F.sha2(said, 256))))


def _turn_order() -> list:
    return [F.col("turn").asc_nulls_first(), F.col("role"), F.col("_order"), F.col("_copy")]


def _partitions(rows: DataFrame) -> int:
    return int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))


class Path:
    """What is known of a conversation while its rows pass by."""

    def __init__(self, key):
        self.key, self.codes, self.turns = key, bytearray(), 0
        self.low = self.high = self.turn = None
        self.illegal, self.before = 0, None

    def add(self, turn, initial, fault):
        self.codes.append(INITIALS.index(initial if initial in "sua" and initial else "?") << 2 | fault)
        if self.before is not None and self.before + initial not in LEGAL:
            self.illegal += 1
        self.before = initial
        if turn is not None and turn != self.turn:
            self.turns, self.turn = self.turns + 1, turn
            self.low, self.high = turn if self.low is None else self.low, turn

    def rows(self) -> list[tuple[str, str]]:
        return [(INITIALS[c >> 2], FAULTS[c & 3]) for c in self.codes]

    def result(self, known: dict) -> tuple:
        codes = bytes(self.codes)
        if (found := known.get(codes)) is None:
            found = cheapest(self.rows())
            if len(codes) <= LONGEST and len(known) < REMEMBERED:
                known[codes] = found
        gaps = 0 if self.low is None else min(self.high - self.low + 1 - self.turns, 2**63 - 1)
        faults = [sum(c & 3 == k for c in codes) for k in (1, 2, 3)]
        return self.key, gaps, *faults, self.illegal, *found


PLAN = ("conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, "
        "cost bigint, audit string")
RESULT = f"{PLAN}, repaired_sha256 string"


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.string() if n in ("audit", "repaired_sha256", "role", "text") else pa.int64() for n in names]
    columns = zip(*rows, strict=True) if rows else [[] for _ in names]
    return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def _names(ddl: str) -> list[str]:
    return [c.split()[0] for c in ddl.split(",")]


def repair_plans(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``coded`` rows: its counts, cost and edit letters."""
    # One exchange by conversation serves the window (whose keys begin with it) and the path.
    here = (rows.select("conv_id", "turn", "role", "_initial", "_blank", "_truncated", "_order", "_copy", "_alive")
            .repartition(_partitions(rows), "conv_id"))
    seen = Window.partitionBy("conv_id", "_order").orderBy(
        F.col("_alive").desc(), F.col("turn").asc_nulls_first(), "_copy")
    flagged = (here.withColumn("_again", F.row_number().over(seen) > 1)
               .withColumn("_fault", F.when(F.col("_blank"), F.lit(1)).when(F.col("_again"), F.lit(2))
                           .when(F.col("_truncated"), F.lit(3)).otherwise(F.lit(0)))
               .sortWithinPartitions(F.col("conv_id"), *_turn_order())
               .select("conv_id", "turn", "_initial", "_fault", "_alive"))

    def plan(batches):
        known: dict[bytes, tuple[int, str]] = {}
        now, out = None, []
        for batch in batches:
            for key, turn, initial, fault, alive in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now is None or key != now.key:
                    if now is not None:
                        out.append(now.result(known))
                    now = Path(key)
                if alive:
                    now.add(turn, initial, fault)
            yield _batch(out, _names(PLAN))
            out = []
        if now is not None:
            yield _batch([now.result(known)], _names(PLAN))

    return flagged.mapInArrow(plan, PLAN)


def _in_order(plans: DataFrame, rows: DataFrame) -> DataFrame:
    """Every conversation's plan, followed by its rows in order, in sorted partitions."""
    heads = plans.withColumn("_head", F.lit(0))
    tails = rows.where("_alive").withColumn("_head", F.lit(1))
    return (heads.unionByName(tails.select("conv_id", "_head", "turn", "role", "text", "_order", "_copy"),
                              allowMissingColumns=True)
            .repartition(_partitions(rows), "conv_id")
            .sortWithinPartitions(F.col("conv_id"), F.col("_head"), *_turn_order()))


def _edited(batches, columns: list[str]):
    """Walk sorted heads and rows: yields ("plan", values) at a head, ("row", (role, text)) for
    every repaired row and ("end", None) after a conversation's last."""
    wide = len(columns)
    edits, at, state, opened = "", 0, START, False

    def inserted():
        nonlocal at, state
        while at < len(edits) and edits[at] == "I":
            role, state = ASKED[state]
            at += 1
            yield "row", (ROLES[role], "")

    for batch in batches:
        for values in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            head, role, text = values[wide:]
            if head == 0:
                if opened:
                    yield "end", None
                opened = True
                yield "plan", values[:wide]
                edits, at, state = values[wide - 1], 0, START
                yield from inserted()
                continue
            edit = edits[at]
            at += 1
            if edit == "K":
                state = after(state, role[:1])
                yield "row", (role, text)
            elif edit == "R":
                initial, state = ASKED[state]
                yield "row", (ROLES[initial], text)
            yield from inserted()
    if opened:
        yield "end", None


def repair_digests(conversations: DataFrame) -> DataFrame:
    """Counts, cost, edits and the hash of the repaired rows of every conversation, for rows
    (conv_id, turn, role, text, _alive, _copy)."""
    rows = coded(conversations)
    ordered = _in_order(repair_plans(rows), rows).select(*_names(PLAN), "_head", "role", "text")

    def digest(batches):
        out, plan, hashed, first = [], None, None, True
        for what, values in _edited(batches, _names(PLAN)):
            if what == "plan":
                plan, hashed, first = values, hashlib.sha256(), True
            elif what == "row":
                hashed.update((("" if first else "\n") + ":".join(values)).encode())
                first = False
            else:
                out.append((*plan, hashed.hexdigest()))
                if len(out) == 1000:
                    yield _batch(out, _names(RESULT))
                    out = []
        yield _batch(out, _names(RESULT))

    return ordered.mapInArrow(digest, RESULT)


def undamaged(conversations: DataFrame) -> DataFrame:
    """Rows as they are, in the layout of ``damaged``."""
    return conversations.select(
        "conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
        F.lit(True).alias("_alive"), F.lit(0).alias("_copy"))


def repair_conversations(conversations: DataFrame) -> DataFrame:
    """The repaired rows (conv_id, turn from 0, role, text) of conversations as they are."""
    rows = coded(undamaged(conversations))
    ordered = _in_order(repair_plans(rows), rows).select(*_names(PLAN), "_head", "role", "text")

    def write(batches):
        out, key, turn = [], None, 0
        for what, values in _edited(batches, _names(PLAN)):
            if what == "plan":
                key, turn = values[0], 0
            elif what == "row":
                out.append((key, turn, *values))
                turn += 1
                if len(out) == 1000:
                    yield _batch(out, ["conv_id", "turn", "role", "text"])
                    out = []
        yield _batch(out, ["conv_id", "turn", "role", "text"])

    return ordered.mapInArrow(write, "conv_id bigint, turn bigint, role string, text string")


def op13_weighted_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, damaged by rule and repaired."""
    return repair_digests(damaged(table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")))


def _oracle() -> str:
    """The same result in SQL: costs and letters as one string of six digits and the letters,
    whose least in string order is the cheapest repair."""
    def put(cost, letter, rest):
        return f"(lpad((substr({rest}, 1, 6)::INT + {cost})::VARCHAR, 6, '0') || '{letter}' || substr({rest}, 7))"

    asked = (3, 3, 4, 3)
    row = [f"least({put(3, 'D', f'b[{q}]')}, CASE WHEN fault < 2 THEN least({put('2 + fault', 'R', f'b[{a}]')}, "
           f"CASE WHEN initial = '{'uuau'[q - 1]}' THEN {put('fault', 'K', f'b[{a}]')} END"
           + (f", CASE WHEN initial = 's' THEN {put('fault', 'K', 'b[2]')} END" if q == 1 else "") + ") END)"
           for q, a in enumerate(asked, 1)]

    def insertions(source, before):
        return "[" + ", ".join(f"least(p[{q}], {put(2, 'I', f'{before}[{a}]')})" for q, a in enumerate(asked, 1)) + f"] FROM ({source})"

    def inserted(source):
        """Two rounds over a source with columns c, i and p."""
        return f"SELECT c, i, {insertions(f'SELECT c, i, p, {insertions(source, "p").replace("] FROM", "] AS o FROM", 1)}', 'o')}"

    return rf"""
WITH RECURSIVE step(i, k, v) AS (
  SELECT range, 0, range FROM range(256)
  UNION ALL
  SELECT i, k + 1, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END FROM step WHERE k < 8),
steps AS (SELECT list(v ORDER BY i) AS t FROM step WHERE k = 8),
keyed AS (SELECT dense_rank() OVER (ORDER BY conv_id) AS c, conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations),
dealt AS (SELECT c, turn, role, text, xor(list_reduce(
      list_prepend(4294967295, list_transform(range(1, strlen(key) + 1), lambda i: ('0x' || substr(hex(key), 2 * i - 1, 2))::BIGINT)),
      lambda c, x: xor(c // 256, t[xor(c, x) % 256 + 1])), 4294967295) % 20 AS kind FROM keyed, steps),
rows AS (SELECT c, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy FROM dealt WHERE kind <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, text, copy) AS i,
    row_number() OVER (PARTITION BY c, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again FROM rows),
coded AS (SELECT c, i, turn, role, text, substr(role, 1, 1) AS initial,
    CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 2 WHEN again THEN 3
         WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 1 ELSE 0 END AS fault FROM placed),
lined AS (SELECT *, lag(initial) OVER (PARTITION BY c ORDER BY i) || initial AS pair FROM coded),
counted AS (SELECT c, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 2) AS blank, count(*) FILTER (fault = 3) AS duplicate, count(*) FILTER (fault = 1) AS truncated,
    count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM lined GROUP BY c),
path(c, i, b) AS (
  {inserted("SELECT c, n AS i, ['000000', NULL, NULL, '000000'] AS p FROM counted")}
  UNION ALL
  {inserted("SELECT c, i - 1 AS i, [" + ", ".join(row) + "] AS p FROM path JOIN coded USING (c, i)")}),
plan AS (SELECT c, substr(b[1], 1, 6)::BIGINT AS cost, substr(b[1], 7) AS audit FROM path WHERE i = 0),
walk(c, pos, i, q, said) AS (
  SELECT c, 1, 1, 1, []::VARCHAR[] FROM plan
  UNION ALL
  SELECT w.c, pos + 1, CASE WHEN e = 'I' THEN w.i ELSE w.i + 1 END,
    CASE WHEN e = 'D' THEN q WHEN e = 'K' AND initial = 's' THEN 2 WHEN q = 3 THEN 4 ELSE 3 END,
    CASE WHEN e = 'D' THEN said WHEN e = 'K' THEN list_append(said, role || ':' || text)
         ELSE list_append(said, CASE WHEN q = 3 THEN 'assistant' ELSE 'user' END || ':' || CASE WHEN e = 'R' THEN text ELSE '' END) END
  FROM (SELECT walk.*, substr(audit, pos, 1) AS e, length(audit) AS n FROM walk JOIN plan USING (c)) w
  LEFT JOIN coded ON coded.c = w.c AND coded.i = w.i WHERE pos <= n),
told AS (SELECT c, array_to_string(arg_max(said, pos), chr(10)) AS said FROM walk GROUP BY c)
SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost,
  coalesce(audit, '') AS audit, sha256(coalesce(said, '')) AS repaired_sha256
FROM (SELECT DISTINCT c, conv_id FROM keyed) LEFT JOIN counted USING (c) LEFT JOIN plan USING (c) LEFT JOIN told USING (c)"""


ORACLE_OP13 = _oracle()
