"""Conversation repair: cheapest edits against exhaustive search, rows against plain Python."""

import hashlib
import re
import zlib

import duckdb
import pytest
from conftest import SF001
from hypothesis import given, settings
from hypothesis import strategies as st

from tripaudit.llm.conversations import (
    ORACLE_OP13,
    cheapest,
    coded,
    damaged,
    op13_weighted_repair,
    repair_conversations,
    repair_digests,
    repair_plans,
    undamaged,
)

FORM = re.compile(r"(s?(ua)+)?")
LAYOUT = "conv_id long, turn long, role string, text string"


def exhaustive(rows, most=4):
    """(cost, letters, given roles) of the best of all edit scripts with few insertions."""
    best = []

    def go(i, cost, letters, roles, left):
        if best and (cost, letters) > best[0][:2] and cost > best[0][0]:
            return
        if i == len(rows) and FORM.fullmatch(roles) and (not best or (cost, letters) < best[0][:2]):
            best[:] = [(cost, letters, roles)]
        if left:
            for r in "ua":
                go(i, cost + 2, letters + "I", roles + r, left - 1)
        if i < len(rows):
            initial, fault = rows[i]
            go(i + 1, cost + 3, letters + "D", roles, left)
            if fault not in ("blank", "duplicate"):
                more = fault == "truncated"
                go(i + 1, cost + more, letters + "K", roles + initial, left)
                for r in "ua":
                    go(i + 1, cost + 2 + more, letters + "R", roles + r, left)

    go(0, 0, "", "", most)
    return best[0]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("suua?a"), st.sampled_from(["", "", "", "blank", "duplicate", "truncated"])),
                max_size=5))
def test_cheapest_equals_exhaustive_search(rows):
    assert cheapest(rows) == exhaustive(rows)[:2]


def test_known_repairs():
    assert cheapest([]) == (0, "")
    assert cheapest([("s", ""), ("u", ""), ("a", "")]) == (0, "KKK")
    assert cheapest([("u", "")]) == (2, "KI")
    assert cheapest([("a", "")]) == (2, "IK")
    assert cheapest([("u", ""), ("u", "")]) == (2, "KR")
    assert cheapest([("s", "")]) == (3, "D")
    cost, letters = cheapest([("u", ""), ("a", "truncated")] * 800)
    assert (cost, letters) == (800, "K" * 1600)


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        if kind == 1:
            text = ""
        elif kind == 2:
            text = re.sub("[.!?]", "", text)
        elif kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def brute(rows, repair=cheapest):
    """All columns of the query, conversation by conversation."""
    out, alive = [], damage(rows)
    for conv in {r[0] for r in rows}:
        mine = sorted((r for r in alive if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0))
        turns = [r[1] for r in mine if r[1] is not None]
        seen, codes = set(), []
        for _, _, role, text in mine:
            solid = re.sub(r"[\x20\x09-\x0D]", "", text)
            fault = ("blank" if not solid else "duplicate" if (role, text) in seen
                     else "truncated" if solid[-1] not in ".!?" else "")
            seen.add((role, text))
            codes.append((role[:1] if role[:1] in ("s", "u", "a") else "?", fault))
        cost, audit = repair(codes)
        said, i, state = [], 0, ""
        for edit in audit:
            asked = "assistant" if state == "u" else "user"
            if edit == "I":
                said.append(f"{asked}:")
                state = asked[0]
                continue
            role, text = mine[i][2:]
            i += 1
            if edit != "D":
                role = asked if edit == "R" else role
                said.append(f"{role}:{text}")
                state = role[0]
        initials = [r[2][:1] for r in mine]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
        faults = [sum(f == k for _, f in codes) for k in ("blank", "duplicate", "truncated")]
        out.append((conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *faults, illegal, cost, audit,
                    hashlib.sha256("\n".join(said).encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_query_equals_brute_force_and_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{SF001}/conversations.parquet'")
    out = got(op13_weighted_repair(spark, SF001))
    assert out == brute(con.sql("SELECT conv_id, turn, role, text FROM conversations").fetchall())
    assert out == sorted(con.sql(ORACLE_OP13).fetchall(), key=str)


EDGE = [(1, None, "user", "Hi."), (1, 3, "assistant", None), (1, 7, None, "what?"), (2, 0, "", ""), (2, 1, "tool", " \t "),
        (None, 0, "user", "one."), (None, 1, "assistant", "two!"), (None, None, "system", "three"),
        (3, 1, "user", "Same."), (3, 2, "user", "Same."), (3, 3, "user", "Same."), (4, -5, "user", "a. "),
        (4, 2**62, "assistant", "b.  \n"), (5, 0, "user", "x " * 50_000 + "."), (5, 1, "assistant", "y. " * 50_000)]


def test_edge_rows_and_damage(spark):
    rows = EDGE + [(c, t, "user" if t % 2 == 0 else "assistant", f"{c} {t}.") for c in range(10, 60) for t in range(4)]
    df = spark.createDataFrame([(*r, "x") for r in rows], f"{LAYOUT}, audit string")
    assert got(repair_digests(damaged(df))) == brute(rows)
    assert got(repair_digests(damaged(df.limit(0)))) == []
    dropped = [(c, 0, "user", "x.") for c in range(100) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    only = got(repair_digests(damaged(spark.createDataFrame(dropped, LAYOUT))))
    assert dropped and only == [(c, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for c in sorted((r[0] for r in dropped), key=str)]


@pytest.mark.parametrize("copies", [40])
def test_repeated_rows(spark, copies):
    rows = [(1, 0, "user", "Hi.")] * copies + [(1, 1, "assistant", "Yes.")] * copies + [(2, 5, "user", "Hi.")]
    plan = {r.conv_id: r for r in repair_plans(coded(undamaged(spark.createDataFrame(rows, LAYOUT)))).collect()}
    assert plan[1].duplicate == 2 * copies - 2 and plan[1].audit == "K" + "D" * (copies - 1) + "K" + "D" * (copies - 1)
    assert (plan[2].cost, plan[2].audit) == (2, "KI")


def test_repaired_rows_are_well_formed(spark):
    df = spark.read.parquet(f"{SF001}/conversations.parquet")
    hurt = damaged(df).where("_alive").select("conv_id", "turn", "role", "text")
    spoken = {}
    for r in sorted(repair_conversations(hurt).collect(), key=lambda r: (r.conv_id, r.turn)):
        spoken.setdefault(r.conv_id, []).append((r.role, r.text))
        assert r.turn == len(spoken[r.conv_id]) - 1
    assert len(spoken) > 90
    digests = {r.conv_id: r.repaired_sha256 for r in repair_digests(damaged(df)).collect()}
    for conv, said in spoken.items():
        assert FORM.fullmatch("".join(r[0] for r, _ in said))
        assert digests[conv] == hashlib.sha256("\n".join(f"{r}:{t}" for r, t in said).encode()).hexdigest()
