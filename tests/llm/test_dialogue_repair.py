"""Conversation repair against all edit sequences of small cases and a plain suffix recursion."""

import hashlib
import itertools
import random
import re
import sys
from functools import lru_cache

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from surgecast.llm import dialogue_repair as dr

sys.setrecursionlimit(20_000)
KIND = "conv_id long, turn long, role string, text string"


def by_all_edits(initials, kinds):
    """(cost, audit) over every sequence of edits with up to two inserted rows in each gap."""
    gaps = [g for n in range(3) for g in itertools.product("ua", repeat=n)]
    best = None
    for fill in itertools.product(gaps, repeat=len(initials) + 1):
        for picks in itertools.product(["K", "Ru", "Ra", "D"], repeat=len(initials)):
            cost, audit, out = 3 * len(fill[0]), "I" * len(fill[0]), "".join(fill[0])
            for x, kind, pick, after in zip(initials, kinds, picks, fill[1:]):
                if kind == dr.MUST_GO and pick != "D":
                    cost = None
                    break
                cost += {"K": 0, "R": 3, "D": 4}[pick[0]] + 3 * (kind == dr.CUT_OFF and pick != "D") + 3 * len(after)
                audit += pick[0] + "I" * len(after)
                out += {"K": x or "?", "D": ""}.get(pick, pick[1:]) + "".join(after)
            if cost is not None and re.fullmatch("(s?(ua)+)?", out) and (best is None or (cost, audit) < best):
                best = cost, audit
    return best


def by_recursion(initials, kinds):
    """(cost, audit, roles) by comparing whole audits of suffixes."""
    n = len(initials)
    step = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}

    @lru_cache(None)
    def best(i, q, inserted):
        ways = [(0, "", "")] if i == n and q in (0, 3) else []

        def put(cost, letter, x, j, ins):
            if x is None:
                c, a, o = best(j, q, ins)
                ways.append((c + cost, letter + a, o))
            elif (q, x) in step:
                c, a, o = best(j, step[q, x], ins)
                ways.append((c + cost, letter + a, x + o))

        if inserted < 3:
            for x in "ua":
                put(3, "I", x, i, inserted + 1)
        if i < n:
            put(4, "D", None, i + 1, 0)
            if kinds[i] != dr.MUST_GO:
                w = 3 * (kinds[i] == dr.CUT_OFF)
                put(w, "K", initials[i] or "?", i + 1, 0)
                for x in "ua":
                    put(3 + w, "R", x, i + 1, 0)
        return min(ways, default=(10**9, "", ""))

    return best(0, 0, 0)


def audit_of(initials, kinds):
    cost, edits = dr.lightest(initials, kinds)
    return cost, "".join(dr.LETTERS[x] for x, _ in edits)


@pytest.mark.parametrize("n", [0, 1, 2])
def test_every_small_case(n):
    for initials in itertools.product(["s", "u", "a", ""], repeat=n):
        for kinds in itertools.product([0, 1, 2], repeat=n):
            assert audit_of(list(initials), bytes(kinds)) == by_all_edits(initials, kinds)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["s", "u", "u", "a", "a", ""]), st.sampled_from([0, 0, 0, 1, 2])), max_size=14))
def test_longer_cases(rows):
    initials, kinds = [r[0] for r in rows], bytes(r[1] for r in rows)
    cost, audit, roles = by_recursion(tuple(initials), tuple(kinds))
    assert audit_of(initials, kinds) == (cost, audit)
    kept = iter(initials)
    got = ""
    for letter, role in dr.lightest(initials, kinds)[1]:
        own = next(kept) if letter != dr.I else ""
        got += role or (own if letter == dr.K else "")
    assert got == roles and re.fullmatch("(s?(ua)+)?", got)


def plain_report(rows):
    """Report of one conversation's rows, in order."""
    seen, faults, kinds, turns = set(), {"blank": 0, "duplicate": 0, "truncated": 0}, [], [r[0] for r in rows if r[0] is not None]
    for _, role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
        seen.add((role, text))
        if fault:
            faults[fault] += 1
        kinds.append({None: 0, "truncated": 1}.get(fault, 2))
    heads = [r[1][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(heads, heads[1:]))
    cost, audit, roles = by_recursion(tuple(x if x in "sua" else "" for x in heads), tuple(kinds))
    given, left, lines = iter(roles), iter(rows), []
    for letter in audit:
        _, role, text = (None, "", "") if letter == "I" else next(left)
        if letter != "D":
            x = next(given)
            lines.append((role if letter == "K" else {"u": "user", "a": "assistant"}[x]) + ":" + text)
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return (gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def test_report_of_odd_rows(spark):
    rnd = random.Random(3)
    texts = ["Hi.", "No end", "", None, " \t", "Why? ", "é!", "a.b", "x" * 3000 + "."]
    rows = [(rnd.choice([None, *range(12)]), rnd.choice([None, 0, 1, 2, 3, 5, 9]), rnd.choice(["user", "assistant", "system", "tool", None, ""]), rnd.choice(texts)) for _ in range(150)]
    rows += [(99, i, "user" if i % 2 else "assistant", f"turn {i}.") for i in range(400)]
    want = {}
    for c in {r[0] for r in rows}:
        own = [(t, " " if r is None else r, " " if x is None else x) for k, t, r, x in rows if k == c]
        want[c] = plain_report(sorted(own, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])))
    got = {r[0]: tuple(r)[1:] for r in dr.report(spark.createDataFrame(rows, KIND)).collect()}
    assert got == want


def test_repaired_rows_and_dropped_ones(spark):
    rows = [(1, 0, "user", "Q?", 1, "k"), (1, 1, "user", "Q?", 2, "k"), (2, 0, "user", "gone.", 0, "k"), (3, 5, "system", "S.", 1, "k"), (3, 6, "assistant", "A.", 1, "k")]
    df = spark.createDataFrame(rows, KIND + ", copies int, edit string")
    got = [tuple(r) for r in dr.repair(df).orderBy("conv_id", "seq").collect()]
    assert got == [(1, 0, "K", "user", "Q?"), (1, 1, "D", "user", "Q?"), (1, 2, "D", "user", "Q?"), (1, 3, "I", "assistant", ""), (3, 0, "K", "system", "S."), (3, 1, "I", "user", ""), (3, 2, "K", "assistant", "A.")]
    empty = [tuple(r) for r in dr.report(df).where("conv_id = 2").collect()]
    assert empty == [(2, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert dr.report(df.limit(0)).count() == 0 and dr.repair(df.limit(0)).count() == 0


def test_texts_over_the_bound_wait_in_a_file(monkeypatch):
    monkeypatch.setattr(dr, "HELD_BYTES", 20)
    held = dr.Texts()
    rows = [(f"r{i}", "é" * i) for i in range(12)]
    for r in rows:
        held.add(*r)
    assert held.file is not None and list(held) == rows


def test_damage_kinds(spark):
    import zlib

    rows = [(c, t, "assistant", "A. B! c?") for c in range(40) for t in range(3)] + [(None, None, None, None)]
    got = {(r.conv_id, r.turn): (r.role, r.text, r.copies) for r in dr.damage(spark.createDataFrame(rows, KIND)).collect()}
    seen = set()
    for c, t, role, text in rows:
        key = f"{' ' if c is None else c}:{' ' if t is None else t}"
        kind = zlib.crc32(key.encode()) % 20
        seen.add(kind)
        role, text = role or " ", text or " "
        want = ("user" if kind == 4 else role, "" if kind == 1 else "A B c" if kind == 2 and t is not None else text, {0: 0, 3: 2}.get(kind, 1))
        assert got[c, t] == want
    assert {0, 1, 2, 3, 4} <= seen
