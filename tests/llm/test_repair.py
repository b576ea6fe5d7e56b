import hashlib
import random
import re
import sys
import time
import zlib
from functools import lru_cache

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from touchline.llm import repair as R

sys.setrecursionlimit(50_000)
GRAMMAR = re.compile("(s?(ua)+)?")


def every_audit(initials, faults):
    """All (cost, audit) with up to two insertions in a place, by trying everything."""
    out = []

    def go(i, made, cost, audit, puts):
        if i == len(initials) and GRAMMAR.fullmatch(made):
            out.append((cost, audit))
        if puts < 2:
            for r in "ua":
                go(i, made + r, cost + 5, audit + "I", puts + 1)
        if i < len(initials):
            go(i + 1, made, cost + 2, audit + "D", 0)
            if faults[i] not in (R.BLANK, R.REPEAT):
                extra = 5 if faults[i] == R.CUT else 0
                go(i + 1, made + (initials[i] or "?"), cost + extra, audit + "K", 0)
                for r in "ua":
                    go(i + 1, made + r, cost + extra + 1, audit + "R", 0)

    go(0, "", 0, "", 0)
    return min(out)


def by_states(initials, faults):
    """(cost, audit) by the least pair for each number of rows and last role; for longer conversations."""

    @lru_cache(maxsize=None)
    def best(i, last, puts):
        found = [(0, "")] if i == len(initials) and last in "-a" else []
        follow = {"-": "u", "s": "u", "u": "a", "a": "u"}[last]
        if puts < 3:
            c, a = best(i, follow, puts + 1)
            found.append((c + 5, "I" + a))
        if i < len(initials):
            moves = [("D", 2, last)]
            if faults[i] not in (R.BLANK, R.REPEAT):
                extra = 5 if faults[i] == R.CUT else 0
                if initials[i] == follow or initials[i] == "s" and last == "-":
                    moves.append(("K", extra, initials[i]))
                moves.append(("R", extra + 1, follow))
            for e, c, q in moves:
                more, a = best(i + 1, q, 0)
                found.append((c + more, e + a))
        return min(found) if found else (1 << 40, "")

    return best(0, "-", 0)


rows = st.lists(st.tuples(st.sampled_from("ssuuuaaax"), st.sampled_from([0, 0, 0, 0, R.BLANK, R.REPEAT, R.CUT])), max_size=3)


@settings(max_examples=60, deadline=None)
@given(rows)
def test_search_equals_every_audit(pairs):
    initials, faults = [r for r, _ in pairs], [f for _, f in pairs]
    assert R.repair(initials, faults) == every_audit(initials, faults) == by_states(initials, faults)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["s", "u", "a", "u", "a", " ", ""]), st.sampled_from([0, 0, 0, R.BLANK, R.REPEAT, R.CUT])), max_size=40))
def test_longer_conversations(pairs):
    initials, faults = [r for r, _ in pairs], [f for _, f in pairs]
    assert R.repair(initials, faults) == by_states(initials, faults)


def test_search_is_linear():
    r = random.Random(5)
    initials, faults = [r.choice("uuaas") for _ in range(20_000)], [r.choice([0, 0, 0, 1, 2, 3]) for _ in range(20_000)]
    began = time.perf_counter()
    cost, audit = R.repair(initials, faults)
    assert time.perf_counter() - began < 20 and len(audit) >= 20_000 and cost > 0


def plain(rows):
    """The contract, row by row: rows(conv_id, turn, role, text) to the query's rows."""
    by = {}
    for c, t, role, text in rows:
        by.setdefault(c, []).append((t, role if role is not None else " ", text if text is not None else " "))
    out = []
    one = lambda x: " " if x is None else str(x)
    for c, own in by.items():
        hurt = []
        for t, role, text in own:
            h = zlib.crc32(f"{one(c)}:{one(t)}".encode()) % 20
            text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
            hurt += [(t, "user" if h == 4 else role, text)] * (0 if h == 0 else 2 if h == 3 else 1)
        hurt.sort(key=lambda x: (x[0] is not None, x[0] or 0, hashlib.sha256(f"{len(x[1])}:{x[1]}{x[2]}".encode()).digest()))
        seen, faults = set(), []
        for _, role, text in hurt:
            body = text.rstrip(R.SPACE)
            faults.append(R.BLANK if not body else R.REPEAT if (role, text) in seen else R.NONE if body[-1] in ".!?" else R.CUT)
            seen.add((role, text))
        roles, turns = [x[1][:1] for x in hurt], {x[0] for x in hurt} - {None}
        cost, audit = by_states(roles, faults)
        made, k, last = [], 0, "-"
        for e in audit:
            if e in "RI":
                last = "a" if last == "u" else "u"
                made.append(f"{'user' if last == 'u' else 'assistant'}:{hurt[k][2] if e == 'R' else ''}")
            elif e == "K":
                last = roles[k]
                made.append(f"{hurt[k][1]}:{hurt[k][2]}")
            k += e != "I"
        out.append((
            c, max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(faults.count(f) for f in (R.BLANK, R.REPEAT, R.CUT)),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(roles, roles[1:])), cost, audit, hashlib.sha256("\n".join(made).encode()).hexdigest()
        ))
    return sorted(out, key=str)


SCHEMA = "conv_id long, turn long, role string, text string"


def test_odd_rows(spark):
    r = random.Random(3)
    texts = [None, "", " \n", "Yes.", "Why? ", "no end", "Ünï!", "long " * 50_000 + "."]
    rows = [(r.choice([None, *range(-3, 40)]), r.choice([None, *range(6)]), r.choice([None, "", "user", "assistant", "system", "tool"]), r.choice(texts)) for _ in range(600)]
    rows += [(77, t, "user" if t % 2 else "assistant", f"Turn {t}.") for t in range(300)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as kind", "'x' as audit", "2 as cost")
    assert sorted(map(tuple, R.repaired(df.repartition(5)).collect()), key=str) == plain(rows)


def test_empty_table(spark):
    got = R.repaired(spark.createDataFrame([], SCHEMA))
    assert got.count() == 0 and got.columns[-1] == "repaired_sha256"


@pytest.mark.parametrize("size", [1, 2, 1000])
def test_streams_over_batches(spark, size):
    """A conversation goes on from batch to batch."""
    rows = [(c, t, "user" if t % 2 else "assistant", f"Turn {t % 50}.") for c in (1, 2) for t in range(300)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    try:
        assert sorted(map(tuple, R.repaired(spark.createDataFrame(rows, SCHEMA)).collect()), key=str) == plain(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
