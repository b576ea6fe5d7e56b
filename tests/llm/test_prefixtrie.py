import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from touchline.llm import prefixtrie as P

SCHEMA = "conv_id long, turn long, role string, text string"


def plain(rows):
    """The trie by dictionaries of tuples."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn, role or "", text or ""))
    for v in own.values():
        v.sort(key=lambda x: (x[0] is not None, x[0] or 0, hashlib.sha256(f"{len(x[1])}:{x[1]}{x[2]}".encode()).digest()))
    members, last = defaultdict(list), defaultdict(list)
    for c in sorted(own):
        h, base = zlib.crc32(str(c).encode()) % 6, c - (c % 100 if c >= 0 else -(-c % 100))
        path = tuple(x[1:] for x in own.get(base, [])[:h] + own[c][h:])
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
        last[path].append(c)
    kids = defaultdict(int)
    for n in members:
        if n:
            kids[n[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for n in members:
        for d in range(len(n) + 1):
            leaves[n[:d]] += not kids[n]
            saved[n[:d]] += (len(members[n]) - 1) * (len(n[-1][1]) if n else 0)
    return sorted(
        (min(m), len(n), min(members[n[:-1]]) if n else -(1 << 60), len(m), kids[n], leaves[n], saved[n],
         hashlib.sha256(",".join(map(str, last[n])).encode()).hexdigest())
        for n, m in members.items()
    )


def got(df, limit):
    return sorted(tuple(-(1 << 60) if v is None else v for v in r) for r in P.trie(df, limit).collect())


@settings(max_examples=200, deadline=None)
@given(st.sets(st.tuples(st.integers(-(2**63), 2**63 - 1), st.integers(-3, 3)), max_size=200))
def test_slots_are_minimal_and_verified(keys):
    a, b = (np.array([k[i] for k in sorted(keys)], np.int64) for i in (0, 1))
    slots = P.Slots(a, b)
    assert sorted(slots.of(a, b)) == list(range(len(a)))
    other = [(x, y + 100) for x, y in keys] + [(1, 9)]
    assert set(slots.of(*(np.array([k[i] for k in other], np.int64) for i in (0, 1)))) == {-1}


def test_many_keys():
    a, b = np.random.default_rng(1).integers(-(2**63), 2**63 - 1, (2, 100_000))
    assert np.array_equal(np.sort(P.Slots(a, b).of(a, b)), np.arange(100_000))


@pytest.fixture(scope="module")
def odd():
    r = random.Random(4)
    texts = [None, "", "a", "b", "ünï", "word " * 20_000]
    rows = [(r.choice([None, *range(-120, 260, 7), 0, 100, 200]), r.choice([None, 0, 0, 1, 2, 3, 5]), r.choice([None, "user", "assistant"]), r.choice(texts)) for _ in range(500)]
    rows += [(1000 + i, t, "user", f"turn {t}") for i in range(300) for t in range(4)]  # copies of one conversation
    rows += [(5000 + i, 0, "user", "the same start") for i in range(200)] + [(5000 + i, 1, "user", f"own {i % 150}") for i in range(200)]
    rows += [(9100, t, "user", f"long {t % 7}") for t in range(250)] + [(9217, t, "user", f"long {t % 7}") for t in range(120)]
    return rows


@pytest.mark.parametrize("limit", [60, 1 << 15])
def test_equals_dictionaries(spark, odd, limit):
    """Whatever is heavy, and in however many rounds."""
    df = spark.createDataFrame(odd, SCHEMA).selectExpr("*", "1 as depth", "'x' as n1", "2 as length")
    assert got(df.repartition(4), limit) == plain(odd)


def test_empty_table_and_no_conversation(spark):
    assert P.trie(spark.createDataFrame([], SCHEMA)).count() == 0
    assert P.trie(spark.createDataFrame([(None, 1, "user", "x")], SCHEMA)).count() == 0


def test_ends_stream_over_batches(spark):
    rows = [(i * 700, 0, "user", "x") for i in range(60)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        assert got(spark.createDataFrame(rows, SCHEMA), 10) == plain(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
