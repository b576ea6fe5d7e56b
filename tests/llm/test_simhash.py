import random

import pytest
import xxhash
from pyspark.sql import Row
from hypothesis import given, settings
from hypothesis import strategies as st

from touchline.llm import common
from touchline.llm.components import stars
from touchline.llm.simhash import links, near_duplicates, one_of_each, shingle_hashes, simhashes

SCHEMA = "doc_id long, text string, fp string, Text2 string"


def plain(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").translate({i: " " for i in range(9, 14)}).split(" ") if w]
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] if words else []
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute(rows):
    fps = [plain(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, fps[i], least.get(find(i))) for i, (d, _) in enumerate(rows)), key=str)


def run(spark, rows):
    docs = spark.createDataFrame([(d, t, "x", "y") for d, t in rows], SCHEMA)
    return sorted(((r.doc_id, r.fp % (1 << 64), r.component_id) for r in near_duplicates(docs).collect()), key=str)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab AB\t\n\x0b\x85éİ", max_size=30), max_size=6))
def test_fingerprint(texts):
    got = simhashes([shingle_hashes(t.encode()) for t in texts])
    assert [int(x) for x in got] == [plain(t) for t in texts]


def test_many_shingles():
    text = " ".join(random.Random(1).choices("abcdefgh", k=3000))
    assert int(simhashes([shingle_hashes(text.encode()), shingle_hashes(b"x")])[0]) == plain(text)


def test_against_brute_force(spark):
    r = random.Random(3)
    rows = [(1, None), (2, ""), (3, "  \t"), (None, "one"), (5, "one two"), (5, "One  TWO"), (7, "one two three")]
    for g in range(30):
        words = [r.choice("the of and to in is it on".split()) + str(r.randrange(9)) for _ in range(r.choice([5, 40, 200]))]
        for _ in range(r.choice([1, 2, 25])):
            near = list(words)
            for _ in range(r.choice([0, 0, 1, 2])):
                near[r.randrange(len(near))] = "zz"
            rows.append((len(rows) + 100, " ".join(near)))
    rows += [(900, "word " * 60_000), (901, "word " * 60_001), rows[-1], rows[-1]]
    assert run(spark, rows) == brute(rows)


def test_empty(spark):
    assert run(spark, []) == []


def test_stars(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 100), (200, 201), (200, 201), (-5, 201)]
    got = {r.a: r.b for r in stars(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {200: -5, 201: -5}


@pytest.mark.parametrize("most", [1, 7, 1 << 15])
def test_long_runs_are_dealt_again(spark, most):
    r = random.Random(most)
    fps = {r.getrandbits(64) for _ in range(60)}
    for centre in [r.getrandbits(64) for _ in range(3)]:
        near = [centre]
        for _ in range(150):  # chains that stray from the centre in one half or in both
            near.append(r.choice(near) ^ sum(1 << b for b in {r.randrange(r.choice([32, 64])) for _ in range(3)}))
        fps |= set(near) | {centre ^ r.getrandbits(32) for _ in range(150)}
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    got = stars(links(spark.createDataFrame([(x,) for x in signed], "fp long"), most)).collect()
    root = {x: x for x in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x in fps:
        for y in fps:
            if x < y and (x ^ y).bit_count() <= 3:
                root[find(x)] = find(y)
    least = {}
    for x, s in zip(fps, signed):
        least[find(x)] = min(s, least.get(find(x), s))
    want = {(s, least[find(x)]) for x, s in zip(fps, signed) if s != least[find(x)]}
    assert {(x.a, x.b) for x in got} == want and len(got) == len(want)


def test_one_of_each_by_either_join(spark, monkeypatch):
    rows = [
        (1, "a b c d e f"), (2, "a b c d e f"), (2, "a b c d e f"), (3, "x y z w v u"), (3, "x y z w v u"), (None, "x y z w v u"), (None, None),
        (None, None)
    ]
    docs = spark.createDataFrame([(*r, "q") for r in rows], "doc_id long, text string, n string")
    for most in (1 << 18, 0):
        monkeypatch.setattr(common.without, "__defaults__", (most,))
        assert sorted(map(str, one_of_each(docs).collect())) == sorted(
            map(str, [Row(doc_id=1, text="a b c d e f", n="q"), Row(doc_id=3, text="x y z w v u", n="q"), Row(doc_id=None, text=None, n="q")])
        )


def test_one_of_each_by_component_not_by_id(spark):
    # an id that repeats with an unrelated text, each with a copy of its own
    one, other = "a b c d e f", "x y z w v u"
    docs = spark.createDataFrame([(4, one), (4, other), (7, one), (9, other)], "doc_id long, text string")
    assert sorted(map(tuple, one_of_each(docs).collect())) == [(4, one), (4, other)]
    # near copies without ids, whose fingerprints differ
    r, near = random.Random(8), []
    while not near:
        words = [f"w{r.randrange(500)}" for _ in range(300)]
        base = " ".join(words)
        words[r.randrange(300)] = "zz"
        if 1 <= (plain(base) ^ plain(" ".join(words))).bit_count() <= 3:
            near = [base, " ".join(words)]
    docs = spark.createDataFrame([(None, t) for t in [*near, one]], "doc_id long, text string")
    kept = sorted(x.text for x in one_of_each(docs).collect())
    assert len(kept) == 2 and one in kept and set(kept) < {*near, one}


def test_hub_of_many_neighbours(spark):
    """A hundred thousand nodes that all link one, and a chain that leads into it."""
    hub = spark.range(1, 100_001).selectExpr("id as a", "0L as b")
    chain = spark.range(200_000, 200_020).selectExpr("id as a", "if(id = 200019, 77L, id + 1) as b")
    got = stars(hub.unionByName(chain)).groupBy("b").count().collect()
    assert [tuple(r) for r in got] == [(0, 100_020)]
