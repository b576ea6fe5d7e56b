import hashlib
import random
import re

import duckdb
import numpy as np
from pyspark.sql import functions as F

from touchline.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items):
    wins = {}
    for item, text in items:
        w = words(text)
        if not w:
            continue
        n = min(10, len(w))
        for i in range(len(w) - n + 1):
            wins.setdefault(tuple(w[i : i + n]), set()).add(item)
    sizes = {len(x) for x in wins}
    out = []
    for d, text in docs:
        w, hit, who = words(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if (got := wins.get(tuple(w[i : i + n]))) is not None:
                    hit |= set(range(i, i + n))
                    who |= got - {None}
        out.append((d, len(w), len(hit), len(who), hashlib.sha256(",".join(sorted(map(str, who))).encode()).hexdigest()))
    return sorted(out, key=str)


def run(spark, docs, items):
    d = spark.createDataFrame([(x, t, 1, "a") for x, t in docs], "doc_id long, text string, fp long, words string")
    i = spark.createDataFrame([(x, t, 2) for x, t in items], "item_id long, text string, length int")
    got = D.contamination(d, i).withColumn("sha", F.sha2(F.array_join("items", ","), 256))
    return sorted([(r.doc_id, r.n_words, r.n_hit, r.n_items, r.sha) for r in got.collect()], key=str)


def made(seed):
    r = random.Random(seed)
    vocab = ["the", "of", "Ärger", "x1", "été", "zoo", "q", "Übung"]
    say = lambda n: " ".join(r.choices(vocab, k=n))
    items = [(i, say(r.choice([1, 3, 6, 9, 10, 11, 30]))) for i in range(8, 20)] + [
        (19, say(12)), (None, say(12)), (50, None), (51, "... !"), (52, "")
    ]
    items += [(60 + i, " ".join(f"w{r.randrange(10 ** 6)}" for _ in range(n))) for i, n in enumerate([10, 12, 25, 80, 7])]
    items += [(70, items[-3][1]), (71, items[-2][1])]
    docs = [(1, None), (2, ""), (3, " . "), (None, say(4)), (5, say(3)), (5, say(3))]
    for d in range(20, 70):
        t = [f"v{r.randrange(10 ** 6)}" for _ in range(r.choice([2, 30, 300]))]
        if r.random() < 0.7:
            _, s = r.choice([x for x in items if x[1]])
            s = s.split(" ")
            if r.random() < 0.4:
                a = r.randrange(len(s))
                s = s[a : a + r.choice([9, 10, 11, 20])]
            p = r.randrange(len(t))
            t[p:p] = s
        docs.append((d, r.choice([" ", ", ", "\n- "]).join(t).upper() if r.random() < 0.2 else " ".join(t)))
    return docs + [docs[-1], docs[-1], (99, "pad " * 50_000 + items[-3][1] + " pad" * 50_000)], items


def test_against_brute_force(spark):
    for seed in (1, 2):
        docs, items = made(seed)
        items = items if seed == 1 else [x for x in items if x[0] is None or x[0] >= 60]
        assert run(spark, docs, items) == brute(docs, items)


def test_empty(spark):
    docs, items = made(3)
    assert run(spark, docs, []) == brute(docs, [])
    assert run(spark, [], items) == []


def test_winnowing_guarantee():
    r = np.random.default_rng(1)
    for _ in range(50):
        span = r.integers(0, 9, 10).astype(np.uint64)
        for k, w in ((5, 6), (3, 8)):
            a, b = (np.r_[r.integers(0, 9, 20).astype(np.uint64), span, r.integers(0, 9, 20).astype(np.uint64)] for _ in range(2))
            fa, fb = (set(g[D.winnow(g, w)]) for g in (D.gram_hashes(a, k), D.gram_hashes(b, k)))
            assert fa & fb


def test_sql(spark):
    sf = "/root/testdata/sf0.001"
    c = duckdb.connect()
    for t in ("documents", "benchmark"):
        c.execute(f"create view {t} as from '{sf}/{t}.parquet'")
    want = {tuple(r) for r in c.execute(f"select doc_id, n_words, n_hit, n_items, items_sha256, contaminated from ({D.ORACLE})").fetchall()}
    got = {tuple(r) for r in D.op1_winnowing(spark, sf).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()}
    assert got == want
