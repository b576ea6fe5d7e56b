import random
import re

import pytest

from touchline.llm import licenses as L

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").translate({i: i + 32 for i in range(65, 91)}))


def grams(w):
    return [tuple(w[i : i + 5]) for i in range(len(w) - 4)]


def brute(rows, templates):
    out = []
    for d, text in rows:
        s = grams(words(text))
        for name, t in templates.items():
            tw = words(t)
            if len(tw) < 5:
                w = words(text)
                at = [i for i in range(len(w) - len(tw) + 1) if tw and w[i : i + len(tw)] == tw]
                out += [(d, name, 1.0, len(at), at[0])] if at else []
                continue
            c, ts = -(-5 * len(tw) // 4), set(grams(tw))
            got = [(len(ts & set(s[a : a + 2 * c - 4])) / len(ts), a) for a in range(0, len(s), c)]
            if hit := [x for x in got if x[0] >= 0.8]:
                out.append((d, name, round(max(hit)[0], 9), len(hit), min(a for _, a in hit)))
    return sorted(out, key=str)


def run(spark, rows, templates=None, **more):
    docs = spark.createDataFrame([(d, t, "l", 1.0) for d, t in rows], "doc_id long, text string, license string, found double")
    return sorted(((r[0], r[1], round(r[2], 9), r[3], r[4]) for r in L.scan(docs, templates, **more).collect()), key=str)


def made():
    r = random.Random(5)
    rows = [
        (1, None), (2, ""), (3, "MIT License"), (4, "Released under the MIT License."), (4, "Released under the MIT License."),
        (None, "released UNDER\nthe mit-license!")
    ]
    for d in range(10, 90):
        w = [f"w{r.randrange(50)}" for _ in range(r.choice([0, 3, 40, 400]))]
        for _ in range(r.choice([0, 1, 1, 3])):
            t = L.TEMPLATES[r.choice(list(L.TEMPLATES))].split()
            for _ in range(r.choice([0, 0, 1, 2, 8])):
                t[r.randrange(len(t))] = "zz"
            a = r.randrange(len(w) + 1)
            w[a:a] = t
        rows.append((d, " ".join(w)))
    return rows + [(99, "Released under the MIT License. " * 4000), (100, "pad " * 50_000 + L.TEMPLATES["ISC"])]


def test_against_brute_force(spark):
    rows = made()
    assert run(spark, rows) == brute(rows, L.TEMPLATES)


def test_empty_and_short_templates(spark):
    assert run(spark, []) == [] and run(spark, made()[:8], {}) == []
    few = {
        "none": " - ", "one": "copyleft", "two": "Public Domain", "three": "all rights reserved", "four": "Licence: see file COPYING",
        "five": "see the file called COPYING"
    }
    rows = [
        (1, "ALL rights-reserved, all rights reserved."), (2, "public domain; copyleft"), (3, "licence see file copying"), (4, "all rights"),
        (5, None), (6, "x " * 50 + "see the file called copying public domain")
    ]
    assert run(spark, rows, few) == brute(rows, few) and len(brute(rows, few)) == 6


@pytest.mark.parametrize("most", [1, 150])
def test_templates_in_several_plans(spark, most):
    rows = made()[::3]
    got = run(spark, rows, plan_words=most)
    assert got == brute(rows, L.TEMPLATES) and got


def test_many_templates(spark):
    """Far more words than one plan takes, with the default bound."""
    r = random.Random(1)
    texts = {f"t{i}": " ".join(f"w{r.randrange(10**6)}" for _ in range(6000)) for i in range(20)}
    rows = [(i, "pad " * i + t) for i, t in enumerate(texts.values())]
    got = {(d, k): c for d, k, c, *_ in run(spark, rows[:3], texts)}
    assert got == {(i, f"t{i}"): 1.0 for i in range(3)}


def test_documents_and_plan(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = L.op2_minhash_bands(spark, sf)
    assert sorted(((r[0], r[1], round(r[2], 9), r[3], r[4]) for r in got.collect()), key=str) == brute(rows, L.TEMPLATES)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Join" not in plan and "Exchange" not in plan


def test_short_notices_in_random_context(spark):
    r, short = random.Random(11), [k for k, t in L.TEMPLATES.items() if len(words(t)) < 13]
    assert {"MIT", "CC-BY-4.0", "Apache-2.0"} <= set(short)
    rows = []
    for d in range(6000):
        w = [f"w{r.randrange(1 << 30)}" for _ in range(60)]
        a = r.randrange(8, 50)
        w[a:a] = L.TEMPLATES["MIT" if d % 2 else short[d // 2 % len(short)]].split()
        rows.append((d, " ".join(w)))
    assert run(spark, rows) == brute(rows, L.TEMPLATES)


def test_bands_follow_the_shingles(spark):
    for k in L._classes(L._rows(spark, L.TEMPLATES)):
        for t in k["templates"]:
            s, least = len(t["shingles"]), -(-4 * len(t["shingles"]) // 5)
            assert (1 - least / (s + 2 * k["c"] - 4 - least)) ** len(t["bands"]) < 1e-4 and len(t["bands"]) <= k["bands"]
