import math
import random
import zlib

import numpy as np
import pytest

from touchline.llm import langid as L

WORDS = {
    "aa": "lorem ipsum dolor sit amet tempor magna aliqua veniam nostrud".split(),
    "bb": "schloß über straße würde möchten können zwischen gegenüber".split(),
    "cc": "это просто русский текст для проверки языка модели".split(),
}


def made(n, seed=1):
    r, rows = random.Random(seed), []
    for i in range(n):
        lang = r.choice(list(WORDS))
        rows.append((i, " ".join(r.choices(WORDS[lang], k=r.choice([3, 20, 200]))), lang))
    return rows


def test_kernel_counts_shared_ngrams():
    x = L.presence(["abc", "ABC", "abd", ""])
    assert (x[0] == x[1]).all() and x[3].sum() == 0
    grams = lambda t: {t[i : i + n] for n in (1, 2, 3) for i in range(len(t) - n + 1)}
    assert x[0].sum() == len(grams("abc")) and (x[0] & x[2]).sum() == len(grams("abc") & grams("abd"))


def test_rows_are_independent():
    texts = [t for _, t, _ in made(50)]
    assert (L.presence(texts) == np.concatenate([L.presence([t]) for t in texts])).all()


def test_landmark_products_equal_the_kernel():
    rows = made(60)
    m = L.train(L.presence([t for _, t, _ in rows]), [k for *_, k in rows])
    text = rows[7][1]
    full = L.presence([text]).astype(float)[0]
    assert full.sum() <= L.BINS and len(m.used) == m.landmarks.shape[1]
    x = full[m.used]
    k = np.array([(x @ (l > 0)) / np.sqrt(full.sum() * (l > 0).sum()) for l in m.landmarks])
    assert np.allclose(np.clip((k @ m.weights + 1) / 2, 0, 1), m.scores([text])[0], atol=1e-3)


def test_query(spark):
    rows = made(300) + [
        (1000, None, "aa"), (1001, "", "aa"), (1002, "12 !?", "bb"), (None, "lorem ipsum dolor", None), (3, made(4)[3][1], "cc"),
        (1003, "lorem " * 100_000, None)
    ]
    # a held-out row's label must not matter
    lie = [(d, t, "zz" if d is not None and zlib.crc32(str(d).encode()) % 3 == 1 else k) for d, t, k in rows]
    docs = spark.createDataFrame([(*x, "s") for x in lie], "doc_id long, text string, lang string, score string")
    got = L.identify(docs, L.fit(docs)).collect()
    assert len(got) == len(rows)
    truth = {d: k for d, _, k in rows}
    for r in got:
        assert 0 <= r.score <= 1 and r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        if r.doc_id is not None and r.doc_id < 300 and r.doc_id != 3:
            assert r.lang_pred == truth[r.doc_id]
    by = {r.doc_id: r for r in got}
    assert [by[d].lang_pred for d in (1000, 1001, 1002, 1003)] == ["und", "und", "und", "aa"]
    kept = L.identified(docs, L.fit(docs))
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {d for d, *_ in rows} - {1000, 1001, 1002}


def test_weights_solve_the_ridge_problem():
    """The fit against plain sums: the weights minimise the weighted squared error plus the ridge, over the span of the
    landmarks with the norm of the kernel's space."""
    rows = made(90, 4) + [(900 + i, t, "cc") for i, t in enumerate(invented(LETTERS["fi"], 5, 3))]
    texts, labels = [t for _, t, _ in rows], [k for *_, k in rows]
    m = L.train(L.presence(texts), labels)
    names = sorted(set(labels))
    grams = [
        {tuple(g) for n in (1, 2, 3) for g in zip(*(L._SPACED[np.frombuffer(t.lower().encode(), np.uint8)][i:] for i in range(n)))} for t in texts
    ]
    share = L.LANDMARKS // len(names)
    marks = [i for k in names for i in [j for j, x in enumerate(labels) if x == k][:share]]
    kernel = lambda a, b: len(grams[a] & grams[b]) / math.sqrt(len(grams[a]) * len(grams[b]))
    k_nm = np.array([[kernel(i, j) for j in marks] for i in range(len(texts))])
    k_mm = np.array([[kernel(i, j) for j in marks] for i in marks])
    for c, name in enumerate(names):
        y = np.array([1.0 if k == name else -1.0 for k in labels])
        w = np.array([len(labels) / len(names) / labels.count(k) for k in labels])
        loss = lambda a: float((w * (k_nm @ a - y) ** 2).sum() + L.RIDGE * len(labels) / len(names) * a @ k_mm @ a)  # noqa: B023, E731
        best = np.linalg.lstsq(k_nm.T @ (w[:, None] * k_nm) + L.RIDGE * len(labels) / len(names) * k_mm, k_nm.T @ (w * y), rcond=1e-10)[0]
        assert loss(m.weights[:, c].astype(float)) <= loss(best) * 1.02 + 1e-3
        assert np.abs(k_nm @ m.weights[:, c] - k_nm @ best).max() < 0.05


def test_two_hundred_languages(spark, monkeypatch):
    r = random.Random(8)
    letters = {f"l{i:03}": "".join(r.sample("abcdefghijklmnopqrstuvwxyzäöüéèñçåøæ", 9)) for i in range(200)}
    rows = [(t, k) for k, v in letters.items() for t in invented(v, 12, int(k[1:]), (60,))]
    docs = spark.createDataFrame([(i, t, k) for i, (t, k) in enumerate(rows)], "doc_id long, text string, lang string")
    m = L.fit(docs)
    assert m.languages == sorted(letters) and len(m.landmarks) > 5 * L.LANDMARKS
    got = L.identify(docs, m).where("held_out").join(docs, "doc_id").selectExpr("avg(cast(lang_pred = lang as double))").first()[0]
    assert got > 0.9
    monkeypatch.setattr(L, "MOST_LANDMARKS", 60)  # each language has one
    few = L.fit(docs)
    assert few.languages == sorted(letters) and len(few.landmarks) == 200
    got = L.identify(docs, few).where("held_out").join(docs, "doc_id").selectExpr("avg(cast(lang_pred = lang as double))").first()[0]
    assert got > 0.8 and L.identified(docs, few).count() > 0.9 * len(rows)


def test_every_label_is_learned(spark):
    """1,100 languages, more than landmarks: all are in the model, and texts get one of them."""
    docs = spark.createDataFrame([(i, f"{'abcdefghijk'[i % 11] * 4} {i:05} {chr(0x4E00 + i // 3)}", f"l{i // 3:04}") for i in range(3300)], "doc_id long, text string, lang string")
    m = L.fit(docs)
    learned = {r.lang for r in docs.where(~L.held_out()).collect()}
    assert len(learned) > 1024 and m.languages == sorted(learned) and len(m.landmarks) == len(learned)
    assert {r.lang_pred for r in L.identify(docs, m).collect()} <= learned


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert L.identify(docs, L.fit(docs)).collect() == []
    one = spark.createDataFrame([(1, "text", None)], docs.schema)
    assert [tuple(r)[2:] for r in L.identify(one, L.fit(one)).collect()] == [("und", 0.0)]


def test_sample_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(L, "PER_LANGUAGE", 3)
    rows = made(90) + [(5000 + i, "lorem ipsum " * 30, "aa") for i in range(50)] + [(7, "lorem " * 9, "aa")] * 200
    seen, solve = [], L._solve
    monkeypatch.setattr(L, "_solve", lambda names, y, bits: seen.append((names, y, bits)) or solve(names, y, bits))
    L.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    (names, y, bits), = seen
    assert names == ["aa", "bb", "cc"] and sorted(y) == [0] * 3 + [1] * 3 + [2] * 3
    assert bits.shape == (9, L.BINS // 8) and len({b.tobytes() for b in bits}) == 9


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    got = L.identify(docs, L.fit(docs)).where("held_out").join(docs, "doc_id").selectExpr("avg(cast(lang_pred = lang as double))").first()[0]
    assert got > 0.97


def invented(letters, n, seed, sizes=(40, 200)):
    r = random.Random(seed)
    words = ["".join(r.choices(letters, weights=[1 / (i + 1) for i in range(len(letters))], k=r.randrange(2, 9))) for _ in range(300)]
    return [" ".join(r.choices(words, k=r.choice(sizes))) for _ in range(n)]


LETTERS = {"de": "enisratdhulcgmobwfkzpv", "fi": "aitneslokuämvrjhypdög", "cy": "ydnaerwlgoihfstcmubp", "vi": "nhtcigaưđôảạmuôlêơ"}


def test_rare_language_beside_large_ones(spark):
    for few in (3, 4, 5):
        rows = [(k, t) for i, k in enumerate(LETTERS) for t in invented(LETTERS[k], few if k == "cy" else 400, i)]
        m = L.train(L.presence([t for _, t in rows]), [k for k, _ in rows])
        names, *_ = m.predict(invented(LETTERS["cy"], 200, 2)[few:])
        assert names == ["cy"] * (200 - few)
    # and by the filter of the pipeline, with other texts of the rare language
    rows += [(None, t) for t in invented(LETTERS["cy"], 60, 2)[5:]]
    docs = spark.createDataFrame([(i, t, k) for i, (k, t) in enumerate(rows)], "doc_id long, text string, lang string")
    kept = {r.doc_id for r in L.identified(docs, m).collect()}
    assert set(range(len(rows) - 55, len(rows))) <= kept and len(kept) > 0.99 * len(rows)


def test_unlearned_scripts_get_a_language_but_are_rejected(spark):
    rows = [(k, t) for i, k in enumerate(LETTERS) for t in invented(LETTERS[k], 100, i)]
    r = random.Random(5)
    strange = ["".join(chr(r.randrange(0x4E00, 0x9FA5)) for _ in range(n)) for n in (20, 300, 4000, 20000)] + invented("абвгдежзиклмнопрст", 40, 9)
    m = L.train(L.presence([t for _, t in rows]), [k for k, _ in rows])
    names, scores, fits = m.predict(strange)
    assert set(names) <= set(LETTERS) and (scores >= 0).all() and (scores <= 1).all() and not fits.any()
    docs = spark.createDataFrame(list(enumerate(strange + [rows[0][1]])), "doc_id long, text string")
    assert [x.doc_id for x in L.identified(docs, m).collect()] == [len(strange)]


def test_long_texts_are_judged_whole(spark):
    """Texts that fill most bins by junk are rejected; where a page of a language stands in one doesn't matter."""
    rows = [(k, t) for i, k in enumerate(LETTERS) for t in invented(LETTERS[k], 100, i)]
    m = L.train(L.presence([t for _, t in rows]), [k for k, _ in rows])
    r = random.Random(7)
    page, junk = rows[0][1], "".join(chr(r.randrange(0x4E00, 0x9FA5)) for _ in range(60_000))
    assert np.count_nonzero(L.presence([junk])) > L.BINS // 2
    long = " ".join(invented(LETTERS["fi"], 900, 1))
    names, scores, fits = m.predict([junk, page, long, f"{page} {junk}", f"{junk} {page}"])
    assert fits[:3].tolist() == [False, True, True] and names[2] == "fi"
    assert names[3] == names[4] and fits[3] == fits[4] and scores[3] == pytest.approx(scores[4], abs=1e-3)


def test_model_of_single_texts():
    texts = [invented(LETTERS[k], 1, i)[0] for i, k in enumerate(LETTERS)]
    assert L.train(L.presence(texts), list(LETTERS)).predict(texts)[0] == list(LETTERS)
