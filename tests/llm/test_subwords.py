import math
import random
import time

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from touchline.llm import subwords as W

PATH = public_tokenizers.path(W.MODEL)
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
PIECES, RAW = W.load(PATH)


def encode(texts):
    ids, bounds = W.Encoder(PIECES)(texts)
    return [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])]


@settings(max_examples=400, deadline=None)
@given(
    st.lists(
        st.lists(
            st.sampled_from(
                ["the", "a", "aa", "ing", "tion", " ", "  ", "\n", "▁", "é", "中", "😀", "S", "ss", "0", "\x00", "<s>", "<0x0A>", "erer", "ABC"]
            ), max_size=14
        ).map("".join), max_size=4
    )
)
def test_ids_equal_the_library(texts):
    assert encode(texts) == LIBRARY.encode(texts)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    assert encode([text]) == [LIBRARY.encode(text)]


def test_runs_and_long_words():
    texts = [c * n for c in " a=-e" for n in range(1, 70)] + ["ab" * 1500, "x" * 2001]
    assert encode(texts) == LIBRARY.encode(texts)


@pytest.mark.parametrize("size", [1, 3, 40])
def test_long_words_walk_to_the_same_ids(monkeypatch, size):
    """Whatever counts as long, and however short the slices are."""
    monkeypatch.setattr(W, "LONG", size)
    monkeypatch.setattr(W, "_SLICE", 19)
    r = random.Random(size)
    texts = [
        "".join(r.choices("etaoinshr", k=300)), "ab" * 200, "a" * 333, " " * 99, "=" * 70, "the" * 90, "".join(r.choices("ab  ", k=400)), "é中" * 50
    ]
    assert encode(texts) == LIBRARY.encode(texts)


@pytest.mark.parametrize("part", ["x", "ab", "the", " ", "=-", None])
def test_a_megabyte_without_a_cut_takes_seconds(part):
    r = random.Random(3)
    text = "".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=1_000_000)) if part is None else part * (1_000_000 // len(part))
    began = time.perf_counter()
    got = encode([text])
    assert time.perf_counter() - began < 20
    assert got == LIBRARY.encode([text])


def test_long_texts_through_spark(spark):
    rows = [(1, "ab" * 150_000), (2, "word " * 200_000), (3, None), (4, "")]
    got = {r.doc_id: r for r in W.encode(spark.createDataFrame(rows, "doc_id long, text string"), PATH).collect()}
    assert all(got[d].piece_ids == LIBRARY.encode(t or "") and got[d].same for d, t in rows)


def test_words_of_one_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(W, "word_hashes", lambda points, start, end: ((end - start) % 2).astype(np.uint64))
    encoder = W.Encoder(PIECES)
    for texts in (["the cat sat"], ["a dog ran here", "", "the cat"], ["x"], ["y"], ["x", "zz"]):
        ids, bounds = encoder(texts)
        assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == LIBRARY.encode(texts)


def test_documents(spark):
    sf = "/root/testdata/sf0.001"
    texts = dict(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    got = W.op8_viterbi(spark, sf).collect()
    assert len(got) == len(texts) and all(r.same for r in got)
    assert {r.doc_id: r.piece_ids for r in got} == {d: LIBRARY.encode(t) for d, t in texts.items()}
    assert {r.doc_id: r.text for r in W.decode(W.op8_viterbi(spark, sf), PATH).collect()} == texts


def test_nulls_repeats_and_clashes(spark):
    rows = [(1, None), (2, ""), (3, " two  spaces "), (3, " two  spaces "), (None, "id"), (5, "a▁b")]
    docs = spark.createDataFrame([(*x, 9) for x in rows], "doc_id long, text string, piece_ids long")
    got = W.encode(docs, PATH).collect()
    assert [r.piece_ids for r in got] == [LIBRARY.encode(t or "") for _, t in rows] and all(r.same for r in got)
    full = W.with_pieces(docs, PATH)
    assert full.columns == ["doc_id", "text", "piece_ids", "same"] and all(r.same for r in full.collect()) and [r.piece_ids for r in full.collect()] == [r.piece_ids for r in got]
    assert W.encode(docs.limit(0), PATH).collect() == []
    null = spark.createDataFrame([(1, None)], "doc_id long, piece_ids array<int>")
    assert W.decode(null, PATH).collect()[0].text is None


@pytest.mark.parametrize("seed", range(5))
def test_unigram_against_brute_force(seed):
    r = random.Random(seed)
    names = sorted({"a", "b", "▁", *("".join(r.choices("ab▁", k=r.randrange(2, 5))) for _ in range(12))})
    score = {i: -r.random() * 9 for i in range(len(names))}
    p = W.vocabulary(dict(enumerate(names)), score, False, np.zeros(0), 99)
    for _ in range(60):
        word = "".join(r.choices("ab▁", k=r.randrange(1, 9)))

        def best(s):
            if not s:
                return 0.0, []
            return max(
                ((score[i] + best(s[len(n) :])[0], [i, *best(s[len(n) :])[1]]) for i, n in enumerate(names) if s.startswith(n)), key=lambda x: x[0]
            )

        ids, count = p.encode_equal(np.array([[ord(c) for c in word]] * 2, np.uint32))
        assert count[0] == count[1] and ids[: count[0]].tolist() == ids[count[0] :].tolist()
        assert "".join(names[i] for i in ids[: count[0]]) == word
        assert math.isclose(sum(score[i] for i in ids[: count[0]]), best(word)[0], abs_tol=1e-9)
        assert p.walk(np.array([ord(c) for c in word], np.uint32)).tolist() == [
            next(k for k, n in enumerate(p.strings) if p.ids[k] == i) for i in ids[: count[0]]
        ]
    assert p.encode_equal(np.array([[ord("z")]], np.uint32))[0].tolist() == [99]
