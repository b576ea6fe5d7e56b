import random
import time

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from touchline.llm import tokencounts as T

PATH = public_tokenizers.path(T.VOCABULARY)
LIBRARY = Tokenizer.from_file(PATH)


def count(text):
    return len(LIBRARY.encode(text or "", add_special_tokens=False))


def by_pretokens(text):
    n, found = T.pretokens(text, PATH)
    return n + sum(count(x) for x in found)


@settings(max_examples=500, deadline=None)
@given(
    st.lists(
        st.sampled_from(
            [
                " ", "  ", "\n", "\t", "\x1c", "\x85", " ", " ", "​", "word", "Thntblere", "'s", "'ll", "é", "中文", "ⅷ", "٣", "12", "²", "_", "!!",
                "<|endoftext|>", "<|endof", "é", "😀", "\U0001e900"
            ]
        ), max_size=12
    ).map("".join)
)
def test_sums_equal_the_library(text):
    assert by_pretokens(text) == count(text)


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet=st.characters(max_codepoint=127), max_size=30))
def test_ascii_text(text):
    assert by_pretokens(text) == count(text)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=40))
def test_any_text(text):
    assert by_pretokens(text) == count(text)


@pytest.mark.parametrize("most", [0, 3, 1 << 18])
def test_query(spark, most):
    r = random.Random(1)
    words = ["the", "thnttionti", "Èenè", "onwhwh", "12", "'s", "<|endoftext|>", "\n\n"]
    rows = [
        (1, None), (2, ""), (3, "same thntblere text"), (3, "same thntblere text"), (None, " x 5 "), (7, "zqzq " * 50_000), (8, "zqx" * 30_000),
        (9, "zqx" * 30_000)
    ]
    rows += [(100 + i, "a " + "-" * 80 + "=" * 30 + "\n" + "~" * (60 + i % 9)) for i in range(40)]  # long and frequent ones
    rows += [(i, " ".join(r.choices(words, k=r.randrange(50)))) for i in range(10, 40)]
    docs = spark.createDataFrame([(*x, "p", 4) for x in rows], "doc_id long, text string, piece string, n long")
    got = T.token_counts(docs.select("doc_id", "text"), PATH, most).collect()
    want = sorted((str(d), len((t or "").encode()), count(t)) for d, t in rows)
    assert sorted((str(x.doc_id), x.n_bytes, x.n_tokens) for x in got) == want
    assert T.token_counts(docs.limit(0), PATH, most).collect() == []


def test_frequent_long_pretokens_are_in_the_head(spark):
    """A rule of dashes in every text is no key of the shuffled join."""
    docs = spark.createDataFrame([(i, "word" + "-" * 90 + f" zq{i}zq") for i in range(300)], "doc_id long, text string")
    pieces = T.cut(
        T.counted(docs, PATH).selectExpr("explode(arrays_zip(pieces, times)) as p").groupBy("p.pieces").agg({"p.times": "sum"}).toDF("piece", "n"),
        PATH
    )
    least = T.least_step(pieces, 5)
    assert "-" * 90 in {r.piece for r in pieces.where(T._step() >= least).collect()}
    assert {(r.doc_id, r.n_tokens) for r in T.token_counts(docs, PATH, 5).collect()} == {(r.doc_id, count(r.text)) for r in docs.collect()}


def test_a_megabyte_without_a_break(spark):
    texts = ["zqx" * 350_000, "- " * 500_000, "\n" * 1_000_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    began = time.perf_counter()
    got = {r.doc_id: r.n_tokens for r in T.token_counts(docs, PATH).collect()}
    assert time.perf_counter() - began < 60
    assert got == {i: count(t) for i, t in enumerate(texts)}


def test_documents(spark):
    sf = "/root/testdata/sf0.001"
    texts = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = {x.doc_id: (x.n_tokens, x.over_limit) for x in T.op10_pretokens(spark, sf).collect()}
    assert got == {d: (count(t), count(t) > 1024) for d, t in texts}
