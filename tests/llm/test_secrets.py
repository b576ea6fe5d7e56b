import base64
import hashlib
import json
import re
import time
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from touchline.llm import secrets as S

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def github(body, prefix="ghp_"):
    n, tail = zlib.crc32(body.encode()), ""
    for _ in range(6):
        n, d = divmod(n, 62)
        tail = S._BASE62.decode()[d] + tail
    return prefix + body + tail


GOOD = github("a1B2c3D4e5F6g7H8i9J0k1L2m3N4o5")
HEAD = base64.urlsafe_b64encode(json.dumps({"alg": "HS256"}).encode()).decode().rstrip("=")
JWT = f"{HEAD}.eyJzdWIiOjF9.c2ln"


def base(text):
    got = [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    got += [(m.start(), m.end(), 1) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    got += [(m.start(), m.end(), 2) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return [(a, b, S.KINDS[k]) for a, b, k in sorted(got, key=lambda x: (x[0], x[2]))]


PARTS = [
    "password", "PassWd", "secret", "tOKEN", "api_key", "apikey", "ſecret", "toKen", "AKIA", "akia", '"', "'", " ", "=", ":", "\t", "é",
    "deadbeef" * 2, "0123456789abcde", "ABCDEFGHIJ1234", "-./+_", "x" * 11, "Z" * 12, "\n"
]


@settings(max_examples=600, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=14).map("".join))
def test_base_spans(text):
    assert [s for s in S.spans_of(text) if s[2] in S.BASE] == base(text)


def test_checksums():
    bad = GOOD[:-1] + ("0" if GOOD[-1] != "0" else "1")
    kinds = lambda t: [k for _, _, k in S.spans_of(t)]
    assert kinds(f"é {GOOD}") == ["github"] and kinds(bad) == [] and kinds(GOOD + "x") == []
    assert kinds(github("Q" * 30, "npm_")) == ["npm"]
    assert kinds(JWT) == ["jwt"] and kinds("eyJhbGciOiJ9.x.y") == []
    assert kinds("-----BEGIN RSA PRIVATE KEY-----") == ["key"]
    assert S.spans_of(f"é {GOOD}")[0][:2] == (2, 42)


DENSE = {
    "jwt": ["eyJ", "eyJ.", "eyJa.eyJb", "eyJa.b.c ", "eyJa.eyJb eyJ", HEAD + ".", JWT + " "],
    "assign": ["token", "token=", "token = a ", "api_key:'x' ", "password" + " " * 50, "secret=abcdefghijkl "],
    "access": ["AKIA", "akia", "AKIA ", "AKIA0123456789ABCD "],
    "hex": ["0123456789abcdef", "deadbeef ", "a"],
    "github": ["ghp_", GOOD, GOOD + " ", "gho_abc"],
    "npm": ["npm_", "npm_" + "a" * 36 + " "],
    "key": ["-----BEGIN ", "-----BEGIN A ", "-----BEGIN " + "RSA " * 200, "-----BEGIN PRIVATE KEY-----"],
}


@pytest.mark.parametrize("kind", DENSE)
def test_a_megabyte_of_keywords_takes_seconds(kind):
    for part in DENSE[kind]:
        text = part * (1_000_000 // len(part))
        began = time.perf_counter()
        spans = S.spans_of(text)
        assert time.perf_counter() - began < 10, part
        assert [s for s in spans if s[2] in S.BASE] == base(text)
        few = S.spans_of(part * 20)
        assert spans[: max(0, len(few) - 2)] == few[:-2]


def test_a_token_after_failed_starts():
    assert [k for *_, k in S.spans_of(f"eyJeyJ eyJ.x {JWT} eyJ{JWT}")] == ["jwt"]
    assert S.spans_of("eyJ." + JWT)[0][2] == "jwt"


def test_scan_and_mask(spark):
    texts = [None, "", "nothing", f'é token = "{GOOD}" and AKIA' + "A" * 16, "f" * 200_000 + " é", "token=" * 5000 + "abcdefghijkl", "same", "same"]
    docs = spark.createDataFrame(
        [(i // 2, t, "x", None if i == 6 else 5) for i, t in enumerate(texts)], "doc_id long, text string, spans string, n_chars long"
    )
    rows = S.scan(docs).collect()
    assert len(rows) == len(texts)
    want = sorted((i // 2, S.digest(S.spans_of(t)), hashlib.sha256(S.digest(base(t or "")).encode()).hexdigest()) for i, t in enumerate(texts))
    assert sorted((r.doc_id, r.spans, r.base_sha256) for r in rows) == want
    got = S.mask(docs).collect()
    assert [r.text for r in got][:3] == [None, "", "nothing"] and got[3].text == 'é [SECRET]" and [SECRET]'
    assert got[3].n_chars == len(got[3].text) and got[2].n_chars == 5 and [r.n_chars for r in got][6:] == [None, 5]
    assert S.scan(docs.limit(0)).collect() == [] and S.mask(docs.limit(0)).collect() == []
