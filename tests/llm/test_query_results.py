"""The queries without SQL, whole, against plain versions on the smallest tables."""

import hashlib
import io
import wave
import zlib

import pytest
from test_media import plain_feature
from test_secrets import base
from test_simhash import brute

from touchline.llm import media, resharding, secrets
from touchline.llm.registry import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def rows(spark, name):
    return QUERIES[name](spark, SF).collect()


def test_op4(spark, texts):
    got = rows(spark, "op4_gear_chunks")
    assert len(got) == len(texts)
    for r in got:
        raw = (texts[r.doc_id].text or "").encode()
        p = raw + b"\xff" * ((-len(raw)) % 576 if raw else 576)
        out = io.BytesIO()
        with wave.open(out, "wb") as w:
            w.setnchannels(1), w.setsampwidth(1), w.setframerate(media.RATE), w.writeframes(p)
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-32:]))
        assert (r.media_bytes, r.media_sha256, r.feature) == (len(out.getvalue()), hashlib.sha256(out.getvalue()).hexdigest(), plain_feature(p))


def test_op5(spark, texts):
    want = [(d, f"{f:016x}", c) for d, f, c in brute([(d, r.text) for d, r in texts.items()])]
    got = [(r.doc_id, r.fingerprint, r.component_id) for r in rows(spark, "op5_simhash")]
    assert sorted(got) == sorted(want) and any(d != c for d, _, c in got)


def test_op6(spark, texts):
    got = rows(spark, "op6_min_cost_flow")
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in got) == sorted(
        (d, len(r.text.encode()) + 1, zlib.crc32(r.text.encode())) for d, r in texts.items()
    )
    assert {(r.law, r.grown_shard) for r in got} == {("bytes", None)} and {r.shard for r in got} == set(range(resharding.SHARDS))
    most = max(r["size"] for r in got)
    loads = [sum(r["size"] for r in got if r.shard == s) for s in range(resharding.SHARDS)]
    assert max(loads) - min(loads) <= 2 * most
    for s in range(resharding.SHARDS):
        slots = sorted(r.slot for r in got if r.shard == s)
        assert slots == list(range(len(slots)))


def test_op7(spark, texts):
    got = rows(spark, "op7_string_kernel")
    assert len(got) == len(texts)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == texts[r.doc_id].lang for r in held) >= 0.95 * len(held)


def test_op9(spark):
    sf = "/root/testdata/sf0.01"  # the smallest tables hold no secret
    texts = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = QUERIES["op9_secrets"](spark, sf).collect()
    assert len(got) == len(texts) and sum(r.n_assign for r in got) > 0
    for r in got:
        want = base(texts[r.doc_id].text or "")
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == kind for *_, k in want) for kind in secrets.BASE)
        assert r.base_sha256 == hashlib.sha256(secrets.digest(want).encode()).hexdigest()
        assert [s for s in r.spans.split(",") if s.split(":")[0] in secrets.BASE] == [x for x in secrets.digest(want).split(",") if x]
