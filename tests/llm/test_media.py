import hashlib
import io
import math
import time
import random
import wave
import zlib

import numpy as np
import pytest

from touchline.llm import common as C
from touchline.llm import media as M


def test_gear_is_a_sum_over_32_bytes():
    data = np.random.default_rng(1).integers(0, 256, 300).astype(np.uint8)
    h = M.gear(data)
    for i in (0, 5, 31, 32, 299):
        assert int(h[i]) == sum(int(M._GEAR[data[i - j]]) << j for j in range(min(32, i + 1))) % (1 << 32)


def test_cuts_follow_the_content():
    r = random.Random(2)
    body = bytes(r.randrange(256) for _ in range(60_000))
    (_, a), (_, b) = M.files([body, b"inserted " + body])
    assert b"".join(a) == M.padded(body) and len(set(a) & set(b)) > 0.8 * len(a) - 3
    assert all(len(c) <= M.MOST for c in a) and all(len(c) >= M.LEAST for c in a[:-1])
    assert list(M.files([body])) == [list(M.files([b"x" * 3000, body]))[1]]  # neighbours don't matter
    assert M.samples(M.header(len(M.padded(body))) + b"".join(a)) == M.padded(body)


def docs_of(spark):
    r = random.Random(3)
    base = ["".join(r.choices("abcdef ghij\n", k=9000)) for _ in range(4)]
    rows = [(1, None), (2, ""), (3, "x" * 576), (4, "x" * 575), (None, "é"), (6, "a" * 300_000)]
    rows += [(10 + i, b) for i, b in enumerate(base)] + [(20 + i, base[0]) for i in range(30)] + [(20, base[0])]
    rows += [(60 + i, base[1][:4000] + f"near {i}" + base[1][4000:]) for i in range(20)]
    return rows, spark.createDataFrame([(*x, "z", 1) for x in rows], "doc_id long, text string, media string, seq int")


def plain_feature(payload):
    n, total, square = len(payload), 0, 0
    crossings = sum((a >= 128) != (b >= 128) for a, b in zip(payload, payload[1:]))
    for b in payload:
        total, square = total + b, square + b * b
    return f"{n}:{total * 100 // n}:{round(math.sqrt(max(0, square / n - (total / n) ** 2)) * 100)}:{crossings}"


def test_against_plain(spark):
    rows, docs = docs_of(spark)
    want = []
    for d, t in rows:
        raw = (t or "").encode()
        p = raw + b"\xff" * ((-len(raw)) % 576 if raw else 576)
        out = io.BytesIO()
        with wave.open(out, "wb") as w:
            w.setnchannels(1), w.setsampwidth(1), w.setframerate(M.RATE), w.writeframes(p)
        f = out.getvalue()
        want.append(
            (d, len(raw), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-32:]), len(f), hashlib.sha256(f).hexdigest(), plain_feature(p))
        )
    cols = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
    got = M.described(docs).select(*cols).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_chunks_are_stored_once(spark):
    rows, docs = docs_of(spark)
    kept = M.store(docs)
    own = [bytes(p["data"]) for r in kept.stored.collect() for p in r.own]
    shared = [bytes(r["data"]) for r in kept.shared.collect()]
    every = [c for _, parts in M.files([(t or "").encode() for _, t in rows]) for c in parts]
    assert len(set(own + shared)) == len(own + shared) and set(own + shared) == set(every)
    assert {bytes(r.media) for r in M.restore(kept).collect()} == {bytes(r.media) for r in kept.recipes.collect()}


def test_long_text_is_restored_in_time_that_follows_its_size(spark):
    """64 MB in one text whose chunks occur elsewhere too, so that all of them move."""
    text = "".join(f"{i:x} " for i in range(9_500_000))[: 64 << 20]
    docs = spark.createDataFrame([(1, text), (2, text[: 20 << 20] + "other")], "doc_id long, text string")
    kept = M.store(docs)
    began = time.perf_counter()
    got = M.features(M.restore(kept)).collect()
    assert time.perf_counter() - began < 40 and {r.payload_bytes for r in got} == {len(text) + (-len(text)) % 576, (20 << 20) + 5 + (-((20 << 20) + 5)) % 576}


def test_hot_chunk_and_hot_text(spark):
    """A third of all texts are one text, and another third begin with the same chunks."""
    start = "".join(f"{i} of the start " for i in range(4000))
    rows = [(i, "the same text" if i % 3 == 0 else start + f"own {i}" if i % 3 == 1 else f"{i} alone") for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as n", "'x' as media", "'y' as digest", "0 as seq")
    got = {r.doc_id: r for r in M.described(docs).collect()}
    assert len(got) == 150
    for d, t in rows:
        assert got[d].payload_sha256 == hashlib.sha256(t.encode() + b"\xff" * ((-len(t.encode())) % 576)).hexdigest()


def test_damage_is_found(spark):
    bad = spark.createDataFrame([(bytearray(b"x" * 32), [bytearray(c) for c in next(M.files([b"a"]))[1]])], "media binary, parts array<binary>")
    with pytest.raises(Exception, match="damaged"):
        M.features(bad).collect()


def test_bitmap_grows_with_the_keys(spark):
    assert C.bits_for(0) == C.BITMAP_BITS == C.bits_for(1 << 20) and C.bits_for(3_000_000) == 1 << 26 and C.bits_for(1 << 40) == C.MOST_BITMAP_BITS
    bits = C.bitmap(spark.range(0, 5000, 7), "id", 1 << 25)
    assert len(bits) == 1 << 19 and C.in_bitmap(bits, np.arange(5000)).tolist() == [i % 7 == 0 for i in range(5000)]


def test_empty(spark):
    _, docs = docs_of(spark)
    assert M.described(docs.limit(0)).collect() == []
