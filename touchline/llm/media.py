"""Media columns in a deduplicated store of content-defined chunks.

A payload is kept as 8-bit mono samples of a WAV file, whose header follows from their number. The samples are cut
wherever a rolling gear hash of the last 32 bytes says so, so equal passages give equal chunks at any offset. Chunks that occur once in the
table are stored with their medium and never shuffled. Those that occur more often (all of them pass a bitmap whose size
follows their number, 128 MB at most; a false hit only takes the longer way) are deduplicated: a join keeps one owner for
each digest. Media are put together again from the ordered chunk list of each distinct file and verified against its digest.
"""

from __future__ import annotations

import hashlib
import io
import struct
import wave
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bitmap, bits_for, chunks, in_bitmap, met_counted, staged, table, text_bytes

UNIT, RATE = 576, 8000
LEAST, MASK_BITS, MOST = 512, 11, 8192
#: Digests that a task remembers to store a shared chunk once.
_SEEN = 1 << 18


def _gear_table() -> np.ndarray:
    return np.frombuffer(b"".join(hashlib.blake2b(bytes([b]), digest_size=4).digest() for b in range(256)), np.uint32)


_GEAR = _gear_table()


def gear(data: np.ndarray) -> np.ndarray:
    """At each byte, the sum of the table's values of the last 32 bytes, each shifted by its distance."""
    h = _GEAR[data]
    for k in (1, 2, 4, 8, 16):
        h[k:] = h[k:] + (h[:-k] << np.uint32(k))
    return h


def cuts(candidates: list[int], n: int) -> list[int]:
    """Ends of the chunks of n bytes: the first candidate LEAST bytes or more after the last cut, MOST at the latest."""
    out, start = [], 0
    while n - start > LEAST:
        i = bisect_left(candidates, start + LEAST)
        start = min(candidates[i] if i < len(candidates) else n, start + MOST, n)
        out.append(start)
    if start < n:
        out.append(n)
    return out


def header(n: int) -> bytes:
    """The header of a WAV file of n 8-bit mono samples."""
    return struct.pack("<4sI4s4sIHHIIHH4sI", b"RIFF", 36 + n, b"WAVE", b"fmt ", 16, 1, 1, RATE, RATE, 1, 8, b"data", n)


def padded(text: bytes) -> bytes:
    return text + b"\xff" * (-len(text) % UNIT if text else UNIT)


def files(texts: list[bytes]) -> Iterator[tuple[bytes, list[bytes]]]:
    """SHA-256 of the file of each text, and the chunks of its samples."""
    payloads = [padded(t) for t in texts]
    joined = b"".join(payloads)
    # LEAST is over 32, so no hash that counts reaches back into another payload
    at = np.flatnonzero(gear(np.frombuffer(joined, np.uint8)) >> np.uint32(32 - MASK_BITS) == 0) + 1
    bounds = np.cumsum([0, *map(len, payloads)])
    first = np.searchsorted(at, bounds)
    for p, a, i, j in zip(payloads, bounds, first, first[1:]):
        ends = cuts((at[i:j] - a).tolist(), len(p))
        sha = hashlib.sha256(header(len(p)))
        sha.update(p)
        yield sha.digest(), [p[x:y] for x, y in zip([0, *ends], ends)]


def digest(chunk: bytes) -> bytes:
    return hashlib.blake2b(chunk, digest_size=16).digest()


def samples(media: bytes) -> bytes:
    with wave.open(io.BytesIO(media), "rb") as w:
        if w.getparams()[:3] != (1, 1, RATE):
            raise ValueError("not 8-bit mono")
        return w.readframes(w.getnframes())


def feature(payload: bytes) -> str:
    """samples:mean:deviation:crossings of the middle line, in whole numbers (deviation and mean in hundredths)."""
    x = np.frombuffer(payload, np.uint8).astype(np.int64)
    n, total, square = len(x), int(x.sum()), int((x * x).sum())
    deviation = round((max(0, square / n - (total / n) ** 2)) ** 0.5 * 100)
    return f"{n}:{total * 100 // n}:{deviation}:{int(np.count_nonzero(np.diff(x >= 128)))}"


@dataclass
class Store:
    """recipes(doc_id, n_bytes, media, chunks): one row per input row, media being the file's SHA-256.
    stored(media, n_chunks, own(seq, data), shared(digest, data)): the chunks as tasks wrote them.
    shared(digest, data): chunks that occur more than once, each once."""

    recipes: DataFrame
    stored: DataFrame
    shared: DataFrame


def _low(column: str) -> F.Column:
    """The first seven bytes of a digest as a number."""
    return F.conv(F.hex(F.substring(column, 1, 7)), 16, 10).cast("long")


def _by_chunk(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    for batch in batches:
        data, at = text_bytes(batch.column(column))
        for i, j in chunks(at):
            raw = data[at[i] : at[j]].tobytes()
            ends = (at[i : j + 1] - at[i]).tolist()
            yield batch.slice(i, j - i), [raw[a:b] for a, b in zip(ends, ends[1:])]


def store(docs: DataFrame) -> Store:
    """Store the texts of docs(doc_id, text), null as empty. docs is read twice; its texts are not shuffled."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in _by_chunk(batches, 1):
            made = [(sha, [digest(c) for c in parts]) for sha, parts in files(texts)]
            cols = [
                batch.column(0), pa.array([len(t) for t in texts]), pa.array([s for s, _ in made], pa.binary()),
                pa.array([d for _, d in made], pa.list_(pa.binary()))
            ]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "n_bytes", "media", "chunks"])

    keys = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    recipes = staged(keys.mapInArrow(describe, "doc_id long, n_bytes long, media binary, chunks array<binary>"), "recipes")
    often = recipes.select(F.explode("chunks").alias("digest")).groupBy("digest").agg(F.count("*").alias("n")).where("n > 1")
    often = staged(often.select(_low("digest").alias("low")), "repeated-chunks")
    sent = docs.sparkSession.sparkContext.broadcast(bitmap(often, "low", bits_for(often.count())))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        own_t = pa.list_(pa.struct([("seq", pa.int32()), ("data", pa.binary())]))
        shared_t = pa.list_(pa.struct([("digest", pa.binary()), ("data", pa.binary())]))
        for _, texts in _by_chunk(batches, 0):
            made = list(files(texts))
            all_ = [digest(c) for _, parts in made for c in parts]
            hit = iter(in_bitmap(sent.value, np.array([int.from_bytes(d[:7]) for d in all_], np.uint64)).tolist())
            names, rows = iter(all_), []
            for sha, parts in made:
                own, shared = [], []
                for seq, c in enumerate(parts):
                    d = next(names)
                    if not next(hit):
                        own.append((seq, c))
                    elif d not in seen:
                        seen.add(d)
                        shared.append((d, c))
                if len(seen) > _SEEN:
                    seen.clear()
                rows.append((sha, len(parts), own, shared))
            if rows:
                cols = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.binary(), pa.int32(), own_t, shared_t))]
                yield pa.RecordBatch.from_arrays(cols, ["media", "n_chunks", "own", "shared"])

    kind = "media binary, n_chunks int, own array<struct<seq: int, data: binary>>, shared array<struct<digest: binary, data: binary>>"
    stored = staged(keys.select("text").mapInArrow(write, kind), "stored", "zstd")
    copies = stored.select(
        F.monotonically_increasing_id().alias("id"), F.posexplode("shared").alias("k", "s")
    ).select(F.struct("id", "k").alias("place"), "s.*")
    owners = copies.groupBy("digest").agg(F.min("place").alias("place"))
    shared = staged(copies.join(owners, ["digest", "place"]).select("digest", "data"), "shared", "zstd")
    return Store(recipes, stored, shared)


def _ordered(parts: str) -> F.Column:
    """The data of array<struct(seq, data)> in the order of seq."""
    return F.transform(F.array_sort(parts), lambda x: x["data"])


def restore(kept: Store) -> DataFrame:
    """(media, parts array<binary>): the chunks of each distinct file in order; end to end they are its samples.

    Files whose chunks are all their own are read where they lie; only the others' chunks move, and a chunk that a large share of
    all references name is broadcast."""
    whole = F.size("own") == F.col("n_chunks")
    alone = kept.stored.where(whole).select("media", _ordered("own").alias("parts"))
    recipes = kept.recipes.groupBy("media").agg(F.first("chunks").alias("chunks"))
    refs = recipes.select("media", F.posexplode("chunks").alias("seq", "digest"))
    fetched = met_counted(refs, kept.shared, "digest").select("media", "seq", "data")
    own = kept.stored.where(~whole).select("media", F.explode("own").alias("o")).select("media", "o.seq", "o.data")
    parts = fetched.unionByName(own).groupBy("media").agg(F.collect_list(F.struct("seq", "data")).alias("parts"))
    return alone.unionByName(parts.select("media", _ordered("parts").alias("parts")))


def features(media: DataFrame) -> DataFrame:
    """media, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature of (media, parts); a
    file that doesn't have its digest is an error. A file's chunks are joined once, so time follows its size."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for sha, parts in zip(batch.column(0).to_pylist(), batch.column(1)):
                raw = b"".join(parts.as_py())
                raw = header(len(raw)) + raw
                if hashlib.sha256(raw).digest() != sha:
                    raise ValueError(f"the stored file {sha.hex()} is damaged")
                p = samples(raw)
                rows.append((sha, len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-32:]), len(raw), sha.hex(), feature(p)))
            if rows:
                kinds = [pa.binary(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
                    ["media", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
                )

    return media.mapInArrow(
        kernel, "media binary, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    )


def described(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes and the features of the stored file for each row of docs(doc_id, text).

    Equal texts share one file and are described once; a null text is stored as an empty one; rows that repeat give a
    row each; an empty table gives none. Memory follows a batch's bytes and the longest text."""
    kept = store(docs)
    media = staged(features(restore(kept)), "media-features")
    return met_counted(kept.recipes.select("doc_id", "n_bytes", "media"), media, "media").drop("media")


def op4_gear_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature for all of documents."""
    return described(table(spark, sf_dir, "documents"))
