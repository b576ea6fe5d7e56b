"""SimHash near-duplicates by deletion-variant signatures.

A fingerprint has 64 bits in two halves. Two fingerprints that differ in at most 3 bits differ in at most one bit of
some half, so they agree in that half once this bit is blanked. Each distinct fingerprint is indexed under its 64
variants (one per half and blanked bit); equal variants meet in one run of a sorted partition, where candidates are
verified by their Hamming distance. Of the links in a run only a spanning forest leaves the task, never all pairs, and
exact copies meet as one fingerprint before the index is built. A run too long for one task's memory is dealt again: its
fingerprints agree in one byte of the other half at least, and of runs still too long each pair of parts is a run.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ROW_KEY, by_batch, chunks, keyed, met, staged, table, text_bytes, without, tidy
from .components import stars

WORDS, BITS, SEED = 3, 3, 42
#: A byte lane of a 64-bit word counts so far without a carry.
_LANE = 255
_ONES = np.uint64(0x0101010101010101)
#: Runs up to this size are compared by shifts over the whole batch, longer ones one by one.
_SHORT = 6
#: Fingerprints of a run (besides a batch) that a task holds; longer runs are dealt again in parts of this size.
RUN = 1 << 15


def shingle_hashes(text: bytes) -> list[int]:
    """XXH64 of each run of three words (A-Z lowered, split at ASCII white space), or of all words if fewer."""
    words = text.lower().split()
    if len(words) < WORDS:
        return [xxhash.xxh64_intdigest(b" ".join(words), SEED)] if words else []
    return [xxhash.xxh64_intdigest(b" ".join(x), SEED) for x in zip(words, words[1:], words[2:])]


def simhashes(hashes: list[list[int]]) -> np.ndarray:
    """A fingerprint per list: a bit is 1 if over half of the hashes have it; an empty list gives zero."""
    sizes = np.array([len(x) for x in hashes], np.int64)
    out = np.zeros(len(hashes), np.uint64)
    full = np.flatnonzero(sizes)
    if not len(full):
        return out
    h = np.concatenate([np.array(hashes[i], np.uint64) for i in full])
    n = sizes[full]
    blocks = -(-n // _LANE)
    first = np.cumsum(blocks) - blocks
    of = np.repeat(np.arange(len(n)), blocks)
    starts = (np.cumsum(n) - n)[of] + (np.arange(len(of)) - first[of]) * _LANE
    got = np.zeros(len(n), np.uint64)
    for k in range(8):  # lane b of the word counts bit 8 b + k
        lanes = np.add.reduceat((h >> np.uint64(k)) & _ONES, starts).view(np.uint8).reshape(-1, 8)
        over = np.add.reduceat(lanes.astype(np.int64), first, axis=0) * 2 > n[:, None]
        for b in range(8):
            got |= over[:, b].astype(np.uint64) << np.uint64(8 * b + k)
    out[full] = got
    return out


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, fp long) for each row of docs(doc_id, text); a null text has no words and so fingerprint zero."""

    def kernel(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        data, at = text_bytes(batch.column(2))
        for i, j in chunks(at):
            fp = simhashes([shingle_hashes(data[at[k] : at[k + 1]].tobytes()) for k in range(i, j)])
            yield pa.RecordBatch.from_arrays([batch.column(0)[i:j], batch.column(1)[i:j], pa.array(fp.view(np.int64))], ["doc_id", "text_key", "fp"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")
    return rows.mapInArrow(by_batch(kernel), "doc_id long, text_key long, fp long")


def variants(nodes: DataFrame) -> DataFrame:
    """(key, fp) for each distinct fp: half, blanked bit and the other 31 bits of that half, packed into key."""
    half = F.when(F.col("i") < 32, F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))).otherwise(F.shiftrightunsigned("fp", 32))
    blank = F.expr("~shiftleft(1L, cast(i % 32 as int))")
    key = F.shiftleft(F.col("i").cast("long"), 32).bitwiseOR(half.bitwiseAND(blank))
    return nodes.select("fp", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("i")).select(key.alias("key"), "fp")


def _forest(fps: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Of distinct fingerprints: each one that others reach by verified links, with the first one of its kind.

    A visited fingerprint leaves the rest, so a dense run costs little more than one pass."""
    ends, roots = [], []
    while len(fps) > 1:
        root, fps = fps[0], fps[1:]
        todo = [root]
        while todo and len(fps):
            near = np.bitwise_count(fps ^ todo.pop()) <= BITS
            if near.any():
                got, fps = fps[near], fps[~near]
                ends.append(got)
                roots.append(np.full(len(got), root))
                todo.extend(got)
    return ends, roots


def _links(keys: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
    """Verified links within runs of equal keys (sorted)."""
    edge = np.flatnonzero(np.diff(keys)) + 1
    starts, ends = np.r_[0, edge], np.r_[edge, len(keys)]
    size = ends - starts
    a, b = [], []
    short = np.repeat(size <= _SHORT, size)
    for d in range(1, min(_SHORT, len(keys))):
        hit = np.flatnonzero((keys[d:] == keys[:-d]) & short[:-d])
        hit = hit[np.bitwise_count(fps[hit] ^ fps[hit + d]) <= BITS]
        a.append(fps[hit + d])
        b.append(fps[hit])
    for k in np.flatnonzero(size > _SHORT):
        x, y = _forest(fps[starts[k] : ends[k]])
        a += x
        b += y
    pairs = np.column_stack([np.concatenate(a), np.concatenate(b)]) if a else np.zeros((0, 2), np.uint64)
    pairs = np.unique(pairs, axis=0).view(np.int64) if len(pairs) else pairs.view(np.int64)
    return pa.RecordBatch.from_arrays([pa.nulls(len(pairs), pa.int64()), pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["key", "a", "b"])


def _put_off(keys: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
    """Rows of a run that is too long: the fingerprint as a, without b."""
    return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(fps.view(np.int64)), pa.nulls(len(keys), pa.int64())], ["key", "a", "b"])


def _runs(most: int | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Links of a partition sorted by key. A run that crosses batches is kept until it ends, or put off once it is longer
    than most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[tuple[np.ndarray, np.ndarray]] = []
        held, long_key = 0, None
        for batch in batches:
            keys, fps = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)
            if long_key is not None and (n := int(np.searchsorted(keys, long_key, "right"))):
                yield _put_off(keys[:n], fps[:n])
                keys, fps = keys[n:], fps[n:]
            if not len(keys):
                continue
            if not kept or keys[-1] != kept[0][0][-1]:
                keys, fps = (np.concatenate(x) for x in zip(*kept, (keys, fps)))
                last = np.searchsorted(keys, keys[-1])
                if last:
                    yield _links(keys[:last], fps[:last])
                keys, fps, kept, held = keys[last:], fps[last:], [], 0
            kept.append((keys, fps))
            held += len(keys)
            if most is not None and held > most:
                yield from (_put_off(*x) for x in kept)
                long_key, kept, held = keys[-1], [], 0
        if kept:
            yield _links(*(np.concatenate(x) for x in zip(*kept)))

    return run


def links(nodes: DataFrame, most: int = RUN) -> DataFrame:
    """Links (a, b) between distinct fingerprints that differ in at most 3 bits: enough of them to connect all."""
    kind = "key long, a long, b long"
    index = variants(nodes).repartition("key").sortWithinPartitions("key")
    found = staged(index.mapInArrow(tidy(_runs(most)), kind), "runs")
    done, rest = found.where("b is not null").select("a", "b"), found.where("b is null")
    if rest.isEmpty():
        return done
    # the other half differs in 3 bits at most, so one of its four bytes agrees; keys that collide do no harm, for links are verified
    half = F.when(F.shiftright("key", 32) < 32, F.shiftrightunsigned("a", 32)).otherwise(F.col("a").bitwiseAND(F.lit(0xFFFFFFFF)))
    byte = F.expr("cast(shiftright(half, 8 * i) & 255 as int)")
    parts = rest.withColumn("half", half).withColumn("i", F.explode(F.array(*map(F.lit, range(4))))).select(
        F.xxhash64("key", "i", byte).alias("key"), F.col("a").alias("fp")
    )
    parts = staged(parts, "long-runs")
    sizes = parts.groupBy("key").agg(F.ceil(F.count("*") / max(1, most)).cast("int").alias("n"))
    part = F.pmod(F.xxhash64("fp"), F.col("n").cast("long")).cast("int")
    pairs = parts.join(sizes, "key").select("key", "fp", part.alias("p"), F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("q"))
    pairs = pairs.select(F.xxhash64("key", F.least("p", "q"), F.greatest("p", "q")).alias("key"), "fp").repartition("key").sortWithinPartitions("key")
    return done.unionByName(pairs.mapInArrow(tidy(_runs(None)), kind).select("a", "b"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, fp long, component_id, root long) for each row of docs(doc_id, text).

    component_id is the smallest doc_id that chains of links reach; root is a fingerprint that names the component and
    is never null. Components share a component_id where a doc_id repeats with other text, never a root. A null text
    counts as an empty one; rows may repeat (each gives a row); a null doc_id never is a component_id unless all of its
    component are null; an empty table gives none. Rows of a fingerprint, and fingerprints of a component, that are many
    are never sent to one task."""
    prints = staged(fingerprints(docs), "fingerprints")
    nodes = staged(prints.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")), "nodes")
    star = stars(links(nodes.select("fp")))
    rooted = nodes.join(star.withColumnRenamed("a", "fp"), "fp", "left").select("fp", "n", "least", F.coalesce("b", "fp").alias("root"))
    rooted = staged(rooted, "rooted")
    names = staged(rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("k")), "names")
    named = staged(met(rooted.select("fp", "n", "root"), names, "root", "k"), "named")
    return met(prints, named, "fp", "n").select("doc_id", "text_key", "fp", "component_id", "root")


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of docs, with all its columns, for each group of near-duplicates: the one with the smallest doc_id
    (null only where there is no other), the smallest hash of text among these, any of rows that agree in both.

    Null and empty texts are one group; of rows that repeat one stays; an empty table stays empty. The row that stays is
    an aggregate of its group, and rows are left out by keys that occur once, so no group meets in one task."""
    groups = near_duplicates(docs)
    nobody = F.lit(-(1 << 63))
    key = [F.coalesce("doc_id", nobody).alias(ROW_KEY[0]), F.col("text_key").alias(ROW_KEY[1])]
    rows = staged(groups.groupBy("root", *key).agg(F.count("*").alias("n")), "keys-of-groups")
    first = F.min(F.struct((F.col(ROW_KEY[0]) == nobody).alias("z"), *ROW_KEY, "n")).alias("k")
    kept = staged(rows.groupBy("root").agg(first).select("k.*").drop("z"), "kept")
    left = without(keyed(docs), rows.join(kept, list(ROW_KEY), "left_anti"))
    again = kept.where("n > 1")
    if again.isEmpty():
        return left.select(*docs.columns)
    again = staged(again, "kept-once")
    single = without(left, again)
    return single.unionByName(met(left, again, list(ROW_KEY), "n").dropDuplicates(list(ROW_KEY))).select(*docs.columns)


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits), component_id for all of documents."""
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", digits.alias("fingerprint"), "component_id")
