"""What several operators share: text buffers of Arrow batches, staged tables and bounded bitmaps."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a kernel turns into numpy arrays at once; a longer single document makes a chunk of its own.
CHUNK_BYTES = 2 << 20
#: Bits of a bitmap that goes to every task: 2 MB, and 128 MB at most where it grows with the keys.
BITMAP_BITS, MOST_BITMAP_BITS = 1 << 24, 1 << 30

_own_folder: list[str] = []
_scratch: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Where that is unset, one temporary folder for this process if the master is
    local; on a cluster, whose machines don't share local folders, an error."""
    if folder := spark.conf.get("spark.checkpoint.dir", None):
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
    if not _own_folder:
        _own_folder.append(tempfile.mkdtemp(prefix="touchline-"))
    return _own_folder[0]


def new_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared folder, or in the scratch folder that is open, that nothing has used before."""
    return f"{_scratch[-1] if _scratch else shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def drop_folder(spark: SparkSession, path: str) -> None:
    """Deletes a folder by Spark's own file system, wherever it is."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


@contextmanager
def scratch(spark: SparkSession, name: str = "scratch") -> Iterator[str]:
    """While it is open, staged tables go to a folder of its own, which is deleted at the end: what was made of them must
    have been written elsewhere by then."""
    folder = new_folder(spark, name)
    _scratch.append(folder)
    try:
        yield folder
    finally:
        _scratch.remove(folder)
        drop_folder(spark, folder)


def staged(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """df as a Parquet table in the shared folder: its lineage ends there, and a lost executor loses nothing of it."""
    path = new_folder(df.sparkSession, name)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column end to end, and the n + 1 bounds of its rows; null is empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    _, bounds, data = column.buffers()
    at = np.frombuffer(bounds, np.int64 if wide else np.int32)[
        column.offset : column.offset + len(column) + 1
    ] if len(column) else np.zeros(1, np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), at.astype(np.int64)


def chunks(at: np.ndarray, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows with at most so many bytes each, one row at least."""
    i, n = 0, len(at) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + most, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def bits_for(keys: int) -> int:
    """16 bits for each key, a power of two between the two bounds: up to 64 million keys, 6 % of others hit by chance."""
    return min(max(BITMAP_BITS, 1 << (max(1, keys) * 16 - 1).bit_length()), MOST_BITMAP_BITS)


def bitmap(keys: DataFrame, column: str, bits: int = BITMAP_BITS) -> np.ndarray:
    """So many bits (a power of two) as 64-bit words; the bit of a key's low bits is set if the key (a long) occurs.

    Spark folds the keys into words first, so at most bits / 64 rows reach the driver."""
    bit = F.col(column).bitwiseAND(F.lit(bits - 1))
    words = keys.select(
        F.shiftright(bit, 6).alias("word"), F.expr(f"shiftleft(1L, cast({column} & 63 as int))").alias("bits")
    ).groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(bits >> 6, np.int64)
    out[words["word"].to_numpy()] = words["bits"].to_numpy()
    return out.view(np.uint64)


def in_bitmap(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys (64-bit) may be in the bitmap: no key that is in it is missed."""
    low = keys.astype(np.uint64) & np.uint64(64 * len(bits) - 1)
    return ((bits[(low >> np.uint64(6)).astype(np.int64)] >> (low & np.uint64(63))) & np.uint64(1)).astype(bool)


ROW_KEY = ("__touchline_id", "__touchline_text")


def keyed(docs: DataFrame) -> DataFrame:
    """docs with ROW_KEY: doc_id (null as the least long) and a hash of text, both never null, to join rows by."""
    return docs.withColumns({ROW_KEY[0]: F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))), ROW_KEY[1]: F.xxhash64("text")})


#: A key table of so many rows at most is broadcast; longer ones meet the documents in a shuffled join.
BROADCAST_KEYS = 1 << 18


def without(docs: DataFrame, keys: DataFrame, most: int = BROADCAST_KEYS) -> DataFrame:
    """The rows of docs (with ROW_KEY) that have none of the keys, which are counted first."""
    keys = staged(keys.select(*ROW_KEY).distinct(), "keys")
    return docs.join(F.broadcast(keys) if keys.count() <= most else keys, list(ROW_KEY), "left_anti")


#: A key that over one in SHARE rows has is hot, so there are SHARE hot keys at most.
SHARE = 10_000


def met(rows: DataFrame, sides: DataFrame, key: str | list[str], n: str) -> DataFrame:
    """rows with the columns of sides, a stored table that has each key once, and in n how many of rows have it.

    Hot keys are broadcast and their rows stay where they are. All others meet in a shuffle, in which no key has over one
    in SHARE rows. The result leaves n out; keys are never null."""
    total = sides.agg(F.sum(n)).first()[0] or 0
    is_hot = F.col(n) * SHARE > total
    marked = rows.join(F.broadcast(sides.where(is_hot).drop(n).withColumn("__hot", F.lit(True))), key, "left")
    rest = marked.where("__hot is null").select(*rows.columns).join(sides.where(~is_hot).drop(n), key)
    return marked.where("__hot").drop("__hot").unionByName(rest)


def met_counted(rows: DataFrame, sides: DataFrame, key: str) -> DataFrame:
    """rows with the columns of sides, which has each key once, where nobody has counted the keys of rows (a stored table)
    yet: as met(), but the count finds hot keys alone, SHARE at most, whose sides are broadcast."""
    total = rows.count()
    hot = staged(rows.groupBy(key).agg(F.count("*").alias("__n")).where(F.col("__n") * SHARE > total).select(key), "hot-keys")
    hot_sides = sides.join(F.broadcast(hot), key, "left_semi")
    rest = rows.join(F.broadcast(hot), key, "left_anti").join(sides, key)
    return rows.join(F.broadcast(hot_sides), key).unionByName(rest)


def mixed(h: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def by_batch(kernel: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]) -> Callable:
    """A function for mapInArrow from one for a single batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from kernel(batch)

    return tidy(run)


def tidy(kernel: Callable) -> Callable:
    """A function for mapInArrow that ends by giving the memory that a task has freed back to the machine: workers live on from
    stage to stage, and what they hoard is missing to the next one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from kernel(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc alone has it
            trim(0)

    return run


def whole_runs(batches: Iterator[pa.RecordBatch], key: int = 0) -> Iterator[pa.Table]:
    """Sorted batches, cut so that rows with equal keys (null is one) are never apart; one run at least is held at a time."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        column, last = batch.column(key), batch.column(key)[-1]
        n = pc.sum(pc.equal(column, last)).as_py() if last.is_valid else column.null_count
        before = batch.num_rows - n
        if held and (before or not held[-1].column(key)[-1].equals(last)):
            yield pa.Table.from_batches([*held, batch.slice(0, before)]).combine_chunks()
            held = []
        elif before:
            yield pa.Table.from_batches([batch.slice(0, before)]).combine_chunks()
        held.append(batch.slice(before))
    if held:
        yield pa.Table.from_batches(held).combine_chunks()
