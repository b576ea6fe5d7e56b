"""Token counts without token ids.

A byte-level BPE merges inside pre-tokens only, so a text has as many tokens as its pre-tokens have pieces. One pass over
the texts stores, for each document, how many of its pre-tokens are a vocabulary entry and how often each other one
occurs. Each distinct one of these is cut once; the counts join the stored frequencies and are summed. The join has two
parts that together are exact at any size: the most frequent pre-tokens, HEAD at most, are broadcast (they are the ones
whose keys would be hot), and the rare rest is shuffled. Long pre-tokens meet by their SHA-256, so keys are short.
"""

from __future__ import annotations

import os
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import by_batch, chunks, staged, table, text_bytes

LIMIT, HEAD = 1024, 1 << 18
#: Bytes of a key; with HEAD keys the broadcast table has 18 MB at most.
KEY_BYTES = 64
VOCABULARY = "byte_bpe_50k.json"
#: What the library's pattern comes to in a text of ASCII alone; the standard library matches it in half the time.
_ASCII = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+", re.ASCII)
#: Steps of the frequency scale per power of two.
_STEPS = 8


@lru_cache(maxsize=2)
def _library(path: str) -> tuple[Tokenizer, regex.Pattern, list[str], dict[str, int]]:
    """The tokenizer, its pattern, its special strings and the vocabulary entries that are one piece."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tok = Tokenizer.from_file(path)
    special = [t.content for t in tok.get_added_tokens_decoder().values()]
    entries = [t for t in map(tok.decode, ([i] for i in range(tok.get_vocab_size()))) if t and "�" not in t]
    single = {t: 1 for t, e in zip(entries, tok.encode_batch(entries, add_special_tokens=False)) if len(e) == 1 and t not in special}
    return tok, regex.compile(public_tokenizers.PATTERN), special, single


def pretokens(text: str | None, path: str) -> tuple[int, list[str]]:
    """The number of special strings in a text, and the pre-tokens of what stands between them."""
    _, pattern, special, _ = _library(path)
    n, parts = 0, [text or ""]
    for s in special:
        parts = [x for p in parts for x in p.split(s)]
    n = len(parts) - 1
    pattern = _ASCII if parts[0].isascii() and not n else pattern
    return n, pattern.findall(parts[0]) if not n else [t for p in parts for t in pattern.findall(p)]


def counted(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_bytes, known, pieces, times) for each row of docs(doc_id, text): the tokens of special strings and
    pre-tokens that are entries of their own, and all other distinct pre-tokens with their frequencies."""

    def kernel(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        single = _library(path)[3]
        at = text_bytes(batch.column(1))[1]
        for i, j in chunks(at):
            known, pieces, times, ends = [], [], [], [0]
            for text in batch.column(1)[i:j].to_pylist():
                total, found = pretokens(text, path)
                for piece, n in Counter(found).items():
                    if piece in single:
                        total += n
                    else:
                        pieces.append(piece)
                        times.append(n)
                known.append(total)
                ends.append(len(pieces))
            ends = pa.array(ends, pa.int32())
            lists = [pa.ListArray.from_arrays(ends, pa.array(x, t)) for x, t in ((pieces, pa.string()), (times, pa.int64()))]
            sizes = pa.array(at[i + 1 : j + 1] - at[i:j])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)[i:j], sizes, pa.array(known, pa.int64()), *lists], ["doc_id", "n_bytes", "known", "pieces", "times"]
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(by_batch(kernel), "doc_id long, n_bytes long, known long, pieces array<string>, times array<long>")


def cut(pieces: DataFrame, path: str) -> DataFrame:
    """(piece, n, pieces int): how many tokens each pre-token has."""

    def kernel(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for i, j in chunks(text_bytes(batch.column(0))[1]):
            got = _library(path)[0].encode_batch(batch.column(0)[i:j].to_pylist(), add_special_tokens=False)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)[i:j], batch.column(1)[i:j], pa.array([len(e) for e in got], pa.int32())], ["piece", "n", "pieces"]
            )

    return pieces.mapInArrow(by_batch(kernel), "piece string, n long, pieces int")


def _key(piece: str) -> Column:
    """The pre-token, or its digest behind a character that no other key of this length begins with."""
    return F.when(F.octet_length(piece) <= KEY_BYTES, F.col(piece)).otherwise(F.concat(F.lit("\x00"), F.sha2(piece, 256)))


def _step() -> Column:
    return F.floor(F.log2("n") * _STEPS)


def least_step(pieces: DataFrame, most: int) -> int | None:
    """The lowest step of frequency such that at most so many pre-tokens are on it or above; None if no step fits."""
    sizes = {r["s"]: r["c"] for r in pieces.groupBy(_step().alias("s")).agg(F.count("*").alias("c")).collect()}  # 64 * _STEPS rows at most
    total, least = 0, None
    for s in sorted(sizes, reverse=True):
        total += sizes[s]
        if total > most:
            break
        least = s
    return least


def token_counts(docs: DataFrame, path: str, most: int = HEAD) -> DataFrame:
    """doc_id, n_bytes, n_tokens for each row of docs(doc_id, text), as the tokenizer's library counts.

    A null text is empty and has no tokens; rows that repeat are counted each for itself; an empty table gives none.
    Memory follows a batch's bytes and the longest text. docs is read once."""
    base = staged(counted(docs, path), "pretokens", "zstd")
    each = F.explode(F.arrays_zip("pieces", "times")).alias("p")
    frequencies = base.select(each).groupBy(F.col("p.pieces").alias("piece")).agg(F.sum("p.times").alias("n"))
    pieces = staged(cut(frequencies, path), "pieces")
    least = least_step(pieces, most)
    in_head = F.lit(False) if least is None else _step() >= least
    sides = pieces.select(_key("piece").alias("key"), "pieces", in_head.alias("head"))
    # numbers of a stored table's rows: a task that is run again numbers them alike
    rows = base.withColumn("row", F.monotonically_increasing_id())
    own = rows.select("row", "doc_id", "n_bytes", F.col("known").alias("tokens"))
    found = rows.where(F.size("pieces") > 0).select("row", each).select("row", F.col("p.pieces").alias("piece"), F.col("p.times").alias("n"))
    found = found.select("row", _key("piece").alias("key"), "n")
    marked = found.join(F.broadcast(sides.where("head").select("key", "pieces")), "key", "left")
    rest = marked.where("pieces is null").select("row", "key", "n").join(sides.where("not head").select("key", "pieces"), "key")
    none = F.lit(None).cast("long")
    parts = [
        x.select(
            "row", none.alias("doc_id"), none.alias("n_bytes"), (F.col("n") * F.col("pieces")).alias("tokens")
        ) for x in (marked.where("pieces is not null"), rest)
    ]
    per = own.unionByName(parts[0]).unionByName(parts[1]).groupBy("row")
    return per.agg(F.max("doc_id").alias("doc_id"), F.max("n_bytes").alias("n_bytes"), F.sum("tokens").alias("n_tokens")).drop("row")


def op10_pretokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for all of documents."""
    got = token_counts(table(spark, sf_dir, "documents").select("doc_id", "text"), public_tokenizers.path(VOCABULARY))
    return got.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > LIMIT).alias("over_limit"))
