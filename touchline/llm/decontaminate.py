"""Benchmark decontamination by winnowing.

Words are runs of digits, letters and characters beyond ASCII, A-Z lowered. A window is WINDOW consecutive words of an
item, or all words of a shorter one. Of each window's k-gram hashes the smallest (the rightmost of equals) is its
fingerprint; the same rule picks fingerprints from every window of a document, so a window that occurs in a document
shares its fingerprint there, and with k + w - 1 = WINDOW no shared span of WINDOW words is missed. Document
fingerprints pass a bitmap of fixed size, carry the words around them, meet the item windows in a join and are extended
there: the window counts only if all its words agree.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ROW_KEY, bitmap, bits_for, by_batch, chunks, in_bitmap, keyed, mixed, staged, table, text_bytes, without

WINDOW, GRAM = 10, 5
#: What a word consists of: 0 for other bytes, else the byte with A-Z lowered.
_BYTE = np.array([b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 0 for b in range(256)], np.uint8)
_P = 0x9E3779B97F4A7C15 | 1
_P_INV = pow(_P, -1, 1 << 64)
_SLICE = 1 << 16
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the multiplier and of its inverse, modulo 2^64."""
    if not _POWERS or len(_POWERS[0]) < n:
        most = max(n, 2 * _SLICE)
        _POWERS[:] = [np.cumprod(np.r_[np.uint64(1), np.full(most - 1, p, np.uint64)]) for p in (_P, _P_INV)]
    return _POWERS[0], _POWERS[1]


def words_of(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lowered bytes, and the first and past-the-end position of each word."""
    low = _BYTE[data]
    inside = np.zeros(len(low) + 2, np.int8)
    inside[1:-1] = low != 0
    step = np.diff(inside)
    return low, np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def word_hashes(low: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word from prefix sums of a polynomial; it depends on the word's bytes alone.

    The sums start anew every _SLICE bytes at a word's start, so tables and sums stay small for texts of any length."""
    out = np.zeros(len(start), np.uint64)
    i = 0
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(start, start[i] + _SLICE)))
        s, e = start[i:j] - start[i], end[i:j] - start[i]
        up, down = _powers(e[-1] + 1)
        total = np.zeros(e[-1] + 1, np.uint64)
        np.cumsum(low[start[i] : end[j - 1]] * up[: e[-1]], out=total[1:])
        out[i:j] = (total[e] - total[s]) * down[s] + (e - s).astype(np.uint64)
        i = j
    return mixed(out)


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """A hash of each run of k words."""
    n = max(0, len(words) - k + 1)
    h = np.zeros(n, np.uint64)
    for i in range(k):
        h = h * np.uint64(_P) + words[i : i + n]
    return mixed(h)


def winnow(grams: np.ndarray, w: int) -> np.ndarray:
    """For each window of w k-grams, the index of its smallest hash, the rightmost of equals."""
    n = max(0, len(grams) - w + 1)
    best, at = grams[:n].copy(), np.zeros(n, np.int64)
    for j in range(1, w):
        less = grams[j : j + n] <= best
        np.copyto(best, grams[j : j + n], where=less)
        at[less] = j
    return at + np.arange(n)


def _gram(length: int) -> int:
    return min(GRAM, length)


def tokens(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of texts end to end with bounds at: lowered bytes with a separator after each text, starts and ends of all words,
    and the bounds of each text's words."""
    n = len(at) - 1
    apart = np.zeros(len(data) + n, np.uint8)
    apart[np.arange(len(data)) + np.repeat(np.arange(n), np.diff(at))] = data
    low, start, end = words_of(apart)
    return low, start, end, np.searchsorted(start, at + np.arange(n + 1))


def windows_of_items(items: DataFrame) -> DataFrame:
    """Distinct windows of items(item_id, text): length, fp long, at (words before the fingerprint), words, items."""

    def kernel(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        data, at = text_bytes(batch.column(1))
        ids, rows = batch.column(0).to_pylist(), []
        low, start, end, bounds = tokens(data[at[0] : at[-1]], at - at[0])
        h, raw = word_hashes(low, start, end), low.tobytes()
        for item, a, b in zip(ids, bounds, bounds[1:]):
            if a == b:
                continue
            length = min(WINDOW, int(b - a))
            words = [raw[x:y].decode() for x, y in zip(start[a:b], end[a:b])]
            grams = gram_hashes(h[a:b], _gram(length)).view(np.int64)
            for x, f in enumerate(winnow(grams.view(np.uint64), length - _gram(length) + 1)):
                rows.append((item, length, int(grams[f]), int(f - x), words[x : x + length]))
        if rows:
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.list_(pa.string())]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["item_id", "length", "fp", "at", "words"])

    made = items.where("text is not null").select(F.col("item_id").cast("long").alias("item_id"), "text")
    made = made.mapInArrow(by_batch(kernel), "item_id long, length int, fp long, at int, words array<string>")
    return made.groupBy("length", "fp", "at", "words").agg(F.collect_set("item_id").alias("items"))


def document_fingerprints(docs: DataFrame, lengths: list[int], bits: np.ndarray) -> DataFrame:
    """Rows of docs(doc_id, text_key, text): one of length 0 for each document, with n_words, and one for each
    fingerprint that may be an item's: its place in words, the words around it and how many of these stand before it."""
    sent = docs.sparkSession.sparkContext.broadcast((lengths, bits))

    def kernel(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        lengths, bits = sent.value
        data, at = text_bytes(batch.column(2))
        for i, j in chunks(at):
            low, start, end, bounds = tokens(data[at[i] : at[j]], at[i : j + 1] - at[i])
            of = np.repeat(np.arange(j - i), np.diff(bounds))
            h = word_hashes(low, start, end)
            # a document's own row: no fingerprint has length 0, and differing values of fp spread these rows
            found = [(np.arange(j - i), 0, np.arange(i, j), np.zeros(j - i, np.int64), np.zeros(j - i, np.int64))]
            words: list = [None] * (j - i)
            for length in lengths:
                k = _gram(length)
                grams, n, w = gram_hashes(h, k), len(h) - length + 1, length - k + 1
                hit = in_bitmap(bits, grams)
                if n < 1 or not hit.any():
                    continue
                # only a window with some k-gram in the bitmap can have such a fingerprint
                near = np.cumsum(np.r_[0, hit])
                pick = np.flatnonzero((near[w : w + n] > near[:n]) & (of[:n] == of[length - 1 :]))
                best, first = grams[pick], pick.copy()
                for x in range(1, w):
                    other = grams[first + x]
                    less = other <= best
                    best[less], pick[less] = other[less], first[less] + x
                pick = np.unique(pick[hit[pick]])
                d = of[pick]
                a, b = np.maximum(pick - (w - 1), bounds[d]), np.minimum(pick + length, bounds[d + 1])
                found.append((d, length, grams[pick].view(np.int64), pick - bounds[d], pick - a))
                words += [[low[start[x] : end[x]].tobytes().decode() for x in range(p, q)] for p, q in zip(a, b)]
            d = np.concatenate([x[0] for x in found])
            kinds = np.concatenate([np.full(len(x[0]), x[1], np.int32) for x in found])
            fp, place, before = (np.concatenate([x[c] for x in found]) for c in (2, 3, 4))
            own = [batch.column(c).take(pa.array(d + i)) for c in range(2)]
            rest = [np.diff(bounds)[d], kinds, fp, place, before.astype(np.int32)]
            yield pa.RecordBatch.from_arrays(
                [*own, *map(pa.array, rest), pa.array(words, pa.list_(pa.string()))],
                ["doc_id", "text_key", "n_words", "length", "fp", "place", "before", "words"]
            )

    return docs.mapInArrow(
        by_batch(kernel), "doc_id long, text_key long, n_words long, length int, fp long, place long, before int, words array<string>"
    )


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, text_key, n_words, n_hit, n_items, items (as sorted strings) for each row of docs(doc_id, text).

    text_key is xxhash64 of the text, so that (doc_id, text_key) leads back to the row. A null text has no words, of documents
    and of items; an item with a null item_id hits words, but has no name to be counted by; an item_id may repeat and then
    counts once. Rows that repeat are judged once and given as often as they occur. Without items, or with an empty table of documents, nothing is hit."""
    windows = staged(windows_of_items(items), "item-windows")
    lengths = sorted(r[0] for r in windows.select("length").distinct().collect())  # 1 to WINDOW
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")
    prints = document_fingerprints(rows, lengths, bitmap(windows, "fp", bits_for(windows.count())))
    met = prints.alias("d").join(windows.alias("w"), (F.col("d.fp") == F.col("w.fp")) & (F.col("d.length") == F.col("w.length")), "left")
    first = F.col("d.before") - F.col("w.at")
    same = (first >= 0) & (F.slice("d.words", F.greatest(first, F.lit(0)) + 1, F.col("w.length")) == F.col("w.words"))
    at = F.col("d.place") - F.col("w.at")
    span = F.when(same, F.struct(at.alias("a"), (at + F.col("w.length")).alias("b")))
    hit = met.select(
        "d.doc_id", "d.text_key", "d.n_words", F.col("d.length").alias("length"), span.alias("span"), F.when(same, F.col("w.items")).alias("items")
    )
    ids = F.transform(F.array_distinct(F.flatten(F.collect_set("items"))), lambda x: x.cast("string"))
    times = F.count_if(F.col("length") == 0)  # a row of length 0 for each row of docs
    per = hit.groupBy("doc_id", "text_key", "n_words").agg(
        F.array_sort(F.collect_set("span")).alias("spans"), F.array_sort(ids).alias("items"), times.alias("times")
    )
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))
    union = F.aggregate(
        "spans", zero, lambda s,
        x: F.struct(
            (s["n"] + F.greatest(F.lit(0).cast("long"), x["b"] - F.greatest(s["end"], x["a"]))).alias("n"), F.greatest(s["end"], x["b"]).alias("end")
        )
    )
    once = per.select("doc_id", "text_key", "n_words", union["n"].alias("n_hit"), F.size("items").cast("long").alias("n_items"), "items", "times")
    return once.withColumn("time", F.explode(F.sequence(F.lit(1).cast("long"), "times"))).drop("time", "times")


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of docs, with all their columns, in which no window of an item occurs.

    Null and empty texts have no words and stay; rows that repeat stay or go together; nulls in other columns don't
    matter; an empty table stays empty, and without items all rows stay; a long text is judged whole."""
    hit = contamination(docs, items).where("n_hit > 0").select(
        F.coalesce("doc_id", F.lit(-(1 << 63))).alias(ROW_KEY[0]), F.col("text_key").alias(ROW_KEY[1])
    )
    return without(keyed(docs), hit).select(*docs.columns)


def op1_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated for all of documents against all of benchmark."""
    got = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.array_join("items", ","), 256)
    return got.select("doc_id", "n_words", "n_hit", "n_items", digest.alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


ORACLE = r"""
with d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
b as (select item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
      from benchmark where text is not null),
bl as (select item_id, w, least(10, len(w)) as n from b where len(w) > 0),
bw as (select distinct item_id, n, array_to_string(w[i:i + n - 1], ' ') as win from (select item_id, w, n, unnest(range(1, len(w) - n + 2)) as i
from bl)),
ns as (select distinct n from bw),
dw as (select doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') as win from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i from d, ns
where len(w) >= n)),
h as (select doc_id, n, i, item_id from dw join bw using (n, win)),
p as (select doc_id, count(distinct j) as n_hit from (select doc_id, unnest(range(i, i + n)) as j from (select distinct doc_id, n, i from h))
group by doc_id),
it as (select doc_id, count(*) as n_items, string_agg(s, ',' order by s) as ids from (select distinct doc_id, cast(item_id as varchar) as s from h
where item_id is not null) group by doc_id)
select d.doc_id as doc_id, cast(len(d.w) as bigint) as n_words, cast(coalesce(p.n_hit, 0) as bigint) as n_hit, cast(coalesce(it.n_items,
0) as bigint) as n_items,
       sha256(coalesce(it.ids, '')) as items_sha256, coalesce(p.n_hit, 0) > 0 as contaminated
from d left join p using (doc_id) left join it using (doc_id)
"""
