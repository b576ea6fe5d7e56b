"""Language identification by a string kernel.

A text is the set of its byte n-grams, 1 to NGRAM long (lower case; ASCII beyond letters counts as a space), hashed to
BINS. The kernel of two texts is the number of n-grams they share over the geometric mean of their numbers. Landmark
texts span the Nyström approximation, one-versus-rest kernel ridge regression is fitted in it on a bounded sample of
labelled rows, in which all languages weigh the same, and texts are scored in batches by two matrix products: with the
landmarks, then with the coefficients.

The regression tells languages apart, not whether a text is of any of them. For that, fit is the number of n-grams a text
shares with the landmarks of its language, less what chance would share, over the most it could share, less the same. A text
whose fit is below the floor of its language, set by the language's own sample, is rejected by identified(); identify()
gives the best language of every text with letters. What chance shares is reckoned from the whole text's number of bins,
so texts of any length are judged alike and as a whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import by_batch, chunks, table, text_bytes

NGRAM, BITS, RIDGE = 3, 16, 1e-2
BINS = 1 << BITS
#: Landmarks: OWN of each language, LANDMARKS at least in all and MOST_LANDMARKS at most, but one of each language.
LANDMARKS, OWN, MOST_LANDMARKS = 128, 4, 1024
#: The sample: so many texts of each language at most, and so many in all, shared evenly by the languages, but one of each. A
#: text of any length reaches the driver as BINS bits, so the sample has 64 MB at most, or 8 KB a language.
PER_LANGUAGE, SAMPLE = 400, 8192
#: Steps of the hash by which texts are drawn.
_RANKS = 1 << 40
#: The pipeline goes by the fit alone; a low score says that languages are alike or rare, not that a text is of none.
LEAST_SCORE = 0.0
#: The floor of a language is FLOOR of the median fit of its sample, or the fit of its lowest texts (LOWEST of them) if that is less.
FLOOR, LOWEST = 0.5, 0.01
_ROWS = 128
_SPACED = np.array([b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)], np.uint8)


def has_letters(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def presence(texts: list[str]) -> np.ndarray:
    """A row per text with a 1 for each bin that some n-gram of it falls into."""
    out = np.zeros((len(texts), BINS), np.uint8)
    raw = [t.lower().encode() for t in texts]
    low = _SPACED[np.frombuffer(b"".join(raw), np.uint8)].astype(np.uint32)
    row = np.repeat(np.arange(len(texts)), [len(x) for x in raw])
    code = np.zeros(len(low), np.uint32)
    for n in range(1, NGRAM + 1):
        size = len(low) - n + 1
        if size < 1:
            break
        code = (code[:size] << np.uint32(8)) | low[n - 1 :]
        own = row[:size] == row[n - 1 :]
        bins = ((code + np.uint32(n << 24)) * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)
        out.ravel()[(row[:size] * BINS + bins)[own]] = 1
    return out


def _sizes(x: np.ndarray) -> np.ndarray:
    return np.count_nonzero(x.view(bool), axis=1)


@dataclass
class Model:
    languages: list[str]
    used: np.ndarray  # the bins that some landmark has
    landmarks: np.ndarray  # unit rows of these bins
    weights: np.ndarray  # landmark by language
    of: np.ndarray  # number of the language of each landmark
    floor: np.ndarray  # least fit of each language

    def scores(self, texts: list[str]) -> np.ndarray:
        """Of each text and language, 0 to 1: where the regression puts the text between the rest (0) and it (1)."""
        x = presence(texts)
        return np.clip((self.near(x, _sizes(x)) @ self.weights + 1) / 2, 0, 1)

    def near(self, x: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The kernels of texts' presence rows, with so many n-grams each, and the landmarks. N-grams that no landmark has
        add nothing to the product."""
        own = x[:, self.used].astype(np.float32)
        return own @ self.landmarks.T / np.sqrt(np.maximum(size, 1))[:, None].astype(np.float32)

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Of each the best language, its score, and whether the text fits that language. und and 0 for null, for a text without
        letters and for a model without languages, which fit nothing."""
        names, best, kept = ["und"] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), bool)
        with_letters = [i for i, t in enumerate(texts) if has_letters(t)] if self.languages else []
        of = np.count_nonzero(self.landmarks, axis=1)
        for a in range(0, len(with_letters), _ROWS):
            part = with_letters[a : a + _ROWS]
            x = presence([texts[i] for i in part])
            size = _sizes(x)
            near = self.near(x, size)
            s = np.clip((near @ self.weights + 1) / 2, 0, 1)
            top = s.argmax(axis=1)
            few = 1 / np.sqrt(np.maximum(size, 1))  # few n-grams tell little
            kept[part] = _fit(near, size, of, self.of[None] == top[:, None]) + few >= self.floor[top]
            for i, k, v in zip(part, top, s.max(axis=1)):
                names[i], best[i] = self.languages[k], v
        return names, best, kept


#: Without a language every text is und.
NO_MODEL = Model([], np.zeros(0, np.int64), np.zeros((0, 0), np.float32), np.zeros((0, 0), np.float32), np.zeros(0, np.int64), np.zeros(0))


def _fit(near: np.ndarray, size: np.ndarray, of: np.ndarray, used: np.ndarray) -> np.ndarray:
    """Of texts with so many n-grams each and these kernels with landmarks of so many: the fit to the landmarks used of each, nan without any."""
    chance = size[:, None] * of / BINS
    over = near * np.sqrt(size[:, None] * of) - chance
    most = (np.minimum(size[:, None], of) - chance) * used
    return np.where(used.any(axis=1), (over * used).sum(axis=1) / np.maximum(most.sum(axis=1), 1), np.nan)


def train(x: np.ndarray, labels: list[str]) -> Model:
    """Fit on texts' presence rows and their languages; of each language its first texts are landmarks, in equal shares."""
    names = sorted(set(labels))
    return NO_MODEL if not names else _solve(names, np.array([names.index(k) for k in labels]), np.packbits(x, axis=1))


def _solve(names: list[str], y: np.ndarray, bits: np.ndarray) -> Model:
    """The model of rows of packed bits and the numbers of their languages."""
    share = max(1, max(LANDMARKS, min(OWN * len(names), MOST_LANDMARKS)) // len(names))
    first = np.concatenate([np.flatnonzero(y == k)[:share] for k in range(len(names))])
    marks = np.unpackbits(bits[first], axis=1)
    used, of = np.flatnonzero(marks.any(axis=0)), _sizes(marks)
    marks = (marks[:, used] / np.sqrt(np.maximum(of, 1))[:, None]).astype(np.float32)
    value, vector = np.linalg.eigh((marks @ marks.T).astype(np.float64))
    half = vector / np.sqrt(np.maximum(value, 1e-6))
    near, size = np.zeros((len(bits), len(marks)), np.float32), np.zeros(len(bits), np.int64)
    model = Model(names, used, marks, np.zeros((0, 0), np.float32), y[first], np.zeros(0))
    for a in range(0, len(bits), _ROWS):
        x = np.unpackbits(bits[a : a + _ROWS], axis=1)
        size[a : a + _ROWS] = _sizes(x)
        near[a : a + _ROWS] = model.near(x, size[a : a + _ROWS])
    phi = near @ half
    target = np.where(y[:, None] == np.arange(len(names)), 1.0, -1.0)
    weight = (len(bits) / len(names) / np.bincount(y, minlength=len(names)))[y][:, None]
    beta = np.linalg.solve(phi.T @ (weight * phi) + RIDGE * len(bits) / len(names) * np.eye(phi.shape[1]), phi.T @ (weight * target))
    # a text is no measure of its own fit
    own = _fit(near, size, of, (y[first][None] == y[:, None]) & (first[None] != np.arange(len(bits))[:, None]))
    floor = np.full(len(names), np.nan)
    for k in range(len(names)):
        if len(f := own[(y == k) & ~np.isnan(own)]):
            floor[k] = min(FLOOR * np.median(f), np.quantile(f, LOWEST))
    known = floor[~np.isnan(floor)]
    floor[np.isnan(floor)] = np.median(known) if len(known) else 0.0  # languages of one text
    return Model(names, used, marks, (half @ beta).astype(np.float32), y[first], floor)


def held_out() -> F.Column:
    """crc32(doc_id as text) mod 3 is 1; false for a null doc_id, which is not learned from either."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame) -> Model:
    """A model of docs(doc_id, text, lang): rows with text and lang that are not held out; the sample is, of each
    language, the distinct texts (by their n-grams) with the smallest hashes of doc_id, within the bounds above.

    Rows with a null doc_id, text or lang, and texts without letters, teach nothing; without any other there is no model
    and every text is und. Rows that repeat count once."""
    usable = docs.where("doc_id is not null and lang is not null and text is not null").where(~held_out())
    counts = usable.groupBy("lang").agg(F.count("*").alias("n")).collect()  # a row a language, as the model has
    if not counts:
        return NO_MODEL
    most = max(1, min(PER_LANGUAGE, SAMPLE // len(counts)))
    shares = [(r["lang"], min(1.0, (2 * most + 20) / r["n"])) for r in counts]
    shares = docs.sparkSession.createDataFrame(shares, "lang string, share double")
    rank = F.pmod(F.xxhash64(F.col("doc_id")), F.lit(_RANKS))

    def kernel(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for i, j in chunks(text_bytes(batch.column(2))[1]):
            part, texts = batch.slice(i, j - i), batch.column(2)[i:j].to_pylist()
            part = part.filter(pa.array(map(has_letters, texts), pa.bool_()))
            for a in range(0, part.num_rows, _ROWS):
                own = part.slice(a, _ROWS)
                bits = np.packbits(presence(own.column(2).to_pylist()), axis=1)
                yield pa.RecordBatch.from_arrays(
                    [own.column(0), own.column(1), pa.array([b.tobytes() for b in bits], pa.binary())], ["lang", "rank", "bits"]
                )

    chosen = usable.select("lang", rank.alias("rank"), "text").join(F.broadcast(shares), "lang").where(F.col("rank") < F.col("share") * _RANKS)
    chosen = chosen.select("lang", "rank", "text")
    rows = chosen.mapInArrow(by_batch(kernel), "lang string, rank long, bits binary").groupBy("lang", "bits").agg(F.min("rank").alias("rank"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("rank", "bits"))
    got = rows.withColumn("place", place).where(F.col("place") <= most).select("lang", "place", "bits").toArrow().sort_by(
        [("lang", "ascending"), ("place", "ascending")]
    )
    if not got.num_rows:
        return NO_MODEL
    names, y = np.unique(got["lang"].to_numpy(zero_copy_only=False).astype(str), return_inverse=True)
    return _solve(names.tolist(), y, np.frombuffer(b"".join(got["bits"].to_pylist()), np.uint8).reshape(-1, BINS // 8))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score for each row of docs(doc_id, text).

    A prediction is a learned language, whether the text fits it or not, and depends on the whole text alone. Null texts and
    texts without letters are und with score 0, and so is every text if nothing was learned; rows that repeat give a row each;
    an empty table gives none."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def kernel(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for i, j in chunks(text_bytes(batch.column(2))[1]):
            names, score, _ = sent.value.predict(batch.column(2)[i:j].to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)[i:j], batch.column(1)[i:j], pa.array(names, pa.string()), pa.array(score)],
                ["doc_id", "held_out", "lang_pred", "score"]
            )

    keys = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text")
    return keys.mapInArrow(by_batch(kernel), "doc_id long, held_out boolean, lang_pred string, score double")


def identified(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of docs whose text fits its best language with a score of LEAST_SCORE or more, with all their columns.

    Null texts and texts without letters go; rows that repeat are judged alike; nulls in other columns don't
    matter; an empty table stays empty; a long text is judged whole."""
    sent, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index("text")

    def kernel(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for i, j in chunks(text_bytes(batch.column(at))[1]):
            _, score, fits = sent.value.predict(batch.column(at)[i:j].to_pylist())
            yield batch.slice(i, j - i).filter(pa.array(fits & (score >= LEAST_SCORE)))

    return docs.mapInArrow(by_batch(kernel), docs.schema)


def op7_string_kernel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, lang_pred, score for all of documents; the model is fitted on documents as well."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return identify(docs, fit(docs))
