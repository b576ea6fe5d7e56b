"""From raw documents to training rows, in five stages; each reads what the one before it kept.

All stages take null, empty and very long texts, rows that repeat, nulls in every column, extra columns and empty tables;
what each makes of them is said in its operator's docstring. No stage crashes on them, and an empty table stays empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from touchline.llm import decontaminate, langid, secrets, simhash, subwords
from touchline.llm.common import drop_folder, new_folder, scratch, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts without a language and those that fit none; the model is fitted on the same rows."""
    return langid.identified(docs, langid.fit(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates."""
    return simhash.one_of_each(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents in which a benchmark window occurs."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks secrets; all rows stay."""
    return secrets.mask(docs)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds piece_ids, and same: whether decoding them gave the text again (but for U+2581, which is a space there)."""
    return subwords.with_pieces(docs, public_tokenizers.path(subwords.MODEL))


STAGES = [
    ("language ID", language),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", benchmark),
    ("secret scans", mask_secrets),
    ("SentencePiece encoding and decoding", pieces),
]

#: Kernels, components and token ids have no SQL; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents. What a stage keeps is written before the next reads it; then what that stage read, and
    the tables it needed, are deleted. The last stage is lazy: what it reads stays in the shared folder."""
    docs, read = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        out = new_folder(spark, name.replace(" ", "-"))
        with scratch(spark):
            kept = stage(spark, docs, sf_dir)
            kept.write.parquet(out)
        if read:
            drop_folder(spark, read)
        docs, read = spark.read.schema(kept.schema).parquet(out), out
    return STAGES[-1][1](spark, docs, sf_dir)
