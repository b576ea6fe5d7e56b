"""Secret scans: an Aho-Corasick pass finds keywords, regular expressions are tried only where one stands, and tokens
that carry a checksum count only if it holds.

Kinds and their order in a digest: assign, access, hex (the base kinds), then github, npm (CRC-32 in the last six
base-62 digits), jwt (a header that decodes to JSON with an "alg") and key (a private key's opening line).
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import zlib
from collections.abc import Iterator
from itertools import accumulate

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import by_batch, table

KINDS = ("assign", "access", "hex", "github", "npm", "jwt", "key")
BASE = KINDS[:3]
HEX = re.compile(rb"[0-9a-f]{16,}")
_BASE62 = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def _crc_holds(token: bytes) -> bool:
    """Whether the last six base-62 digits are the CRC-32 of what stands between prefix and them."""
    body, tail = token[token.index(b"_") + 1 : -6], token[-6:]
    value = 0
    for c in tail:
        value = value * 62 + _BASE62.index(c)
    return value == zlib.crc32(body)


def _is_jwt(token: bytes) -> bool:
    head = token.split(b".")[0]
    try:
        return "alg" in json.loads(base64.urlsafe_b64decode(head + b"=" * (-len(head) % 4)))
    except (ValueError, TypeError, RecursionError):
        return False


#: kind, expression tried at a keyword, test of the match. A failing match still uses up its text.
_RULES = {
    "assign": (
        re.compile(rb"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), lambda m: len(m[2]) >= 12
    ),
    "access": (re.compile(rb"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 18),
    "github": (re.compile(rb"gh[pousr]_[A-Za-z0-9]{36}(?![A-Za-z0-9])"), lambda m: _crc_holds(m[0])),
    "npm": (re.compile(rb"npm_[A-Za-z0-9]{36}(?![A-Za-z0-9])"), lambda m: _crc_holds(m[0])),
    "jwt": (re.compile(rb"eyJ[A-Za-z0-9_-]++\.[A-Za-z0-9_-]++\.[A-Za-z0-9_-]++"), lambda m: _is_jwt(m[0])),
    "key": (re.compile(rb"-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY-----"), lambda m: True),
}
#: Where one of these kinds fails, so does every later start in the same run of these characters, which is passed over.
_RUNS = {"jwt": re.compile(rb"[A-Za-z0-9_-]++")}
_KEYWORDS = {w: "assign" for w in ("password", "passwd", "secret", "token", "apikey", "api_key")}
_KEYWORDS |= {"akia": "access", "npm_": "npm", "eyj": "jwt", "-----begin ": "key"} | {f"gh{c}_": "github" for c in "pousr"}


def _automaton() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for word, kind in _KEYWORDS.items():
        a.add_word(word, (kind, len(word)))
    a.make_automaton()
    return a


_FIND = _automaton()


def spans_of(text: str | None) -> list[tuple[int, int, str]]:
    """(start, end, kind) in code points, by start, then kind as listed. Matches of a kind don't overlap."""
    if not text:
        return []
    raw = text.encode()
    found, past = [(*m.span(), 2) for m in HEX.finditer(raw)], {}
    for last, (kind, n) in _FIND.iter(raw.lower().decode("latin-1")):  # one character a byte
        start = last + 1 - n
        if start < past.get(kind, 0):
            continue
        rule, holds = _RULES[kind]
        if m := rule.match(raw, start):
            past[kind] = m.end()
            if holds(m):
                found.append((*m.span(), KINDS.index(kind)))
        elif run := kind in _RUNS and _RUNS[kind].match(raw, start):
            past[kind] = run.end()
    found.sort(key=lambda x: (x[0], x[2], x[1]))
    if found and len(raw) != len(text):
        cuts = sorted({0, *(x for f in found for x in f[:2])})
        points = dict(zip(cuts[1:], accumulate(len(raw[a:b].decode()) for a, b in zip(cuts, cuts[1:])))) | {0: 0}
        found = [(points[a], points[b], k) for a, b, k in found]
    return [(a, b, KINDS[k]) for a, b, k in found]


def digest(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans for each row of docs(doc_id, text).

    A null text is empty; a text without spans has an empty list; rows that repeat give a row each, and an empty table
    none. Texts of any length are scanned whole, in time linear in their length."""

    def kernel(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        counts, shas, all_ = [[], [], []], [], []
        for text in batch.column(1):
            spans = spans_of(text.as_py())
            base = [s for s in spans if s[2] in BASE]
            for c, kind in zip(counts, BASE):
                c.append(sum(s[2] == kind for s in base))
            shas.append(hashlib.sha256(digest(base).encode()).hexdigest())
            all_.append(digest(spans))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(shas), pa.array(all_)],
            ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
        )

    keys = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return keys.mapInArrow(by_batch(kernel), "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def masked(text: str | None) -> str | None:
    """The text with each stretch of overlapping spans replaced by [SECRET]."""
    out, at = [], 0
    for a, b, _ in spans_of(text):
        if a >= at:
            out += [text[at:a], "[SECRET]"]
        at = max(at, b)
    return "".join([*out, text[at:]]) if out else text


def mask(docs: DataFrame) -> DataFrame:
    """docs with the secrets in text masked and n_chars, if there, counted anew where a text changed; all rows stay.

    Null and empty texts stay as they are, as does every other column, null or not; rows that repeat are masked each; an
    empty table stays empty; a long text is masked whole, in time linear in its length."""
    names, schema = docs.columns, docs.schema

    def kernel(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        cols = {n: batch.column(i) for i, n in enumerate(names)}
        old = cols["text"].to_pylist()
        new = [masked(t) for t in old]
        cols["text"] = pa.array(new, cols["text"].type)
        if "n_chars" in cols:
            chars = cols["n_chars"].to_pylist()
            cols["n_chars"] = pa.array([c if a is b else len(b) for a, b, c in zip(old, new, chars)], cols["n_chars"].type)
        yield pa.RecordBatch.from_arrays(list(cols.values()), names)

    return docs.mapInArrow(by_batch(kernel), schema)


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans for all of documents."""
    return scan(table(spark, sf_dir, "documents"))
