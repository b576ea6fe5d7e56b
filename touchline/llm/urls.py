"""URL filters by a Bloom filter cascade, in DataFrame functions only.

Level 1 holds the listed keys, level 2 the unlisted keys of the corpus that level 1 lets through, level 3 the listed
ones that level 2 lets through, and so on until a level lets nothing wrong through. The first level that a key misses
tells whether it is listed, and over the corpus's complete key universe that is exact. Looking a key up takes a few bit
tests on literals: no join, no shuffle.

Literals are bounded, so keys are dealt by their hash to as many segments as it takes, each with a cascade of its own. One
segment judges all pages in one plan. Of several, each reads the pages of its own keys alone, from a table parted by
segment, and writes its verdicts; together they read every page once, and some are worked on at a time.
"""

from __future__ import annotations

import math
import string
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import new_folder, staged, table

#: All levels of a segment together: 2 MB at most go into a plan.
MAX_BITS = 1 << 24
#: Pages and keys lie in so many folders at most; segments beyond that share folders.
MOST_FOLDERS = 4096
#: Files of a folder at most, and segments that are worked on at once.
FILES, TOGETHER = 8, 8
#: (verdict, host, path); a rule fits its host and all subdomains if the path starts with the rule's.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host(url: str = "url") -> Column:
    """What stands between the first :// and the next /, ? or #, with A-Z lowered; empty without one."""
    return F.coalesce(F.translate(F.regexp_extract(url, _URL, 1), string.ascii_uppercase, string.ascii_lowercase), F.lit(""))


def path(url: str = "url") -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def _positions(key: str, level: int, bits: int, probes: int) -> list[Column]:
    h = F.xxhash64(F.lit(level), F.col(key))
    low, high = h.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(h, 32).bitwiseOR(F.lit(1))
    return [(low + high * i) % bits for i in range(probes)]


def _contains(key: str, level: int, bits: int, probes: int, words: str) -> Column:
    table_ = F.split(F.lit(words), ",").cast("array<bigint>")  # folded to one literal
    tests = [
        F.call_function(
            "shiftright", F.get(table_, F.floor(p / 64).cast("int")), (p % 64).cast("int")
        ).bitwiseAND(F.lit(1)) == 1 for p in _positions(key, level, bits, probes)
    ]
    return reduce(lambda a, b: a & b, tests)


def _level(keys: DataFrame, level: int, bits: int, probes: int) -> tuple[int, str]:
    """The number of keys and the 64-bit words of their Bloom filter, comma-joined, in one job; Spark folds the keys, so
    that bits / 64 rows reach the driver."""
    at = keys.select(F.explode(F.array(*_positions("key", level, bits, probes))).alias("p"))
    words = at.groupBy(F.floor(F.col("p") / 64).alias("w")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(p % 64 as int))")).alias("b"), F.count("*").alias("n")
    )
    out, n = [0] * (bits // 64), 0
    for r in words.collect():
        out[r["w"]] = r["b"]
        n += r["n"]
    return n // probes, ",".join(map(str, out))


def _size(n: float, probes: int) -> int:
    return 64 * max(1, math.ceil(n * probes * 1.4427 / 64))


def _probes(listed: int, others: int) -> int:
    """Those of level 1, by which the whole is smallest; further levels have two."""
    return max(1, math.ceil(math.log2(max(2, 1.42 * others / listed))))


def expected_bits(listed: int, others: int) -> int:
    """Of all levels: about half of the listed keys' number of others pass level 1, a quarter of the rest each further one."""
    return _size(listed, _probes(listed, others)) + 4 * _size(listed, 1) if listed else 0


def cascade(universe: DataFrame, listed: int, others: int, max_bits: int = MAX_BITS) -> Column | None:
    """Whether column key is listed, for universe(key string, listed boolean) with so many keys of both kinds; None if
    the levels don't fit in max_bits and there are keys to split.

    The universe must be a stored table of distinct keys: each level reads it. Levels after the first are made for the
    number of keys expected; a wrong guess costs bits or a level, never a wrong answer."""
    if not listed:
        return F.lit(False)
    held, tested = universe.where("listed"), universe.where("not listed")
    n, m, probes, used, levels = float(listed), float(others), _probes(listed, others), 0, []
    while True:
        bits = _size(n, probes)
        used += bits
        if used > max_bits and listed > 1:
            return None
        count, words = _level(held, len(levels), bits, probes)
        if not count:
            break
        levels.append(_contains("key", len(levels), bits, probes, words))
        held, tested = tested.where(levels[-1]), held
        n, m, probes = m * (1 - math.exp(-count * probes / bits)) ** probes, float(count), 2
        n += 3 * math.sqrt(n) + 8
    out = F.lit(len(levels) % 2 == 1)
    for i, inside in reversed(list(enumerate(levels))):
        out = F.when(~inside, F.lit(i % 2 == 1)).otherwise(out)
    return out


def rule_of(host_: Column, path_: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits (like net/) and its verdict; null without one."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host_ == h) | F.endswith(host_, F.lit(f".{h}"))) & F.startswith(path_, F.lit(p))
        name, verdict = F.when(fits, F.lit(h + p)).otherwise(name), F.when(fits, F.lit(v)).otherwise(verdict)
    return name, verdict


def judge(pages: DataFrame, listed: DataFrame, rules=RULES, max_bits: int = MAX_BITS) -> DataFrame:
    """page_id, host, path, rule, verdict for each row of pages(page_id, url); listed(key) holds host + path of what to block.

    A rule's verdict holds where one fits, else listed pages are blocked and all others allowed. A null url, or one
    without ://, has neither host nor path; its empty key is never listed, nor is a null key. Rows that repeat give a
    row each; an empty table gives none, an empty list blocks nothing. The corpus's keys are gathered without regard to
    how often each occurs, so a hot host or url costs one row a task."""
    spark = pages.sparkSession
    parts = pages.select("page_id", host().alias("host"), path().alias("path")).withColumn("key", F.concat("host", "path"))
    keys = parts.select("key", F.lit(False).alias("listed")).unionByName(
        listed.select(F.col("key").cast("string").alias("key"), F.lit(True).alias("listed"))
    )
    universe = staged(keys.where("key <> ''").groupBy("key").agg(F.bool_or("listed").alias("listed")), "url-keys")
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)

    def judged(rows: DataFrame, inside: Column) -> DataFrame:
        blocked = F.when((F.col("key") != "") & inside, F.lit("block")).otherwise(F.lit("allow"))
        return rows.select("page_id", "host", "path", name.alias("rule"), F.coalesce(verdict, blocked).alias("verdict"))

    def sizes(of: DataFrame) -> tuple[int, int]:
        n = dict(of.groupBy("listed").count().collect())
        return n.get(True, 0), n.get(False, 0)

    n = sizes(universe)
    if expected_bits(*n) <= max_bits and (inside := cascade(universe, *n, max_bits)) is not None:
        return judged(parts, inside)
    first = min(1 << math.ceil(math.log2(max(2, 1.2 * expected_bits(*n) / max_bits))), MOST_FOLDERS)
    segment = lambda of: F.pmod(F.xxhash64(F.lit("segment"), F.col("key")), F.lit(of))

    def parted(df: DataFrame, folder: str, salt: str) -> DataFrame:
        """df in folders by segment, of FILES files each at most; rows of one key go to as many tasks, for salt is not of the key."""
        rows = df.withColumn("folder", segment(first)).withColumn("salt", F.pmod(F.xxhash64(F.lit("salt"), F.col(salt)), F.lit(FILES)))
        rows.repartition("folder", "salt").drop("salt").write.partitionBy("folder").parquet(at := new_folder(spark, folder))
        return spark.read.schema(rows.drop("salt").schema).parquet(at)

    out = new_folder(spark, "url-verdicts")
    parts, universe = parted(parts, "url-pages", "page_id"), parted(universe, "url-segments", "key")

    def judged_segment(m: int, r: int) -> str | None:
        """Where the verdicts of a segment's pages are; None if its keys are too many for one plan."""
        mine = (F.col("folder") == r % first) & (segment(m) == r)
        own = universe.where(mine)
        inside = cascade(own, *sizes(own), max_bits)
        if inside is None:
            return None
        judged(parts.where(mine), inside).write.parquet(f"{out}/{m}-{r}")
        return f"{out}/{m}-{r}"

    todo, done = [(first, r) for r in range(first)], []
    with ThreadPoolExecutor(TOGETHER) as pool:  # a segment's jobs are small: several at once fill the cluster
        while todo:
            found = list(pool.map(lambda x: judged_segment(*x), todo))
            done += [at for at in found if at]
            # the keys of those that are left are dealt to two
            todo = [(2 * m, r + k * m) for (m, r), at in zip(todo, found) if not at for k in (0, 1)]
    return spark.read.schema(judged(parts, F.lit(False)).schema).parquet(*done)


def op3_bloom_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, host, path, rule, verdict for all of pages. The tables have no block list; the one used here stands in
    for it: the addresses whose MD5 begins with 0, a sixteenth of all."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    key = F.concat(host(), path())
    return judge(pages, pages.select(key.alias("key")).where("md5(key) like '0%'"))


ORACLE = r"""
with u as (select page_id, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as rest from pages),
p as (select page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
             coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') as path from u),
r as (select * from (values ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'),
('block', 'com', '/de/')) as t(v, h, x)),
f as (select page_id, host, path, max_by(h || x, length(h || x)) as rule, max_by(v, length(h || x)) as v
      from p left join r on (host = h or ends_with(host, '.' || h)) and starts_with(path, x) group by page_id, host, path)
select page_id, host, path, rule, coalesce(v, case when md5(host || path) like '0%' and host || path <> '' then 'block' else 'allow' end) as verdict
from f
"""
