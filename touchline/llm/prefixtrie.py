"""A prefix trie of conversations, as tables of nodes with minimal perfect hashes.

A node is a distinct sequence of first turns. Its key has 128 bits of a chained digest, its name is (smallest member,
depth). Nodes are counted by one grouping of keys. The sums over subtrees are made in tasks: nodes are dealt out by whole
subtrees with LIMIT turns below them at most, each task enumerates the keys of some subtrees, assigns slots 0 to n - 1 by a
minimal perfect hash (levels of bit arrays: a key that is alone in its place gets the place's rank), verifies every
slot by the whole key, scatters counts into flat arrays and adds them up through an array of parents' slots, deepest
nodes first.

Nodes with more below them are heavy: they wait, take the sums of the light subtrees that hang on them, and make up a much
smaller trie, which is treated alike in the next round. So no task holds more than a few subtrees of bounded size,
however many conversations share a beginning, and rounds grow with the logarithm of the table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import met, mixed, staged, table, whole_runs
from .repair import crc32_sql

#: Conversations of one hundred share the turns of its first; so many at most.
BASES, SHARED = 100, 5
#: Turns of members below a light node at most.
LIMIT = 1 << 15
#: Ends of a node are hashed in blocks of 2^BLOCK neighbouring conv_ids.
BLOCK = 9
KEY = ["n1", "n2"]
PATHS = "conv_id long, depth long, length long, size long, n1 long, n2 long, p1 long, p2 long, proof long"
DONE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, n1 long, n2 long, p1 long, p2 long, top boolean"


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 0, by turn, null first, then by digest), digest of role and text, code points of the text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256))
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), digest.alias("digest"), F.length(text).cast("long").alias("size")
    )
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "digest")) - 1
    return rows.select("conv_id", place.alias("pos"), "digest", "size")


def rebuilt(own: DataFrame) -> DataFrame:
    """conv_id, pos, digest, size: the turns of every rebuilt conversation of turns(), and a row at pos -1 for each."""
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (SHARED + 1)).cast("int")
    convs = own.where("pos = 0").select("conv_id", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % BASES).alias("base"))
    first = own.where((F.col("conv_id") % BASES == 0) & (F.col("pos") < SHARED)).groupBy(F.col("conv_id").alias("base"))
    first = first.agg(F.sort_array(F.collect_list(F.struct("pos", "digest", "size"))).alias("head"))  # SHARED at most
    taken = convs.join(first, "base").select("conv_id", F.explode(F.slice("head", F.lit(1), F.col("h"))).alias("t")).select("conv_id", "t.*")
    roots = convs.select("conv_id", F.lit(-1).alias("pos"), F.lit(None).cast("binary").alias("digest"), F.lit(0).cast("long").alias("size"))
    return own.where(F.col("pos") >= h).unionByName(taken).unionByName(roots)


def paths(turns_of: DataFrame) -> DataFrame:
    """PATHS: a row for each rebuilt conversation and number of its first turns, 0 included, with the keys of the node and
    of its parent. Conversations stream through a task; it holds one digest."""
    whole = Window.partitionBy("conv_id").orderBy("pos")
    rows = turns_of.select(
        "conv_id", (F.row_number().over(whole) - 1).cast("long").alias("depth"),
        (F.count("*").over(whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)) - 1).alias("length"), "size", "digest", "pos"
    ).sortWithinPartitions("conv_id", "pos")  # as the windows leave them

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = bytes(16)
        for batch in batches:
            keys, parents = bytearray(), bytearray()
            for depth, digest in zip(batch.column(1).to_pylist(), batch.column(4).to_pylist()):
                parents += state if depth else bytes(16)
                state = hashlib.blake2b(state + digest if depth else b"", digest_size=16).digest()
                keys += state
            columns = [pa.array(np.frombuffer(bytes(x), np.int64).reshape(-1, 2)[:, k].copy()) for x in (keys, parents) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], *columns, batch.column(4)], ["conv_id", "depth", "length", "size", "n1", "n2", "p1", "p2", "digest"])

    chained = rows.select("conv_id", "depth", "length", "size", "digest").mapInArrow(kernel, PATHS.replace("proof long", "digest binary"))
    return chained.select("conv_id", "depth", "length", "size", *KEY, "p1", "p2", F.xxhash64("p1", "p2", "digest").alias("proof"))


class Slots:
    """A minimal perfect hash of distinct 128-bit keys: slot(key) is 0 to n - 1, or -1 for a key that is not among them."""

    def __init__(self, a: np.ndarray, b: np.ndarray) -> None:
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []  # of places: whether a key is alone there, and its slot
        rest, used = np.arange(len(a)), 0
        while len(rest):
            size = 2 * len(rest) + 1
            at = self._place(a[rest], b[rest], size)
            alone = np.bincount(at, minlength=size) == 1
            self.levels.append((alone, used + np.cumsum(alone) - 1))
            used += int(alone.sum())
            rest = rest[~alone[at]]
        self.a, self.b = np.zeros(len(a), np.int64), np.zeros(len(a), np.int64)
        own = self._slots(a, b)
        self.a[own], self.b[own] = a, b
        assert np.array_equal(np.bincount(own, minlength=len(a)), np.ones(len(a), np.int64)), "two keys have one slot"

    def _place(self, a: np.ndarray, b: np.ndarray, size: int) -> np.ndarray:
        seed = np.uint64((0x9E3779B97F4A7C15 * (len(self.levels) + 1) + size) & (2**64 - 1))
        return (mixed(mixed(a.view(np.uint64) ^ seed) + b.view(np.uint64)) % np.uint64(size)).astype(np.int64)

    def _slots(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out, rest, levels = np.full(len(a), -1), np.arange(len(a)), self.levels
        self.levels = []
        for alone, slot in levels:  # the seed of a place depends on the number of levels before it
            at = self._place(a[rest], b[rest], len(alone))
            self.levels.append((alone, slot))
            out[rest[alone[at]]] = slot[at[alone[at]]]
            rest = rest[~alone[at]]
        return out

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        slot = self._slots(a, b)
        good = (slot >= 0) & (self.a[slot] == a) & (self.b[slot] == b) if len(self.a) else np.zeros(len(a), bool)
        return np.where(good, slot, -1)


def summed(nodes: DataFrame) -> DataFrame:
    """DONE for nodes(f1, f2, conv_id, depth, top_conv, n_convs, size, children, leaves, saved, n1, n2, p1, p2): whole subtrees, (f1, f2)
    the key of their top, whose parent's name is top_conv; children, leaves and saved come from subtrees done before."""
    names = [x.split()[0] for x in DONE.split(", ")]

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_runs(batches):
            c = {n: t[n].to_numpy() for n in t.column_names if n != "top_conv"}
            slots = Slots(c["n1"], c["n2"])
            slot = slots.of(c["n1"], c["n2"])
            flat = {n: np.empty(len(slot), np.int64) for n in ("conv_id", "depth", "n_convs", "size", "children", "leaves", "saved", "parent", "row")}
            parent = np.where(c["depth"] > 0, slots.of(c["p1"], c["p2"]), -1)
            for n, v in (*c.items(), ("parent", parent), ("row", np.arange(len(slot)))):
                if n in flat:
                    flat[n][slot] = v
            inside = flat["parent"] >= 0
            flat["children"] += np.bincount(flat["parent"][inside], minlength=len(slot))
            flat["leaves"] += flat["children"] == 0
            flat["saved"] += (flat["n_convs"] - 1) * flat["size"]
            order = np.argsort(-flat["depth"], kind="stable")
            bounds = np.flatnonzero(np.diff(flat["depth"][order], prepend=-1, append=-1))
            for i, j in zip(bounds[:-1], bounds[1:]):
                level = order[i:j][inside[order[i:j]]]
                for n in ("leaves", "saved"):
                    np.add.at(flat[n], flat["parent"][level], flat[n][level])
            over = t["top_conv"].combine_chunks().take(pa.array(flat["row"]))
            name = pa.array(np.where(inside, flat["conv_id"][flat["parent"]], 0), mask=~inside)
            at = lambda n: pa.array(c[n][flat["row"]])
            columns = [pa.array(flat["conv_id"]), pa.array(flat["depth"]), pc.coalesce(name, over), pa.array(flat["n_convs"])]
            columns += [pa.array(flat[n]) for n in ("children", "leaves", "saved")] + [at(n) for n in ("n1", "n2", "p1", "p2")] + [pa.array(~inside)]
            yield pa.RecordBatch.from_arrays(columns, names)

    return nodes.repartition("f1", "f2").sortWithinPartitions("f1", "f2").mapInArrow(kernel, DONE)


def ends(of: DataFrame) -> DataFrame:
    """n1, n2, ends_sha256 of the nodes of paths() at which some conversation ends. Blocks of neighbouring conv_ids are
    joined first, then stream through the hash in order, so that no task holds a node's conversations."""
    last = of.where("depth = length").groupBy(*KEY, F.shiftright("conv_id", BLOCK).alias("block"))
    blocks = last.agg(F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))  # 2^BLOCK at most

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, running = None, None
        for batch in batches:
            done = []
            for a, b, ids in zip(*(batch.column(k).to_pylist() for k in (0, 1, 3))):
                if (a, b) != own:
                    if running:
                        done.append((*own, running.hexdigest()))
                    own, running = (a, b), hashlib.sha256(ids.encode())
                else:
                    running.update(f",{ids}".encode())
            yield _hashes(done)
        if running:
            yield _hashes([(*own, running.hexdigest())])

    return blocks.repartition(*KEY).sortWithinPartitions(*KEY, "block").mapInArrow(kernel, "n1 long, n2 long, ends_sha256 string")


def _hashes(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [(), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, (pa.int64(), pa.int64(), pa.string()))], ["n1", "n2", "ends_sha256"])


def trie(conversations: DataFrame, limit: int = LIMIT) -> DataFrame:
    """A row for each node of the trie of conversations(conv_id, turn, role, text), rebuilt: conv_id, depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256.

    Turns of a conversation are taken by turn, null first, those of one turn by the digest of role and text; null role and text are
    empty; repeated rows are turns of their own; rows with a null conv_id belong to no conversation and are left out. Extra
    columns don't matter; an empty table has no node, not even a root. Two prefixes with one key (128 bits) raise an error."""
    own = staged(turns(conversations), "turns")
    every = staged(paths(rebuilt(own)), "paths")
    way = every.select("conv_id", "depth", "length", *KEY)
    zero = [F.lit(0).cast("long").alias(n) for n in ("children", "leaves", "saved")]
    grouped = every.groupBy(*KEY).agg(
        F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), *(F.min(c).alias(c) for c in ("depth", "size", "p1", "p2")),
        F.sum(F.col("length") - F.col("depth")).alias("below"), (F.min("proof") != F.max("proof")).alias("collides")
    )
    nodes = staged(grouped.select("*", F.col("n_convs").alias("rows"), *zero), "nodes")
    if nodes.where("collides").limit(1).count():
        raise RuntimeError("two prefixes have one key")
    done, constant = [], ["conv_id", "depth", "n_convs", "size", *KEY, "p1", "p2"]
    while True:
        light, heavy = nodes.where(F.col("below") <= limit), nodes.where(F.col("below") > limit)
        last = not heavy.limit(1).count()
        if last:
            cut = light.select("*", F.lit(0).cast("long").alias("f1"), F.lit(0).cast("long").alias("f2"), F.lit(None).cast("long").alias("top_conv"))
        else:
            known = heavy.select(*KEY, F.col("conv_id").alias("name"), "rows")
            over = staged(met(way.select("conv_id", "depth", *KEY), known, KEY, "rows"), "heavy-paths")
            tops = over.groupBy("conv_id").agg(F.max("depth").alias("top"), F.max_by("name", "depth").alias("top_conv"))
            tops = staged(tops, "tops")
            below = way.join(tops, "conv_id").where(F.col("depth") == F.col("top") + 1)
            cut = light.join(below.select("conv_id", F.col("n1").alias("f1"), F.col("n2").alias("f2"), "top_conv"), "conv_id")
        done.append(staged(summed(cut.select("f1", "f2", "top_conv", "children", "leaves", "saved", *constant)), "sums"))
        if last:
            break
        hung = done[-1].where("top").groupBy(F.col("p1").alias("n1"), F.col("p2").alias("n2"))
        hung = hung.agg(F.count("*").alias("c"), F.sum("n_leaves").alias("l"), F.sum("saved_tokens").alias("s"))
        way = over.select("conv_id", "depth", *KEY).join(heavy.select("conv_id").distinct(), "conv_id", "left_semi").join(tops, "conv_id")
        way = staged(way.select("conv_id", "depth", F.col("top").alias("length"), *KEY), "heavy-ways")
        weights = way.groupBy(*KEY).agg(F.sum(F.col("length") - F.col("depth")).alias("below"), F.count("*").alias("rows"))
        more = [(F.col(n) + F.coalesce(m, F.lit(0))).alias(n) for n, m in (("children", "c"), ("leaves", "l"), ("saved", "s"))]
        nodes = heavy.drop("below", "rows").join(weights, KEY).join(hung, KEY, "left")
        nodes = staged(nodes.select(*constant, "below", "rows", *more), "heavy")
    every_node = done[0]
    for d in done[1:]:
        every_node = every_node.unionByName(d)
    names = [x.split()[0] for x in DONE.split(", ")][:7]
    got = every_node.select(*names, *KEY).join(ends(every), KEY, "left")
    return got.select(*names, F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All nodes of the trie of conversations."""
    return trie(table(spark, sf_dir, "conversations"))


ORACLE = f"""
WITH own AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest) - 1 AS pos, digest, size FROM (
    SELECT conv_id, turn, sha256(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS digest,
      length(coalesce(text, '')) AS size FROM conversations WHERE conv_id IS NOT NULL)),
convs AS (SELECT c, c - c % 100 AS base, {crc32_sql("c::VARCHAR")} % 6 AS h FROM (SELECT DISTINCT conv_id AS c FROM own)),
built AS (
  SELECT c, pos, digest, size FROM convs JOIN own ON conv_id = base AND pos < h
  UNION ALL SELECT c, pos, digest, size FROM convs JOIN own ON conv_id = c AND pos >= h),
chained AS (
  SELECT c, row_number() OVER w AS depth, size, sha256(string_agg(digest, '') OVER w) AS node FROM built WINDOW w AS (PARTITION BY c ORDER BY pos)),
paths AS (
  SELECT c, depth, size, node, lag(node, 1, 'root') OVER (PARTITION BY c ORDER BY depth) AS parent FROM chained
  UNION ALL SELECT c, 0, 0, 'root', NULL FROM convs),
nodes AS (
  SELECT node, min(c) AS conv_id, min(depth) AS depth, min(size) AS size, min(parent) AS parent, count(*) AS n_convs FROM paths GROUP BY node),
kids AS (SELECT parent, count(*) AS n FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
own_sums AS (
  SELECT x.conv_id, x.depth, CASE WHEN k.n IS NULL THEN 1 ELSE 0 END AS leaf, (x.n_convs - 1) * x.size AS saved FROM nodes x LEFT JOIN kids k ON k.parent = x.node),
sums AS (
  SELECT p.node, sum(leaf) AS n_leaves, sum(saved) AS saved FROM own_sums s JOIN paths p ON p.c = s.conv_id AND p.depth <= s.depth GROUP BY p.node),
finals AS (
  SELECT node, sha256(string_agg(c::VARCHAR, ',' ORDER BY c)) AS h FROM (SELECT c, node, depth, max(depth) OVER (PARTITION BY c) AS most FROM paths)
  WHERE depth = most GROUP BY node)
SELECT x.conv_id, x.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, x.n_convs, coalesce(k.n, 0) AS n_children, s.n_leaves::BIGINT AS n_leaves,
  s.saved::BIGINT AS saved_tokens, coalesce(f.h, sha256('')) AS ends_sha256
FROM nodes x JOIN sums s USING (node) LEFT JOIN nodes p ON p.node = x.parent LEFT JOIN kids k ON k.parent = x.node LEFT JOIN finals f ON f.node = x.node
"""
