"""Minimum-cost-flow resharding of a folder of shards.

Each new shard has a capacity in bytes. The flow that moves the fewest bytes is solved over the shards (a few nodes,
whatever the data) by successive cheapest paths, then laid over the files: within an old shard files stand in the order of
their paths, the first bytes stay, the next go to the first receiver, and so on. A file that stays whole is not touched. A
file that goes whole is copied to its new shard; the few in which a border falls are cut at a row. Nothing is shuffled, the
old files are left as they are, and the new layout holds from the moment its list of files is written.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from .common import BROADCAST_KEYS, new_folder, table

SHARDS = 8
#: The folder level that says which shard a file is of.
PART = "__shard"
Flow = list[tuple[int, int, int]]


def min_cost_flow(supply: list[int], capacity: list[int], cost: Callable[[int, int], int]) -> Flow:
    """(old, new, amount) rows that send all supplies within the capacities at the least total of cost x amount.

    Successive cheapest augmenting paths with Bellman-Ford; the graph has one node per shard."""
    n, m = len(supply), len(capacity)
    left, room = list(supply), list(capacity)
    sent = [[0] * m for _ in range(n)]
    while any(left):
        dist: dict[tuple[str, int], tuple[int, tuple | None]] = {("o", i): (0, None) for i in range(n) if left[i]}
        changed = True
        while changed:
            changed = False
            for i in range(n):
                for j in range(m):
                    if ("o", i) in dist and (("n", j) not in dist or dist["o", i][0] + cost(i, j) < dist["n", j][0]):
                        dist["n", j], changed = (dist["o", i][0] + cost(i, j), ("o", i)), True
                    if sent[i][j] and ("n", j) in dist and (("o", i) not in dist or dist["n", j][0] - cost(i, j) < dist["o", i][0]):
                        dist["o", i], changed = (dist["n", j][0] - cost(i, j), ("n", j)), True
        ends = [j for j in range(m) if room[j] and ("n", j) in dist]
        if not ends:
            raise ValueError("the capacities hold less than the supplies")
        end = min(ends, key=lambda j: (dist["n", j][0], j))
        path, node = [], ("n", end)
        while node is not None:
            path.append(node)
            node = dist[node][1]
        path.reverse()
        steps = list(zip(path, path[1:]))
        amount = min([left[path[0][1]], room[end], *(sent[b[1]][a[1]] for a, b in steps if a[0] == "n")])
        for a, b in steps:
            if a[0] == "o":
                sent[a[1]][b[1]] += amount
            else:
                sent[b[1]][a[1]] -= amount
        left[path[0][1]] -= amount
        room[end] -= amount
    return [(i, j, sent[i][j]) for i in range(n) for j in range(m) if sent[i][j]]


def plan(sizes: dict[int, int], shards: int) -> Flow:
    """The flow from old shard sizes to even capacities (at most one byte apart); bytes that stay cost nothing."""
    total = sum(sizes.values())
    old = sorted(sizes)
    capacity = [total // shards + (j < total % shards) for j in range(shards)]
    return [(old[i], j, n) for i, j, n in min_cost_flow([sizes[i] for i in old], capacity, lambda i, j: int(old[i] != j))]


def _intervals(flow: Flow) -> list[tuple[int, int, int, int]]:
    """(old, from, to, new) byte ranges of each old shard; what stays comes first."""
    out, at = [], {}
    for old, new, n in sorted(flow, key=lambda x: (x[0], x[0] != x[1], x[1])):
        a = at.get(old, 0)
        out.append((old, a, a + n, new))
        at[old] = a + n
    return out


def size_of(text: str = "text") -> F.Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


@dataclass
class Layout:
    """files(path, shard, first, rows): the files of each shard, with the slot of a file's first row; and the rows' schema."""

    files: DataFrame
    schema: StructType


def lay_out(docs: DataFrame, shard: F.Column, folder: str) -> Layout:
    """Writes docs as the files of shards (never null) in a new folder."""
    docs.withColumn(PART, shard.cast("int")).write.partitionBy(PART).parquet(folder)
    return listed(docs.sparkSession, folder, docs.schema, {}, f"{folder}.layout")


def listed(spark: SparkSession, folder: str, schema: StructType, kept: dict[str, int], to: str) -> Layout:
    """The layout of the files below folder and of those kept from elsewhere (path to shard), written to a table."""
    parts = spark.read.schema(StructType([*schema.fields]).add(PART, IntegerType())).parquet(folder)
    found = parts.select(F.col("_metadata.file_path").alias("path"), F.col(PART).alias("shard"))
    if kept:
        old = spark.read.schema(schema).parquet(*map(unquote, kept)).select(F.col("_metadata.file_path").alias("path"))
        shards = spark.createDataFrame(list(kept.items()), "path string, shard int")
        found = found.unionByName(
            old.groupBy("path").agg(F.count("*").alias("n")).join(shards, "path").select("path", "shard", "n"), allowMissingColumns=True
        )
    else:
        found = found.withColumn("n", F.lit(None).cast("long"))
    rows = found.groupBy("path", "shard").agg(F.sum(F.coalesce("n", F.lit(1))).alias("rows"))
    before = Window.partitionBy("shard").orderBy("path").rowsBetween(Window.unboundedPreceding, -1)  # files, not rows
    rows.select("path", "shard", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("first"), "rows").write.parquet(to)
    return Layout(spark.read.schema("path string, shard int, first long, rows long").parquet(to), schema)


def rows_of(layout: Layout) -> DataFrame:
    """All rows as the files have them, with shard and slot (gapless from 0 in each shard)."""
    spark, files = layout.files.sparkSession, layout.files
    paths = [unquote(r["path"]) for r in files.select("path").collect()]  # as Spark lists them itself to read them
    if not paths:
        return spark.createDataFrame([], layout.schema).select("*", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    rows = spark.read.schema(layout.schema).parquet(*paths).select(
        "*", F.col("_metadata.file_path").alias("__path"), F.col("_metadata.row_index").alias("__row")
    )
    places = files.select(F.col("path").alias("__path"), F.col("shard").alias("__shard"), "first")
    met = rows.join(F.broadcast(places) if len(paths) <= BROADCAST_KEYS else places, "__path")
    return met.select(*layout.schema.names, F.col("__shard").alias("shard"), (F.col("first") + F.col("__row")).alias("slot"))


def transfers(files: list[tuple[str, int, int]], shards: int) -> tuple[dict[str, int], dict[str, int], list[tuple[str, int, int]]]:
    """Of files (path, shard, bytes): those that stay (path to shard), those that go whole (path to new shard), and
    for each cut file the bytes from which its rows go to a shard: (path, from, new shard)."""
    sizes: dict[int, int] = {}
    for _, shard, n in files:
        sizes[shard] = sizes.get(shard, 0) + n
    ranges: dict[int, list[tuple[int, int, int]]] = {}
    for old, a, b, new in _intervals(plan(sizes, shards)):
        ranges.setdefault(old, []).append((a, b, new))
    stay, go, cut, at = {}, {}, [], dict.fromkeys(sizes, 0)
    for path, shard, n in sorted(files):
        a, b = at[shard], at[shard] + n
        at[shard] = b
        mine = [(max(x, a) - a, new) for x, y, new in ranges[shard] if x < b and y > a]
        if len(mine) > 1:
            cut += [(path, x, new) for x, new in mine]
        elif mine[0][1] == shard:
            stay[path] = shard
        else:
            go[path] = mine[0][1]
    return stay, go, cut


def _cut_rows(layout: Layout, size: F.Column, cut: list[tuple[str, int, int]]) -> DataFrame:
    """(path, new, from_row, to_row): where the rows of cut files go, by their first bytes. There are fewer cuts than pairs
    of shards, and a window holds the sizes of one file's rows."""
    spark = layout.files.sparkSession
    cuts = spark.createDataFrame([(p, x, n) for p, x, n in cut], "path string, start long, new int")
    rows = spark.read.schema(layout.schema).parquet(*map(unquote, sorted({p for p, *_ in cut})))
    rows = rows.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.row_index").alias("row"), size.alias("size"))
    first = F.sum("size").over(Window.partitionBy("path").orderBy("row").rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    met = rows.withColumn("byte", first).join(F.broadcast(cuts), "path").where("byte >= start")
    begins = met.groupBy("path", "start", "new").agg(F.min("row").alias("from_row"))
    after = F.lead("from_row", 1, (1 << 62)).over(Window.partitionBy("path").orderBy("start"))
    return begins.select("path", "new", "from_row", after.alias("to_row"))


def rewrite(layout: Layout, size: F.Column, folder: str, shards: int = SHARDS) -> Layout:
    """Reshards a layout to even shares of size, summed over rows, into a new folder that holds only what moved.

    Shares are even up to one row at each border. Files that stay are part of the new layout where they are, and no old
    file is changed: the old layout holds until the new one's list is written, which is the last step. An empty layout
    gives an empty one. Rows go by their place in a file, so rows that repeat, and nulls, are rows like all others."""
    spark, schema = layout.files.sparkSession, layout.schema
    files = [(r["path"], r["shard"]) for r in layout.files.collect()]
    if not files:
        return layout
    paths = lambda names: spark.read.schema(schema).parquet(*map(unquote, names))
    bytes_ = {
        r["path"]: r["bytes"] for r in paths([p for p, _ in files]).select(
            F.col("_metadata.file_path").alias("path"), size.alias("size")
        ).groupBy("path").agg(F.sum("size").alias("bytes")).collect()
    }
    stay, go, cut = transfers([(p, s, bytes_[p]) for p, s in files], shards)
    moved = []
    for new in sorted(set(go.values())):
        moved.append(paths([p for p, s in go.items() if s == new]).withColumn(PART, F.lit(new)))
    if cut:
        to = F.broadcast(_cut_rows(layout, size, cut).withColumnsRenamed({"path": "__path"}))
        rows = paths(sorted({p for p, *_ in cut})).select(
            "*", F.col("_metadata.file_path").alias("__path"), F.col("_metadata.row_index").alias("__row")
        )
        rows = rows.join(to, "__path").where("__row >= from_row and __row < to_row")
        moved.append(rows.select(*schema.names, F.col("new").alias(PART)))
    if not moved:
        return layout
    reduce(DataFrame.unionByName, moved).write.partitionBy(PART).parquet(folder)
    return listed(spark, folder, schema, stay, f"{folder}.layout")


def source_shard(shards: int = SHARDS) -> F.Column:
    """The layout before: each source in one shard, so that a hot source makes a hot shard."""
    return F.pmod(F.xxhash64("source"), F.lit(shards))


def op6_min_cost_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, size, text_crc32, law (bytes), shard, slot, grown_shard (null) for all of documents, read back from the files
    of the new layout.

    The law balances bytes alone: groups of equal texts are not kept together, for one may hold more than a shard."""
    docs = table(spark, sf_dir, "documents")
    old = lay_out(docs, source_shard(), new_folder(spark, "shards-before"))
    rows = rows_of(rewrite(old, size_of(), new_folder(spark, "shards")))
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    names = [F.col("doc_id").cast("long").alias("doc_id"), size_of().alias("size"), crc.alias("text_crc32"), F.lit("bytes").alias("law")]
    return rows.select(*names, "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
