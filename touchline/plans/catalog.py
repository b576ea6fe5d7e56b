"""The tables of the engine: basis, metrics and scraping databases of Parquet tables."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.upsert import appended, merged, newest, updated
from ..schemas import TABLES

#: Tables that grow with every game are kept in parts by game, so that an upsert rewrites only parts that have its keys.
BUCKETED = ("metrics.player_game_metric", "metrics.base_metric", "basis.player_game", "basis.games")
PART = "part"
#: Rows that a part is to have; the number of parts doubles when parts have twice that, up to MOST_PARTS.
PART_ROWS, MOST_PARTS = 1_000_000, 4096
#: A part, or a table without parts, that lies in so many folders is written anew into one.
MOST_FOLDERS = 32


class Catalog:
    """Reads and writes the tables under a folder: <folder>/<database>/<table>.

    Rows lie in data/<id>, or data/<id>/part=<n>, and are never changed there. versions/<n> lists the folders that make up
    the table; the newest version holds, and it is put in place by one rename as the last step of a write. So a job that
    fails anywhere leaves the table as it was, and no job reads what it overwrites. Folders that the last two versions
    don't list are deleted, those of failed jobs too. One writer at a time."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name.replace('.', '/')}"

    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def _versions(self, name: str) -> list[int]:
        fs, p = self._fs(f"{self.path(name)}/versions")
        return sorted(int(f.getPath().getName()) for f in fs.listStatus(p) if f.getPath().getName().isdigit()) if fs.exists(p) else []

    def _version(self, name: str, n: int) -> dict:
        fs, p = self._fs(f"{self.path(name)}/versions/{n}")
        stream = fs.open(p)
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _state(self, name: str) -> dict:
        """The newest version: parts (0 for a table without), rows, and folders (id to its live parts)."""
        if n := self._versions(name):
            return self._version(name, n[-1])
        return {"parts": int(name in BUCKETED), "rows": 0, "folders": {}}

    def _commit(self, name: str, state: dict) -> None:
        """Makes state the newest version, then forgets what only versions before the last one list."""
        seen = self._versions(name)
        n = seen[-1] + 1 if seen else 0
        fs, part = self._fs(f"{self.path(name)}/versions/.{n}-{uuid.uuid4().hex}")
        fs.mkdirs(part.getParent())
        out = fs.create(part)
        out.write(bytearray(json.dumps(state).encode()))
        out.close()
        if not fs.rename(part, self._fs(f"{self.path(name)}/versions/{n}")[1]):
            raise RuntimeError(f"another writer has made version {n} of {name}")
        kept = {*state["folders"], *(self._version(name, seen[-1])["folders"] if seen else ())}
        data = self._fs(f"{self.path(name)}/data")[1]
        for f in fs.listStatus(data) if fs.exists(data) else []:
            if f.getPath().getName() not in kept:  # also what jobs that failed have left
                fs.delete(f.getPath(), True)
        for old in seen[:-1]:
            fs.delete(self._fs(f"{self.path(name)}/versions/{old}")[1], False)

    def create(self) -> None:
        """All tables that aren't there, empty."""
        for name in TABLES:
            if not self._versions(name):
                self._commit(name, self._state(name))

    def _read(self, name: str, folders: dict[str, list[int] | None]) -> DataFrame:
        paths = [f"{self.path(name)}/data/{f}" + ("" if p is None else f"/{PART}={p}") for f, live in folders.items() for p in (live or [None])]
        schema = TABLES[name][0]
        return self.spark.read.schema(schema).option("recursiveFileLookup", True).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def table(self, name: str) -> DataFrame:
        return self._read(name, self._state(name)["folders"])

    def register(self) -> None:
        """Temporary views <database>_<table>, for SQL."""
        for name in TABLES:
            self.table(name).createOrReplaceTempView(name.replace(".", "_"))

    def _write(self, name: str, rows: DataFrame, parts: int) -> tuple[dict[str, list[int] | None], int]:
        """Rows in a folder of their own: the folder with its parts, and how many rows it has."""
        folder = uuid.uuid4().hex
        path = f"{self.path(name)}/data/{folder}"
        if not parts:
            rows.write.parquet(path)
            return {folder: None}, self._read(name, {folder: None}).count()
        part = F.pmod(F.xxhash64("game_id"), F.lit(parts)).cast("int")
        rows.withColumn(PART, part).repartition(PART).write.partitionBy(PART).parquet(path)
        there = self.spark.read.schema(f"{TABLES[name][0]}, {PART} int").parquet(path).groupBy(PART).count().collect()  # MOST_PARTS rows at most
        return ({folder: sorted(r[PART] for r in there)} if there else {}), sum(r["count"] for r in there)

    def _replace(self, name: str, rows: DataFrame) -> None:
        rows = rows.select(*self._typed(name))
        folders, n = self._write(name, rows, self._state(name)["parts"])
        self._commit(name, self._grown(name, {"parts": self._state(name)["parts"], "rows": n, "folders": folders}))

    def _grown(self, name: str, state: dict) -> dict:
        """state, written anew with more parts where its parts have become too large."""
        parts = state["parts"]
        while parts and parts < MOST_PARTS and state["rows"] > 2 * parts * PART_ROWS:
            parts *= 2
        if parts == state["parts"]:
            return state
        folders, n = self._write(name, self._read(name, state["folders"]), parts)
        return {"parts": parts, "rows": n, "folders": folders}

    def _typed(self, name: str) -> list:
        return [F.col(f.name).cast(f.dataType).alias(f.name) for f in self.spark.createDataFrame([], TABLES[name][0]).schema.fields]

    def upsert(self, name: str, rows: DataFrame, order: str | None = None) -> None:
        """Rows replace those with their keys and are added otherwise; where keys repeat in rows, the last by order.

        Parts that have none of the keys just get the new rows beside the old ones."""
        keys = list(TABLES[name][1])
        rows = rows if order is None else newest(rows, keys, order)
        typed, state = rows.select(*self._typed(name)), self._state(name)
        if not state["parts"]:
            return self._replace(name, merged(self.table(name), typed, keys))
        new, n = self._write(name, typed, state["parts"])
        touched = {p for live in new.values() for p in live}
        held = {f: [p for p in live if p in touched] for f, live in state["folders"].items()}
        held = {f: live for f, live in held.items() if live}
        part = F.pmod(F.xxhash64("game_id"), F.lit(state["parts"])).cast("int")
        again = set()
        if held:
            met = self._read(name, held).select(*keys).join(self._read(name, new).select(*keys), keys, "left_semi")
            again = {r[0] for r in met.select(part.alias(PART)).distinct().collect()}
        again |= {p for p in touched if sum(p in live for live in held.values()) >= MOST_FOLDERS}
        both = lambda folders: {f: live for f, x in folders.items() if (live := [p for p in x if p in again])}
        total = state["rows"] + n
        if again:
            old, fresh = self._read(name, both(held)), self._read(name, both(new))
            before = old.count() + fresh.count()
            made, after = self._write(name, merged(old, fresh, keys), state["parts"])
            total += after - before
        else:
            made = {}
        rest = {f: live for f, x in (state["folders"] | new).items() if (live := [p for p in x if p not in again])}
        self._commit(name, self._grown(name, {"parts": state["parts"], "rows": total, "folders": rest | made}))

    def append_new(self, name: str, rows: DataFrame) -> None:
        """The rows whose keys the table doesn't have, in a folder beside the others."""
        old, state = self.table(name), self._state(name)
        new = appended(old, rows.select(*self._typed(name)), list(TABLES[name][1]))
        if state["parts"] or len(state["folders"]) >= MOST_FOLDERS:
            return self._replace(name, old.unionByName(new))
        folders, n = self._write(name, new, 0)
        if n:
            self._commit(name, {"parts": 0, "rows": state["rows"] + n, "folders": state["folders"] | folders})

    def update(self, name: str, rows: DataFrame, columns: list[str]) -> None:
        """Sets columns to the non-null values of rows with the same keys."""
        self._replace(name, updated(self.table(name), rows, list(TABLES[name][1]), columns))

    def overwrite(self, name: str, rows: DataFrame) -> None:
        self._replace(name, rows)

    def clear(self, *names: str) -> None:
        for name in names or TABLES:
            self._commit(name, {"parts": int(name in BUCKETED), "rows": 0, "folders": {}})
