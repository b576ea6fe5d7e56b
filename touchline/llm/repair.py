"""Conversation structure repair by depth-first branch and bound.

A conversation's rows become edits: Keep, Rerole, Delete, Insert, so that the initials of the roles read (s?(ua)+)?. A node
of the search is a number of rows that are edited and the last role that stands; its moves are the edits of the next row
and an insertion. An explicit stack visits moves in the order of their letters, so audits are met in ASCII order and the
first of equal cost is the least. A node goes no further if its cost and the suffix's lower bound exceed the incumbent's
cost, or if its dominance table (the least cost of any prefix that led there, all of them earlier in the order) has a cost
that is not higher. The bound is the cheapest way to edit the rest if a conversation could end after any role and an
insertion could lead anywhere; it is exact but for the end, so that few nodes are visited twice. A dive along the bound
gives the first incumbent's cost. When the stack is empty, nothing cheaper and no lesser audit exists.

Rows meet twice by conversation: first a few bytes of each (turn, role's initial, fault, digest), for counts and audit;
then the texts, behind their audit, which are hashed as they stream by. So a task holds two bytes a row of one conversation
while it searches, and the audit and one text while it hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, whole_runs

SPACE = " \t\n\x0b\x0c\r"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: Faults of a row, and the mark of one that damage dropped.
NONE, BLANK, REPEAT, CUT, GONE = range(5)
#: States: nothing stands yet, a system turn, a user turn, an assistant turn; and the state after the turn that may follow.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
_AFTER = (USER, USER, ASSISTANT, USER)
_MOST = 1 << 60


def _kept(initial: str, state: int) -> int | None:
    """The state after a turn with this initial, or None if it may not follow."""
    if initial == "s":
        return SYSTEM if state == NOTHING else None
    if initial == "u":
        return USER if state != USER else None
    return ASSISTANT if initial == "a" and state == USER else None


#: (edit, cost, state after it) of a row, by initial, whether it must go and state; in the order of the letters.
_MOVES = {
    (i, must, q): [("D", DELETE, q)] + ([] if must else ([("K", KEEP, _kept(i, q))] if _kept(i, q) is not None else []) +
    ([("R", REROLE, _AFTER[q])] if _kept(i, q) != _AFTER[q] else []))
    for i in ("s", "u", "a", "") for must in (False, True) for q in range(4)
}


def _steps(initials: list[str], faults: list[int]) -> list[list[list[tuple[str, int, int]]]]:
    """The moves of each row, by state: one of a few shared tables a row."""
    tables = {}
    for i in ("s", "u", "a", ""):
        for fault in (NONE, BLANK, REPEAT, CUT):
            extra = TRUNCATED if fault == CUT else 0
            moves = [_MOVES[i, fault in (BLANK, REPEAT), q] for q in range(4)]
            tables[i, fault] = [[(e, c + (extra if e != "D" else 0), q) for e, c, q in m] for m in moves]
    return [tables[i if i in ("s", "u", "a") else "", f] for i, f in zip(initials, faults)]


def _bounds(steps: list) -> list[tuple[int, int, int, int]]:
    """For each number of edited rows and state, what the rest costs at least."""
    out = [(0, 0, 0, 0)] * (len(steps) + 1)
    for i in range(len(steps) - 1, -1, -1):
        after = out[i + 1]
        row = [min([c + after[q] for _, c, q in moves]) for moves in steps[i]]
        least = min(row) + INSERT
        out[i] = tuple([min(x, least) for x in row])
    return out


def _dive(steps: list, bounds: list) -> int:
    """The cost of a repair that follows the bound."""
    cost, state = 0, NOTHING
    for i, by_state in enumerate(steps):
        after = bounds[i + 1]
        row = min((c + after[q], c, q) for _, c, q in by_state[state])
        put = min((INSERT + c + after[q], INSERT + c, q) for _, c, q in by_state[_AFTER[state]])
        _, c, state = min(row, put)
        cost += c
    return cost + (0, 2 * INSERT, INSERT, 0)[state]


def repair(initials: list[str], faults: list[int]) -> tuple[int, str]:
    """Cost and audit of the cheapest edits of a conversation's rows, the ASCII-least of equals."""
    steps = _steps(initials, faults)
    bounds, n = _bounds(steps), len(steps)
    incumbent, audit, dominance = _dive(steps, bounds), None, {}
    path: list[str] = []
    stack = [(0, NOTHING, 0, 0, "")]  # rows edited, state, cost, edits so far, the last of them
    while stack:
        i, state, cost, length, edit = stack.pop()
        total = cost + bounds[i][state]
        if total > incumbent or total == incumbent and audit is not None:
            continue
        if dominance.get((node := 4 * i + state), _MOST) <= cost:
            continue
        dominance[node] = cost
        if length:
            del path[length - 1 :]
            path.append(edit)
        if i == n and state in (NOTHING, ASSISTANT):
            incumbent, audit = cost, "".join(path[:length])
            continue
        put = (i, _AFTER[state], cost + INSERT, length + 1, "I")
        if i == n:
            stack.append(put)
            continue
        moves = [(i + 1, q, cost + c, length + 1, e) for e, c, q in steps[i][state]]
        stack.extend(reversed([moves[0], put, *moves[1:]]))
    return incumbent, audit


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, gone: the rows after damage, those that it drops marked; null role and text are one space."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    hit = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), text("role").alias("role"),
        text("text").alias("text"), hit.alias("hit"),
        F.explode(F.when(hit == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")
    )
    return rows.select(
        "conv_id", "turn", F.when(F.col("hit") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("hit") == 1, "").when(F.col("hit") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        (F.col("hit") == 0).alias("gone")
    )


def _digest() -> Column:
    return F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))


AUDITS = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def audits(rows: DataFrame) -> DataFrame:
    """One row a conversation of rows(conv_id, turn, role, text, gone): its faults, and the cost and audit of its repair."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in AUDITS.split(", ")]
        for t in whole_runs(batches):
            ids, turns, initials, marks, digests = (c.to_pylist() for c in t.columns)
            out, i = [], 0
            while i < len(ids):
                j = i
                while j < len(ids) and ids[j] == ids[i]:
                    j += 1
                own = [k for k in range(i, j) if marks[k] != GONE]
                seen: set[bytes] = set()
                faults = []
                for k in own:
                    faults.append(BLANK if marks[k] == BLANK else REPEAT if digests[k] in seen else marks[k])
                    seen.add(digests[k])
                roles, known = [initials[k] for k in own], {turns[k] for k in own} - {None}
                gaps = max(known) - min(known) + 1 - len(known) if known else 0
                illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(roles, roles[1:]))
                out.append((ids[i], gaps, *(faults.count(f) for f in (BLANK, REPEAT, CUT)), illegal, *repair(roles, faults)))
                i = j
            kinds = [pa.int64()] * 7 + [pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    end = F.rtrim("text", F.lit(SPACE))
    whole = end.endswith(".") | end.endswith("!") | end.endswith("?")
    mark = F.when(F.col("gone"), GONE).when(end == "", BLANK).when(~whole, CUT).otherwise(NONE)
    thin = rows.select("conv_id", "turn", F.substring("role", 1, 1).alias("initial"), mark.alias("mark"), _digest().alias("digest"))
    return thin.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "digest").mapInArrow(kernel, AUDITS)


def repaired(conversations: DataFrame) -> DataFrame:
    """The columns of AUDITS and repaired_sha256 for each conversation of conversations(conv_id, turn, role, text), after damage.

    Rows of a conversation are taken by turn, null first; rows of one turn by the digest of role and text. Null role and text are one
    space (a blank text, a role without a legal initial); a null conv_id is a conversation like any other. Conversations whose rows
    damage dropped all have zeros, an empty audit and the hash of nothing. Rows that repeat are duplicates. Extra columns
    don't matter; an empty table gives none."""
    rows = damaged(conversations)
    stats = [c.split()[0] for c in AUDITS.split(", ")][1:]
    heads = audits(rows).select(
        "conv_id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit(None).cast("binary").alias("digest"),
        F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"), *stats
    )
    nothing = [F.lit(None).cast("string" if c == "audit" else "long").alias(c) for c in stats]
    texts = rows.where("not gone").select("conv_id", F.lit(1).alias("kind"), "turn", _digest().alias("digest"), "role", "text", *nothing)
    both = heads.unionByName(texts).repartition("conv_id").sortWithinPartitions("conv_id", "kind", "turn", "digest")
    names = ["conv_id", *stats, "repaired_sha256"]

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: Rewriter | None = None
        for batch in batches:
            done = []
            ids, kinds, roles, texts = (batch.column(k).to_pylist() for k in (0, 1, 4, 5))
            for k, kind in enumerate(kinds):
                if kind == 0:
                    if open_:
                        done.append(open_.end())
                    open_ = Rewriter([ids[k], *(batch.column(6 + c)[k].as_py() for c in range(len(stats)))])
                else:
                    open_.row(roles[k], texts[k])
            yield _batch(done, names)
        if open_:
            yield _batch([open_.end()], names)

    return both.mapInArrow(kernel, f"{AUDITS}, repaired_sha256 string")


def _batch(rows: list[list], names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if i < 7 else pa.string()) for i, c in enumerate(columns)], names)


class Rewriter:
    """Follows an audit over a conversation's rows in order and hashes what stands after it."""

    def __init__(self, head: list) -> None:
        self.head, self.audit, self.at, self.state, self.hash, self.first = head, head[-1], 0, NOTHING, hashlib.sha256(), True

    def _put(self, role: str, text: str) -> None:
        self.hash.update(f"{'' if self.first else chr(10)}{role}:{text}".encode())
        self.first = False

    def _insertions(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self._next("")
            self.at += 1

    def _next(self, text: str) -> None:
        self.state = _AFTER[self.state]
        self._put("user" if self.state == USER else "assistant", text)

    def row(self, role: str, text: str) -> None:
        self._insertions()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.state = _kept(role[:1], self.state)
            self._put(role, text)
        elif edit == "R":
            self._next(text)

    def end(self) -> list:
        self._insertions()
        return [*self.head, self.hash.hexdigest()]


def op11_branch_and_bound(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest repair and its result for all of conversations, after damage."""
    return repaired(table(spark, sf_dir, "conversations"))


def crc32_sql(s: str) -> str:
    """DuckDB SQL for the unsigned CRC-32 of an ASCII string."""
    bits = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))"
    bytes_ = f"list_transform(string_split({s}, ''), lambda x: ascii(x)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {bytes_}), lambda c, b: {bits}), 4294967295)"


def _add(state: str, cost: str, edit: str) -> str:
    return f"lpad((substr({state}, 1, 9)::INT + {cost})::VARCHAR, 9, '0') || substr({state}, 10) || '{edit}'"


def _closed(s: list[str]) -> list[str]:
    """States after an insertion, where it pays; taken twice, as two in a row are the most that can."""
    users = [_add(s[k], "5", "I") for k in (0, 1, 3)]
    return [s[0], s[1], f"least({s[2]}, {', '.join(users)})", f"least({s[3]}, {_add(s[2], '5', 'I')})"]


_ROW = [
    _add("c0", "2", "D"),
    f"least({_add('c1', '2', 'D')}, CASE WHEN NOT must AND r = 's' THEN {_add('c0', 't', 'K')} END)",
    f"""least({_add('c2', '2', 'D')}, CASE WHEN NOT must THEN CASE WHEN r = 'u' THEN least({_add('c0', 't', 'K')}, {_add('c1', 't', 'K')},
        {_add('c3', 't', 'K')}) ELSE least({_add('c0', 't + 1', 'R')}, {_add('c1', 't + 1', 'R')}, {_add('c3', 't + 1', 'R')}) END END)""",
    f"least({_add('c3', '2', 'D')}, CASE WHEN NOT must THEN CASE WHEN r = 'a' THEN {_add('c2', 't', 'K')} ELSE {_add('c2', 't + 1', 'R')} END END)",
]
_ONE, _TWO = (_closed([f"{x}{k}" for k in range(4)]) for x in "sm")

ORACLE = f"""
WITH RECURSIVE hit AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {crc32_sql("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS h FROM conversations),
hurt AS (
  SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN h = 1 THEN '' WHEN h = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(CASE WHEN h = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM hit WHERE h <> 0),
numbered AS (
  SELECT *, sha256(length(role)::VARCHAR || ':' || role || text) AS digest, left(role, 1) AS r, regexp_replace(text, '[\\x20\\x09-\\x0D]+$', '') AS body FROM hurt),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest, copy) AS i FROM numbered),
seen AS (SELECT *, row_number() OVER (PARTITION BY conv_id, digest ORDER BY i) > 1 AS again FROM placed),
faulty AS (
  SELECT *, CASE WHEN body = '' THEN 1 WHEN again THEN 2 WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault,
    lead(r) OVER (PARTITION BY conv_id ORDER BY i) AS after FROM seen),
stats AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank,
    count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
    count(*) FILTER (after IS NOT NULL AND r || after NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM faulty GROUP BY conv_id),
steps AS (
  SELECT conv_id, 0::BIGINT AS i, '000000000' AS s0, NULL::VARCHAR AS s1, NULL::VARCHAR AS s2, NULL::VARCHAR AS s3 FROM stats
  UNION ALL
  SELECT conv_id, i, {', '.join(f'{x} AS n{k}' for k, x in enumerate(_ROW))} FROM (
    SELECT conv_id, i, must, t, r, {', '.join(f'{x} AS c{k}' for k, x in enumerate(_TWO))} FROM (
      SELECT s.conv_id, f.i, f.fault IN (1, 2) AS must, CASE WHEN f.fault = 3 THEN 5 ELSE 0 END AS t, f.r,
        {', '.join(f'{x} AS m{k}' for k, x in enumerate(_ONE))}
      FROM steps s JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM s.conv_id AND f.i = s.i + 1))),
ends AS (
  SELECT conv_id, least(c0, c3) AS best FROM (
    SELECT conv_id, {', '.join(f'{x} AS c{k}' for k, x in enumerate(_TWO))} FROM (
      SELECT s.conv_id, {', '.join(f'{x} AS m{k}' for k, x in enumerate(_ONE))}
      FROM steps s JOIN stats z ON z.conv_id IS NOT DISTINCT FROM s.conv_id AND z.n = s.i))),
edits AS (
  SELECT conv_id, unnest(string_split(substr(best, 10), '')) AS e, generate_subscripts(string_split(substr(best, 10), ''), 1) AS p
  FROM ends WHERE length(best) > 9),
consumed AS (SELECT *, sum(CASE WHEN e = 'I' THEN 0 ELSE 1 END) OVER (PARTITION BY conv_id ORDER BY p) AS i FROM edits),
standing AS (
  SELECT c.conv_id, c.p, c.e, f.role, CASE WHEN c.e = 'I' THEN '' ELSE f.text END AS text,
    row_number() OVER (PARTITION BY c.conv_id ORDER BY c.p) AS k,
    first_value(CASE WHEN c.e = 'K' AND f.r = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY c.conv_id ORDER BY c.p) AS system
  FROM consumed c LEFT JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM c.conv_id AND f.i = c.i AND c.e <> 'I' WHERE c.e <> 'D'),
rebuilt AS (
  SELECT conv_id, string_agg((CASE WHEN e = 'K' THEN role WHEN (k - system) % 2 = 1 THEN 'user' ELSE 'assistant' END) || ':' || text, chr(10) ORDER BY p) AS whole
  FROM standing GROUP BY conv_id)
SELECT a.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(substr(best, 1, 9)::BIGINT, 0) AS cost, coalesce(substr(best, 10), '') AS audit,
  sha256(coalesce(whole, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a
LEFT JOIN stats s ON s.conv_id IS NOT DISTINCT FROM a.conv_id LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM a.conv_id
LEFT JOIN rebuilt b ON b.conv_id IS NOT DISTINCT FROM a.conv_id
"""
