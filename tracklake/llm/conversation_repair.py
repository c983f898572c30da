"""Repair of conversation structure: the cheapest edits that give an order of roles a model can be trained on.

A lattice of (row, state) is searched by A*: the state is the last role kept (none, system, user, assistant), an
edit keeps, re-roles or deletes a row or inserts an empty turn. The heuristic is the suffix sum of what the rows
ahead must cost at least: deletions of blank and repeated rows, and the charge of truncated ones. The queue is
ordered by (cost plus heuristic, audit), audit being the initials of the edits; so what first reaches a
goal is the cheapest, and of equals the first in ASCII order.

Conversations may be of any length: rows are sorted over all tasks, each run of ``RUN`` rows of a conversation is searched
from every state to every state, and these maps are composed in order. A second pass streams the rows past their audit,
since a digest of the repaired text needs them one after the other.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tracklake.storage import discard, materialize

RUN = 256
SPACE = " \t\n\x0b\x0c\r"
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
AFTER = {"s": {EMPTY: SYSTEM}, "u": {EMPTY: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
ANSWER = {EMPTY: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
NAME = {USER: "user", ASSISTANT: "assistant"}
DELETE, REROLE, INSERT, CUT_OFF = 4, 3, 3, 3
LEGAL = {"su", "ua", "au"}
Map = dict[tuple[int, int], tuple[int, str]]


def cheapest(rows: list[tuple[str, int]], start: int, goals: set[int]) -> dict[int, tuple[int, str]]:
    """A* over ``rows`` (role initial, fault) from a state: for each goal state the least (cost, audit) that reaches it behind the last row."""
    n = len(rows)
    ahead = [0] * (n + 1)
    for i in range(n - 1, -1, -1):
        fault = rows[i][1]
        ahead[i] = ahead[i + 1] + (DELETE if fault in (BLANK, DUPLICATE) else CUT_OFF if fault == TRUNCATED else 0)
    queue = [(ahead[0], "", 0, start)]
    closed: set[tuple[int, int]] = set()
    found: dict[int, tuple[int, str]] = {}
    while queue and len(found) < len(goals):
        bound, audit, i, state = heapq.heappop(queue)
        if (i, state) in closed:
            continue
        closed.add((i, state))
        cost = bound - ahead[i]
        if i == n:
            if state in goals:
                found[state] = (cost, audit)
        else:
            initial, fault = rows[i]
            heapq.heappush(queue, (cost + DELETE + ahead[i + 1], audit + "D", i + 1, state))
            if fault not in (BLANK, DUPLICATE):
                own = cost + (CUT_OFF if fault == TRUNCATED else 0) + ahead[i + 1]
                kept = AFTER.get(initial, {}).get(state)
                if kept is not None:
                    heapq.heappush(queue, (own, audit + "K", i + 1, kept))
                heapq.heappush(queue, (own + REROLE, audit + "R", i + 1, ANSWER[state]))
        heapq.heappush(queue, (cost + INSERT + ahead[i], audit + "I", i, ANSWER[state]))
    return found


def composed(best: dict[int, tuple[int, str]], paths: Map) -> dict[int, tuple[int, str]]:
    """The least (cost, audit) of each state after a further run."""
    out: dict[int, tuple[int, str]] = {}
    for (a, b), (cost, audit) in paths.items():
        if a in best:
            whole = (best[a][0] + cost, best[a][1] + audit)
            if b not in out or whole < out[b]:
                out[b] = whole
    return out


def applied(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """(role, text) of the repaired conversation; ``rows`` are its rows in order."""
    state = EMPTY
    for edit in audit:
        if edit == "I":
            state = ANSWER[state]
            yield NAME[state], ""
            continue
        role, text = next(rows)
        if edit == "D":
            continue
        state = AFTER[role[0]][state] if edit == "K" else ANSWER[state]
        yield (role if edit == "K" else NAME[state]), text


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, copy`` after the damage that the crc32 of ``conv_id:turn`` decides: of 20 remainders 0 drops a row, 1 empties
    its text, 2 takes out its sentence ends, 3 repeats it, and 4 makes it the user's. Nulls are one space each."""
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = conversations.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), shown("role").alias("role"), shown("text").alias("text"))
    what = F.crc32(F.concat_ws(":", shown("conv_id"), shown("turn"))) % 20
    hurt = rows.withColumn("_what", what).where("_what <> 0")
    text = F.when(F.col("_what") == 1, "").when(F.col("_what") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.when(F.col("_what") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return hurt.select("conv_id", "turn", F.when(F.col("_what") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.explode(copies).alias("copy"))


def _ordered(rows: DataFrame) -> DataFrame:
    """With ``digest``: rows of one turn follow one another by role and text, so copies are neighbours."""
    return rows.withColumn("digest", F.sha2("text", 256))


PLACE = ["conv_id", "turn", "role", "digest", "copy"]


def _fault() -> Column:
    """The first fault of a row; ``_again`` numbers the rows of one role and text."""
    end = F.right(F.rtrim("text", F.lit(SPACE)), F.lit(1))
    return F.when(end == "", BLANK).when(F.col("_again") > 1, DUPLICATE).when(~end.isin(".", "!", "?"), TRUNCATED).otherwise(SOUND)


PATHS = "array<struct<a:int,b:int,cost:bigint,audit:string>>"
SUMMARY = f"conv_id long, task int, run long, blank long, duplicate long, truncated long, illegal long, turns long, low long, high long, head string, tail string, paths {PATHS}"


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A summary of each run of rows; rows come in order."""
    task, number, held = TaskContext.get().partitionId(), 0, []
    schema = pa.schema([("conv_id", pa.int64()), ("task", pa.int32()), ("run", pa.int64()), *((c, pa.int64()) for c in ("blank", "duplicate", "truncated", "illegal", "turns", "low", "high")), ("head", pa.string()), ("tail", pa.string()), ("paths", pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])))])

    def summary(rows: list[tuple]) -> dict:
        lattice, turns = [(r[2], r[3]) for r in rows], [r[1] for r in rows if r[1] is not None]
        paths = [{"a": a, "b": b, "cost": c, "audit": s} for a in range(4) for b, (c, s) in cheapest(lattice, a, {EMPTY, SYSTEM, USER, ASSISTANT} if a == EMPTY else {SYSTEM, USER, ASSISTANT} if a == SYSTEM else {USER, ASSISTANT}).items()]
        faults = [r[3] for r in rows]
        return {
            "conv_id": rows[0][0], "task": task, "run": number, "blank": faults.count(BLANK), "duplicate": faults.count(DUPLICATE), "truncated": faults.count(TRUNCATED),
            "illegal": sum(x[2] + y[2] not in LEGAL for x, y in zip(rows, rows[1:], strict=False)), "turns": len(set(turns)), "low": min(turns, default=None), "high": max(turns, default=None),
            "head": rows[0][2], "tail": rows[-1][2], "paths": paths,
        }

    out: list[dict] = []
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "initial", "fault")), strict=True):
            if held and (held[0][0] != row[0] or len(held) == RUN):
                out.append(summary(held))
                number, held = number + 1, []
            held.append(row)
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)
            out = []
    if held:
        yield pa.RecordBatch.from_pylist([summary(held)], schema)


RESULT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of conversations from the summaries of their runs, which come in order; one without a run has its marker row alone."""
    types = [pa.int64()] * 7 + [pa.string()]
    schema = pa.schema(list(zip([c.strip().split(" ")[0] for c in RESULT.split(",")], types, strict=True)))
    state: dict | None = None

    def result(s: dict) -> dict:
        cost, audit = min(s["best"][q] for q in (EMPTY, ASSISTANT) if q in s["best"])
        gaps = s["high"] - s["low"] + 1 - s["turns"] if s["low"] is not None else 0
        return {"conv_id": s["conv_id"], "gaps": gaps, **{c: s[c] for c in ("blank", "duplicate", "truncated", "illegal")}, "cost": cost, "audit": audit}

    for batch in batches:
        out = []
        for row in batch.to_pylist():
            if state is None or state["conv_id"] != row["conv_id"]:
                if state is not None:
                    out.append(result(state))
                state = {"conv_id": row["conv_id"], "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "turns": 0, "low": None, "high": None, "tail": None, "best": {EMPTY: (0, "")}}
            if row["run"] is None:
                continue
            for c in ("blank", "duplicate", "truncated", "illegal"):
                state[c] += row[c]
            if state["tail"] is not None:
                state["illegal"] += state["tail"] + row["head"] not in LEGAL
            state["tail"] = row["tail"]
            if row["low"] is not None:
                state["turns"] += row["turns"] - (state["high"] == row["low"])
                state["low"] = row["low"] if state["low"] is None else state["low"]
                state["high"] = row["high"]
            state["best"] = composed(state["best"], {(p["a"], p["b"]): (p["cost"], p["audit"]) for p in row["paths"]})
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)
    if state is not None:
        yield pa.RecordBatch.from_pylist([result(state)], schema)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each conversation; its audit comes first, then its rows in order. One row is held at a time."""
    schema = pa.schema([("conv_id", pa.int64()), ("repaired_sha256", pa.string())])
    stream = ((c, a, r, t) for batch in batches for c, a, r, t in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "audit", "role", "text")), strict=True))
    row = next(stream, None)
    out = []
    while row is not None:
        conv, audit = row[0], row[1]
        row = next(stream, None)

        def own(conv=conv) -> Iterator[tuple[str, str]]:
            nonlocal row
            while row is not None and row[1] is None and row[0] == conv:
                mine, row = row, next(stream, None)
                yield mine[2], mine[3]

        digest, rows = hashlib.sha256(), own()
        for k, (role, text) in enumerate(applied(audit, rows)):
            digest.update(f"{chr(10) if k else ''}{role}:{text}".encode())
        for _ in rows:
            raise AssertionError("more rows than edits")
        out.append({"conv_id": conv, "repaired_sha256": digest.hexdigest()})
        if len(out) == 1000:
            yield pa.RecordBatch.from_pylist(out, schema)
            out = []
    if out:
        yield pa.RecordBatch.from_pylist(out, schema)


def repaired(conversations: DataFrame) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256`` of each conversation, after ``damaged``.

    Rows go by turn, null turns first; rows of one turn by role and the digest of the text. Rows without conv_id are one
    conversation. A conversation none of whose rows is left has zeros, an empty audit and the digest of the empty
    text. An empty table gives no rows; other columns are ignored.
    """
    rows = _ordered(damaged(conversations))
    seen = rows.withColumn("_again", F.row_number().over(Window.partitionBy("conv_id", "role", "digest").orderBy("turn", "copy")))
    judged = seen.select(*PLACE, F.substring("role", 1, 1).alias("initial"), _fault().alias("fault"))
    runs = materialize(judged.repartitionByRange(*PLACE).sortWithinPartitions(*PLACE).mapInArrow(_runs, SUMMARY), "runs")
    every = conversations.select(F.col("conv_id").cast("bigint").alias("conv_id")).distinct()
    marked = runs.unionByName(every, allowMissingColumns=True)
    results = materialize(marked.repartition("conv_id").sortWithinPartitions("conv_id", "task", "run").mapInArrow(_whole, RESULT), "repairs")
    told = results.select("conv_id", F.lit(0).alias("kind"), "audit")
    told = told.unionByName(rows.withColumn("kind", F.lit(1)), allowMissingColumns=True)
    digests = told.repartition("conv_id").sortWithinPartitions("conv_id", "kind", *PLACE[1:]).select("conv_id", "audit", "role", "text").mapInArrow(_digests, "conv_id long, repaired_sha256 string")
    digests = digests.withColumnRenamed("conv_id", "_conv")
    out = materialize(results.join(digests, F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv"), "repaired")
    discard(runs, results)
    return out
