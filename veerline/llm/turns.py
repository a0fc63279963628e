"""Conversation structure repair: turns are aligned to an alternating grammar by banded Wagner-Fischer tables."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import store

# The price of each edit, and what an undeleted truncated turn adds.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: White space as the contracts define it, and the marks that end a finished turn (fixed values).
SPACE, ENDS = " \t\n\x0b\f\r", ".!?"
ROLES = {"u": "user", "a": "assistant"}
FAR = 1 << 40
#: Cells of the table that are held at once.
CELLS = 1 << 24


class _Table:
    """Least costs ``rest[i][k]`` of aligning the turns from i on to the last k letters of the alternating string.

    The last k letters are the same for every target, ``a`` at the end and ``u`` before each ``a``, so one table
    holds the alignments to all feasible lengths. ``lead[i][k]`` is the cost if an ``s`` still has to come first.
    A cell whose length differs from the turns left by more than the incumbent cost can pay for (Ukkonen's band)
    is not computed. Only every ``step``-th row is kept; the rows in between are computed again on the way back.
    """

    def __init__(self, initials: str, cut: list[bool], incumbent: int):
        self.n, self.initials, self.cut = len(initials), initials, cut
        # One cell more below, as the s that may come first is not counted in k.
        self.below, self.above = incumbent // DELETE + 1, incumbent // INSERT
        width = self.below + self.above + 1
        self.step = max(1, min(self.n, max(isqrt(self.n), CELLS // (2 * width))))
        self.ahead = np.arange(width, dtype="int64") * INSERT
        self.rows: dict[int, tuple[np.ndarray, np.ndarray]] = {self.n: self._end()}
        row = self.rows[self.n]
        for i in range(self.n - 1, -1, -1):
            row = self._row(i, *row)
            if i % self.step == 0:
                self.rows[i] = row
        self.held: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def low(self, i: int) -> int:
        """The length in the first cell of row i; a row has cells for negative lengths, which stay unreachable."""
        return self.n - i - self.below

    def _end(self) -> tuple[np.ndarray, np.ndarray]:
        k = self.low(self.n) + np.arange(len(self.ahead))
        return np.where(k >= 0, k * INSERT, FAR), np.full(len(k), FAR)

    def _row(self, i: int, rest: np.ndarray, lead: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row i from row i + 1, whose cells stand for lengths that are one smaller."""
        k = self.low(i) + np.arange(len(rest))
        extra = TRUNCATED if self.cut[i] else 0
        met = np.where(k % 2 == 0, self.initials[i] == "u", self.initials[i] == "a")
        stay = np.where(k >= 1, rest + np.where(met, KEEP, REROLE) + extra, FAR)
        # Deleting keeps the length: the cell to the right in the row below.
        drop = np.append(rest[1:], FAR) + DELETE
        best = np.where(k >= 0, np.minimum(stay, drop), FAR)
        # An insertion adds one letter: a running minimum along the row.
        best = np.minimum(np.minimum.accumulate(best - self.ahead) + self.ahead, FAR)
        first = np.append(lead[1:], FAR) + DELETE
        if self.initials[i] == "s":
            # The s is kept, and at least one pair follows.
            follow = np.append(rest[1:], FAR) + KEEP + extra
            first = np.minimum(first, np.where((k >= 2) & (k % 2 == 0), follow, FAR))
        return best, np.minimum(first, FAR)

    def row(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        if i in self.rows:
            return self.rows[i]
        if i not in self.held:
            top = min(self.n, (i // self.step + 1) * self.step)
            self.held, now = {}, self.rows[top]
            for j in range(top - 1, i - 1, -1):
                now = self.held[j] = self._row(j, *now)
        return self.held[i]

    def cost(self, i: int, k: int, lead: bool) -> int:
        if i > self.n:
            return FAR
        at = k - self.low(i)
        cells = self.row(i)[1 if lead else 0]
        return int(cells[at]) if 0 <= at < len(cells) else FAR


def _incumbent(initials: str, cut: list[bool]) -> int:
    """The cost of one script that is easy to find: truncated turns go, the rest alternates by changed roles."""
    cost, kept = 0, 0
    for x, truncated in zip(initials, cut):
        if truncated:
            cost += DELETE
        else:
            cost += KEEP if x == "ua"[kept % 2] else REROLE
            kept += 1
    return min(cost + DELETE * (kept % 2), DELETE * len(initials))


def align(initials: str, forced: list[bool], cut: list[bool]) -> tuple[int, str]:
    """Least cost, and the least audit in ASCII order among the scripts that cost it.

    ``forced`` turns must go: they cost the same in every script, and deleting is the least letter, so they are
    left out of the tables. The audits of all lengths that reach the least cost are traced back side by side, and
    at each letter only those go on that have the least one.
    """
    free = [i for i, gone in enumerate(forced) if not gone]
    letters, ends = "".join(initials[i] for i in free), [cut[i] for i in free]
    table = _Table(letters, ends, _incumbent(letters, ends))
    rest, lead = table.row(0)
    lengths = table.low(0) + np.arange(len(rest))
    even = (lengths % 2 == 0) & (lengths >= 0)
    least = int(min(rest[even].min(), lead[even].min()))
    # A state: length still to come, and whether an s has to come first.
    alive = {(int(k), False) for k in lengths[even & (rest == least)]} | {(int(k), True) for k in lengths[even & (lead == least)]}
    audit, at, left = [], 0, least
    for gone in forced:
        if gone:
            audit.append("D")
            continue
        spent = ""
        while spent in ("", "I"):
            moves: dict[str, set] = {}
            for k, first in alive:
                if table.cost(at + 1, k, first) == left - DELETE:
                    moves.setdefault("D", set()).add((k, first))
                if not first and k and table.cost(at, k - 1, False) == left - INSERT:
                    moves.setdefault("I", set()).add((k - 1, False))
                extra = TRUNCATED if ends[at] else 0
                if first and letters[at] == "s" and k >= 2 and table.cost(at + 1, k, False) == left - KEEP - extra:
                    moves.setdefault("K", set()).add((k, False))
                elif not first and k:
                    same = letters[at] == "au"[k % 2 == 0]
                    if table.cost(at + 1, k - 1, False) == left - (KEEP if same else REROLE) - extra:
                        moves.setdefault("K" if same else "R", set()).add((k - 1, False))
            spent = min(moves)
            alive = moves[spent]
            audit.append(spent)
            extra = TRUNCATED if ends[at] and spent in "KR" else 0
            left -= {"D": DELETE, "I": INSERT, "K": KEEP, "R": REROLE}[spent] + extra
        at += 1
    # What is left can only be inserted.
    audit += "I" * (left // INSERT)
    return least + DELETE * sum(forced), "".join(audit)


def damaged(turns: DataFrame, key: str = "conv_id") -> DataFrame:
    """The test damage of the contract: ``key``, turn, role, text and ``copies`` (0: the row is dropped)."""
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (key, "turn")])
    kind = F.crc32(name) % 20
    return turns.select(
        key, "turn", F.when(kind == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(text, r"[.!?]", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, Iterator[dict]]]:
    """(key, its rows) one conversation after the other, of batches that are sorted by their first column."""
    rows = (row for batch in batches for part in range(0, batch.num_rows, 1024) for row in batch.slice(part, 1024).to_pylist())
    row = next(rows, None)
    while row is not None:
        key = row["k"]

        def mine() -> Iterator[dict]:
            nonlocal row
            while row is not None and row["k"] == key:
                yield row
                row = next(rows, None)

        yield key, mine()


def _audits(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held = []
    for key, rows in _conversations(batches):
        initials, forced, cut = [], [], []
        counts, last, illegal = [0, 0, 0], None, 0
        low = high = seen = None
        distinct = 0
        for row in rows:
            for copy in range(row["copies"]):
                fault = 0 if row["blank"] else 1 if row["again"] or copy else 2 if row["cut"] else None
                if fault is not None:
                    counts[fault] += 1
                letter = row["role"][:1]
                if last is not None and last + letter not in ("su", "ua", "au"):
                    illegal += 1
                last = letter
                # Roles that the grammar does not know are alike.
                initials.append(letter if letter in ("s", "u", "a") else "?")
                forced.append(fault in (0, 1))
                cut.append(fault == 2)
            if row["copies"] and row["turn"] is not None:
                low, high = row["turn"] if low is None else low, row["turn"]
                distinct += row["turn"] != seen
                seen = row["turn"]
        cost, audit = align("".join(initials), forced, cut)
        gaps = 0 if low is None else high - low + 1 - distinct
        held.append([key, gaps, *counts, illegal, cost, audit])
        if len(held) >= 1024:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _edited(rows: Iterator[dict], audit: str) -> Iterator[tuple[str, str]]:
    """The repaired turns: roles of changed and inserted turns follow from their place in the alternation."""
    place, edits = 0, iter(audit)

    def role() -> str:
        return ROLES["ua"[place % 2]]

    for row in rows:
        for _ in range(row["copies"]):
            edit = next(edits)
            while edit == "I":
                yield role(), ""
                place += 1
                edit = next(edits)
            if edit == "D":
                continue
            yield row["role"] if edit == "K" else role(), row["text"]
            # The s that may come first is no part of the alternation.
            place += not (place == 0 and edit == "K" and row["role"][:1] == "s")
    for _ in edits:
        yield role(), ""
        place += 1


def _hashes(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held = []
    for key, rows in _conversations(batches):
        head = next(rows)
        digest, joint = hashlib.sha256(), ""
        for role, text in _edited(rows, head["audit"]):
            digest.update(f"{joint}{role}:{text}".encode())
            joint = "\n"
        held.append([key, digest.hexdigest()])
        if len(held) >= 1024:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _repaired(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held = []
    for key, rows in _conversations(batches):
        head = next(rows)
        for place, (role, text) in enumerate(_edited(rows, head["audit"])):
            held.append([key, place, role, text])
            if len(held) >= 1024:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
                held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _mapped(df: DataFrame, work, fields: list[tuple[str, T.DataType]]) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = T.StructType([T.StructField(n, kind) for n, kind in fields])
    return df.mapInArrow(partial(work, schema=to_arrow_schema(schema)), schema)


def _turns(turns: DataFrame, key: str) -> DataFrame:
    """The turns under fixed names, nulls as one space; without ``copies`` every row counts once."""
    copies: Column = F.col("copies") if "copies" in turns.columns else F.lit(1)
    return turns.select(
        F.col(key).alias("k"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"), copies.cast("int").alias("copies"),
    )


def audits(turns: DataFrame, key: str = "conv_id") -> DataFrame:
    """One row per conversation: ``key``, gaps, blank, duplicate, truncated, illegal, cost, audit.

    The turns of a conversation stand in the order of ``turn`` (nulls first; equal ones by role and a hash of the
    text); ``copies``, if there is such a column, says how often a row counts. Texts are judged in the JVM, and a
    duplicate is found by conversation *and content*; only a letter and three marks per turn meet in the task that
    aligns a conversation. Null roles and texts count as one space, a null key is a conversation of its own,
    repeated rows are duplicates, and a conversation without rows has zeros and an empty audit. An empty table
    gives an empty one; other columns may have any name.
    """
    rows = _turns(turns, key)
    end = F.substring(F.rtrim(F.col("text"), F.lit(SPACE)), -1, 1)
    same = Window.partitionBy("k", "role", "content", F.col("copies") > 0).orderBy("turn")
    judged = rows.select(
        "k", "turn", "role", "copies", F.md5("text").alias("content"), (end == "").alias("blank"), (~end.isin(*ENDS)).alias("cut")
    ).withColumn("again", F.row_number().over(same) > 1)
    dealt = judged.repartition("k").sortWithinPartitions("k", "turn", "role", "content")
    kind = rows.schema["k"].dataType
    fields = [("k", kind), *[(c, T.LongType()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")], ("audit", T.StringType())]
    return _mapped(dealt, _audits, fields).withColumnRenamed("k", key)


def _with_audits(turns: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """The turns in order, the audit of a conversation before its first turn."""
    rows = _turns(turns, key).withColumns({"head": F.lit(False), "audit": F.lit(None).cast("string")})
    heads = found.select(F.col(key).alias("k"), "audit", F.lit(True).alias("head"))
    both = rows.unionByName(heads, allowMissingColumns=True).withColumn("content", F.md5("text"))
    return both.repartition("k").sortWithinPartitions("k", F.desc("head"), "turn", "role", "content")


def repaired(turns: DataFrame, found: DataFrame, key: str = "conv_id") -> DataFrame:
    """The repaired turns (``key``, place, role, text), from the turns and their audits; turns stream past."""
    kind = turns.schema[key].dataType
    fields = [("k", kind), ("place", T.LongType()), ("role", T.StringType()), ("text", T.StringType())]
    return _mapped(_with_audits(turns, found, key), _repaired, fields).withColumnRenamed("k", key)


def repair(turns: DataFrame, key: str = "conv_id") -> DataFrame:
    """``audits``, and ``repaired_sha256`` of each repaired conversation's ``role:text`` lines.

    Nulls, empties, ties and repeated rows as in ``audits``. A digest needs its conversation in order, so the
    texts of one conversation pass through one task, but they stream past and are not held.
    """
    found = store(audits(turns, key), "turn-audits")
    kind = turns.schema[key].dataType
    digests = _mapped(_with_audits(turns, found, key), _hashes, [("_k", kind), ("repaired_sha256", T.StringType())])
    joined = found.join(digests, found[key].eqNullSafe(digests["_k"]))
    return joined.drop("_k")
