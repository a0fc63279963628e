"""Turn repair against a search over all edit scripts."""

from __future__ import annotations

import hashlib
import heapq
import random
import zlib
from collections import defaultdict

import duckdb
import pytest

from veerline.llm import queries, turns

SF = "/root/testdata/sf0.001"


def cheapest(initials: str, forced: list[bool], cut: list[bool]) -> tuple[int, str]:
    """Least (cost, audit) of all scripts, cheapest first; states: nothing yet, s, u, a was last."""
    step = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
    heap, best = [(0, "", 0, 0)], None
    while heap:
        cost, audit, i, state = heapq.heappop(heap)
        if best is not None and cost > best[0]:
            return best
        if i == len(initials) and state in (0, 3):
            best = min(best or (cost, audit), (cost, audit))
        if i < len(initials):
            heapq.heappush(heap, (cost + 2, audit + "D", i + 1, state))
            extra = 5 if cut[i] else 0
            if not forced[i]:
                if state in step.get(initials[i], {}):
                    heapq.heappush(heap, (cost + extra, audit + "K", i + 1, step[initials[i]][state]))
                for x in "ua":
                    if state in step[x]:
                        heapq.heappush(heap, (cost + 1 + extra, audit + "R", i + 1, step[x][state]))
        if cost + 5 <= 2 * len(initials):
            for x in "ua":
                if state in step[x]:
                    heapq.heappush(heap, (cost + 5, audit + "I", i, step[x][state]))
    return best


def test_alignment_equals_the_search_over_all_scripts():
    r = random.Random(5)
    for _ in range(1500):
        n = r.randint(0, 8)
        initials = "".join(r.choice("suua?a") for _ in range(n))
        forced = [r.random() < 0.15 for _ in range(n)]
        cut = [not f and r.random() < 0.25 for f in forced]
        assert turns.align(initials, forced, cut) == cheapest(initials, forced, cut), (initials, forced, cut)


def test_rows_of_the_table_that_were_not_kept_are_computed_again(monkeypatch):
    r = random.Random(6)
    cases = []
    for _ in range(60):
        n = r.randint(20, 60)
        cases.append(("".join(r.choice("ssuuuaaa?") for _ in range(n)), [r.random() < 0.1 for _ in range(n)], [False] * n))
    whole = [turns.align(*c) for c in cases]
    monkeypatch.setattr(turns, "CELLS", 1)
    assert [turns.align(*c) for c in cases] == whole


def expected(rows: list[tuple]) -> tuple:
    """Digest columns of one conversation's damaged rows (turn, role, text), in order."""
    forced, cut, seen, counts = [], [], set(), [0, 0, 0]
    for _, role, text in rows:
        body = text.strip(" \t\n\x0b\x0c\r")
        fault = 0 if not body else 1 if (role, text) in seen else 2 if body[-1] not in ".!?" else None
        if fault is not None:
            counts[fault] += 1
        seen.add((role, text))
        forced.append(fault in (0, 1))
        cut.append(fault == 2)
    initials = "".join(role[:1] or "?" for _, role, _ in rows)
    illegal = sum(x + y not in ("su", "ua", "au") for x, y in zip(initials, initials[1:]))
    at = [t for t, _, _ in rows if t is not None]
    gaps = max(at) - min(at) + 1 - len(set(at)) if at else 0
    cost, audit = cheapest(initials, forced, cut)
    out, rest = [], iter(rows)
    for edit in audit:
        new = "assistant" if out and out[-1][0][0] == "u" else "user"
        if edit == "I":
            out.append((new, ""))
            continue
        _, role, text = next(rest)
        if edit != "D":
            out.append((role if edit == "K" else new, text))
    digest = hashlib.sha256("\n".join(f"{a}:{b}" for a, b in out).encode()).hexdigest()
    return (gaps, *counts, illegal, cost, audit, digest)


def test_query_against_the_search(spark):
    rows = defaultdict(list)
    for conv, turn, role, text in duckdb.execute(f"SELECT conv_id, turn, role, text FROM '{SF}/conversations.parquet'").fetchall():
        mine, kind = rows[conv], zlib.crc32(f"{conv}:{turn}".encode()) % 20
        text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
        if kind:
            mine += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    got = {x.conv_id: tuple(x)[1:] for x in queries.op11_turn_repair(spark, SF).collect()}
    assert got == {conv: expected(sorted(mine, key=lambda x: x[0])) for conv, mine in rows.items()}


@pytest.fixture
def odd(spark):
    rows = [
        (1, None, "user", "Hi."), (1, 3, None, None), (1, 3, "", ""), (None, 1, "user", "A?"), (None, 1, "user", "A?"),
        (2, 0, "system", "Be."), (2, 1, "tool", "x" * 200_000), (3, 5, "user", " \t "),
    ]
    rows += [(4, i, "user" if i % 2 == 0 else "assistant", f"Turn {i}.") for i in range(600)] * 2
    return spark.createDataFrame([(*r, "x", 9) for r in rows], "conv_id long, turn long, role string, text string, k string, audit int")


def test_nulls_empties_ties_repeats_and_clashing_names(odd):
    got = {x.conv_id: x for x in turns.repair(odd).collect()}
    assert set(got) == {None, 1, 2, 3, 4}
    # A null turn comes first; null and empty texts are blank.
    assert (got[1].blank, got[1].cost, got[1].audit) == (2, 6, "DDD")
    assert (got[None].duplicate, got[None].gaps) == (1, 0)
    assert (got[3].blank, got[3].audit, got[3].repaired_sha256) == (1, "D", hashlib.sha256(b"").hexdigest())
    assert (got[4].duplicate, got[4].cost, got[4].audit.count("K")) == (600, 1200, 600)
    assert got[2].truncated == 1


def test_dropped_conversations_and_empty_tables(spark, odd):
    gone = odd.withColumn("copies", odd["turn"] * 0).filter("turn IS NOT NULL")
    empty = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert {tuple(x)[1:] for x in turns.repair(gone).collect()} == {empty}
    assert turns.repair(odd.limit(0)).collect() == []


def test_repaired_turns_alternate(odd):
    found = turns.audits(odd)
    rows = defaultdict(list)
    for x in turns.repaired(odd, found).orderBy("conv_id", "place").collect():
        rows[x.conv_id].append(x.role[0])
    assert all("".join(v).removeprefix("s") == "ua" * (len("".join(v).removeprefix("s")) // 2) for v in rows.values())
    assert len(rows[4]) == 600
