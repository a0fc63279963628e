"""Periodic runs against a search over all periods."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import duckdb
import numpy as np

from veerline.llm import queries, runs

SF = "/root/testdata/sf0.001"


def all_runs(ids: list[int], least: int, times: int) -> list[tuple[int, int, int]]:
    """(start, length, period), found period by period; the smallest period of a stretch comes first."""
    x, found = np.array(ids), []
    for q in range(1, len(ids) // times + 1):
        same = np.diff(np.concatenate([[0], x[:-q] == x[q:], [0]]).astype(int))
        for start, end in zip(np.flatnonzero(same == 1).tolist(), np.flatnonzero(same == -1).tolist()):
            run = (start, end - start + q)
            inside = any(s == run[0] and n == run[1] and q % p == 0 for s, n, p in found)
            if run[1] >= max(least, times * q) and not inside:
                found.append((*run, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def test_runs_equal_the_search_over_all_periods():
    r = random.Random(2)
    for _ in range(1200):
        n, letters = r.randint(0, 45), r.choice([1, 2, 3, 5])
        ids = [r.randrange(letters) for _ in range(n)]
        if n > 6 and r.random() < 0.6:
            a, p = r.randrange(n), r.randint(1, 6)
            ids = [ids[i] if i < a else ids[a + (i - a) % p] for i in range(n)]
        for least, times in ((6, 4), (2, 2), (6, 3)):
            assert [tuple(x) for x in runs.find_runs(np.array(ids, "int64"), least, times).tolist()] == all_runs(ids, least, times)


def test_extensions_equal_direct_comparison():
    r = random.Random(3)
    for _ in range(60):
        s = [r.randrange(3) for _ in range(r.randint(1, 40))]
        found = runs.Extensions(np.array(s), True)
        order = sorted(range(len(s) + 1), key=lambda i: s[i:])
        back = sorted(range(len(s) + 1), key=lambda i: [-c for c in s[i:]])
        assert found.ranks.tolist() == np.argsort(order).tolist() and found.back.tolist() == np.argsort(back).tolist()
        x, y = np.divmod(np.arange(len(s) ** 2), len(s))
        direct = [next((k for k in range(len(s)) if max(a, b) + k == len(s) or s[a + k] != s[b + k]), len(s)) for a, b in zip(x, y)]
        assert found.shared(x, y).tolist() == direct


def test_query_against_the_search(spark):
    got = {x.doc_id: tuple(x)[1:] for x in queries.op13_periodic_runs(spark, SF).collect()}
    texts = duckdb.execute(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    seen = 0
    for doc, text in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        h, n = zlib.crc32(str(doc).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        numbers: dict = {}
        found = all_runs([numbers.setdefault(w, len(numbers)) for w in words], 6, 4)
        gone = {i for s, m, q in found for i in range(s + q, s + m)}
        best = min(found, key=lambda x: (-x[1], x[0], x[2]), default=None)
        listed = "".join(f"{s},{m},{q}\n" for s, m, q in found)
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (listed, kept)]
        first = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        assert got[doc] == (len(found), *first, *digests)
        seen += bool(found)
    assert len(got) == len(texts) and seen > 20


def test_nulls_empties_repeats_and_long_texts(spark):
    long = "a b c " * 40_000
    mixed = " ".join(f"w{zlib.crc32(b'%d' % i) % 9973}" for i in range(60_000)) + " " + "z " * 500
    rows = [(None, "x x x x x x x"), (1, None), (2, ""), (3, " \n\t"), (4, long), (4, long), (5, mixed), (6, "x y " * 6 + "x")]
    docs = spark.createDataFrame([(i, t, "a", 1) for i, t in rows], "doc_id long, text string, k string, runs int")
    got = [(x.doc_id, x.n_words, [tuple(r) for r in x.runs], x.collapsed) for x in runs.periodic_runs(docs).collect()]
    assert got[0] == (None, 7, [(0, 7, 1)], "x")
    assert got[1:4] == [(1, 0, [], ""), (2, 0, [], ""), (3, 0, [], "")]
    assert got[4] == got[5] == (4, 120_000, [(0, 120_000, 3)], "a b c")
    assert got[6][1:3] == (60_500, [(60_000, 500, 1)])
    # Only the six characters of white space separate words.
    assert got[7] == (6, 7, [(0, 6, 1)], "x y x")
    assert runs.periodic_runs(docs.limit(0)).collect() == []
    planted = {x.doc_id: x.text for x in runs.planted(docs.dropDuplicates(["doc_id"])).collect()}
    assert planted[None] == "x x x x x x x" and planted[1] is None
