"""Periodic runs of words: Lyndon roots, extended both ways by longest common extensions over suffix trees."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A run has at least this many words, and this many periods.
LEAST, TIMES = 6, 4


def _tree(s: list[int]) -> tuple[list[int], list[int], list[dict | None]]:
    """Ukkonen's suffix tree of a string whose last symbol is unique: edge starts, edge ends, children.

    Node 0 is the root; leaves have no children, their edges end with the string, and they come up in the order
    of their suffixes.
    """
    n = len(s)
    start, end, link, kids = [0], [0], [0], [{}]
    node = edge = length = rest = 0
    for i, c in enumerate(s):
        rest += 1
        open_link = 0
        while rest:
            if not length:
                edge = i
            below = kids[node].get(s[edge])
            if below is None:
                kids[node][s[edge]] = len(start)
                start.append(i)
                end.append(n)
                link.append(0)
                kids.append(None)
                if open_link:
                    link[open_link] = node
                    open_link = 0
            else:
                at = start[below]
                span = (end[below] if end[below] <= i else i + 1) - at
                if length >= span:
                    edge += span
                    length -= span
                    node = below
                    continue
                if s[at + length] == c:
                    length += 1
                    if open_link:
                        link[open_link] = node
                    break
                split = len(start)
                kids[node][s[edge]] = split
                kids.append({s[at + length]: below, c: split + 1})
                start.append(at)
                end.append(at + length)
                link.append(0)
                start[below] = at + length
                start.append(i)
                end.append(n)
                link.append(0)
                kids.append(None)
                if open_link:
                    link[open_link] = split
                open_link = split
            rest -= 1
            if node:
                node = link[node]
            elif length:
                length -= 1
                edge = i - rest + 1
    return start, end, kids


class Extensions:
    """Longest common extensions of suffixes of ``s`` in constant time each, by the tree's Euler tour.

    The lowest common ancestor of two leaves is the node of least depth between them in the tour, and its depth is
    the length of what both suffixes share. ``ranks`` has the places of the suffixes if symbols are in order, and
    ``back`` those if they are in reverse order; in both the end of the string comes first.
    """

    def __init__(self, s: np.ndarray, ordered: bool):
        symbols = s.tolist()
        symbols.append(-1)
        start, end, kids = _tree(symbols)
        n = len(symbols)
        # The j-th leaf that was made is suffix j.
        suffix = np.cumsum([k is None for k in kids]).tolist()
        self.first = np.zeros(n, "int64")
        tour, order = [], []
        stack = [(0, 0, iter(self._down(kids[0], ordered)))]
        tour.append(0)
        first = [0] * n
        while stack:
            node, depth, rest = stack[-1]
            below = next(rest, None)
            if below is None:
                stack.pop()
                if stack:
                    tour.append(stack[-1][1])
                continue
            if kids[below] is None:
                j = suffix[below] - 1
                first[j] = len(tour)
                order.append(j)
                tour.append(n - j)
                tour.append(depth)
            else:
                deep = depth + end[below] - start[below]
                tour.append(deep)
                stack.append((below, deep, iter(self._down(kids[below], ordered))))
        self.first = np.array(first, "int64")
        self.length = n - 1
        self.least = [np.array(tour, "int32")]
        while 2 << (len(self.least) - 1) <= len(tour):
            last, step = self.least[-1], 1 << (len(self.least) - 1)
            self.least.append(np.minimum(last[:-step], last[step:]))
        if ordered:
            self.ranks = np.empty(n, "int64")
            self.ranks[order] = np.arange(n)
            self.back = np.empty(n, "int64")
            self.back[self._backwards(kids, suffix)] = np.arange(n)

    @staticmethod
    def _down(kids: dict, ordered: bool) -> list[int]:
        return [kids[c] for c in sorted(kids)] if ordered else list(kids.values())

    @staticmethod
    def _backwards(kids: list, suffix: list[int]) -> list[int]:
        order, stack = [], [0]
        while stack:
            node = stack.pop()
            if kids[node] is None:
                order.append(suffix[node] - 1)
                continue
            # A stack gives the last first: the end of the string, then the greatest symbol.
            stack += [kids[node][c] for c in sorted(kids[node]) if c >= 0]
            if -1 in kids[node]:
                stack.append(kids[node][-1])
        return order

    def shared(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """How many symbols the suffixes at x and y share; a place at the end of the string shares none."""
        a, b = self.first[x], self.first[y]
        low, high = np.minimum(a, b), np.maximum(a, b) + 1
        level = np.frexp((high - low).astype("float64"))[1] - 1
        found = np.empty(len(low), "int64")
        for k in np.unique(level):
            at = level == k
            table = self.least[k]
            found[at] = np.minimum(table[low[at]], table[high[at] - (1 << int(k))])
        return np.where(x == y, self.length - x, found)


def _lyndon(ranks: np.ndarray) -> np.ndarray:
    """Length of the longest Lyndon word that starts at each place: up to the next smaller suffix."""
    rank, out, stack = ranks.tolist(), [0] * (len(ranks) - 1), []
    for i, r in enumerate(rank):
        while stack and rank[stack[-1]] > r:
            j = stack.pop()
            out[j] = i - j
        stack.append(i)
    return np.array(out, "int64")


def _promising(ids: np.ndarray, least: int, times: int) -> np.ndarray:
    """Places that can lie in a run, as a mask.

    A run of ``times`` periods holds each of its words ``times`` times, and again within a ``times``-th of its length.
    So a word that is rarer in a stretch, or whose neighbours of its kind are farther away there, splits it, and
    short stretches are left out, until nothing changes: no run is lost.
    """
    mask = np.zeros(len(ids), bool)
    if len(ids) < least:
        return mask
    at, before = np.flatnonzero(np.bincount(ids)[ids] >= times), -1
    width = int(ids.max()) + 1
    while len(at) and len(at) != before:
        before = len(at)
        stretch = np.cumsum(np.diff(at, prepend=at[0]) > 1)
        size = np.bincount(stretch)[stretch]
        long = size >= least
        at, stretch, size = at[long], stretch[long], size[long]
        code = stretch * width + ids[at]
        order = np.argsort(code, kind="stable")
        code, place = code[order], at[order]
        apart = np.where(code[1:] == code[:-1], np.diff(place), len(ids))
        near = np.empty(len(at), "int64")
        near[order] = np.minimum(np.append(apart, len(ids)), np.insert(apart, 0, len(ids)))
        kind = np.cumsum(np.diff(code, prepend=code[:1]) > 0)
        count = np.empty(len(at), "int64")
        count[order] = np.bincount(kind)[kind] if len(kind) else 0
        at = at[(count >= times) & (near <= size // times)]
    mask[at] = True
    return mask


def find_runs(ids: np.ndarray, least: int = LEAST, times: int = TIMES) -> np.ndarray:
    """(start, length, period) of every run in a sequence of word numbers, by start, then period.

    A run is a longest stretch with a smallest period q and at least max(``least``, ``times`` * q) words; ``times``
    is 2 or more. Each run holds, for one of the two orders of the words, a Lyndon word of length q that is the
    longest one at its place; so these words are the only candidates, and each is extended once in either direction.
    """
    mask = _promising(ids, least, times)
    if not mask.any():
        return np.zeros((0, 3), "int64")
    at = np.flatnonzero(mask)
    # Stretches stand one after the other, with a symbol of its own after each.
    gap = np.flatnonzero(np.diff(at) > 1) + 1
    s = np.insert(ids[at], gap, int(ids.max()) + 1 + np.arange(len(gap)))
    place = np.insert(at, gap, -1)
    n = len(s)
    ahead = Extensions(s, True)
    roots = [np.stack([np.arange(n), _lyndon(r)]) for r in (ahead.ranks, ahead.back)]
    x, p = np.unique(np.concatenate(roots, 1), axis=1)
    fit = x + p <= n
    x, p = x[fit], p[fit]
    ends = x + p + ahead.shared(x, x + p)
    del ahead
    behind = Extensions(s[::-1].copy(), False)
    start = x - behind.shared(n - x, n - x - p)
    length = ends - start
    long = (length >= np.maximum(least, times * p)) & (place[x] >= 0)
    found = np.unique(np.stack([place[start[long]], length[long], p[long]], 1), axis=0)
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def _search(batches: Iterator[pa.RecordBatch], least: int, times: int) -> Iterator[pa.RecordBatch]:
    span = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    for batch in batches:
        counts, spans, texts = [], [], []
        for text in batch.column(1):
            # Bytes split at exactly the six characters of white space.
            words = (text.as_py() or "").encode().split()
            numbers = {w: i for i, w in enumerate(dict.fromkeys(words))}
            ids = np.fromiter(map(numbers.__getitem__, words), "int64", len(words))
            found = find_runs(ids, least, times)
            counts.append(len(words))
            spans.append([dict(zip(("start", "length", "period"), r)) for r in found.tolist()])
            if len(found):
                steps = np.zeros(len(words) + 1, "int64")
                np.add.at(steps, found[:, 0] + found[:, 2], 1)
                np.add.at(steps, found[:, 0] + found[:, 1], -1)
                words = [words[i] for i in np.flatnonzero(np.cumsum(steps[:-1]) == 0)]
            texts.append(b" ".join(words).decode())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(counts, pa.int64()), pa.array(spans, pa.list_(span)), pa.array(texts, pa.string())],
            ["k", "n_words", "runs", "collapsed"],
        )


def periodic_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST, times: int = TIMES) -> DataFrame:
    """Per row: ``key``, ``n_words``, ``runs`` (start, length, period; by start, then period) and ``collapsed``.

    Words are separated by white space. ``collapsed`` is the text without the words that a run holds after its
    first period, joined by single spaces. Each whole text is searched on its own, without a shuffle; a null or
    empty text has no words and an empty collapsed text; repeated rows give repeated results, a null key stays
    null, an empty table gives an empty one, and only key and text are read. A text needs about a kilobyte for each
    word that can lie in a run, that is, whose stretch holds it ``times`` times.
    """
    span = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])
    fields = [("n_words", T.LongType()), ("runs", T.ArrayType(span)), ("collapsed", T.StringType())]
    rows = docs.select(F.col(key).alias("k"), F.col(text).alias("t"))
    schema = T.StructType([T.StructField("k", rows.schema["k"].dataType), *(T.StructField(n, kind) for n, kind in fields)])
    return rows.mapInArrow(partial(_search, least=least, times=times), schema).withColumnRenamed("k", key)


def planted(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The test runs of the contract: ``key`` and ``text``, in which every tenth text (by hash) repeats its tail.

    A null key, and a text without words, stay as they are.
    """
    hashed = docs.select(F.col(key).alias("k"), F.col(text).alias("t"), F.crc32(F.col(key).cast("string").cast("binary")).alias("h"))
    split = hashed.withColumn("w", F.when(F.col("h") % 10 == 0, F.expr(r"array_remove(split(t, '[\\x20\\x09-\\x0D]+'), '')")))
    g = F.floor(F.col("h") / 10)
    n = F.size("w")
    cut = split.withColumn("a", F.when(n > 0, g % n)).withColumn("p", 1 + F.floor((n - F.col("a")) / (3 + g % 8)))
    tail = F.expr("array_join(transform(sequence(0, size(w) - 1), i -> w[CAST(CASE WHEN i < a THEN i ELSE a + (i - a) % p END AS INT)]), ' ')")
    return cut.select(F.col("k").alias(key), F.when(F.col("a").isNotNull(), tail).otherwise(F.col("t")).alias(text))
