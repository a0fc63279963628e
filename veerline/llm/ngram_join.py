"""Jaccard join on word n-grams: MinHash bands find candidates, full n-gram sets verify them."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import store

SIMILARITY, WORDS, RECALL, HASHES = 0.8, 5, 0.999, 128
#: Buckets with more members, or more bytes of n-grams, are split into blocks that meet two by two.
BLOCK_ROWS, BLOCK_BYTES = 256, 4 << 20
#: Columns of the table of n-grams that is multiplied at a time, and rows that are sent back at a time.
WIDTH, SENT = 4096, 8192


def bands_for(similarity: float = SIMILARITY, recall: float = RECALL, hashes: int = HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows per band, so the fewest false candidates, that still reach the recall."""
    for rows in range(hashes, 0, -1):
        bands = hashes // rows
        if 1 - (1 - similarity**rows) ** bands >= recall:
            return bands, rows
    raise ValueError("too few hashes for this recall")


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def ngrams(words: np.ndarray, n: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes (32 bits) of all runs of n words; fewer words make one run, none an empty set."""
    words = words.view("uint64")
    n = min(n, len(words))
    if not n:
        return np.zeros(0, "uint32")
    total = np.zeros(len(words) - n + 1, "uint64")
    for i in range(n):
        total = _mix(total + words[i : len(words) - n + 1 + i])
    return np.unique((total >> np.uint64(32)).astype("uint32"))


def _sign(batches: Iterator[pa.RecordBatch], bands: int, rows: int, n: int) -> Iterator[pa.RecordBatch]:
    seeds = np.random.default_rng(1).integers(1, 1 << 63, bands * rows, dtype="uint64") | np.uint64(1)
    for batch in batches:
        keys, sets, marks = [], [], []
        for words in batch.column(2):
            grams = ngrams(words.values.to_numpy(zero_copy_only=False), n)
            keys.append(hashlib.md5(grams.tobytes()).hexdigest())
            sets.append(grams.tobytes())
            if not len(grams):
                marks.append([])
                continue
            wide = _mix(grams.astype("uint64") + np.uint64(1))
            low = np.empty(bands * rows, "uint64")
            for at in range(0, len(seeds), 16):
                least = None
                for part in range(0, len(wide), 4096):
                    x = wide[part : part + 4096, None] * seeds[None, at : at + 16]
                    found = (x ^ (x >> np.uint64(32))).min(0)
                    least = found if least is None else np.minimum(least, found)
                low[at : at + 16] = least
            mark = np.arange(bands, dtype="uint64")
            for column in low.reshape(bands, rows).T:
                mark = _mix(mark * np.uint64(31) + column)
            marks.append(mark.view("int64"))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(keys, pa.string()), pa.array(sets, pa.binary()),
             pa.array(marks, pa.list_(pa.int64()))],
            ["n", "id", "k", "grams", "bands"],
        )


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of one pair of blocks (b, i, j) at a time, of batches that are sorted by these columns."""
    held, last = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(c).to_numpy() for c in ("b", "i", "j")])
        cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1).tolist(), batch.num_rows]
        for low, high in zip(cuts, cuts[1:]):
            now = tuple(keys[:, low].tolist())
            if held and now != last:
                yield _joined(held)
                held = []
            held.append(batch.slice(low, high - low))
            last = now
    if held:
        yield _joined(held)


def _joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return parts[0] if len(parts) == 1 else pa.Table.from_batches(parts).combine_chunks().to_batches()[0]


def _sent(rows: Iterator[list[np.ndarray]], names: list[str]) -> Iterator[pa.RecordBatch]:
    held, n = [], 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x), pa.int64()) for x in zip(*held)], names)

    for row in rows:
        held.append(row)
        n += len(row[0])
        if n >= SENT:
            yield batch()
            held, n = [], 0
    if n:
        yield batch()


def _pairs(group: pa.RecordBatch, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of rows that this pair of blocks has to verify.

    A pair comes up in the first band that both rows share, and only if the sizes of its sets allow the similarity.
    """
    part, size = group.column("p").to_numpy(), group.column("size").to_numpy()
    bands = group.column("bands").flatten().to_numpy().reshape(len(part), -1)
    x, y = np.triu_indices(len(part), 1)
    fit = np.minimum(size[x], size[y]) >= np.maximum(size[x], size[y]) * (similarity - 1e-9)
    if group.column("i")[0].as_py() != group.column("j")[0].as_py():
        fit &= part[x] != part[y]
    x, y = x[fit], y[fit]
    for column in bands[:, : int((bands[0] == group.column("b")[0].as_py()).argmax())].T:
        new = column[x] != column[y]
        x, y = x[new], y[new]
    return x, y


def _needed(batches: Iterator[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    """The rows of each pair of blocks that have a pair to verify there."""

    def rows() -> Iterator[list[np.ndarray]]:
        for group in _groups(batches):
            at = np.unique(np.concatenate(_pairs(group, similarity)))
            if len(at):
                yield [group.column(c).to_numpy()[at] for c in ("b", "i", "j", "p", "n")]

    return _sent(rows(), ["b", "i", "j", "p", "n"])


def _shared(sets: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many n-grams the sets x and y have in common."""
    if len(x) <= 4 * len(sets):
        return np.array([len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for a, b in zip(x, y)], "int64")
    who = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, at, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    often = times > 1
    held = often[at]
    who, at = who[held], (np.cumsum(often) - 1)[at[held]]
    order = np.argsort(at, kind="stable")
    who, at = who[order], at[order]
    both = np.zeros((len(sets), len(sets)))
    for low in range(0, int(often.sum()), WIDTH):
        first, end = np.searchsorted(at, [low, low + WIDTH])
        table = np.zeros((len(sets), WIDTH), "float32")
        table[who[first:end], at[first:end] - low] = 1
        both += table @ table.T
    return both[x, y].astype("int64")


def _link(batches: Iterator[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    """Per pair of blocks and row with a link there: the rows at the other ends, and the least row reached."""

    def rows() -> Iterator[list[np.ndarray]]:
        for group in _groups(batches):
            x, y = _pairs(group, similarity)
            sets = [np.frombuffer(g.as_buffer(), "uint32") for g in group.column("grams")]
            n, copies, size = (group.column(c).to_numpy() for c in ("n", "copies", "size"))
            both = _shared(sets, x, y)
            alike = both / (size[x] + size[y] - both) >= similarity
            x, y = x[alike], y[alike]
            if not len(x):
                continue
            links, least, before = np.zeros(len(n), "int64"), n.copy(), None
            np.add.at(links, x, copies[y])
            np.add.at(links, y, copies[x])
            while before is None or (least != before).any():
                before = least.copy()
                low = np.minimum(least[x], least[y])
                np.minimum.at(least, x, low)
                np.minimum.at(least, y, low)
            tied = links > 0
            yield [n[tied], links[tied], least[tied]]

    return _sent(rows(), ["n", "links", "least"])


def components(edges: DataFrame) -> DataFrame:
    """(k, c): the smallest node that can be reached; labels are passed on and shortened until none changes."""
    both = store(edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).distinct(), "join-edges")
    labels = store(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("c")).withColumnRenamed("a", "k"), "join-labels")
    while True:
        offered = both.join(labels, both["b"] == labels["k"]).groupBy("a").agg(F.min("c").alias("o"))
        stepped = labels.join(offered, labels["k"] == offered["a"]).select("k", F.least("c", "o").alias("m"), "c")
        parent = labels.select(F.col("k").alias("p"), F.col("c").alias("pc"))
        fresh = stepped.join(parent, stepped["m"] == parent["p"]).select("k", F.least("m", "pc").alias("c"), (F.least("m", "pc") != F.col("c")).alias("changed"))
        fresh = store(fresh, "join-labels")
        labels = fresh.select("k", "c")
        if not fresh.filter("changed").limit(1).count():
            return labels


def _by_blocks(df: DataFrame) -> DataFrame:
    return df.repartition("b", "i", "j").sortWithinPartitions("b", "i", "j")


def ngram_join(
    docs: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = SIMILARITY, n: int = WORDS
) -> DataFrame:
    """Per row of ``docs``: key, ``exact_id``, ``class_id`` (long keys), ``n_links`` and ``n_copies``.

    Words are runs of letters, digits and underscores in lower case. Texts with equal sets of n-grams are one
    class of copies (``exact_id``: its smallest key, ``n_copies``: its rows). Representatives that share a
    band are linked if the Jaccard similarity of their full sets is at least ``similarity``; ``class_id`` is
    the smallest key of everything that links connect, and ``n_links`` counts the other rows that are copies of a
    row or linked to it. Every such pair is verified, and only once: in the first band that both share. Large
    buckets are dealt into blocks that meet two by two, so that no task has a bucket's pairs alone and no pair is
    a row of its own: a pair of blocks gives each of its members one row, with the count of links. A group of m
    similar texts costs at most m * m / 256 rows in each band (ids, and n-grams where a pair is new there), and
    m * m / 2 comparisons in all.

    Null and empty texts have no n-grams and are copies of each other; fewer than n words make one n-gram;
    null keys stay null in the key and are left out of the smallest; repeated rows are copies; an empty table
    gives an empty one; other columns may have any name.
    """
    bands, rows = bands_for(similarity)
    words = F.expr(r"transform(regexp_extract_all(lower(coalesce(_t, '')), '([\\p{L}\\p{M}\\p{N}_]+)', 1), w -> xxhash64(w))")
    named = docs.select(F.monotonically_increasing_id().alias("n"), F.col(key).cast("long").alias("id"), F.col(text).alias("_t"))
    schema = "n long, id long, k string, grams binary, bands array<long>"
    signed = store(named.select("n", "id", words.alias("w")).mapInArrow(partial(_sign, bands=bands, rows=rows, n=n), schema), "join-signed")
    reps = store(signed.groupBy("k").agg(F.min("n").alias("n"), F.min("id").alias("id"), F.count(F.lit(1)).alias("copies")), "join-reps")
    size = (F.octet_length("grams") / 4).cast("long").alias("size")
    sized = signed.filter("size(bands) > 0").select("n", size, "bands").join(reps.select("n"), "n")
    marks = sized.select("n", "size", F.explode("bands").alias("b"))
    split = F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK_ROWS, F.sum("size") * 4 / BLOCK_BYTES)).alias("parts")
    buckets = marks.groupBy("b").agg(F.count(F.lit(1)).alias("m"), split).filter("m > 1").select("b", "parts")
    placed = store(marks.select("n", "b").join(buckets, "b").withColumn("p", F.expr("pmod(xxhash64(n, b), parts)")), "join-buckets")
    # Each member goes to the pairs of blocks that its own block is in.
    met = placed.join(sized, "n").select("n", "size", "bands", "b", "p", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("q"))
    dealt = met.select("b", F.least("p", "q").alias("i"), F.greatest("p", "q").alias("j"), "p", "n", "size", "bands")
    needed = store(_by_blocks(dealt).mapInArrow(partial(_needed, similarity=similarity), "b long, i long, j long, p long, n long"), "join-needed")
    whole = signed.join(reps.join(needed.select("n").distinct(), "n").select("n", "copies"), "n")
    sets = needed.join(store(whole.select("n", "copies", size, "bands", "grams"), "join-sets"), "n")
    links = store(_by_blocks(sets).mapInArrow(partial(_link, similarity=similarity), "n long, links long, least long"), "join-links")
    named = reps.select("k", "n")
    known = components(links.filter("n != least").select(F.col("n").alias("a"), F.col("least").alias("b")).distinct())
    known = known.withColumnRenamed("k", "n").join(named, "n").select("k", "c")
    counted = links.groupBy("n").agg(F.sum("links").alias("links")).join(named, "n").select("k", "links")
    groups = known.join(reps.select("k", "id"), "k").groupBy("c").agg(F.min("id").alias("class"))
    linked = known.join(groups, "c").join(counted, "k").select("k", "class", "links")
    table = store(
        reps.join(linked, "k", "left").select(
            "k", F.col("id").alias("exact_id"), F.coalesce("class", "id").alias("class_id"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.col("copies").alias("n_copies"),
        ), "join-classes",
    )
    return signed.select("id", "k").join(table, "k").select(F.col("id").alias(key), "exact_id", "class_id", "n_links", "n_copies")


def keep_first(docs: DataFrame, text: str = "text", **how) -> DataFrame:
    """One row of each class, unchanged: the first in the order in which the rows are stored."""
    held = store(docs.select(F.monotonically_increasing_id().alias("_n"), F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row")), "join-rows")
    classes = ngram_join(held.select("_n", F.col("row").getField(text).alias("_text")), "_n", "_text", **how)
    kept = classes.filter("_n = class_id").select("_n")
    return held.join(kept, "_n", "left_semi").select("row.*")
