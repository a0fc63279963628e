"""Quality classifier: a generalised additive model with pairwise interactions, learnt by cyclic boosting."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import broadcast_below, partitions, store
from .quality_rules import measures

#: Labelled rows that the model is fitted on, at most; chosen by hash.
FIT_ROWS = 40_000
BINS, PAIR_BINS, PAIRS, ROUNDS, RATE, LEAST = 32, 8, 6, 200, 0.1, 8

FEATURES = (
    "log_words", "mean_word_chars", "symbols_per_word", "stop_word_ratio", "letter_word_ratio", "capital_ratio",
    "dup_line_ratio", "ellipsis_line_ratio", "bullet_line_ratio", "repeat_ratio", "words_per_line", "end_marks",
    "digits", "distinct_words",
)


def features(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, and the features of every whole text as one array; computed in the JVM, without a shuffle."""
    held = docs.select(F.struct(F.col(key).alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t")).alias("row"))
    known = measures(held.select("row", F.col("row.t").alias("text")), "row", "text")
    t, n = F.col("row.t"), F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    chars = F.greatest(F.length(t), F.lit(1)).cast("double")
    added = known.select(
        "*",
        F.log1p("n_words").alias("log_words"),
        (F.col("n_repeat_words") / n).alias("repeat_ratio"),
        (F.col("n_words") / F.greatest(F.col("n_lines"), F.lit(1))).alias("words_per_line"),
        (F.regexp_count(t, F.lit(r"[.!?]")) / n).alias("end_marks"),
        (F.regexp_count(t, F.lit(r"[0-9]")) / chars).alias("digits"),
        (F.col("n_distinct_words") / n).alias("distinct_words"),
    )
    return added.select(F.col("row.k").alias(key), F.array(*[F.col(f).cast("double") for f in FEATURES]).alias("x"))


@dataclass
class Model:
    """Cut points per feature, a table of additions per feature, and tables for pairs of features."""

    start: float
    cuts: list[np.ndarray]
    tables: list[np.ndarray]
    pair_cuts: list[np.ndarray]
    pairs: dict[tuple[int, int], np.ndarray]

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        for j, (cut, table) in enumerate(zip(self.cuts, self.tables)):
            total += table[np.searchsorted(cut, x[:, j], "right")]
        if self.pairs:
            coarse = [np.searchsorted(cut, x[:, j], "right") for j, cut in enumerate(self.pair_cuts)]
            for (i, j), table in self.pairs.items():
                total += table[coarse[i], coarse[j]]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _cuts(column: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(column, np.arange(1, bins) / bins))


def _split(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> tuple[float, int]:
    """Gain and place of the best cut of a histogram."""
    if len(g) < 2:
        return 0.0, 0
    gl, hl, nl = np.cumsum(g)[:-1], np.cumsum(h)[:-1], np.cumsum(n)[:-1]
    gr, hr, nr = g.sum() - gl, h.sum() - hl, n.sum() - nl
    gain = gl**2 / (hl + 1) + gr**2 / (hr + 1) - g.sum() ** 2 / (h.sum() + 1)
    gain = np.where((nl >= LEAST) & (nr >= LEAST), gain, 0.0)
    best = int(np.argmax(gain))
    return float(gain[best]), best + 1


def _tree(g: np.ndarray, h: np.ndarray, n: np.ndarray, depth: int) -> np.ndarray:
    """A shallow tree over the bins of one feature, as additions per bin."""
    gain, at = _split(g, h, n) if depth else (0.0, 0)
    if gain <= 1e-9:
        return np.full(len(g), g.sum() / (h.sum() + 1))
    return np.concatenate([_tree(g[:at], h[:at], n[:at], depth - 1), _tree(g[at:], h[at:], n[at:], depth - 1)])


def _pair_tree(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> tuple[float, np.ndarray]:
    """One cut on the first feature and one on the second within each side."""
    best, table = 0.0, np.zeros(g.shape)
    for at in range(1, g.shape[0]):
        gain, parts = 0.0, []
        for rows in (slice(0, at), slice(at, None)):
            gs, hs, ns = g[rows].sum(0), h[rows].sum(0), n[rows].sum(0)
            parts.append(_tree(gs, hs, ns, 1))
            gain += float((parts[-1] * gs).sum())
        if gain > best:
            best = gain
            table = np.vstack([np.tile(parts[0], (at, 1)), np.tile(parts[1], (g.shape[0] - at, 1))])
    return best, table


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Boost feature by feature in turn, then the pairs that explain most of what is left. One class: a constant."""
    if not len(y):
        return Model(0.0, [], [], [], {})
    rate = (y.sum() + 1) / (len(y) + 2)
    cuts = [_cuts(c, BINS) for c in x.T]
    model = Model(float(np.log(rate / (1 - rate))), cuts, [np.zeros(len(c) + 1) for c in cuts], [], {})
    bins = [np.searchsorted(c, v, "right") for c, v in zip(cuts, x.T)]
    total = np.full(len(y), model.start)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-np.clip(total, -30, 30)))
        return y - p, p * (1 - p)

    def tally(place: np.ndarray, shape, g: np.ndarray, h: np.ndarray) -> list[np.ndarray]:
        size = int(np.prod(shape))
        return [np.bincount(place, w, size).reshape(shape) for w in (g, h, np.ones(len(g)))]

    for _ in range(ROUNDS):
        for b, table in zip(bins, model.tables):
            step = RATE * _tree(*tally(b, len(table), *slopes()), 2)
            table += step
            total += step[b]
    model.pair_cuts = [_cuts(c, PAIR_BINS) for c in x.T]
    coarse = [np.searchsorted(c, v, "right") for c, v in zip(model.pair_cuts, x.T)]
    shape = lambda i, j: (len(model.pair_cuts[i]) + 1, len(model.pair_cuts[j]) + 1)
    place = lambda i, j: coarse[i] * shape(i, j)[1] + coarse[j]
    g, h = slopes()
    gains = [(_pair_tree(*tally(place(i, j), shape(i, j), g, h))[0], (i, j)) for i, j in combinations(range(x.shape[1]), 2)]
    model.pairs = {p: np.zeros(shape(*p)) for _, p in sorted(gains, reverse=True)[:PAIRS]}
    for _ in range(ROUNDS // 4):
        for (i, j), table in model.pairs.items():
            step = RATE * _pair_tree(*tally(place(i, j), table.shape, *slopes()))[1]
            table += step
            total += step[coarse[i], coarse[j]]
    return model


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), len(FEATURES))


def _score(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        scores = model.score(_matrix(batch.column(1)))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], ["key", "score"])


def labelled(labels: DataFrame, label: str, key: str = "doc_id") -> DataFrame:
    """One row per labelled key; contradicting labels of a key count as the larger. Null labels are left out."""
    named = labels.select(F.col(key).alias("_key"), F.col(label).alias("_label"))
    return named.filter("_label IS NOT NULL AND _key IS NOT NULL").groupBy("_key").agg(F.max("_label").alias("_label"))


def sampled(rows: DataFrame, most: int, key: str = "_key") -> DataFrame:
    """At most ``most`` rows, those with the least hashes of their key; few rows are left for the last step to order."""
    n = rows.count()
    if n <= most:
        return rows
    # Half as many again as wanted pass a bound on the hash, so that the sort does not see all rows.
    share = F.pmod(F.xxhash64(key), F.lit(1 << 30)) < F.lit(min(1 << 30, int((1 << 30) * (1.5 * most + 100) / n)))
    return rows.filter(share).orderBy(F.pmod(F.xxhash64(key), F.lit(1 << 30)), key).limit(most)


def learn(docs: DataFrame, labels: DataFrame, label: str, key: str = "doc_id", text: str = "text", rows: int = FIT_ROWS) -> Model:
    """Fit on at most ``rows`` labelled documents, chosen by a hash of the key.

    Null labels, and labels of documents that are not there, do not count; a null text is empty; repeated rows of a
    document count each, still within the bound; without labels every score is 0.5, with labels of one kind it is a
    constant near them.
    """
    known = store(sampled(labelled(labels, label, key), rows), "labels")
    joined = docs.select(F.col(key).alias("_id"), F.col(text).alias("_text")).join(broadcast_below(known), F.col("_id") == F.col("_key"))
    # Repeated rows of a key could exceed the bound again.
    held = store(joined.select(F.struct("_id", "_label").alias("_at"), "_text", F.col("_id").alias("_key")), "labelled-texts")
    fit_rows = sampled(held, rows)
    seen = features(fit_rows.repartition(partitions(docs.sparkSession)), "_at", "_text")
    found = seen.select("_at._id", F.col("_at._label").alias("y"), "x").orderBy(F.xxhash64("_id"), "_id", "y").toPandas()
    x = np.array(found["x"].tolist(), "float64").reshape(len(found), len(FEATURES))
    return fit(x, found["y"].to_numpy("float64"))


def classify(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score) per row: null and empty texts are scored by the features of an empty text; no shuffle.

    Repeated rows give repeated results; an empty table gives an empty one; only key and text are read.
    """
    kind = docs.select(F.col(key).alias("key")).schema["key"].dataType.simpleString()
    seen = features(docs, key, text).withColumnRenamed(key, "key")
    return seen.mapInArrow(partial(_score, model=model), f"key {kind}, score double").withColumnRenamed("key", key)
