"""Toxicity by compression distance: separate dictionaries of toxic and ordinary text, calibrated thresholds."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import broadcast_below, partitions, store
from .gam import labelled, sampled

#: Labelled rows that dictionaries and thresholds are learnt from (at most, by hash), and bounds of the dictionaries.
FIT_ROWS, TOXIC_WINDOWS, ORDINARY_WINDOWS, DICT_BYTES = 8000, 400, 8000, 240_000
#: A window belongs to the toxic samples if it is so many standard deviations more frequent there than by chance.
LEAST_Z = 6.0
#: Levels of a text: matched windows (up to MATCHES), then the best ratio of compressed lengths in quarters.
MATCHES, RATIOS, LEAST_GAIN = 4, 12, 3
LEVELS = range((MATCHES + 1) * RATIOS)
WORD = r"[\p{L}\p{N}_]+"


def spelled(word: str) -> str:
    """Each letter with its place, then the length: a short word is long enough to gain by a match, a part of one is no match."""
    return " " + "".join(f"{c}{i:02d}" for i, c in enumerate(word)) + f"={len(word):02d}= "


@dataclass
class Model:
    """Two dictionaries, the length of a window that the toxic one holds, and the calibrated score of each level."""

    toxic: bytes
    ordinary: bytes
    rates: dict[int, float]
    full: float = 0.0


def _compressor(words: bytes) -> zstandard.ZstdCompressor:
    data = zstandard.ZstdCompressionDict(words, dict_type=zstandard.DICT_TYPE_RAWCONTENT) if words else None
    how = zstandard.ZstdCompressionParameters(
        strategy=zstandard.STRATEGY_BTOPT, min_match=4, window_log=19, hash_log=17, chain_log=17, search_log=6, target_length=64,
        write_content_size=False, write_dict_id=False,
    )
    if data:
        data.precompute_compress(compression_params=how)
    return zstandard.ZstdCompressor(dict_data=data, compression_params=how)


class Gains:
    """Compressed lengths per window under both dictionaries; frequent windows are remembered."""

    def __init__(self, model: Model):
        self.toxic, self.ordinary, self.known = _compressor(model.toxic), _compressor(model.ordinary), {}
        self.full = model.full

    def window(self, word: str) -> tuple[int, int]:
        found = self.known.get(word)
        if found is None:
            data = spelled(word).encode()
            found = len(self.toxic.compress(data)), len(self.ordinary.compress(data))
            if len(self.known) < 200_000:
                self.known[word] = found
        return found

    def text(self, text: str | None) -> tuple[int, int]:
        """(level, matched windows); a window matches if the toxic dictionary holds it whole and the other does not.

        A text without words has the least level.
        """
        words = regex.findall(WORD, (text or "").lower())
        sizes = {w: self.window(w) for w in set(words)}
        held = {w for w, (t, o) in sizes.items() if t <= self.full and o - t >= LEAST_GAIN}
        many = sum(w in held for w in words)
        best = max((int(4 * o / t) for t, o in sizes.values()), default=0)
        return RATIOS * min(MATCHES, many) + min(RATIOS - 1, best), many


def _gain(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    gains = Gains(model)
    for batch in batches:
        rows = [gains.text(t) for t in batch.column(1).to_pylist()]
        best, many = zip(*rows) if rows else ((), ())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(best, pa.int64()), pa.array(many, pa.int64())], ["key", "level", "n_windows"]
        )


def gains(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    named = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = named.schema["key"].dataType.simpleString()
    return named.mapInArrow(partial(_gain, model=model), f"key {kind}, level long, n_windows long")


def _dictionary(words: list[str]) -> bytes:
    """Windows one after another, the weightiest last, where matches are cheapest."""
    return "".join(spelled(w) for w in reversed(words)).encode()[-DICT_BYTES:]


def calibrate(rows: list[tuple[int, int, int]]) -> dict[int, float]:
    """Rates of toxic texts by level, never falling as the level grows; rows are (level, texts, toxic ones)."""
    total, toxic = sum(r[1] for r in rows), sum(r[2] for r in rows)
    prior = (toxic + 1) / (total + 2)
    blocks: list[list] = []
    for level, n, hit in sorted(rows):
        blocks.append([[level], n + 1.0, hit + prior])
        while len(blocks) > 1 and blocks[-2][2] / blocks[-2][1] >= blocks[-1][2] / blocks[-1][1]:
            g, n, hit = blocks.pop()
            blocks[-1] = [blocks[-1][0] + g, blocks[-1][1] + n, blocks[-1][2] + hit]
    known = {g: hit / n for gs, n, hit in blocks for g in gs}
    rates, last = {}, min(known.values(), default=prior)
    for level in LEVELS:
        last = rates[level] = known.get(level, last)
    return rates


def learn(docs: DataFrame, labels: DataFrame, label: str = "toxic", key: str = "doc_id", text: str = "text") -> Model:
    """Dictionaries from windows of at most ``FIT_ROWS`` labelled documents, chosen by hash.

    A window is a word. It is counted once per document and once per pair of neighbours, whichever is fewer,
    so that copies of a document do not make its words typical. Windows much more frequent in toxic documents
    than by chance feed the toxic dictionary, the most frequent others the ordinary one. Null labels do not count, a
    null text is empty, repeated rows count each within the bound; without labels, or with labels of one kind, no
    window is toxic and every text gets the calibrated rate.
    """
    known = store(sampled(labelled(labels, label, key), FIT_ROWS), "toxic-labels")
    named = docs.select(F.col(key).alias("_id"), F.lower(F.coalesce(F.col(text), F.lit(""))).alias("_text"))
    held = store(named.join(broadcast_below(known), F.col("_id") == F.col("_key")).select("_id", "_text", "_label", "_key"), "toxic-texts")
    rows = store(sampled(held, FIT_ROWS).drop("_key").repartition(partitions(docs.sparkSession)), "toxic-fit")
    words = rows.select("_id", "_label", F.regexp_extract_all("_text", F.lit(rf"({WORD})"), 1).alias("w"))
    windows = words.select(
        "_id", "_label",
        F.explode(F.expr("transform(w, (x, i) -> named_struct('w', x, 'c', xxhash64(get(w, i - 1), get(w, i + 1))))")).alias("x"),
    )
    toxic = F.col("_label") == 1
    counts = windows.groupBy(F.col("x.w").alias("w")).agg(
        F.least(F.count_distinct(F.when(toxic, F.col("_id"))), F.count_distinct(F.when(toxic, F.col("x.c")))).alias("t"),
        F.least(F.count_distinct(F.when(~toxic, F.col("_id"))), F.count_distinct(F.when(~toxic, F.col("x.c")))).alias("o"),
    )
    share = rows.agg(F.avg(toxic.cast("double"))).first()[0] or 0.0
    chance = (F.col("t") + F.col("o")) * share
    z = store(counts.withColumn("z", (F.col("t") - chance) / F.sqrt(chance + 0.5)), "toxic-windows")
    picked = z.filter(F.col("z") >= LEAST_Z).orderBy(F.desc("z"), "w").limit(TOXIC_WINDOWS).collect()
    others = z.filter(F.col("z") < LEAST_Z).orderBy(F.desc("o"), "w").limit(ORDINARY_WINDOWS).collect()
    model = Model(_dictionary([r.w for r in picked]), _dictionary([r.w for r in others]), {})
    if picked:
        plain = Gains(model)
        # Every window that the dictionary is made of has to match by it.
        model.full = max(plain.window(r.w)[0] for r in picked)
    seen = gains(rows.select(F.struct("_id", "_label").alias("_at"), "_text"), model, "_at", "_text")
    tally = seen.groupBy("level").agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("key._label") == 1).cast("long")).alias("hit"))
    model.rates = calibrate([tuple(r) for r in tally.collect()])
    return model


def classify(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score, level, n_windows) per row. Null and empty texts have the least level and its score; repeated

    rows give repeated results; an empty table gives an empty one; only key and text are read. No shuffle.
    """
    rates = F.element_at(F.array(*[F.lit(float(model.rates[g])) for g in LEVELS]), (F.col("level") + 1).cast("int"))
    return gains(docs, model, key, text).select(F.col("key").alias(key), rates.alias("score"), "level", "n_windows")
