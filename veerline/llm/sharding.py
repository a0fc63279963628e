"""Sharding by sampled splitters: size-weighted key samples, quantile boundaries, subdivided ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import store

#: Ranges per shard, and samples per range.
RANGES, SAMPLES = 32, 32


def text_bytes(text: Column) -> Column:
    """UTF-8 bytes of a text, plus 1; a null text has none."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def _splitters(keyed: DataFrame, step: float) -> list[tuple]:
    """Keys hit by a sample that takes a record once per ``step`` bytes; a hash decides on the fraction."""
    chance = F.pmod(F.xxhash64("_h", "_id", "_seq", F.lit(7)), F.lit(1 << 30)) / float(1 << 30)
    hits = F.floor(F.col("_size") / F.lit(step) + chance).alias("hits")
    # At most as many rows as samples are asked for, whatever the size of the input.
    found = keyed.select("_h", "_id", "_seq", hits).filter("hits > 0").orderBy("_h", "_id", "_seq").collect()
    keys, seen = [], 0
    for row in found:
        before, seen = seen, seen + row.hits
        if before // SAMPLES != seen // SAMPLES:
            keys.append((row["_h"], row["_id"], row["_seq"]))
    return keys


def _range_of(keys: list[tuple]) -> Column:
    """The number of splitters up to a record's key: first the block of splitters, then the place in it."""
    if not keys:
        return F.lit(0)
    width = max(1, int(len(keys) ** 0.5))
    blocks = [keys[i : i + width] for i in range(0, len(keys), width)]

    def literal(key: tuple) -> str:
        return "named_struct('h', {}, 'i', {}, 's', {})".format(
            *[("CAST(NULL AS BIGINT)" if part is None else f"CAST('{part}' AS BIGINT)") for part in key]
        )

    heads = ", ".join(literal(b[0]) for b in blocks)
    inner = ", ".join("array(" + ", ".join(literal(k) for k in b) + ")" for b in blocks)
    key = "named_struct('h', _h, 'i', _id, 's', _seq)"
    block = f"size(filter(array({heads}), x -> x <= {key}))"
    return F.expr(
        f"CASE WHEN {block} = 0 THEN 0 ELSE ({block} - 1) * {width}"
        f" + size(filter(element_at(array({inner}), {block}), x -> x <= {key})) END"
    )


def shard(docs: DataFrame, shards: int = 8, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` as a struct ``row``, with ``size``, ``shard`` (0 to ``shards - 1``) and ``slot``.

    Shards hold nearly equal bytes. The order is by a hash of the text, then key, then a number that tells
    repeated rows apart, so equal texts lie together and a text that fills a shard is still cut. Splitters
    come from a size-weighted sample of bounded size; ranges above twice their share are sampled again until no new
    splitter is found, which takes as many rounds as a range is too large by powers of two;
    neighbouring ranges join into shards by the middle of their bytes. Slots count the rows of a shard from
    0: each range is numbered on its own, then shifted by the ranges before it. Null texts have size 1, null
    keys come first, an empty table gives an empty one, and other columns may have any name.
    """
    held = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"))
    body = F.col("row").getField(text)
    keyed = store(
        held.select(
            "row",
            F.xxhash64(F.coalesce(body, F.lit(""))).alias("_h"),
            F.col("row").getField(key).cast("long").alias("_id"),
            F.monotonically_increasing_id().alias("_seq"),
            text_bytes(body).alias("_size"),
        ),
        "shard-keys",
    )
    total = keyed.agg(F.sum("_size")).first()[0] or 0
    share = max(1.0, total / (shards * RANGES))
    keys = _splitters(keyed, share / SAMPLES) if total else []
    # Each round halves the samples' distance in what is still too full, and ends where only single rows are left.
    while keys:
        ranged = keyed.withColumn("_range", _range_of(keys))
        sizes = ranged.groupBy("_range").agg(F.sum("_size").alias("b"), F.count(F.lit(1)).alias("n"))
        # One row per range: a bounded number.
        full = [r["_range"] for r in sizes.filter((F.col("b") > 2 * share) & (F.col("n") > 1)).collect()]
        more = _splitters(ranged.filter(F.col("_range").isin(full)), share / SAMPLES / 2) if full else []
        fresh = set(more) - set(keys)
        if not fresh:
            break
        keys = sorted(set(keys) | fresh, key=lambda k: (k[0], k[1] is not None, k[1] or 0, k[2]))
    ranged = keyed.withColumn("_range", _range_of(keys))
    parts = store(
        ranged.groupBy("_range").agg(F.sum("_size").alias("_b"), F.count(F.lit(1)).alias("_n")), "shard-ranges"
    )
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    middle = F.coalesce(F.sum("_b").over(before), F.lit(0)) + F.col("_b") / 2
    placed = parts.select(
        "_range", "_n", F.least(F.lit(shards - 1), F.floor(middle * shards / F.lit(max(1, total)))).cast("int").alias("shard")
    )
    inside = Window.partitionBy("shard").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("_shift", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
    order = Window.partitionBy("_range").orderBy("_h", "_id", "_seq")
    numbered = ranged.withColumn("_place", F.row_number().over(order).cast("long") - 1)
    joined = numbered.join(F.broadcast(placed.drop("_n")), "_range")
    return joined.select("row", F.col("_size").alias("size"), "shard", (F.col("_place") + F.col("_shift")).alias("slot"))
