"""Mixing sources to target weights: hash-random order, distributed prefix sums, a cut at each exact budget."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import broadcast_below, running_totals, store, word_count

#: No document is repeated more often than this.
EPOCHS = 3
SEED = "mix-1"


def targets(sources: DataFrame, weights: tuple[int, ...] = (1, 2, 3), epochs: int = EPOCHS) -> DataFrame:
    """Per row of (``_source``, ``source_size``): ``target``.

    Sources by code point, null last, weigh ``weights``, repeating. All sizes are shared out by weight; a
    target stops at ``epochs`` times the source. In ascending order of size per weight a source is full if
    its share of what the ones before it leave is more than it can give; the rest share by weight.
    """
    order = Window.orderBy(F.col("_source").isNull(), F.col("_source"))
    turn = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))
    weighed = sources.withColumn("_w", F.element_at(F.array(*map(F.lit, weights)), turn + 1).cast("double"))
    most = (F.col("source_size") * epochs).cast("double")
    ranked = Window.orderBy(most / F.col("_w"), F.col("_source").isNull(), F.col("_source"))
    earlier = ranked.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    left = F.sum("source_size").over(whole) - F.coalesce(F.sum(most).over(earlier), F.lit(0.0))
    heavy = F.sum("_w").over(whole) - F.coalesce(F.sum("_w").over(earlier), F.lit(0.0))
    shared = weighed.select("*", most.alias("_most"), (left / heavy).alias("_unit"))
    open_ = F.col("_most") > F.col("_unit") * F.col("_w")
    unit = F.max(F.when(open_, F.col("_unit"))).over(whole)
    target = F.when(open_, unit * F.col("_w")).otherwise(F.col("_most"))
    return shared.select("_source", "source_size", target.alias("target"))


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Rows of ``docs`` as a struct ``row``, with size, ``source_size``, ``target``, ``taken``, ``epochs``, ``cut``.

    ``taken`` words = size * ``epochs`` + ``cut``: every document of a source is repeated for each whole
    epoch, and in the last one documents are taken in hash-random order up to the exact budget, which ends
    inside a document (``cut`` words). Null texts have size 0 and null sources form one source; repeated rows
    count each; an empty table gives an empty one; other columns may have any name. A source may hold all
    rows: the order is range-partitioned by source *and* hash.
    """
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"))
    ident = F.coalesce(F.col("row").getField(key).cast("string"), F.lit(""))
    sized = rows.select(
        "row",
        F.col("row").getField(source).alias("_source"),
        F.md5(F.concat(ident, F.lit(f":{SEED}"))).alias("_key"),
        F.col("row").getField(key).alias("_id"),
        F.xxhash64(F.col("row").getField(text)).alias("_text"),
        word_count(F.col("row").getField(text)).alias("size"),
    )
    # Null sources last, as in the weights; rows that share a key stand in the order of their texts.
    order = [F.col("_source").isNull(), F.col("_source"), F.col("_key"), F.col("_id"), F.col("_text")]
    placed = running_totals(sized, order, ["size"], "mix-order")
    # One row per source.
    sums = placed.groupBy("_source").agg(F.sum("size").alias("source_size"), F.min("_before_size").alias("_start"))
    known = store(sums, "mix-sources")
    budgets = store(
        targets(known.select("_source", "source_size")).alias("t")
        .join(known.alias("k"), F.col("t._source").eqNullSafe(F.col("k._source")))
        .select(F.col("k._source").alias("_s"), "k.source_size", "k._start", "t.target",
                F.round("t.target").cast("long").alias("_budget")),
        "mix-targets",
    )
    whole = F.when(F.col("source_size") > 0, F.expr("_budget div source_size")).otherwise(F.lit(0)).cast("long")
    rest = F.col("_budget") - whole * F.col("source_size")
    cut = F.greatest(F.lit(0), F.least(F.col("size"), rest - (F.col("_before_size") - F.col("_start"))))
    joined = placed.join(broadcast_below(budgets), placed["_source"].eqNullSafe(budgets["_s"]))
    return joined.select(
        "row", "size", "source_size", "target", (F.col("size") * whole + cut).cast("long").alias("taken"),
        whole.alias("epochs"), cut.cast("long").alias("cut"),
    )


def mixed(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents of the mix, whole: one row per repeat.

    The document at a source's cut is taken if at least half of its words lie before the cut, so a source comes
    within half a document of its budget. Documents without words (null texts, too) are in no mix; repeated rows
    count each; an empty table gives an empty one; other columns may have any name.
    """
    chosen = mix(docs, text=text).filter("size > 0")
    more = ((F.col("cut") > 0) & (2 * F.col("cut") >= F.col("size"))).cast("int")
    copies = F.array_repeat(F.lit(0), F.col("epochs").cast("int") + more)
    return chosen.select("row", F.explode(copies)).select("row.*")
