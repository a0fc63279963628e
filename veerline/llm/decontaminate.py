"""Benchmark decontamination: numbers, names and units become placeholders; template windows are hash-joined."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import broadcast_below, store

#: Tokens of a window, and the share of an item's windows from which a document holds the item. An edited word
#: takes five windows, so an item of 14 tokens is still found with one.
WINDOW, SHARE = 5, 0.5
# Units of measure, recognised after a number.
UNITS = (
    "mm cm m km in ft yd mi mg g kg t oz lb lbs ml cl l gal s sec min h hr hrs day days week weeks month months"
    " year years second seconds minute minutes hour hours inch inches foot feet yard yards mile miles meter meters"
    " metre metres kilometer kilometers kilometre kilometres gram grams kilogram kilograms pound pounds ounce"
    " ounces liter liters litre litres gallon gallons dollar dollars euro euros cent cents percent degrees mph kmh"
)


def marked(text: Column) -> Column:
    """Tokens of a text: names get the mark @ and units the mark #; numbers start with a digit.

    A name is a capitalised word that does not start a sentence or line. Each pattern starts with what is rare, a
    capital or a digit, so that most places fail at their first character.
    """
    units = "|".join(sorted(set(UNITS.split()), key=lambda u: (-len(u), u)))
    named = F.regexp_replace(F.coalesce(text, F.lit("")), r"(?=\p{Lu})(?<=[\p{Ll}\p{N},;] )(\p{Lu}\p{Ll}+)(?!\p{L})", "@$1")
    both = F.regexp_replace(named, rf"(\d ?)({units})(?!\p{{L}})", "$1#$2")
    return F.regexp_extract_all(both, F.lit(r"([@#]?[\p{L}\p{M}]+|\d+(?:[.,]\d+)*|[%$€£])"), 1)


def templates(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Adds ``raw`` (marked tokens) and ``h``: hashes of all windows of template tokens, then one of the whole template.

    A window without a single ordinary word has no hash (null): a table of numbers would match any other.
    """
    template = """transform(raw, x -> CASE WHEN x LIKE '@%' THEN '@' WHEN x LIKE '#%' OR x IN ('%', '$', '€', '£') THEN '#'
        WHEN x >= '0' AND x < ':' THEN '0' ELSE lower(x) END)"""
    tokens = rows.select(*keys, marked(F.col("text")).alias("raw"))
    plain = " OR ".join(f"t[i + {k}] NOT IN ('@', '#', '0')" for k in range(WINDOW))
    # The tokens are bound once: the optimizer would otherwise put their computation into the loop over windows.
    hashes = f"""element_at(transform(array({template}), t -> concat(CASE
        WHEN size(t) >= {WINDOW} THEN transform(sequence(0, size(t) - {WINDOW}),
            i -> CASE WHEN {plain} THEN xxhash64({", ".join(f"t[i + {k}]" for k in range(WINDOW))}) END)
        ELSE array() END, array(xxhash64(t, 'whole')))), 1)"""
    return tokens.select(*keys, "raw", F.expr(hashes).alias("h"))


def matches(docs: DataFrame, benchmark: DataFrame, item: str = "item_id", text: str = "text") -> DataFrame:
    """(n, item, coverage) for every text of ``docs`` (n, text; equal n have equal texts) that holds an item.

    Windows with equal templates are aligned by their distance. A window counts if its slots agree: each value
    of the item stands for the value of the document that it stands for in most windows of the alignment. The
    coverage is the share of the item's windows that count in any alignment. An item without a window is found
    where the whole templates are equal.
    """
    named = benchmark.select(F.col(item).cast("long").alias("item"), F.col(text).alias("text")).filter("item IS NOT NULL")
    # The last hash is that of the whole template, which only serves items without windows.
    known = templates(named, ["item"]).filter("size(raw) > 0").withColumn("usable", F.expr("size(filter(slice(h, 1, size(h) - 1), x -> x IS NOT NULL))"))
    windows = known.select("item", F.posexplode("h").alias("ipos", "h"), "raw", "usable", F.expr("size(h) - 1").alias("last")).filter(
        "h IS NOT NULL AND (ipos < last) = (usable > 0)"
    )
    sought = store(
        windows.select("item", F.greatest("usable", F.lit(1)).alias("windows"), "ipos", "h", F.expr(f"slice(raw, ipos + 1, {WINDOW})").alias("iraw"))
        .distinct(), "leak-items",
    )
    hashes = broadcast_below(store(sought.select("h").distinct(), "leak-hashes"))
    # Most texts share no window with any item; only the others are taken apart into places.
    places = templates(docs, ["n"]).select("n", F.explode("h").alias("h"))
    touched = store(places.join(hashes, "h", "left_semi").select("n").distinct(), "leak-texts")
    held = docs.join(broadcast_below(touched), "n", "left_semi").groupBy("n").agg(F.first("text").alias("text"))
    slices = f"transform(h, (x, i) -> named_struct('pos', i, 'h', x, 'draw', slice(raw, i + 1, {WINDOW})))"
    spread = templates(held, ["n"]).select("n", F.explode(F.expr(slices)).alias("x")).select("n", "x.*").filter("h IS NOT NULL")
    slots = "filter(zip_with(iraw, draw, (i, d) -> named_struct('i', i, 'd', d)), p -> p.i RLIKE '^[@#0-9%$€£]')"
    one = spread.join(broadcast_below(sought), "h").select(
        "n", "item", "windows", (F.col("pos") - F.col("ipos")).alias("shift"), "ipos", F.expr(slots).alias("slots")
    )
    # An alignment has at most as many rows as the item has windows.
    aligned = one.groupBy("n", "item", "windows", "shift").agg(F.collect_list(F.struct("ipos", "slots")).alias("rows"))
    # What an item's value stands for is put to the vote only where it is not the same everywhere.
    votes = "flatten(transform(rows, r -> r.slots))"
    good = """CASE WHEN size(array_distinct(v)) = size(array_distinct(v.i)) THEN NULL ELSE
        filter(array_distinct(v), p -> 2 * size(filter(v, q -> q.i = p.i AND q.d = p.d)) > size(filter(v, q -> q.i = p.i))) END"""
    agreeing = f"""element_at(transform(array({votes}), v -> element_at(transform(array({good}), good -> transform(filter(rows, r ->
        good IS NULL OR forall(r.slots, p -> array_contains(good, p))), r -> r.ipos)), 1)), 1)"""
    counted = aligned.select("n", "item", "windows", F.explode(F.expr(agreeing)).alias("ipos"))
    covered = counted.groupBy("n", "item", "windows").agg(F.count_distinct("ipos").alias("got"))
    return covered.select("n", "item", (F.col("got") / F.col("windows")).alias("coverage"))


def _key(text: str) -> Column:
    """Equal texts have equal keys, so rows need no numbers of their own; a null text is an empty one."""
    return F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")))).alias("n")


def _leaks(docs: DataFrame, benchmark: DataFrame, text: str, share: float) -> DataFrame:
    texts = docs.select(_key(text), F.coalesce(F.col(text), F.lit("")).alias("text"))
    found = matches(texts, benchmark).filter(F.col("coverage") >= share)
    return store(found.groupBy("n").agg(F.sort_array(F.collect_set("item")).alias("items"), F.max("coverage").alias("coverage")), "leaks")


def contaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", share: float = SHARE) -> DataFrame:
    """Per row of ``docs``: key, ``contaminated``, ``items`` (ids of the items it holds, sorted), ``coverage``.

    Built-in functions only. Null and empty texts hold nothing; an item with fewer tokens than a window, or without
    an ordinary word, is only found where it is the whole text; empty items and null ids are left out; repeated rows
    are judged alike; an empty table on either side gives no leak; other columns may have any name. A passage that a
    third of all documents hold costs a few rows per document, keyed by document.
    """
    leaks = broadcast_below(_leaks(docs, benchmark, text, share))
    joined = docs.select(docs[f"`{key}`"].alias("key"), _key(text)).join(leaks, "n", "left")
    return joined.select(
        F.col("key").alias(key), F.col("items").isNotNull().alias("contaminated"),
        F.coalesce("items", F.array().cast("array<bigint>")).alias("items"), F.coalesce("coverage", F.lit(0.0)).alias("coverage"),
    )


def without_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", share: float = SHARE) -> DataFrame:
    """The rows of ``docs`` that hold no item, unchanged; nulls, empties and repeats as in ``contaminated``."""
    row = F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row")
    held = docs.select(row, _key(text))
    return held.join(broadcast_below(_leaks(docs, benchmark, text, share)), "n", "left_anti").select("row.*")
