"""Quality rules: a table of thresholds compiled into one projection of built-in functions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# How words, symbols and lines are told apart, and the limits that hold for every rule set.
SEPARATORS = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50

#: Frequent function words of English, French, German and Spanish.
STOP_WORDS = (
    "the and of to in is that for on with as was by it be are this or an at from",
    "le la les de des du et un une que qui dans pour par pas sur est au avec en",
    "der die das und den von ist mit zu dem ein eine nicht sich auf auch",
    "el los del y por para con se su las una no al lo como",
)


@dataclass(frozen=True)
class Rule:
    """A document passes if ``low <= measure <= high``; an open end is None."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None


#: The measures are columns of :func:`measures`; a ratio over nothing is 0. Repeated lines must be many and also
#: hold much of the text, so that a short line that stands twice in a text of few lines is no reason to drop it.
RULES = (
    Rule("word_length", "mean_word_chars", 2.0, 15.0),
    Rule("symbols", "symbols_per_word", None, 0.2),
    Rule("stop_words", "stop_word_ratio", 0.02, None),
    Rule("letters", "letter_word_ratio", 0.6, None),
    Rule("capitals", "capital_ratio", None, 0.5),
    Rule("repeated_lines", "dup_line_share", None, 0.3),
    Rule("cut_lines", "ellipsis_line_ratio", None, 0.3),
    Rule("list_lines", "bullet_line_ratio", None, 0.9),
)


def stop_words() -> list[str]:
    return sorted(set(" ".join(STOP_WORDS).split()))


def _ratio(part: str, whole: str) -> Column:
    return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(F.lit(0.0))


def measures(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts and ratios of every whole text; a null text counts as empty.

    Words are separated by white space. ``n_repeat_words`` counts the words that stand in a window of three
    words which the text holds twice or more: the windows are sorted by their hash together with their
    position, so that equal ones are neighbours and a long text costs n log n.
    """
    spread = docs.select(F.col(key).alias(key), F.coalesce(F.col(text), F.lit("")).alias("t")).select(
        key,
        "t",
        F.array_remove(F.split("t", SEPARATORS), "").alias("w"),
        F.filter(F.split("t", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
    )
    # Arrays are bound once: the optimizer would otherwise put their computation into the loops over them.
    windows = """element_at(transform(array(w), w -> CASE WHEN size(w) > 2 THEN sort_array(transform(sequence(1, size(w) - 2),
        i -> named_struct('h', xxhash64(get(w, i - 1), get(w, i), get(w, i + 1)), 'i', i)))
        ELSE array() END), 1)"""
    counted = spread.select(
        key,
        "t",
        "lines",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.size(F.filter("w", lambda x: x.rlike(r"\p{L}"))).cast("long").alias("n_letter_words"),
        F.size(F.filter("w", lambda x: F.lower(x).isin(stop_words()))).cast("long").alias("n_stop_words"),
        F.size(F.array_distinct(F.transform("w", F.lower))).cast("long").alias("n_distinct_words"),
        F.expr(windows).alias("s"),
    )
    repeated = """element_at(transform(array(s), s -> CASE WHEN size(s) > 1 THEN size(array_distinct(flatten(transform(
        filter(sequence(0, size(s) - 1), k -> s[k].h = get(s, k - 1).h OR s[k].h = get(s, k + 1).h),
        k -> array(s[k].i, s[k].i + 1, s[k].i + 2))))) ELSE 0 END), 1)"""
    counts = counted.select(
        key,
        "n_words",
        "word_chars",
        "n_letter_words",
        "n_stop_words",
        "n_distinct_words",
        (F.length("t") - F.length(F.translate("t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.length(F.array_join("lines", "")).cast("long").alias("n_line_chars"),
        (F.length(F.array_join("lines", "")) - F.length(F.array_join(F.array_distinct("lines"), ""))).cast("long")
        .alias("n_dup_line_chars"),
        F.expr(repeated).cast("long").alias("n_repeat_words"),
        # What is left without all others: one match per gap, not per letter.
        F.length(F.regexp_replace("t", r"\P{L}+", "")).cast("long").alias("n_letters"),
        F.length(F.regexp_replace("t", r"\P{Lu}+", "")).cast("long").alias("n_capitals"),
        F.size("lines").cast("long").alias("n_lines"),
        F.size(F.filter("lines", lambda x: x.rlike(r"(?:\.\.\.|…)[\x20\x09-\x0D]*\z"))).cast("long")
        .alias("n_ellipsis_lines"),
        F.size(F.filter("lines", lambda x: x.rlike(r"\A[\x20\x09-\x0D]*[-*•]"))).cast("long")
        .alias("n_bullet_lines"),
    )
    return counts.select(
        "*",
        _ratio("word_chars", "n_words").alias("mean_word_chars"),
        _ratio("n_symbols", "n_words").alias("symbols_per_word"),
        _ratio("n_stop_words", "n_words").alias("stop_word_ratio"),
        _ratio("n_letter_words", "n_words").alias("letter_word_ratio"),
        _ratio("n_capitals", "n_letters").alias("capital_ratio"),
        _ratio("n_dup_lines", "n_lines").alias("dup_line_ratio"),
        F.least(_ratio("n_dup_lines", "n_lines"), _ratio("n_dup_line_chars", "n_line_chars")).alias("dup_line_share"),
        _ratio("n_ellipsis_lines", "n_lines").alias("ellipsis_line_ratio"),
        _ratio("n_bullet_lines", "n_lines").alias("bullet_line_ratio"),
    )


def compile_rules(rules: tuple[Rule, ...] = RULES) -> Column:
    """The names of the rules that a row of measures breaks, in the table's order."""
    broken = []
    for rule in rules:
        measure, fails = F.col(rule.measure), F.lit(False)
        if rule.low is not None:
            fails = fails | (measure < rule.low)
        if rule.high is not None:
            fails = fails | (measure > rule.high)
        broken.append(F.when(fails, F.lit(rule.name)))
    return F.array_compact(F.array(*broken)) if broken else F.array().cast("array<string>")


def quality_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: key, measures, ``base_failed``, ``broken`` (names of broken rules), ``kept``.

    Nulls and empty texts have no words and fail; repeated rows give repeated results; a null key stays
    null; an empty table gives an empty one. Only key and text are read, so other columns may have any
    name. One projection over the scan: no shuffle, no user function.
    """
    short = F.col("n_words") < MIN_WORDS
    repetitive = 100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")
    judged = measures(docs, key, text).select(
        "*", (short | repetitive).alias("base_failed"), compile_rules(rules).alias("broken")
    )
    return judged.withColumn("kept", ~F.col("base_failed") & (F.size("broken") == 0))


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass, unchanged; decided row by row in the same projection.

    Null and empty texts go, repeated rows are judged alike, a null key does not matter, an empty table gives an
    empty one, and other columns may have any name.
    """
    held = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("_row"), docs[f"`{text}`"].alias("_text"))
    judged = quality_rules(held, rules, "_row", "_text").select("_row", "kept", F.monotonically_increasing_id().alias("_n"))
    # The row number keeps the optimizer from moving the filter below the measures, which it would compute once per rule.
    return judged.filter(F.col("kept") & (F.col("_n") >= 0)).select("_row.*")
