"""One query per corpus operator over its whole tables, and the SQL twins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, gam, hnsw, license_scan, mixing, ngram_join, quality_rules, runs, sharding, token_file, toxicity, turns, warc
from .common import read


def _remainder(key: str, n: int) -> Column:
    return F.crc32(F.col(key).cast("string")) % n


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    sharded = sharding.shard(read(spark, sf_dir, "documents").select("doc_id", "text"), 8)
    return sharded.select(
        "row.doc_id", "size", F.crc32(F.coalesce("row.text", F.lit(""))).alias("text_crc32"), F.lit("bytes").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan_licenses(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    model = gam.learn(docs, labels.filter(_remainder("doc_id", 3) != 1), "quality")
    return _judged(gam.classify(docs, model), 3, 1, 0.5)


def _judged(scored: DataFrame, n: int, held: int, least: float) -> DataFrame:
    out = F.coalesce(_remainder("doc_id", n) == held, F.lit(False))
    return scored.select("doc_id", out.alias("held_out"), "score", (F.col("score") >= least).cast("int").alias("predicted"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "contaminated", F.array_join(F.col("items").cast("array<string>"), ",").alias("item_ids"), "coverage")


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = warc.write_warc(read(spark, sf_dir, "pages"), warc.archive_folder(spark))
    return warc.read_warc(listed).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(read(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.select("row.doc_id", "size", "source_size", "target", "taken")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    model = toxicity.learn(docs, labels.filter(_remainder("doc_id", 4) != 2))
    return _judged(toxicity.classify(docs, model), 4, 2, 0.3)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.quality_rules(read(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op9_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_file.read_tokens(*token_file.write_tokens(read(spark, sf_dir, "documents"), path))


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_join(read(spark, sf_dir, "documents"))


def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return turns.repair(turns.damaged(rows))


def op12_vector_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw.near_duplicates(read(spark, sf_dir, "embeddings"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.periodic_runs(runs.planted(read(spark, sf_dir, "documents")))
    # The longest run, then the first, then that of the smallest period.
    best = F.expr("array_max(transform(runs, r -> struct(r.length AS length, -r.start AS start, -r.period AS period)))")
    listed = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"), F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def _quality_sql() -> str:
    stops = ", ".join(f"'{w}'" for w in quality_rules.stop_words())
    sep = r"[^\x20\x09-\x0D]"
    limits = []
    for rule in quality_rules.RULES:
        limits += [f"{rule.measure} >= {rule.low}"] if rule.low is not None else []
        limits += [f"{rule.measure} <= {rule.high}"] if rule.high is not None else []
    return rf"""
WITH d AS (SELECT row_number() OVER () AS n, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT n, doc_id, t, regexp_extract_all(t, '{sep}+') AS w,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{sep}')) AS lines FROM d),
g AS (SELECT n, i, w[i] || chr(32) || w[i + 1] || chr(32) || w[i + 2] AS g
    FROM (SELECT n, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
r AS (SELECT n, count(DISTINCT p) AS n_repeat_words FROM (
    SELECT n, unnest([i, i + 1, i + 2]) AS p FROM (SELECT n, i, count(*) OVER (PARTITION BY n, g) AS c FROM g) WHERE c > 1)
    GROUP BY n),
c AS (SELECT n, doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    length(array_to_string(lines, '')) AS n_line_chars,
    length(array_to_string(lines, '')) - coalesce(list_sum(list_transform(list_distinct(lines), lambda x: length(x))), 0) AS n_dup_line_chars,
    len(list_filter(w, lambda x: regexp_matches(x, '\p{{L}}'))) AS n_letter_words,
    len(list_filter(w, lambda x: list_contains([{stops}], lower(x)))) AS n_stop_words,
    len(regexp_extract_all(t, '\p{{L}}')) AS n_letters, len(regexp_extract_all(t, '\p{{Lu}}')) AS n_capitals,
    len(lines) AS n_lines,
    len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$'))) AS n_ellipsis,
    len(list_filter(lines, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[-*•]'))) AS n_bullet FROM w),
m AS (SELECT c.*, coalesce(r.n_repeat_words, 0) AS n_repeat_words,
    coalesce(word_chars / nullif(n_words, 0), 0) AS mean_word_chars,
    coalesce(n_symbols / nullif(n_words, 0), 0) AS symbols_per_word,
    coalesce(n_stop_words / nullif(n_words, 0), 0) AS stop_word_ratio,
    coalesce(n_letter_words / nullif(n_words, 0), 0) AS letter_word_ratio,
    coalesce(n_capitals / nullif(n_letters, 0), 0) AS capital_ratio,
    least(coalesce(n_dup_lines / nullif(n_lines, 0), 0), coalesce(n_dup_line_chars / nullif(n_line_chars, 0), 0)) AS dup_line_share,
    coalesce(n_ellipsis / nullif(n_lines, 0), 0) AS ellipsis_line_ratio,
    coalesce(n_bullet / nullif(n_lines, 0), 0) AS bullet_line_ratio
    FROM c LEFT JOIN r USING (n)),
f AS (SELECT *, n_words < {quality_rules.MIN_WORDS}
    OR 100 * n_repeat_words > {quality_rules.MAX_REPEATED_PERCENT} * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND {' AND '.join(limits)} AS kept FROM f"""


MIXING_SQL = rf"""
WITH d AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
    md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':{mixing.SEED}') AS k FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CAST(1 + (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 AS DOUBLE) AS w,
    CAST({mixing.EPOCHS} * source_size AS DOUBLE) AS most FROM s),
u AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(most) OVER e, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER e, 0)) AS unit
    FROM w WINDOW e AS (ORDER BY most / w, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size,
    CASE WHEN most > unit * w THEN max(CASE WHEN most > unit * w THEN unit END) OVER () * w ELSE most END AS target FROM u),
b AS (SELECT *, CAST(round(target) AS BIGINT) AS budget FROM t),
o AS (SELECT d.doc_id, d.size, b.source_size, b.target, b.budget,
    coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY k, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target,
    CAST(CASE WHEN source_size = 0 THEN 0 ELSE size * (budget // source_size)
    + greatest(0, least(size, budget - source_size * (budget // source_size) - before)) END AS BIGINT) AS taken FROM o"""

WARC_SQL = """
WITH p AS (SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
m AS (SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) END AS first FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first IS NULL OR first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN first <> page_id THEN first END AS refers_to FROM m"""

QUERIES = {
    "op1_sharding": op1_sharding,
    "op2_license_scan": op2_license_scan,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_decontamination": op4_decontamination,
    "op5_warc": op5_warc,
    "op6_mixing": op6_mixing,
    "op7_toxicity": op7_toxicity,
    "op8_quality_rules": op8_quality_rules,
    "op9_token_file": op9_token_file,
    "op10_ngram_join": op10_ngram_join,
    "op11_turn_repair": op11_turn_repair,
    "op12_vector_duplicates": op12_vector_duplicates,
    "op13_periodic_runs": op13_periodic_runs,
}
ORACLES = {"op5_warc": WARC_SQL, "op6_mixing": MIXING_SQL, "op8_quality_rules": _quality_sql()}
