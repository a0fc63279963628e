from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.bounds import Bounds
from .storage import materialise, publish, published


def write_table(df: DataFrame, name: str, mode: str = "overwrite", fmt: str = "parquet") -> None:
    """Write a catalog table, or files where ``name`` is a path."""
    writer = df.write.format(fmt).mode(mode)
    writer.save(name) if "/" in name else writer.saveAsTable(name)


#: What a later run can change in a finding of the same id.
CONTENT = (
    "severity", "risk_score", "risk_level", "peer_group", "network_evidence", "process_evidence", "analysis_version",
    "model_version",
)


def _content(df: DataFrame, names: list[str]) -> Column:
    """Fingerprint of the named columns; doubles are rounded, since sums depend on the order of their parts."""
    fields, cells = {f.name.lower(): f for f in df.schema}, []
    for name in names:
        field = fields[name]
        inner = [(f"`{field.name}`.`{f.name}`", f) for f in field.dataType] if isinstance(field.dataType, T.StructType) else [(f"`{field.name}`", field)]
        for path, f in inner:
            cell = F.col(path)
            if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
                cell = F.round(cell.cast("double"), 6)
            cells.append(cell.cast("string").alias(f"{name}_{f.name.lower()}"))
    return F.sha2(F.to_json(F.struct(F.lit("").alias("_"), *cells)), 256)


@dataclass(frozen=True)
class Covered:
    """What a run has looked at: a stored finding of these analytics that it no longer finds is withdrawn."""

    bounds: Bounds
    analytics: tuple[str, ...]


def _cell(fields: dict[str, T.StructField], name: str, part: str = "") -> list[Column]:
    field = fields.get(name)
    if field is None or part and not (isinstance(field.dataType, T.StructType) and part in field.dataType.names):
        return []
    return [F.col(f"`{field.name}`.`{part}`" if part else f"`{field.name}`")]


def _seen(day: Column, start: Column, end: Column) -> Column:
    """Microseconds of a day that lie between two instants."""
    first, last = F.unix_micros(start.cast("timestamp")), F.unix_micros(end.cast("timestamp"))
    midnight = F.unix_micros(F.date_trunc("day", day.cast("timestamp")))
    return F.greatest(F.least(midnight + 86_400_000_000, last) - F.greatest(midnight, first), F.lit(0))


def _rank(df: DataFrame) -> Column:
    """What decides between the rows of an id: how much of its day the run saw, and when its period ended."""
    fields = {f.name.lower(): f for f in df.schema}
    start, end = (_cell(fields, "context", f"analysis_period_{x}") for x in ("start", "end"))
    seen = F.coalesce(_seen(F.col("event_time"), start[0], end[0]), F.lit(0)) if start and end else F.lit(0).cast("long")
    return F.struct(seen.alias("seen"), F.coalesce(*end, F.lit("")).alias("until"))


def _latest(df: DataFrame) -> Column:
    """``_rank``, then the events that the run counted, the time of loading, and the higher score."""
    fields = {f.name.lower(): f for f in df.schema}
    counted = _cell(fields, "network_evidence", "daily_events") + _cell(fields, "process_evidence", "daily_processes")
    order = [_rank(df)] + ([F.coalesce(*counted)] if counted else [])
    gone = _cell(fields, "withdrawn")
    # Of one run, a finding stands above a withdrawal.
    order += [~F.coalesce(gone[0], F.lit(False))] if gone else []
    for name in ("load_timestamp", "risk_score", "severity"):
        order += _cell(fields, name)
    return F.struct(*[c.alias(f"_{i}") for i, c in enumerate(order)])


def _withdrawn(df: DataFrame) -> Column:
    gone = _cell({f.name.lower(): f for f in df.schema}, "withdrawn")
    return F.coalesce(gone[0], F.lit(False)) if gone else F.lit(False)


def _changes(findings: DataFrame, stored: DataFrame, covered: Covered | None) -> DataFrame:
    """The rows to append: new and changed findings, and with ``covered`` withdrawals.

    One full outer join by id of the findings with the state of the days at hand, so a rerun of one day does not
    read the whole history. Content that is stored already counts as changed only if the run saw more of the day, or
    ended later, than the row that holds now. A stored finding that is missing is withdrawn by a row of its own if
    the run saw at least as much of its day. Columns that one side lacks are not compared.
    """
    days = findings.agg(F.min("event_time").alias("lo"), F.max("event_time").alias("hi"))
    near = F.col("event_time").between(days.select("lo").scalar(), days.select("hi").scalar())
    if covered is not None:
        limits = [F.date_trunc("day", F.lit(x).cast("timestamp")) for x in (covered.bounds.analysis_start, covered.bounds.analysis_end)]
        near = F.coalesce(near, F.lit(False)) | F.col("event_time").cast("timestamp").between(*limits)
    recent = stored.filter(near)
    both = {f.name.lower() for f in findings.schema} & {f.name.lower() for f in stored.schema}
    names = [c for c in CONTENT if c in both]
    row = F.struct(*[F.col(f"`{c}`") for c in stored.columns])
    marked = recent.select(
        F.col("finding_id").alias("_id"), row.alias("_row"), _latest(recent).alias("_latest"), _rank(recent).alias("_rank"),
        _withdrawn(recent).alias("_gone"), _content(stored, names).alias("_content"),
    )
    state = marked.groupBy("_id").agg(
        F.max_by(F.struct("_row", "_rank", "_gone", "_content"), "_latest").alias("_now"), F.collect_set("_content").alias("_known")
    )
    given = F.struct(*[F.col(f"`{c}`") for c in findings.columns])
    new = findings.select(
        F.col("finding_id").alias("_fid"), given.alias("_given"), _rank(findings).alias("_frank"), _content(findings, names).alias("_fcontent")
    )
    joined = materialise(new.join(state, F.col("_fid") == F.col("_id"), "full_outer"), "finding-changes")
    same = ~F.col("_now._gone") & (F.col("_fcontent") == F.col("_now._content"))
    known = F.array_contains("_known", F.col("_fcontent")) & ~(F.col("_frank") > F.col("_now._rank"))
    added = joined.filter(F.col("_fid").isNotNull() & (F.col("_id").isNull() | ~(same | known)))
    appended = added.select("_given.*")
    if covered is None:
        return appended
    start, end = (F.lit(x) for x in (covered.bounds.analysis_start, covered.bounds.analysis_end))
    mine = F.struct(_seen(F.col("_now._row.event_time"), start, end).alias("seen"), end.alias("until"))
    left = joined.filter(
        F.col("_fid").isNull() & ~F.col("_now._gone") & F.col("_now._row.analytic_name").isin(*covered.analytics)
        & (mine > F.col("_now._rank"))
    ).select("_now._row.*")
    fields = {f.name.lower(): f for f in left.schema}
    context = fields["context"].name
    period = F.col(context).withField("analysis_period_start", start).withField("analysis_period_end", end)
    left = left.withColumns({context: period, fields["withdrawn"].name if "withdrawn" in fields else "withdrawn": F.lit(True)})
    if "load_timestamp" in fields:
        left = left.withColumn(fields["load_timestamp"].name, F.current_timestamp())
    return appended.unionByName(left, allowMissingColumns=True)


def current_findings(stored: DataFrame) -> DataFrame:
    """The row that holds now of each id, without withdrawn ones: appends keep the earlier rows.

    The run that saw most of the finding's day comes first (a run cuts its first and its last day), then the run
    that ended last, the row with more events, the row loaded last, and the higher score; columns that are absent
    do not count. The columns are those of ``stored`` but for ``withdrawn``.
    """
    kept = [c for c in stored.columns if c.lower() != "withdrawn"]
    row = F.struct(*[F.col(f"`{c}`") for c in kept])
    last = F.max_by(F.struct(row.alias("row"), _withdrawn(stored).alias("gone")), _latest(stored)).alias("_now")
    return stored.groupBy("finding_id").agg(last).filter("NOT _now.gone").select("_now.row.*")


def finding_history(stored: DataFrame) -> DataFrame:
    """Every stored row of each id in order: finding_id, user, event_time, step (from 1), severity, risk_score, change.

    ``change`` is ``raised`` for the first row, ``withdrawn``, ``again`` for a finding that comes back, or ``changed``.
    """
    rows = stored.select("finding_id", "user", "event_time", "severity", "risk_score", _withdrawn(stored).alias("gone"), _latest(stored).alias("at"))
    order = Window.partitionBy("finding_id").orderBy("at")
    before = F.lag("gone").over(order)
    change = F.when(F.col("gone"), "withdrawn").when(before.isNull(), "raised").when(before, "again").otherwise("changed")
    return rows.select(
        "finding_id", "user", "event_time", F.row_number().over(order).alias("step"), "severity", "risk_score", change.alias("change")
    )


def append_findings(findings: DataFrame, path: str, covered: Covered | None = None) -> DataFrame:
    """Append findings at ``path`` and return the stored findings; a rerun adds nothing.

    A finding whose content has changed is appended beside the stored one; with ``covered`` a stored finding that
    the run did not find again is withdrawn by a row beside it. ``current_findings`` gives the row that holds of
    each id. New columns are allowed: the returned reader merges the schemas of all appends.
    """
    reader = findings.sparkSession.read.option("mergeSchema", True)
    try:
        # Fixed before the append, which would otherwise change its own input.
        findings = materialise(_changes(findings, reader.parquet(path), covered), "new-findings")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    findings.write.mode("append").parquet(path)
    return reader.parquet(path)


def _aligned(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of a stored table; names match without regard to case, absent ones are NULL."""
    given = {c.lower(): c for c in df.columns}
    return df.select(
        *[
            (F.col(f"`{given[f.name.lower()]}`") if f.name.lower() in given else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )


def append_to_table(findings: DataFrame, table: str, covered: Covered | None = None) -> None:
    """As ``append_findings``, into a catalog table, to which missing columns are added.

    Names match without regard to case; columns the findings lack are filled with NULL.
    """
    spark = findings.sparkSession
    if not spark.catalog.tableExists(table):
        findings.write.saveAsTable(table)
        return
    wanted = {f.name: f.dataType for f in findings.schema}
    if covered is not None:
        wanted["withdrawn"] = T.BooleanType()
    known = {f.name.lower() for f in spark.table(table).schema}
    added = [(name, kind) for name, kind in wanted.items() if name.lower() not in known]
    if added:
        columns = ", ".join(f"`{name}` {kind.simpleString()}" for name, kind in added)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")
    stored = spark.table(table)
    changes = _changes(_aligned(findings, stored.schema), stored, covered)
    _aligned(materialise(changes, "new-findings"), stored.schema).write.insertInto(table)


def write_events(events: DataFrame, path: str, partitions: int | None = None, replace: str = "all") -> None:
    """Lay events out by day, and within a day clustered by user and time.

    The time is part of the range key, so that a user with very many events is spread over several files instead
    of filling one task. ``replace="days"`` is the daily load: only the days of ``events`` are replaced, each as a
    whole, so a repeated load adds nothing and earlier days stay.
    """
    if replace not in ("all", "days"):
        raise ValueError("replace all or days")
    keys = ["date", "user", "event_time"]
    dated = events.withColumn("date", F.to_date("event_time"))
    ranged = dated.repartitionByRange(partitions, *keys) if partitions else dated.repartitionByRange(*keys)
    writer = ranged.sortWithinPartitions(*keys).write.mode("overwrite").partitionBy("date")
    writer.option("partitionOverwriteMode", "dynamic" if replace == "days" else "static").parquet(path)


def analyze(spark: SparkSession, table: str) -> None:
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS")


def save_baseline(baseline: DataFrame, path: str, version: int | None = None) -> None:
    """Store user baselines, so that scoring need not read the baseline period again.

    With a version they go beside the earlier ones, for ``latest_baseline``; a repeated version replaces itself.
    """
    baseline.write.mode("overwrite").parquet(path if version is None else f"{path}/versions/{version}")
    if version is not None:
        publish(baseline.sparkSession, path, version)


def load_baseline(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def latest_baseline(spark: SparkSession, path: str) -> DataFrame:
    """The newest published version below ``path``, or the plain baseline that is stored there."""
    versions = published(spark, path)
    return load_baseline(spark, f"{path}/versions/{versions[-1]}" if versions else path)
