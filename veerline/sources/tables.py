from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..config import DEFAULT, Settings


def _is_path(name: str) -> bool:
    return "/" in name or name.endswith(".parquet")


def read_events(
    spark: SparkSession, source: str, schema: T.StructType | None = None, fmt: str = "parquet"
) -> DataFrame:
    """A catalog table, or files at a path; the schema, if given, saves the inference job."""
    if not _is_path(source):
        return spark.table(source)
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(source)


def read_optional(
    spark: SparkSession, source: str, schema: T.StructType | None = None, fmt: str = "parquet"
) -> DataFrame | None:
    """As ``read_events``, but ``None`` where the source does not exist.

    Only absence is forgiven; any other failure is raised.
    """
    if not _is_path(source) and not spark.catalog.tableExists(source):
        return None
    try:
        return read_events(spark, source, schema, fmt)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_sources(spark: SparkSession, settings: Settings = DEFAULT) -> tuple[DataFrame, DataFrame | None]:
    """Network and process events of the configured data source, as flat events.

    Production tables are OCSF-shaped and are flattened; ``settings.partition_column`` stays a column of its own, so
    that the time bounds prune whole partitions. Without a process table the second value is ``None`` and the
    analysis runs on network events alone.
    """
    from .ocsf import flatten_network, flatten_process

    names = settings.source_tables()
    network = read_events(spark, names["network"])
    process = read_optional(spark, names["process"])
    if not settings.synthetic:
        network = flatten_network(network, settings.partition_column)
        process = flatten_process(process, settings.partition_column) if process is not None else None
    return network, process


def read_findings(
    findings: DataFrame, levels: tuple[str, ...] = ("CRITICAL", "HIGH")
) -> DataFrame:
    """Review list of the stored findings, most risky first."""
    return (
        findings.filter(F.upper("severity").isin(*[x.upper() for x in levels]))
        .select("event_time", "user", "finding_type", "severity", "title", "risk_score", "description")
        .orderBy(F.desc("risk_score"), "user", "event_time", "finding_type")
    )


def create_tables(
    spark: SparkSession, database: str, fmt: str = "parquet", partition_column: str | None = None
) -> list[str]:
    """Create the database and its three OCSF-shaped tables where they do not exist.

    With ``partition_column`` each table gets a date column of that name and is partitioned by it.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    names = []
    for name, schema in schemas.TABLES.items():
        columns = [f"`{f.name}` {f.dataType.simpleString()} COMMENT '{f.metadata['comment']}'" for f in schema]
        parted = ""
        if partition_column:
            columns.append(f"`{partition_column}` date COMMENT 'day of EVENT_TIME'")
            parted = f" PARTITIONED BY (`{partition_column}`)"
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({', '.join(columns)}) USING {fmt}{parted}")
        names.append(f"{database}.{name}")
    return names


def load_days(events: DataFrame, table: str, partition_column: str) -> None:
    """Load OCSF-shaped rows into a partitioned table: the days of ``events`` are replaced, all others stay.

    Names match without regard to case; columns that the rows lack are NULL. Loading a day again gives the same table.
    """
    spark = events.sparkSession
    given = {c.lower(): c for c in events.columns}
    day = F.to_date(F.col(given["event_time"]))
    cells = []
    for field in spark.table(table).schema:
        held = F.col(f"`{given[field.name.lower()]}`") if field.name.lower() in given else F.lit(None)
        cells.append((day if field.name == partition_column else held).cast(field.dataType).alias(field.name))
    # A day with very many rows fills several files.
    ranged = events.select(*cells).repartitionByRange(partition_column, given["event_time"])
    # A catalog table takes this mode from the session only.
    name = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(name)
    spark.conf.set(name, "dynamic")
    try:
        ranged.write.mode("overwrite").insertInto(table)
    finally:
        spark.conf.set(name, before)


def describe(spark: SparkSession, table: str) -> DataFrame:
    return spark.sql(f"DESCRIBE EXTENDED {table}")
