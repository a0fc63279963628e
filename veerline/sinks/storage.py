"""Where intermediate tables go, and when a side may be broadcast."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT, Settings

_local_dirs: dict[str, str] = {}


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local master, whose executors share the driver's disk, may go without the setting
    (tests); on a cluster a folder of one machine would be invisible to the others.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    if context.applicationId not in _local_dirs:
        _local_dirs[context.applicationId] = tempfile.mkdtemp(prefix="run-veerline-")
    return _local_dirs[context.applicationId]


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the written table.

    Cuts the lineage: what follows neither scans the events again nor depends on shuffle files
    of lost executors, and the table's real size is known to the join planner.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/veerline/{label}-{uuid.uuid4().hex}"
    # Texts take a third less room than with the default codec.
    df.write.option("compression", "zstd").mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def publish(spark: SparkSession, path: str, version: int) -> None:
    """Add a version to the manifest below ``path``: readers see it from now on, whole, as its files are all written."""
    spark.createDataFrame([(version,)], "version int").coalesce(1).write.mode("append").parquet(f"{path}/manifest")


def published(spark: SparkSession, path: str) -> list[int]:
    """The published versions in ascending order; none where there is no manifest."""
    try:
        rows = spark.read.schema("version int").parquet(f"{path}/manifest").distinct()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    # One small row per version.
    return sorted(r["version"] for r in rows.collect())


def broadcast_if_small(df: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Mark ``df`` for broadcasting after counting that it has at most the allowed rows.

    The count stops at the limit. A larger side is left to a shuffled join, in which Spark
    splits skewed partitions at run time.
    """
    limit = settings.broadcast_rows
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df
