"""Helpers of the corpus operators: reading, storing, checked broadcasts, distributed running totals."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sinks.storage import materialise as store

__all__ = ["broadcast_below", "partitions", "read", "running_totals", "store", "word_count"]

#: A whitespace-separated word, as the corpus contracts define it (fixed value).
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def word_count(text: Column) -> Column:
    """Whitespace-separated words of a text; none for a null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def plan_bytes(df: DataFrame) -> int:
    """The size Spark expects ``df`` to have; for a written table that follows from its files."""
    found = re.search(r"sizeInBytes=([\d.]+) ?(\w*)", df._jdf.queryExecution().stringWithStats())
    unit = {"B": 0, "KiB": 10, "MiB": 20, "GiB": 30, "TiB": 40, "PiB": 50, "EiB": 60}
    return int(float(found.group(1)) * 2 ** unit.get(found.group(2), 60)) if found else 2**60


def broadcast_below(stored: DataFrame, limit: int = 8 << 20) -> DataFrame:
    """Mark a stored table for broadcasting if its files say that it has fewer bytes than ``limit``.

    A larger one is left to a shuffled join, whose skewed partitions Spark splits.
    """
    return F.broadcast(stored) if plan_bytes(stored) < limit else stored


def running_totals(df: DataFrame, order: list, sums: list[str], label: str) -> DataFrame:
    """Add ``_row`` and, per summed column, ``_before_<column>``: how many rows, and which total, stand before a row.

    The rows are range-partitioned and sorted by ``order``; each partition counts its own rows while they
    stream past, and the partitions' totals (one row each) give the offsets. No partition holds the whole
    order, and equal keys only share one if ``order`` cannot tell them apart. Summed columns hold no nulls.
    """
    ranged = df.repartitionByRange(partitions(df.sparkSession), *order).sortWithinPartitions(*order)
    added = [("_part", T.IntegerType())] + [(c, T.LongType()) for c in ("_row", *(f"_before_{s}" for s in sums))]
    schema = T.StructType([*df.schema.fields, *(T.StructField(n, kind) for n, kind in added)])
    counted = store(ranged.mapInArrow(partial(_count, sums=sums), schema), label)
    parts = counted.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"), *[F.sum(s).alias(f"_all_{s}") for s in sums])
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        "_part",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n"),
        *[F.coalesce(F.sum(f"_all_{s}").over(before), F.lit(0)).alias(f"_all_{s}") for s in sums],
    )
    # At most one row per partition.
    joined = counted.join(F.broadcast(offsets), "_part")
    return joined.select(
        *[counted[f"`{c}`"] for c in df.columns],
        (counted["_row"] + F.col("_n")).alias("_row"),
        *[(counted[f"_before_{s}"] + F.col(f"_all_{s}")).alias(f"_before_{s}") for s in sums],
    )


def _count(batches: Iterator[pa.RecordBatch], sums: list[str]) -> Iterator[pa.RecordBatch]:
    part, row, total = TaskContext.get().partitionId(), 0, dict.fromkeys(sums, 0)
    for batch in batches:
        n = batch.num_rows
        columns = list(batch.columns)
        columns += [pa.array(np.full(n, part, "int32")), pa.array(np.arange(row, row + n, dtype="int64"))]
        for name in sums:
            values = batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False)
            ends = total[name] + np.cumsum(values, dtype="int64")
            columns.append(pa.array(ends - values, pa.int64()))
            total[name] = int(ends[-1]) if n else total[name]
        row += n
        names = [*batch.schema.names, "_part", "_row", *(f"_before_{s}" for s in sums)]
        yield pa.RecordBatch.from_arrays(columns, names)
