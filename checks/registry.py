"""Pairs of a Spark query and its SQL twin, by operator id."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .prelude import PRELUDE

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

DATE = "%Y-%m-%d"
TIME = "%Y-%m-%d %H:%M:%S.%f"


def plain(df: DataFrame) -> DataFrame:
    """Columns in a form that two engines print alike: rounded doubles, times and arrays as text."""
    columns = []
    for field in df.schema:
        cell = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            cell = F.round(cell.cast("double"), 6)
        elif isinstance(field.dataType, T.DateType):
            cell = F.date_format(cell, "yyyy-MM-dd")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            cell = F.date_format(cell, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(field.dataType, T.ArrayType):
            cell = F.array_join(cell.cast("array<string>"), ",")
        columns.append(cell.alias(field.name))
    return df.select(*columns)


def check(name: str, sql: str | None = None, doubles: str = "", dates: str = "", times: str = ""):
    """Register a query; the SQL is a SELECT over the common table expressions.

    The named columns are brought into the form that ``plain`` gives them.
    """

    def register(query: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            # Days and hours are cut in the session time zone; the tables are in UTC.
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return plain(query(spark, sf_dir))

        QUERIES[name] = run
        if sql is not None:
            shaped = [f'round("{c}", 6) AS "{c}"' for c in doubles.split()]
            shaped += [f"strftime(\"{c}\", '{DATE}') AS \"{c}\"" for c in dates.split()]
            shaped += [f"strftime(\"{c}\", '{TIME}') AS \"{c}\"" for c in times.split()]
            star = f"* REPLACE ({', '.join(shaped)})" if shaped else "*"
            ORACLES[name] = f"{PRELUDE}\nSELECT {star} FROM (\n{sql.strip()}\n) q"
        return query

    return register
