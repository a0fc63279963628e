"""OCSF-shaped rows (wide, with JSON in cells) to the flat events of the analysis."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.parse import parse_ocsf_ts

_ENDPOINT = (
    "struct<ip: string, port: int, name: string, domain: string, owner: string, zone: string,"
    " interface_name: string, location: struct<country: string>>"
)
_TRAFFIC = "bytes_in bigint, bytes_out bigint, packets_in bigint, packets_out bigint"
_CONNECTION = "direction string, protocol_name string, session struct<count: int, uid: string>"
_PROCESS = (
    "name string, cmd_line string, pid int,"
    " file struct<path: string, name: string, hashes: array<struct<algorithm: string, value: string>>>,"
    " parent_process struct<name: string, pid: int>,"
    " user struct<name: string>"
)
_FINDING_INFO = (
    "analytic struct<name: string, type: string, type_id: int, uid: string>,"
    " first_seen_time bigint, title string, type array<string>, uid string"
)
_EVIDENCES = (
    "protocol_name string, url struct<url_string: string>,"
    f" src_endpoint {_ENDPOINT}, dst_endpoint {_ENDPOINT}"
)


def read_ocsf_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV export with JSON over several lines and doubled quotes.

    The header names the columns, in any order. Cells are read as text; with ``schema`` the
    columns it names are cast, timestamps in any of the feed's three formats.
    """
    raw = (
        spark.read.option("header", True)
        .option("multiLine", True)
        .option("escape", '"')
        .option("encoding", "UTF-8")
        .csv(path)
    )
    # A byte-order mark that the reader leaves in place would sit in the first name.
    raw = raw.toDF(*[c.lstrip("﻿") for c in raw.columns])
    if schema is None:
        return raw
    present = set(raw.columns)
    cells = []
    for field in schema:
        if field.name not in present:
            cell = F.lit(None).cast(field.dataType)
        elif isinstance(field.dataType, T.TimestampType):
            cell = parse_ocsf_ts(field.name)
        elif isinstance(field.dataType, T.StringType):
            cell = F.col(field.name)
        else:
            cell = F.col(field.name).try_cast(field.dataType)
        cells.append(cell.alias(field.name))
    return raw.select(*cells)


def _text(name: str) -> Column:
    """A text cell, with the empty string read as absent."""
    return F.nullif(F.trim(F.col(name)), F.lit(""))


def _seconds(later: str, earlier: str) -> Column:
    return (F.unix_micros(F.col(later).cast("timestamp")) - F.unix_micros(F.col(earlier).cast("timestamp"))) / 1e6


def _kept(partition_column: str | None) -> list[Column]:
    """The column a table is partitioned by, passed on as it is: only then are whole partitions pruned."""
    return [F.col(partition_column)] if partition_column else []


def flatten_network(df: DataFrame, partition_column: str | None = None) -> DataFrame:
    """OCSF network activity to flat network events.

    The user is ``_USER``, else the owner of the source endpoint; rows with neither are kept
    under their source address, so no traffic leaves the analysis.
    """
    df = df.withColumns(
        {
            "_dst": F.from_json("DST_ENDPOINT", _ENDPOINT),
            "_src": F.from_json("SRC_ENDPOINT", _ENDPOINT),
            "_traffic": F.from_json("TRAFFIC", _TRAFFIC),
            "_connection": F.from_json("CONNECTION_INFO", _CONNECTION),
        }
    )
    src_ip = F.coalesce(_text("SRC_IP"), F.col("_src.ip"))
    return df.select(
        F.col("EVENT_TIME").alias("event_time"),
        F.coalesce(_text("_USER"), F.nullif(F.trim(F.col("_src.owner")), F.lit("")), src_ip).alias("user"),
        src_ip.alias("src_ip"),
        F.col("_src.port").alias("src_port"),
        F.coalesce(_text("DEST_IP"), F.col("_dst.ip")).alias("dest_ip"),
        F.coalesce(F.col("_dst.domain"), _text("DEST_HOST"), F.col("_dst.name")).alias("dest_host"),
        F.coalesce(F.col("DEST_PORT"), F.col("_dst.port")).alias("dest_port"),
        F.col("_src.location.country").alias("src_country"),
        F.col("_dst.location.country").alias("dest_country"),
        F.col("_connection.protocol_name").alias("protocol"),
        F.col("APP_NAME").alias("app_name"),
        F.col("_traffic.bytes_in").alias("bytes_in"),
        F.col("_traffic.bytes_out").alias("bytes_out"),
        F.col("_traffic.packets_in").alias("packets_in"),
        F.col("_traffic.packets_out").alias("packets_out"),
        F.coalesce(F.col("DURATION").cast("double"), _seconds("END_TIME", "START_TIME"))
        .cast("int")
        .alias("session_duration"),
        F.coalesce(_text("DISPOSITION"), _text("_ACTION")).alias("action"),
        *_kept(partition_column),
    )


def _hash_of(algorithm: str) -> Column:
    matching = F.filter(
        F.col("_process.file.hashes"), lambda h: F.upper(h["algorithm"]).isin(algorithm, algorithm.replace("-", ""))
    )
    return F.get(matching, 0)["value"]


def flatten_process(df: DataFrame, partition_column: str | None = None) -> DataFrame:
    """OCSF process activity to flat process events; the ``PROCESS`` cell fills empty columns."""
    df = df.withColumn("_process", F.from_json("PROCESS", _PROCESS))
    return df.select(
        F.col("EVENT_TIME").alias("event_time"),
        F.coalesce(_text("_USER"), F.col("_process.user.name"), _text("USER_ID"), _text("_HOST")).alias("user"),
        _text("_HOST").alias("host"),
        F.coalesce(_text("PROCESS_NAME"), F.col("_process.name")).alias("process_name"),
        F.coalesce(_text("PROCESS_PATH"), F.col("_process.file.path")).alias("process_path"),
        F.coalesce(_text("PROCESS_CMD_LINE"), F.col("_process.cmd_line")).alias("cmd_line"),
        F.coalesce(_text("PARENT_PROCESS_NAME"), F.col("_process.parent_process.name")).alias("parent_process"),
        F.col("_process.pid").alias("pid"),
        F.col("_process.parent_process.pid").alias("parent_pid"),
        F.coalesce(_text("MD5_HASH"), _hash_of("MD5")).alias("md5_hash"),
        F.coalesce(_text("SHA256_HASH"), _hash_of("SHA-256")).alias("sha256_hash"),
        _text("EVENT_PLATFORM").alias("os_platform"),
        *_kept(partition_column),
    )


def flatten_finding(df: DataFrame) -> DataFrame:
    """OCSF detection findings with the analytic, first-seen time and evidence laid open."""
    df = df.withColumns(
        {
            "_info": F.from_json("FINDING_INFO", _FINDING_INFO),
            "_evidence": F.from_json("EVIDENCES", _EVIDENCES),
        }
    )
    return df.select(
        F.col("EVENT_TIME").alias("event_time"),
        F.col("_info.uid").alias("finding_uid"),
        F.col("_info.title").alias("title"),
        F.col("_info.analytic.name").alias("analytic_name"),
        F.col("_info.analytic.type").alias("analytic_type"),
        F.filter(F.col("_info.type"), lambda t: t.isNotNull()).alias("finding_types"),
        F.timestamp_seconds(F.col("_info.first_seen_time")).alias("first_seen_time"),
        F.col("_evidence.src_endpoint.ip").alias("src_ip"),
        F.col("_evidence.src_endpoint.owner").alias("src_owner"),
        F.col("_evidence.dst_endpoint.ip").alias("dest_ip"),
        F.col("_evidence.dst_endpoint.domain").alias("dest_host"),
        F.col("_evidence.dst_endpoint.port").alias("dest_port"),
        F.col("_evidence.protocol_name").alias("protocol"),
        F.col("_evidence.url.url_string").alias("url"),
        F.col("SEVERITY").alias("severity"),
        F.col("RISK_LEVEL").alias("risk_level"),
        F.col("RISK_SCORE").alias("risk_score"),
        F.col("ACTION").alias("action"),
    )
