"""The driver's tables seen as network and process events.

Every row of ``events`` is a network event and a process event. Users 0 to 3 get a new account
on 24 January in the network feed only: the new accounts have no baseline and no processes,
the old ones have processes only in the last days.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veerline.config import DEFAULT

# The values of `events` are small: what counts as a large transfer is set to match.
SETTINGS = DEFAULT.with_(exfiltration_bytes=25_000)
HOURS = (8, 18)
CENTROIDS = [[0.1, 0.1], [0.3, 0.3], [0.5, 0.5], [0.7, 0.7], [0.9, 0.9]]
NEW_ACCOUNTS_FROM = "2024-01-24 00:00:00"


_plans: dict[tuple[SparkSession, str, str], DataFrame] = {}


def _once(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    """The lazy plan of a view, built once per session; no data is computed or kept."""
    key = (spark, sf_dir, name)
    if key not in _plans:
        _plans[key] = build()
    return _plans[key]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return _once(spark, sf_dir, f"table {name}", lambda: spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "*", "CAST(get_json_object(props, '$.k') AS INT) AS k", "CAST(round(value * 100) AS BIGINT) AS bo"
    )


def network(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _once(
        spark,
        sf_dir,
        "network",
        lambda: _events(spark, sf_dir).selectExpr(
            "event_id",
            "ts AS event_time",
            f"""concat(CASE WHEN user_id <= 3 AND ts >= TIMESTAMP_NTZ '{NEW_ACCOUNTS_FROM}' THEN 'new' ELSE 'u' END,
                       CAST(user_id AS STRING)) AS user""",
            "concat('10.0.', user_id div 250, '.', user_id % 250 + 1) AS src_ip",
            "CAST(49152 + event_id % 16384 AS INT) AS src_port",
            "concat(CASE WHEN k < 10 THEN '10.1.0.' ELSE '203.0.113.' END, k) AS dest_ip",
            "concat(event_type, '.example') AS dest_host",
            "element_at(array(443, 80, 22, 445, 3389), k % 5 + 1) AS dest_port",
            "'tcp' AS protocol",
            "event_type AS app_name",
            "bo * 3 AS bytes_in",
            "bo AS bytes_out",
            "bo * 3 div 1500 AS packets_in",
            "bo div 1500 AS packets_out",
            "CAST(1 + event_id % 300 AS INT) AS session_duration",
            "'Allowed' AS action",
            "bo >= 25000 AS is_anomaly",
        ),
    )


def process(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _once(
        spark,
        sf_dir,
        "process",
        lambda: _events(spark, sf_dir)
        .selectExpr(
            "*",
            "event_type = 'error' AND value >= 150 AS is_anomaly",
            """CASE WHEN event_type = 'signup' THEN 'powershell.exe' WHEN event_type = 'purchase' THEN 'cmd.exe'
                    WHEN event_type = 'error' AND value >= 150 THEN 'mimikatz.exe'
                    WHEN event_type = 'error' THEN 'python.exe' WHEN event_type = 'click' THEN 'chrome.exe'
                    ELSE 'excel.exe' END AS process_name""",
        )
        .selectExpr(
            "event_id",
            "ts AS event_time",
            "concat('u', CAST(user_id AS STRING)) AS user",
            "concat('h', k % 7) AS host",
            "process_name",
            "concat('/opt/p', k % 13) AS process_path",
            "concat(process_name, ' --k ', k) AS cmd_line",
            "CASE WHEN k % 2 = 0 THEN 'explorer.exe' ELSE 'bash' END AS parent_process",
            "md5(process_name) AS md5_hash",
            "sha2(process_name, 256) AS sha256_hash",
            "is_anomaly",
        ),
    )


def network_with_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Network events with source and destination countries from ``nation``."""
    events = network(spark, sf_dir).withColumns({
        "src_key": F.regexp_extract("user", r"(\d+)$", 1).cast("int") % 25,
        "dest_key": F.substring_index("dest_ip", ".", -1).cast("int") % 25,
    })
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    source = nation.select(F.col("n_nationkey").alias("src_key"), F.col("n_name").alias("src_country"))
    dest = nation.select(F.col("n_nationkey").alias("dest_key"), F.col("n_name").alias("dest_country"))
    return events.join(source, "src_key").join(dest, "dest_key").drop("src_key", "dest_key")


def _json(**columns):
    return F.to_json(F.struct(*[c.alias(n) for n, c in columns.items()]))


def ocsf_network(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The network events written the OCSF way: nested JSON in text cells."""
    n = network(spark, sf_dir)
    return n.select(
        F.col("event_time").alias("EVENT_TIME"),
        # Half of the feed names the user in the column, half only in the endpoint.
        F.when(F.col("dest_port") < 100, F.col("user")).otherwise("").alias("_USER"),
        "src_ip",
        F.col("dest_ip").alias("DEST_IP"),
        F.col("dest_port").alias("DEST_PORT"),
        F.lit("fw-1").alias("DEST_HOST"),
        F.lit(None).cast("bigint").alias("DURATION"),
        F.col("event_time").alias("START_TIME"),
        (F.col("event_time") + F.make_dt_interval(secs=F.col("session_duration"))).alias("END_TIME"),
        F.col("app_name").alias("APP_NAME"),
        F.col("action").alias("DISPOSITION"),
        F.lit("Traffic").alias("_ACTION"),
        _json(
            ip=F.col("src_ip"), port=F.col("src_port"), owner=F.col("user"), zone=F.lit("trust")
        ).alias("SRC_ENDPOINT"),
        _json(ip=F.col("dest_ip"), domain=F.col("dest_host"), port=F.col("dest_port")).alias("DST_ENDPOINT"),
        _json(
            bytes_in=F.col("bytes_in"), bytes_out=F.col("bytes_out"),
            packets_in=F.col("packets_in"), packets_out=F.col("packets_out"),
        ).alias("TRAFFIC"),
        _json(direction=F.lit("Outbound"), protocol_name=F.col("protocol")).alias("CONNECTION_INFO"),
    ).withColumnRenamed("src_ip", "SRC_IP")


def ocsf_process(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The process events written the OCSF way; names and hashes only inside the JSON cell."""
    p = process(spark, sf_dir)
    hashes = F.array(
        F.struct(F.lit("MD5").alias("algorithm"), F.col("md5_hash").alias("value")),
        F.struct(F.lit("SHA-256").alias("algorithm"), F.col("sha256_hash").alias("value")),
    )
    cell = _json(
        name=F.col("process_name"),
        cmd_line=F.col("cmd_line"),
        pid=F.col("event_id"),
        file=F.struct(F.col("process_path").alias("path"), hashes.alias("hashes")),
        parent_process=F.struct(F.col("parent_process").alias("name")),
    )
    empty = F.lit(None).cast("string")
    return p.select(
        F.col("event_time").alias("EVENT_TIME"),
        F.col("user").alias("_USER"),
        F.col("host").alias("_HOST"),
        cell.alias("PROCESS"),
        *[
            empty.alias(c)
            for c in (
                "USER_ID", "PROCESS_NAME", "PROCESS_PATH", "PROCESS_CMD_LINE", "PARENT_PROCESS_NAME",
                "MD5_HASH", "SHA256_HASH",
            )
        ],
        F.lit("Win").alias("EVENT_PLATFORM"),
    )


def ocsf_finding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagged network events as OCSF findings."""
    n = network(spark, sf_dir).filter("is_anomaly")
    info = _json(
        analytic=F.struct(F.lit("large_transfer").alias("name"), F.lit("rule").alias("type")),
        first_seen_time=F.unix_timestamp(F.col("event_time").cast("timestamp")),
        title=F.concat(F.lit("transfer "), F.col("event_id").cast("string")),
        type=F.array(F.lit("url"), F.lit(None)),
        uid=F.col("event_id").cast("string"),
    )
    evidence = _json(
        src_endpoint=F.struct(F.col("src_ip").alias("ip"), F.col("user").alias("owner")),
        dst_endpoint=F.struct(
            F.col("dest_ip").alias("ip"), F.col("dest_host").alias("domain"), F.col("dest_port").alias("port")
        ),
        protocol_name=F.col("protocol"),
        url=F.struct(F.concat(F.col("dest_host"), F.lit("/")).alias("url_string")),
    )
    return n.select(
        F.col("event_time").alias("EVENT_TIME"), info.alias("FINDING_INFO"), evidence.alias("EVIDENCES"),
        F.lit("Informational").alias("SEVERITY"),
        F.lit(None).cast("string").alias("RISK_LEVEL"),
        F.lit(None).cast("double").alias("RISK_SCORE"),
        F.lit("Allowed").alias("ACTION"),
    )
