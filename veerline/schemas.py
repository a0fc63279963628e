"""Declared schemas of the inputs and outputs."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(), "int": T.IntegerType(), "long": T.LongType(),
    "double": T.DoubleType(), "timestamp": T.TimestampType(), "boolean": T.BooleanType(),
    "array<string>": T.ArrayType(T.StringType()),
}


def _struct(lines: str, nullable: str = "") -> T.StructType:
    """``name type`` per line; names listed in ``nullable`` may be NULL."""
    optional = set(nullable.split())
    fields = []
    for line in lines.strip().splitlines():
        name, kind = line.split()
        fields.append(T.StructField(name, _TYPES[kind], name in optional or nullable == "*"))
    return T.StructType(fields)


NETWORK_EVENTS = _struct(
    """
    event_id long
    event_time timestamp
    user string
    src_ip string
    src_port int
    dest_ip string
    dest_host string
    dest_port int
    protocol string
    app_name string
    bytes_in long
    bytes_out long
    packets_in long
    packets_out long
    session_duration int
    action string
    is_anomaly boolean
    anomaly_reason string
    """,
    nullable="anomaly_reason",
)

PROCESS_EVENTS = _struct(
    """
    event_id long
    event_time timestamp
    user string
    host string
    process_name string
    process_path string
    cmd_line string
    parent_process string
    pid int
    parent_pid int
    md5_hash string
    sha256_hash string
    os_platform string
    is_anomaly boolean
    anomaly_reason string
    """,
    nullable="anomaly_reason",
)

RULE_FINDINGS = _struct(
    """
    finding_id long
    event_time timestamp
    user string
    finding_type string
    severity string
    title string
    description string
    src_ip string
    dest_ip string
    dest_host string
    bytes_transferred long
    host string
    process_name string
    cmd_line string
    process_hash string
    analytic_name string
    risk_score double
    action_taken string
    """,
    nullable="src_ip dest_ip dest_host bytes_transferred host process_name cmd_line process_hash",
)

FINDINGS = _struct(
    """
    finding_id string
    event_time timestamp
    user string
    finding_type string
    severity string
    title string
    description string
    risk_score double
    risk_level string
    analytic_name string
    analytic_type string
    peer_group int
    recommended_actions array<string>
    model_version string
    """,
    nullable="peer_group recommended_actions model_version",
)

MODEL_OUTPUT = _struct(
    """
    user string
    is_anomaly int
    anomaly_score double
    risk_score double
    risk_level string
    peer_group int
    """
)

# Model inputs, in the order in which the model sees them.
MODEL_FEATURES = (
    "baseline_avg_events",
    "baseline_std_events",
    "baseline_avg_bytes_out",
    "baseline_std_bytes_out",
    "baseline_avg_destinations",
    "baseline_std_destinations",
    "baseline_typical_start_hour",
    "baseline_typical_end_hour",
    "peer_group",
)

# --- OCSF-shaped production tables -------------------------------------------------------
# Columns of the three production tables, by name; all are nullable.

_JSON_CELLS = {
    "CONNECTION_INFO", "DST_ENDPOINT", "SRC_ENDPOINT", "METADATA", "TRAFFIC", "FIREWALL_RULE",
    "DEVICE", "ACTOR", "PROCESS", "PROCESS_HASH", "EVIDENCES", "FINDING_INFO",
}

_NETWORK_COLUMNS = """
ACTIVITY_NAME ACTIVITY_ID APP_NAME CATEGORY_NAME CATEGORY_UID CLASS_NAME CLASS_UID
CONNECTION_INFO DST_ENDPOINT DURATION END_TIME START_TIME EVENT_TIME ENRICHMENTS MESSAGE
METADATA OBSERVABLES SEVERITY SEVERITY_ID SRC_ENDPOINT STATUS_CODE STATUS_DETAIL STATUS_ID
_STATUS TLS TIMEZONE_OFFSET TRAFFIC TYPE_UID TYPE_NAME URL UNMAPPED FILE_NAME S3_FILE_TS
LOAD_TS _COUNT _TIME EVENT_SIMPLENAME SOURCE _HOST DEST_HOST _ACTION ACTION_ID DEST_PORT
SRC_IP DEST_IP PROXY EPOCH_TIME FIREWALL_RULE API CLOUD ACTOR DEVICE PROXY_CONNECTION_INFO
PROXY_ENDPOINT PROXY_HTTP_REQUEST PROXY_HTTP_RESPONSE PROXY_TLS PROXY_TRAFFIC AUTHORIZATIONS
DISPOSITION DISPOSITION_ID ATTACKS MALWARE LOAD_BALANCER CONTAINER NAMESPACE_PID
DATA_CLASSIFICATION AID AIP _USER
"""

_PROCESS_COLUMNS = """
ACTIVITY_NAME ACTIVITY_ID ACTOR ACTUAL_PERMISSIONS REQUESTED_PERMISSIONS CATEGORY_NAME
CATEGORY_UID CLASS_NAME CLASS_UID DEVICE DURATION END_TIME START_TIME EVENT_TIME BIN_TIME
ENRICHMENTS EXIT_CODE INJECTION_TYPE INJECTION_TYPE_ID MESSAGE METADATA MODULE OBSERVABLES
PROCESS PROCESS_CMD_LINE PROCESS_PATH PROCESS_NAME PROCESS_HASH PROCESS_TREE
PARENT_PROCESS_NAME SEVERITY SEVERITY_ID STATUS_CODE STATUS_DETAIL STATUS_ID _STATUS
TIMEZONE_OFFSET TYPE_UID TYPE_NAME UNMAPPED FILE_NAME S3_FILE_TS LOAD_TS _COUNT _TIME
EVENT_SIMPLENAME EVENT_PLATFORM EPOCH_TIME SOURCE _HOST _USER USER_ID MD5_HASH SHA256_HASH
IMPHASH API CLOUD _ACTION ACTION_ID AUTHORIZATIONS DISPOSITION DISPOSITION_ID FIREWALL_RULE
ATTACKS MALWARE DATA_CLASSIFICATION CONTAINER NAMESPACE_PID
"""

_FINDING_COLUMNS = """
ACTIVITY_NAME ACTIVITY_ID RESOURCES CATEGORY_NAME CATEGORY_UID CLASS_NAME CLASS_UID COMMENT
CONFIDENCE CONFIDENCE_ID CONFIDENCE_CORE DURATION END_TIME START_TIME EVENT_TIME ENRICHMENTS
EVIDENCES FINDING_INFO IMPACT_SCORE IMPACT IMPACT_ID RISK_DETAILS RISK_LEVEL RISK_LEVEL_ID
RISK_SCORE SEVERITY SEVERITY_ID MESSAGE METADATA OBSERVABLES REMEDIATION STATUS_CODE
STATUS_DETAIL STATUS_ID _STATUS TIMEZONE_OFFSET TYPE_UID TYPE_NAME UNMAPPED VULNERABILITIES
FILE_NAME S3_FILE_TS LOAD_TS _COUNT _TIME API CLOUD ACTOR DEVICE ACTION ACTION_ID
AUTHORIZATIONS DISPOSITION DISPOSITION_ID FIREWALL_RULE ATTACKS MALWARE DATA_CLASSIFICATION
CONTAINER NAMESPACE_PID
"""

_TIMES = {"END_TIME", "START_TIME", "EVENT_TIME", "BIN_TIME", "S3_FILE_TS", "LOAD_TS", "_TIME"}
_LONGS = {"DURATION", "EPOCH_TIME"}
_DOUBLES = {"CONFIDENCE_CORE", "IMPACT_SCORE", "RISK_SCORE"}
_INTS = {"_COUNT", "EXIT_CODE", "DEST_PORT", "TIMEZONE_OFFSET"}


def _ocsf_type(name: str) -> T.DataType:
    """Column types follow from the names, but for ``USER_ID``, which is text."""
    if name in _TIMES:
        return T.TimestampType()
    if name in _LONGS:
        return T.LongType()
    if name in _DOUBLES:
        return T.DoubleType()
    if name in _INTS or (name.endswith(("_ID", "_UID")) and name != "USER_ID"):
        return T.IntegerType()
    return T.StringType()


def _comment(name: str) -> str:
    if name in _JSON_CELLS:
        return "JSON object"
    if name in _TIMES:
        return "UTC"
    return name.strip("_").replace("_", " ").lower()


def _ocsf_table(columns: str) -> T.StructType:
    return T.StructType(
        [T.StructField(c, _ocsf_type(c), True, {"comment": _comment(c)}) for c in columns.split()]
    )


OCSF_NETWORK = _ocsf_table(_NETWORK_COLUMNS)
OCSF_PROCESS = _ocsf_table(_PROCESS_COLUMNS)
OCSF_FINDING = _ocsf_table(_FINDING_COLUMNS)

TABLES = {
    "network_activity": OCSF_NETWORK,
    "process_activity": OCSF_PROCESS,
    "detection_finding": OCSF_FINDING,
}
