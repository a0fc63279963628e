from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.text import cef_line


def export_json(findings: DataFrame, path: str) -> None:
    """JSON lines, for log-analysis platforms."""
    findings.write.mode("overwrite").json(path)


def export_cef(findings: DataFrame, path: str) -> None:
    """CEF lines, for syslog forwarders."""
    findings.select(cef_line().alias("value")).write.mode("overwrite").text(path)
