from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# CEF severity (0-10) of each level.
CEF_SEVERITY = {"CRITICAL": 10, "HIGH": 8, "MEDIUM": 5, "LOW": 3}


def finding_id(finding_type: str, user: Column | str = "user", date: Column | str = "date") -> Column:
    """The same finding gets the same id in every run, so appends can be repeated."""
    user = F.col(user) if isinstance(user, str) else user
    date = F.col(date) if isinstance(date, str) else date
    return F.sha2(F.concat_ws("|", F.lit(finding_type), user, date.cast("string")), 256)


def _header(value: Column) -> Column:
    escaped = F.replace(F.replace(value, F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit("\\|"))
    return F.regexp_replace(escaped, r"[\r\n]+", " ")


def _extension(value: Column) -> Column:
    escaped = F.replace(F.replace(value, F.lit("\\"), F.lit("\\\\")), F.lit("="), F.lit("\\="))
    return F.replace(F.replace(escaped, F.lit("\r"), F.lit("\\r")), F.lit("\n"), F.lit("\\n"))


def cef_line(vendor: str = "veerline", product: str = "anomaly", version: str = "1.0") -> Column:
    """One CEF line per finding row."""
    severity = F.coalesce(
        *[F.when(F.upper("severity") == level, F.lit(str(n))) for level, n in CEF_SEVERITY.items()],
        F.lit("0"),
    )
    header = F.concat_ws(
        "|",
        F.lit("CEF:0"), F.lit(vendor), F.lit(product), F.lit(version),
        _header(F.col("finding_type")), _header(F.col("title")), severity,
    )
    extension = F.concat_ws(
        " ",
        F.concat(F.lit("externalId="), _extension(F.col("finding_id"))),
        F.concat(F.lit("suser="), _extension(F.col("user"))),
        F.concat(F.lit("rt="), F.unix_millis(F.col("event_time").cast("timestamp")).cast("string")),
        F.concat(F.lit("cn1Label=risk_score cn1="), F.format_string("%.6f", F.col("risk_score"))),
        F.concat(F.lit("msg="), _extension(F.col("description"))),
    )
    return F.concat_ws("|", header, extension)
