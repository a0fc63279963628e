from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import DEFAULT, Settings


def is_admin_process(name: str = "process_name", settings: Settings = DEFAULT) -> Column:
    return F.col(name).isin(*settings.admin_processes)


def is_suspicious_process(name: str = "process_name", settings: Settings = DEFAULT) -> Column:
    return F.col(name).isin(*settings.suspicious_processes)


def is_internal_ip(ip: str = "dest_ip", settings: Settings = DEFAULT) -> Column:
    return F.col(ip).rlike(settings.internal_ip_pattern)
