"""Column expressions: no DataFrame goes in or out, so all of them stay in code generation."""

from .parse import parse_ocsf_ts
from .scoring import (
    after_hours,
    baseline_ratio,
    capped,
    ladder,
    outlier_band,
    sum_terms,
    zscore,
)
from .predicates import (
    is_admin_process,
    is_internal_ip,
    is_suspicious_process,
)
from .text import cef_line, finding_id

__all__ = [
    "after_hours", "baseline_ratio", "capped", "cef_line", "finding_id", "is_admin_process",
    "is_internal_ip", "is_suspicious_process", "ladder", "outlier_band", "parse_ocsf_ts",
    "sum_terms", "zscore",
]
