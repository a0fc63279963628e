"""Settings that every operator takes explicitly; nothing is read from globals."""

from __future__ import annotations

from dataclasses import dataclass, replace

# Process names the detector counts as administration tools.
ADMIN_PROCESSES = ("powershell.exe", "cmd.exe", "bash", "sudo", "ssh")

# Known attack tools, Windows then Linux.
SUSPICIOUS_PROCESSES = (
    "mimikatz.exe", "psexec.exe", "nc.exe", "nmap.exe", "metasploit.exe", "cobalt.exe",
    "ncat", "socat", "nmap", "sqlmap", "john", "hashcat", "metasploit",
)

# Private IPv4 prefixes (RFC 1918), as one anchored pattern.
INTERNAL_IP_PATTERN = r"^(10\.|192\.168\.|172\.(1[6-9]|2[0-9]|3[01])\.)"

# SSH, SMB and RDP.
LATERAL_PORTS = (22, 445, 3389)

LEVELS = ("CRITICAL", "HIGH", "MEDIUM", "LOW")


@dataclass(frozen=True)
class ScoreProfile:
    """Weights of a network score, in the order in which the terms are added."""

    terms: tuple[tuple[str, float], ...]
    after_hours: float


# The two weightings of the network score.
FIVE_TERM = ScoreProfile(
    terms=(
        ("events_zscore", 0.2),
        ("bytes_out_zscore", 0.4),
        ("destinations_zscore", 0.2),
        ("hosts_zscore", 0.1),
    ),
    after_hours=0.1,
)
FOUR_TERM = ScoreProfile(
    terms=(
        ("events_zscore", 0.2),
        ("bytes_out_zscore", 0.4),
        ("destinations_zscore", 0.2),
    ),
    after_hours=0.2,
)

# Weights of the process score; the last one is for suspicious tools.
PROCESS_TERMS = (
    ("processes_zscore", 0.3),
    ("unique_processes_zscore", 0.2),
    ("admin_processes_zscore", 0.3),
)
SUSPICIOUS_WEIGHT = 0.2


@dataclass(frozen=True)
class Settings:
    baseline_days: int = 21
    analysis_days: int = 7
    align_to_day: bool = False
    # Column the event tables are partitioned by (equal to the event's date), if any.
    partition_column: str | None = None

    peer_groups: int = 5
    seed: int = 42
    # Users without a baseline are scored against their peers' mean instead of not at all.
    peer_fallback: bool = False

    zscore_threshold: float = 2.5
    zscore_strong: float = 3.0
    zscore_very_strong: float = 4.0
    zscore_cap: float = 3.0
    signed_zscore: bool = False
    after_hours_margin: int = 2

    medium: float = 0.5
    high: float = 0.7
    critical: float = 0.85

    profile: ScoreProfile = FIVE_TERM
    process_terms: tuple[tuple[str, float], ...] = PROCESS_TERMS
    suspicious_weight: float = SUSPICIOUS_WEIGHT
    network_weight: float = 0.6
    process_weight: float = 0.4

    admin_processes: tuple[str, ...] = ADMIN_PROCESSES
    suspicious_processes: tuple[str, ...] = SUSPICIOUS_PROCESSES
    # "names" counts listed tools, "label" counts rows flagged in is_anomaly.
    suspicious_by: str = "names"
    internal_ip_pattern: str = INTERNAL_IP_PATTERN
    lateral_ports: tuple[int, ...] = LATERAL_PORTS

    exfiltration_zscore: float = 2.0
    exfiltration_bytes: int = 5_000_000

    trees: int = 100
    tree_sample: int = 256
    max_contamination: float = 0.1

    catalog: str = "security"
    synthetic: bool = True
    # Sides with more rows than this are never broadcast; Spark shuffles both sides instead.
    broadcast_rows: int = 200_000

    def with_(self, **changes) -> "Settings":
        return replace(self, **changes)

    def source_tables(self) -> dict[str, str]:
        """Names of the input tables for the chosen data source, and of the output table."""
        suffix = "_synthetic" if self.synthetic else ""
        return {
            "network": f"{self.catalog}.network_activity{suffix}",
            "process": f"{self.catalog}.process_activity{suffix}",
            "findings": f"{self.catalog}.detection_finding",
        }


DEFAULT = Settings()
