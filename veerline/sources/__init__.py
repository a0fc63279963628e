from .ocsf import flatten_finding, flatten_network, flatten_process, read_ocsf_csv
from .tables import (
    create_tables,
    describe,
    load_days,
    read_events,
    read_findings,
    read_optional,
    read_sources,
)

__all__ = [
    "create_tables", "describe", "flatten_finding", "flatten_network", "flatten_process", "load_days",
    "read_events", "read_findings", "read_ocsf_csv", "read_optional", "read_sources",
]
