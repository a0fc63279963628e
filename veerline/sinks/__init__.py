from .storage import broadcast_if_small, materialise, publish, published, scratch_dir
from .tables import (
    Covered,
    analyze,
    append_findings,
    append_to_table,
    current_findings,
    finding_history,
    latest_baseline,
    load_baseline,
    save_baseline,
    write_events,
    write_table,
)
from .exports import export_cef, export_json

__all__ = [
    "publish", "published",
    "Covered", "finding_history", "latest_baseline",
    "analyze", "append_findings", "append_to_table", "broadcast_if_small",
    "current_findings", "export_cef", "export_json", "load_baseline", "materialise", "save_baseline", "scratch_dir",
    "write_events", "write_table",
]
