from .stream import (
    ROCKSDB,
    alert_stream,
    current_alerts,
    read_event_stream,
    revised_daily,
    score_stream,
    stream_daily,
)

__all__ = [
    "ROCKSDB", "alert_stream", "current_alerts", "read_event_stream", "revised_daily", "score_stream", "stream_daily",
]
