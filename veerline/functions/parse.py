from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The three ways in which the feeds write a timestamp.
OFFSET_FORMAT = "yyyy-MM-dd HH:mm:ss.SSS Z"
ZULU_FORMAT = "yyyy-MM-dd HH:mm:ss.SSS X"
NAIVE_FORMAT = "yyyy-MM-dd HH:mm:ss.SSS"


def parse_ocsf_ts(text: Column | str) -> Column:
    """Timestamp of a feed cell: with a numeric offset, with ``Z``, or naive (UTC session)."""
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(
        F.try_to_timestamp(text, F.lit(OFFSET_FORMAT)),
        F.try_to_timestamp(text, F.lit(ZULU_FORMAT)),
        F.try_to_timestamp(text, F.lit(NAIVE_FORMAT)),
        F.try_to_timestamp(text),
    )
