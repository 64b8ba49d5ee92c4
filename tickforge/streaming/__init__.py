"""Live versions of the quote jobs as Structured Streaming queries."""

from tickforge.streaming.live import (  # noqa: F401
    latest_result, latest_state, payload_stream, run_to_table, stream_bars, stream_enrich, stream_ltp,
    stream_merged_quotes, tick_stream,
)
from tickforge.streaming.tables import FreshEnrich, LateSplit, LiveTable, committed, run_batches  # noqa: F401
