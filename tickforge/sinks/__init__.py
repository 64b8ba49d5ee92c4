"""Outputs: master dump (O07), candle files (O08), tick files, per-request status."""

from tickforge.sinks.outputs import (  # noqa: F401
    list_master, request_status, write_candles, write_master, write_ticks,
)
from tickforge.sinks.stores import BarStore, save_candles  # noqa: F401
