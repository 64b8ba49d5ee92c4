"""Readers for landed vendor files: masters, request lists, quote and candle payloads."""

from tickforge.sources.masters import read_master_a, read_master_b, read_master_json  # noqa: F401
from tickforge.sources.payloads import parse_candles, parse_quotes  # noqa: F401
from tickforge.sources.requests import read_requests  # noqa: F401
