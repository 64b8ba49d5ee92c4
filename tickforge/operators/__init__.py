"""DataFrame operators (pure DataFrame -> DataFrame functions)."""

from tickforge.operators.bars import (  # noqa: F401
    bar_partials, bars, full_market_quote, instrument_key_of, latest_bar, ltp_quote, newest_bars, ohlc_quote, roll_up,
    wanted_bars,
)
from tickforge.operators.history import (  # noqa: F401
    backfill_today, chunk_coverage, historical_data, history_to_today, normalise_candle_time, trailing_window,
)
from tickforge.operators.joins import broadcast_if_small, estimated_bytes  # noqa: F401
from tickforge.operators.master import (  # noqa: F401
    backfill_index_symbols, index_symbol_map, unify_masters,
)
from tickforge.operators.quotes import enrich_quotes, merge_quote_batches, quote_matrix  # noqa: F401
from tickforge.operators.resolve import (  # noqa: F401
    first_match, resolve_instruments, resolve_symbols, unresolved_requests, validate_requests,
)
from tickforge.operators.sequencing import (  # noqa: F401
    explode_days, ordinal_within, plan_date_chunks, plan_key_batches,
)
