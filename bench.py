"""Headline jobs at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each job is planned and run to completion (written to a no-op sink, so every
row is computed) three times: the first (cold) run compiles code and resolves
relations; the reported time is the better of the two warm runs, which damps
GC and JIT noise.  ``cold_total`` sums the first runs.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tickforge.plans import catalog  # noqa: E402
from tickforge.session import build_session  # noqa: E402

HEADLINE = [
    "ltp", "ohlc_1d", "ohlc_i1", "full_quote", "full_quote_enriched", "bars_1minute", "bars_day",
    "resolved", "unresolved", "request_status", "quotes_enriched", "quotes_merged",
    "historical", "today_backfill", "chunk_coverage", "key_batches_750", "date_chunks",
    "candles_parsed", "ltp_for_requests", "full_quote_for_requests", "historical_for_requests",
    "stream_bars", "master_a_csv", "master_json", "requests_json", "candles_written", "master_written",
    "ohlc_for_requests", "candles_saved", "historical_stored", "bars_day_rolled",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(f"local[{cpus}]", app="tickforge-bench", shuffle_partitions=int(cpus),
                          extra={"spark.driver.memory": "16g"})
    qs = catalog.queries()
    names = [n for n in (sys.argv[1:] or HEADLINE) if n in qs]
    times, cold = {}, {}
    for n in names:
        runs = []
        for _ in range(3):
            t0 = time.perf_counter()
            run(qs[n](spark, sf_dir))
            runs.append(time.perf_counter() - t0)
        cold[n] = round(runs[0], 3)
        times[n] = round(min(runs[1:]), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_headline_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf,
                      "cold_total": round(sum(cold.values()), 3)}))
    spark.stop()


if __name__ == "__main__":
    main()
