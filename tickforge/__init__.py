"""tickforge: market-data jobs (instrument masters, quotes, bars, history) on Spark.

Every public operator is a pure ``DataFrame(s) -> DataFrame`` function built from
Spark SQL expressions; nothing is collected to the driver and no Python UDF runs
per row.  Operators that can reject input return ``(good, rejects)`` pairs so bad
rows stay visible as data.
"""

from tickforge.session import build_session, staging_dir  # noqa: F401

__all__ = ["build_session", "staging_dir"]
