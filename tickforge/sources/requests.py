"""Request lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge.operators.resolve import with_request_defaults
from tickforge.schemas import REQUEST_BODY


def read_requests(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """JSON request items -> rows with the service defaults.

    Items are JSON objects (one per line, or arrays with ``multi_line=True``)
    with ``exchange_token``, ``exchange``, ``instrument_type`` and optionally
    ``request_id``, ``pos``, ``interval_name`` (``interval`` in a history body),
    ``from_date``, ``to_date``.  All values are read as strings (a numeric token
    becomes its text); ``exchange`` defaults to ``NSE``, token and type to ``''``.
    Without ``pos`` the file order is used.  Items without ``request_id`` belong
    to the request their file landed: its id is a hash of the file's path, so a
    large drop of id-less files is many requests, not one.
    """
    df = spark.read.schema(REQUEST_BODY).option("multiLine", multi_line).json(path)
    df = df.withColumns({
        "pos": F.coalesce(F.col("pos"), F.monotonically_increasing_id()),
        "request_id": F.coalesce(F.col("request_id"), F.xxhash64(F.col("_metadata.file_path"))),
        "interval_name": F.coalesce(F.col("interval_name"), F.col("interval")),
    })
    return with_request_defaults(df).drop("interval")
