"""Instrument-master readers.

Files are read with a header and every column as a string; the known columns
are then cast by name (a declared CSV schema would bind by position).  Unknown
columns are kept as strings.  ``(src_file, src_pos)`` records file order for
first-match lookups: Spark may read a larger file first, so the file name comes
first; the splits of one file keep their order, so within it
``monotonically_increasing_id`` follows the file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickforge.schemas import MASTER_A_TYPES, MASTER_B_TYPES, MASTER_JSON_TYPES


def _typed(df: DataFrame, types: dict) -> DataFrame:
    cols = []
    for c in df.columns:
        if c in types:
            cols.append(F.col(f"`{c}`").try_cast(types[c]).alias(c))
        else:
            cols.append(F.col(f"`{c}`"))
    return df.select(*cols, *([] if "src_pos" in df.columns else [F.col("_metadata")]))


def _with_pos(df: DataFrame) -> DataFrame:
    if "src_pos" in df.columns:
        return df.withColumn("src_pos", F.col("src_pos").try_cast("long"))
    return df.withColumns({"src_file": F.col("_metadata.file_path"), "src_pos": F.monotonically_increasing_id()}) \
        .drop("_metadata")


def read_master_a(spark: SparkSession, path: str) -> DataFrame:
    """Feed-A master CSV (plain or ``.gz``) with header.

    ``exchange_token`` becomes BIGINT (NULL when not an integer); empty fields
    read as NULL, as in the vendor's own tooling.
    """
    raw = spark.read.option("header", True).option("inferSchema", False).csv(path)
    return _with_pos(_typed(raw, MASTER_A_TYPES))


def read_master_b(spark: SparkSession, path: str) -> DataFrame:
    """Feed-B master CSV (O02): the documented columns typed, ``strike`` DOUBLE,
    ``expiry`` DATE."""
    raw = spark.read.option("header", True).option("inferSchema", False).csv(path)
    return _with_pos(_typed(raw, MASTER_B_TYPES))


def read_master_json(spark: SparkSession, path: str, multi_line: bool = True,
                     fields: dict[str, T.DataType] | None = None) -> DataFrame:
    """JSON master (O03): (gzip) JSON arrays of instrument objects, or JSON lines.

    The declared fields (``schemas.MASTER_JSON_TYPES``, or ``fields``) are typed columns, NULL where an
    object lacks them or the value does not fit; the whole object is the VARIANT column ``record``, so
    any other field can be read (``record:name::string``).  No pass over the files infers a schema.
    A file is one array, read whole by one task; land the master as several files to read it in
    parallel.  A file that is no JSON array fails the job.  Keys keep their JSON names
    (``trading_symbol`` here, with the underscore).
    """
    if multi_line:
        files = spark.read.text(path, wholetext=True).select("value", "_metadata")
        objects = F.from_json("value", "array<variant>", {"mode": "FAILFAST"})
        rows = files.where(F.trim("value") != "").select(F.explode(objects).alias("record"), "_metadata")
    else:
        rows = spark.read.option("singleVariantColumn", "record").json(path).select("record", "_metadata")
    typed = [F.try_variant_get("record", f"$['{c}']", "string").try_cast(t).alias(c)
             for c, t in (fields or MASTER_JSON_TYPES).items()]
    return _with_pos(rows.select(*typed, "record", "_metadata"))
