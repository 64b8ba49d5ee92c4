"""Land derived views as vendor-style files under the shared checkpoint root,
so the readers are exercised on real files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickforge.operators.sequencing import ordinal_within
from tickforge.session import staging_dir

#: Objects per JSON array.
ROWS_PER_ARRAY = 5_000


def stage_csv(df: DataFrame, name: str, gzip: bool = True) -> str:
    path = staging_dir(df.sparkSession, name)
    w = df.write.mode("overwrite").option("header", True)
    if gzip:
        w = w.option("compression", "gzip")
    w.csv(path)
    return path


def stage_json_lines(df: DataFrame, name: str) -> str:
    path = staging_dir(df.sparkSession, name)
    df.write.mode("overwrite").json(path)
    return path


def stage_json_arrays(df: DataFrame, name: str, order_col: str) -> str:
    """Write ``df`` as gzip files that each hold one JSON array of ``ROWS_PER_ARRAY`` objects, in
    ``order_col``'s order; no array grows with the table."""
    numbered = ordinal_within(df, [], [order_col])
    arrays = (numbered.groupBy(F.floor((F.col("ordinal") - 1) / ROWS_PER_ARRAY).alias("_b"))
              .agg(F.to_json(F.collect_list(F.struct(*[F.col(c) for c in df.columns]))).alias("value")))
    path = staging_dir(df.sparkSession, name)
    # One array per file: a file is read as one.
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (arrays.repartition(n, "_b").withColumn("part", F.col("_b")).select("value", "part").write.mode("overwrite")
     .option("compression", "gzip").partitionBy("part").text(path))
    return path + "/*"
