"""Tables that streams keep: committed batch folders, compacted live state, late rows, master versions.

A batch is a folder of its own, written whole and marked by the ``_SUCCESS`` file that Spark puts
there when the job has committed; a retried batch replaces its folder.  Readers list the marked folders
and never meet a half-written one.  Folders are listed and removed through the store's own file system
interface, so the tables may lie wherever Spark can write.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge.operators.quotes import enrich_quotes


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def committed(spark: SparkSession, root: str, name: str) -> dict[int, str]:
    """The committed folders ``root``/``name``=<number>, by number (a listing, no data)."""
    fs, path = _fs(spark, root)
    if not fs.exists(path):
        return {}
    out = {}
    for s in fs.listStatus(path):
        folder = s.getPath().getName()
        if folder.startswith(f"{name}=") and fs.exists(_fs(spark, f"{root}/{folder}/_SUCCESS")[1]):
            out[int(folder.split("=", 1)[1])] = f"{root}/{folder}"
    return out


def _remove(spark: SparkSession, folder: str) -> None:
    fs, path = _fs(spark, folder)
    fs.delete(path, True)


def run_batches(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append",
                timeout_s: float | None = None) -> None:
    """Hand every micro-batch of what is available now to ``write(rows, batch_id)``, then stop.  Started
    again with the same checkpoint it goes on where it stopped; a batch that failed comes again
    under its number, so ``write`` must replace what it wrote for that number."""
    q = (stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).outputMode(mode)
         .trigger(availableNow=True).start())
    q.awaitTermination(timeout_s)
    if q.isActive:
        q.stop()
        raise TimeoutError("stream did not finish in time")
    if q.exception() is not None:
        raise q.exception()


class LiveTable:
    """The current row per key of an update-mode stream: changes per batch, compacted now and then.

    ``write`` stores a batch's changed rows.  Every ``every`` batches the newest row per key is written
    as a snapshot; then the changes it holds and all but the newest two snapshots are removed, so the
    table stays within two snapshots and ``2 * every`` batches of changes, however long the stream
    runs.  ``read`` takes the newest snapshot and the later changes.  A snapshot is made of committed
    folders only and removed only when a newer one is committed; the older of the two, and the changes
    between them, stay for readers that have begun.
    """

    def __init__(self, spark: SparkSession, root: str, keys: list[str], every: int = 10):
        self.spark, self.root, self.keys, self.every = spark, root, list(keys), every

    def write(self, rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.root}/changes/batch={batch_id}")
        if (batch_id + 1) % self.every == 0:
            self.compact(batch_id)

    def _parts(self, upto: int | None = None) -> list[tuple[int, str]]:
        """(number, folder) of the snapshot and the changes that make the state."""
        snaps = {k: v for k, v in committed(self.spark, f"{self.root}/snapshots", "upto").items() if upto is None or k < upto}
        base = max(snaps, default=-1)
        changes = committed(self.spark, f"{self.root}/changes", "batch")
        later = sorted((k, v) for k, v in changes.items() if k > base and (upto is None or k <= upto))
        return ([(base, snaps[base])] if snaps else []) + later

    def _merged(self, parts: list[tuple[int, str]]) -> DataFrame:
        whole = None
        for k, folder in parts:
            df = self.spark.read.parquet(folder).withColumn("_at", F.lit(k).cast("long"))
            whole = df if whole is None else whole.unionByName(df)
        if whole is None:
            raise ValueError(f"nothing has been written to {self.root}")
        others = [c for c in whole.columns if c not in self.keys and c != "_at"]
        newest = whole.groupBy(*self.keys).agg(F.max_by(F.struct(*others), F.col("_at")).alias("_r"))
        return newest.select(*self.keys, "_r.*")

    def compact(self, upto: int) -> None:
        """Write the state after batch ``upto`` as a snapshot and drop what it makes needless."""
        self._merged(self._parts(upto)).write.mode("overwrite").parquet(f"{self.root}/snapshots/upto={upto}")
        snaps = sorted(committed(self.spark, f"{self.root}/snapshots", "upto").items())
        for _, folder in snaps[:-2]:
            _remove(self.spark, folder)
        kept = snaps[-2:][0][0] if len(snaps) > 1 else -1
        for k, folder in committed(self.spark, f"{self.root}/changes", "batch").items():
            if k <= kept:
                _remove(self.spark, folder)

    def read(self) -> DataFrame:
        """The current row per key."""
        return self._merged(self._parts())


class LateSplit:
    """Ticks behind the watermark as data (O32): ``on_time`` and ``late`` rows of every batch.

    A batch's mark is the latest event time of all batches before it, less ``lateness``; it is written
    down with the batch, so a batch that comes again, and a job that is stopped and started
    again, split alike.  Rows at or before the mark are late, and carry it; a row without a time
    is late as well.  The first batch has no mark.  A bar stream over ``on_time`` with the same
    lateness then loses no row unseen.
    """

    def __init__(self, spark: SparkSession, root: str, lateness: str = "10 minutes", ts: str = "ts"):
        self.spark, self.root, self.lateness, self.ts = spark, root, lateness, ts

    def write(self, rows: DataFrame, batch_id: int) -> None:
        marks = committed(self.spark, f"{self.root}/marks", "batch")
        before = max((k for k in marks if k < batch_id), default=None)
        past = self.spark.read.parquet(marks[before]).first().latest if before is not None else None    # one value
        mark = F.lit(past).cast("timestamp") - F.expr(f"INTERVAL {self.lateness}")
        at = F.col(self.ts)
        late = F.coalesce(at <= mark, at.isNull())
        rows = rows.persist()
        try:
            # The mark comes last: without it the batch counts as not written.
            rows.where(~late).write.mode("overwrite").parquet(f"{self.root}/on_time/batch={batch_id}")
            (rows.where(late).withColumn("mark", mark).write.mode("overwrite").parquet(f"{self.root}/late/batch={batch_id}"))
            latest = rows.agg(F.greatest(F.max(at.cast("timestamp")), F.lit(past).cast("timestamp")).alias("latest"))
            latest.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/marks/batch={batch_id}")
        finally:
            rows.unpersist()

    def late(self) -> DataFrame:
        return self._read("late")

    def on_time(self) -> DataFrame:
        return self._read("on_time")

    def _read(self, part: str) -> DataFrame:
        done = committed(self.spark, f"{self.root}/marks", "batch")
        out = None
        for k in sorted(done):
            df = self.spark.read.parquet(f"{self.root}/{part}/batch={k}").withColumn("batch", F.lit(k).cast("long"))
            out = df if out is None else out.unionByName(df)
        if out is None:
            raise ValueError(f"nothing has been written to {self.root}")
        return out


class FreshEnrich:
    """Quotes enriched from the newest master (O30): each batch looks which version of the master has
    landed, and every row says which it used.

    Versions are committed folders ``masters``/version=<number>.  A batch writes its version down before its
    rows, and takes the one written down when it comes again.  ``quotes`` and ``rejects`` are
    folders per batch.
    """

    def __init__(self, spark: SparkSession, masters: str, root: str):
        self.spark, self.masters, self.root = spark, masters, root

    def write(self, quotes: DataFrame, batch_id: int) -> None:
        noted = committed(self.spark, f"{self.root}/versions", "batch")
        versions = committed(self.spark, self.masters, "version")
        if batch_id in noted:
            version = self.spark.read.parquet(noted[batch_id]).first().version
        else:
            if not versions:
                raise ValueError(f"no master has landed in {self.masters}")
            version = max(versions)
            (self.spark.range(1).select(F.lit(version).cast("long").alias("version")).coalesce(1)
             .write.mode("overwrite").parquet(f"{self.root}/versions/batch={batch_id}"))
        good, bad = enrich_quotes(quotes, self.spark.read.parquet(versions[version]))
        for name, rows in (("quotes", good), ("rejects", bad)):
            (rows.withColumn("master_version", F.lit(version).cast("long"))
             .write.mode("overwrite").parquet(f"{self.root}/{name}/batch={batch_id}"))

    def read(self, name: str = "quotes") -> DataFrame:
        out = None
        for k, folder in sorted(committed(self.spark, f"{self.root}/{name}", "batch").items()):
            df = self.spark.read.parquet(folder).withColumn("batch", F.lit(k).cast("long"))
            out = df if out is None else out.unionByName(df)
        if out is None:
            raise ValueError(f"nothing has been written to {self.root}")
        return out
