"""Helpers shared by the training-data operators.

Text scans run in ``mapInArrow``: a record batch's strings are one UTF-8 buffer,
so words are found and hashed for a whole block of documents at once with numpy,
without a Python object per word.
"""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge.session import checkpoint_root

# Bytes of text handled by one numpy pass inside a task; bounds its scratch memory.
BLOCK_BYTES = 1 << 20

_U64 = np.uint64


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the workers this package, once per application, as ``addPyFile`` does for any library."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    path = Path(tempfile.mkdtemp(prefix="tickforge-py-")) / "tickforge_package.zip"     # the driver serves it
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    sc.addPyFile(str(path))
    _shipped.add(sc.applicationId)


def reliable(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the folder the cluster shares."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


# --------------------------------------------------------------- Arrow text blocks

def blocks(batches: Iterator[pa.RecordBatch], col: str,
           limit: int = BLOCK_BYTES) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Cut record batches into row ranges of about ``limit`` bytes of ``col``.

    Yields the range and its text with NULL replaced by the empty string.  A
    document is never cut, so one longer than ``limit`` is a block by itself.
    """
    for batch in batches:
        if batch.num_rows == 0:
            continue
        text = pc.fill_null(batch.column(col), "")
        sizes = np.cumsum(pc.binary_length(text).to_numpy(zero_copy_only=False).astype(np.int64))
        lo = 0
        while lo < batch.num_rows:
            base = sizes[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(sizes, base + limit, side="right")))
            yield batch.slice(lo, hi - lo), text.slice(lo, hi - lo)
            lo = hi


def utf8(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a null-free string array and the n + 1 offsets into them."""
    n = len(text)
    _, offs, data = text.buffers()
    width = np.int64 if pa.types.is_large_string(text.type) else np.int32
    offsets = np.frombuffer(offs, dtype=width)[text.offset:text.offset + n + 1].astype(np.int64)
    if data is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    raw = np.frombuffer(data, dtype=np.uint8)[offsets[0]:offsets[-1]]
    return raw, offsets - offsets[0]


# --------------------------------------------------------------- words and hashes

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
# Words: digits, lower-cased ASCII letters and every byte of a non-ASCII character.
_IN_WORD = np.zeros(256, dtype=bool)
_IN_WORD[48:58] = _IN_WORD[97:123] = _IN_WORD[128:] = True

_BASE = 0x9E3779B97F4A7C15
_powers: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n (the base is odd, so it has an inverse)."""
    have = _powers.get("up")
    if have is None or len(have) < n:
        size = max(n, BLOCK_BYTES + (1 << 16))
        for name, b in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, b, dtype=_U64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps, dtype=_U64)
    return _powers["up"], _powers["down"]


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and odd multipliers): spreads every input bit."""
    h = (h ^ (h >> _U64(30))) * _U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U64(27))) * _U64(0x94D049BB133111EB)
    return h ^ (h >> _U64(31))


class Words:
    """The words of a block of documents.

    ``low`` the lower-cased bytes, ``start``/``end`` each word's byte range,
    ``first`` (n_docs + 1) the index of each document's first word.
    """

    def __init__(self, text: pa.Array):
        raw, offs = utf8(text)
        self.low = _LOWER[raw]
        inside = _IN_WORD[self.low]
        edge = np.zeros(len(raw) + 1, dtype=bool)      # a document starts here
        edge[offs] = True
        left = np.zeros(len(raw), dtype=bool)
        right = np.zeros(len(raw), dtype=bool)
        if len(raw):
            left[1:] = inside[:-1]
            right[:-1] = inside[1:]
        self.start = np.flatnonzero(inside & (~left | edge[:-1]))
        self.end = np.flatnonzero(inside & (~right | edge[1:])) + 1
        self.first = np.searchsorted(self.start, offs)

    def __len__(self) -> int:
        return len(self.start)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash per word: polynomial prefix sums, then ``mix`` with the length."""
        up, down = _power_tables(len(self.low) + 1)
        prefix = np.zeros(len(self.low) + 1, dtype=_U64)
        np.cumsum((self.low.astype(_U64) + _U64(1)) * up[:len(self.low)], out=prefix[1:])
        body = (prefix[self.end] - prefix[self.start]) * down[self.start]
        return mix(body + (self.end - self.start).astype(_U64) * _U64(0xD6E8FEB86659FD93))

    def owner(self) -> np.ndarray:
        """The document index of every word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def joined(self, lo: int, hi: int) -> str:
        """Words lo..hi-1, separated by one space."""
        low = self.low
        return b" ".join(low[a:b].tobytes() for a, b in
                         zip(self.start[lo:hi], self.end[lo:hi])).decode("utf-8", "replace")


# --------------------------------------------------------------- connected components

def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest reachable index of each of n nodes under the links a[i] - b[i]."""
    label = np.arange(n)
    if not len(a):
        return label
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        while True:
            jumped = new[new]
            if np.array_equal(jumped, new):
                break
            new = jumped
        if np.array_equal(new, label):
            return label
        label = new


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Columns ``node``, ``component`` (smallest id reachable) for every linked node.

    Alternating large-star / small-star rounds over the link table: each round
    groups links by one end, takes the smallest neighbour (partial aggregates, so
    a hub is combined map-side) and points the other neighbours at it, until the
    links no longer change.  Links stay distributed; the driver sees one
    checksum per round.  Every round is a reliable checkpoint, so a lost
    executor costs one round at most.
    """
    edges = reliable(links.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
                     .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    seen = None
    while True:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.where("v > u").join(low, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u")
                 .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                           F.struct(F.col("u").alias("u"), F.col("m").alias("v"))))
                         .alias("e")).select("e.u", "e.v").where("u != v").distinct())
        edges = reliable(small)
        now = edges.agg(F.count(F.lit(1)).alias("n"),
                        F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if seen == (now.n, now.s):
            break
        seen = (now.n, now.s)
    return (edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionAll(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))
