"""Operator 2: reversible line dedup with sharded cuckoo filters over exact reference counts.

State, as Parquet tables under one folder of the shared storage.  A change writes what it adds and
returns a new index that names the parts; nothing written before is rewritten, so an index stays as it was:

* ``refs``: (key, doc_id), one row per document that holds a line key: a part per insert, and the ids
  deleted since;
* ``counts``: (shard, key, n_refs, first_doc, last_doc), the exact reference counts: a part of new keys and
  a part of changed keys per change (the later part holds; 0 references: gone), merged into one now and then;
* ``filters``: one cuckoo filter per shard, holding the keys of that shard's counts.

Inserting documents: their distinct (key, doc_id) references are counted per key, so a
line that a third of the documents hold is one row before it meets the filters.  Each shard
probes its filter: a key the filter does not know is proven new and goes to the
counts without a lookup; only the others are joined with the stored counts.
Deleting documents: their references are taken out, counts fall, keys that reach zero leave
filter and counts -- cuckoo filters can delete, Bloom filters cannot -- and the
smallest holder is found again from ``refs``.  So insert followed by delete gives back the
earlier answers.

A key is the line with white space (``[\\x20\\x09-\\x0D]``) stripped and A-Z lower-cased, by its
128-bit digest.  Keys shorter than ``min_chars`` are no keys.  Keys of at least two documents
are dropped from all but the smallest ``doc_id`` that holds them.

Nulls: a NULL or empty text is one empty line; rows with a NULL ``doc_id`` hold no
references and keep all lines.  Rows sharing a ``doc_id`` are one document in the counts
and keep or lose lines alike; they belong in one insert.
"""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge.llm.common import ship
from tickforge.operators.joins import broadcast_if_small
from tickforge.session import staging_dir

_BLANK = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    return F.translate(F.trim(line, F.lit(_BLANK)), _UPPER, _LOWER)


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text.cast("string"), F.lit("")), "\n", -1)


def _digest(key: Column) -> Column:
    return F.unhex(F.md5(key))


def references(docs: DataFrame, min_chars: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key, doc_id): the distinct keys of every document, without a shuffle."""
    keys = F.array_distinct(F.filter(F.transform(_lines(F.col(text_col)), line_key),
                                     lambda k: F.length(k) >= min_chars))
    line = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("doc_id"), F.explode(keys).alias("k"))
    return line.select(_digest(F.col("k")).alias("key"), "doc_id")


# --------------------------------------------------------------- cuckoo filter

class CuckooFilter:
    """16-bit fingerprints in buckets of four; a key lives in one of two buckets.

    All operations take arrays of 64-bit key hashes.  Inserts place whole arrays round by
    round and move a victim where both buckets are full; a filter that cannot
    place a key doubles and is filled again from the exact keys (``rebuild``).
    """

    SLOTS = 4

    def __init__(self, table: np.ndarray):
        self.table = table                      # (buckets, SLOTS) uint16, 0 = free

    @classmethod
    def sized(cls, keys: int) -> CuckooFilter:
        buckets = 1 << max(4, int(np.ceil(np.log2(max(1, keys) / (cls.SLOTS * 0.8)))))
        return cls(np.zeros((buckets, cls.SLOTS), np.uint16))

    @classmethod
    def load(cls, data: bytes) -> CuckooFilter:
        return cls(np.frombuffer(data, np.uint16).reshape(-1, cls.SLOTS).copy())

    def dump(self) -> bytes:
        return self.table.tobytes()

    def _place(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        mark = ((h >> np.uint64(48)).astype(np.uint16)) | np.uint16(1)
        return mark, (h & np.uint64(len(self.table) - 1)).astype(np.int64)

    def _other(self, bucket: np.ndarray, mark: np.ndarray) -> np.ndarray:
        return (bucket ^ (mark.astype(np.int64) * 0x5BD1E995)) & (len(self.table) - 1)

    def has(self, h: np.ndarray) -> np.ndarray:
        mark, b = self._place(h)
        return ((self.table[b] == mark[:, None]).any(1)
                | (self.table[self._other(b, mark)] == mark[:, None]).any(1))

    def add(self, h: np.ndarray, rounds: int = 500) -> bool:
        """False if some key found no place; the caller then rebuilds a larger filter."""
        mark, b = self._place(h)
        side = np.random.default_rng(len(h))
        for turn in range(rounds):
            if not len(mark):
                return True
            # One key per bucket and round, so that no two write the same slot.
            _, pick = np.unique(b, return_index=True)
            m, at = mark[pick], b[pick]
            row = self.table[at]
            slot = np.argmax(row == 0, axis=1)
            free = row[np.arange(len(at)), slot] == 0
            if turn >= 2:                       # both buckets are full: move a victim on
                slot = np.where(free, slot, side.integers(0, self.SLOTS, len(at)))
                free_or_moved = np.ones(len(at), bool)
            else:
                free_or_moved = free
            victim = row[np.arange(len(at)), slot]
            self.table[at[free_or_moved], slot[free_or_moved]] = m[free_or_moved]
            wait = np.ones(len(mark), bool)
            wait[pick] = False
            moved = free_or_moved & ~free
            again = ~free_or_moved
            mark, b = (np.concatenate((mark[wait], victim[moved], m[again])),
                       np.concatenate((b[wait], self._other(at[moved], victim[moved]),
                                       self._other(at[again], m[again]))))
        return not len(mark)

    def remove(self, h: np.ndarray) -> None:
        mark, b = self._place(h)
        for m, at in zip(mark.tolist(), b.tolist()):
            for x in (at, int(self._other(np.array([at]), np.array([m], np.uint16))[0])):
                hit = np.flatnonzero(self.table[x] == m)
                if len(hit):
                    self.table[x, hit[0]] = 0
                    break


def _filled(h: np.ndarray) -> CuckooFilter:
    size = len(h)
    while True:
        f = CuckooFilter.sized(size)
        if f.add(h):
            return f
        size *= 2


def _hash64(keys: pa.Array) -> np.ndarray:
    """The first eight bytes of each digest; the shard number comes from other bytes."""
    raw = np.frombuffer(b"".join(keys.to_pylist()), dtype=">u8").reshape(-1, 2)
    return raw[:, 0].astype(np.uint64)


def _shard(key: Column, shards: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(shards)).cast("int")


def _update_shard(key, left: pa.Table, right: pa.Table) -> pa.Table:
    """One shard's changed keys against its filter: which it may know, and the filter afterwards.
    ``gone`` keys leave the filter first; ``sure`` keys are known to be new and are added unasked."""
    stored = [x for x in right.column("filter").to_pylist() if x is not None]
    keys = left.column("key").combine_chunks()
    gone = left.column("gone").to_numpy().astype(bool)
    sure = left.column("sure").to_numpy().astype(bool)
    h = _hash64(keys) if len(keys) else np.zeros(0, np.uint64)
    held = right.column("keys").to_pylist()[0] if len(stored) else 0
    f = CuckooFilter.load(stored[0]) if stored else CuckooFilter.sized(int((~gone).sum()))
    f.remove(h[gone])
    known = f.has(h) & ~gone & ~sure if stored else np.zeros(len(h), bool)
    fresh = h[~known & ~gone]
    full = held + len(fresh) > 0.9 * f.table.size or not f.add(fresh)
    out = left.select(["shard", "key", "n_refs", "first_doc", "last_doc"]).append_column("known", pa.array(known))
    end = pa.table({
        "shard": pa.array([key[0].as_py()], pa.int32()),
        # A full filter is dropped here and filled again from the exact keys.
        "filter": pa.array([b"" if full else f.dump()], pa.binary()),
        "keys": pa.array([held + len(fresh) - int(gone.sum())], pa.int64())})
    whole = pa.concat_tables([out, end], promote_options="default")
    return whole.select(["shard", "key", "n_refs", "first_doc", "last_doc", "known", "filter", "keys"]).cast(pa.schema([
        ("shard", pa.int32()), ("key", pa.binary()), ("n_refs", pa.int64()), ("first_doc", out.schema.field("first_doc").type),
        ("last_doc", out.schema.field("last_doc").type), ("known", pa.bool_()), ("filter", pa.binary()), ("keys", pa.int64())]))


def _fill_shard(t: pa.Table) -> pa.Table:
    return pa.table({"shard": t.column("shard").slice(0, 1),
                     "filter": pa.array([_filled(_hash64(t.column("key").combine_chunks())).dump()], pa.binary()),
                     "keys": pa.array([t.num_rows], pa.int64())})


def _fill(counts: DataFrame) -> DataFrame:
    """Filters made from exact counts."""
    return (counts.select("shard", "key").groupBy("shard")
            .applyInArrow(_fill_shard, "shard int, filter binary, keys long"))


def _per_key(refs: DataFrame) -> DataFrame:
    """Exact counts; a key is in at least two documents when its first and last holder differ."""
    return refs.groupBy("key").agg(F.count(F.lit(1)).alias("n_refs"), F.min("doc_id").alias("first_doc"),
                                   F.max("doc_id").alias("last_doc"))


_COUNTS = ["shard", "key", "n_refs", "first_doc", "last_doc"]


def _without(text: pd.Series, drop: pd.Series) -> pd.DataFrame:
    kept, dropped = [], []
    for t, keys in zip(text, drop):
        n = 0
        if keys is not None and len(keys):
            gone = set(keys)
            lines = t.split("\n")
            rest = [x for x in lines if hashlib.md5(x.encode("utf-8").strip(b" \t\n\x0b\x0c\r").lower()).digest()
                    not in gone]
            n = len(lines) - len(rest)
            t = "\n".join(rest)
        kept.append(t)
        dropped.append(n)
    return pd.DataFrame({"text": kept, "n": dropped})


@dataclass(frozen=True)
class LineIndex:
    """The line index in ``folder``: the parts that make it.  Every change returns a new index."""

    spark: SparkSession
    folder: str
    min_chars: int = 10
    shards: int = 0
    #: A folder per insert.
    ref_parts: tuple[str, ...] = ()
    #: (folder of deleted ids, how many of ``ref_parts`` they were deleted from).
    gone: tuple[tuple[str, int], ...] = ()
    #: (folder, "all", "new": its keys are in no earlier part, "over": it replaces earlier rows).
    count_parts: tuple[tuple[str, str], ...] = ()
    filter_part: str = ""

    #: Count parts that are read together before they are merged into one.
    MERGE = 12

    @classmethod
    def create(cls, spark: SparkSession, folder: str | None = None, min_chars: int = 10) -> LineIndex:
        return cls(spark, folder or staging_dir(spark, "lines"), min_chars)

    def _store(self, df: DataFrame, name: str) -> str:
        path = f"{self.folder}/{name}-{uuid.uuid4().hex[:12]}"
        df.write.parquet(path)
        return path

    def _load(self, path: str) -> DataFrame:
        return self.spark.read.parquet(path)

    @property
    def counts(self) -> DataFrame:
        rows = None
        for path, kind in self.count_parts:
            df = self._load(path)
            part = df.where("key IS NOT NULL AND NOT known").select(*_COUNTS) if kind == "new" else df.select(*_COUNTS)
            if rows is not None:
                if kind == "over":
                    rows = rows.join(broadcast_if_small(part.select("key")), "key", "left_anti").select(*_COUNTS)
                part = rows.unionByName(part)
            rows = part
        return rows.where("n_refs > 0")

    @property
    def filters(self) -> DataFrame:
        return self._load(self.filter_part).where("filter IS NOT NULL").select("shard", "filter", "keys")

    @property
    def refs(self) -> DataFrame:
        out = None
        for i, path in enumerate(self.ref_parts):
            part = self._load(path)
            for ids, upto in self.gone:
                if i < upto:
                    part = part.join(broadcast_if_small(self._load(ids)), "doc_id", "left_anti").select("key", "doc_id")
            out = part if out is None else out.unionByName(part)
        return out

    def _probe(self, keys: DataFrame, gone: bool = False, sure: bool = False) -> str:
        ids = dict(keys.dtypes)["first_doc"]
        keys = keys.select(*_COUNTS, F.lit(gone).alias("gone"), F.lit(sure).alias("sure"))
        out = keys.groupBy("shard").cogroup(self.filters.groupBy("shard")).applyInArrow(
            _update_shard, f"shard int, key binary, n_refs long, first_doc {ids}, last_doc {ids}, known boolean, "
                           "filter binary, keys long")
        return self._store(out, "probe")

    def _refilled(self, probed: DataFrame, counts: DataFrame) -> str:
        """The filters after a change; full ones are filled again from the exact counts, others stay."""
        changed = probed.where("key IS NULL").select("shard", "filter", "keys")
        full = changed.where(F.length("filter") == 0).select("shard")
        fresh = _fill(counts.join(full, "shard", "left_semi"))
        same = self.filters.join(changed.select("shard"), "shard", "left_anti").select("shard", "filter", "keys")
        return self._store(changed.where(F.length("filter") > 0).unionAll(fresh).unionAll(same), "filters")

    def _merged(self) -> LineIndex:
        if len(self.count_parts) <= self.MERGE:
            return self
        return replace(self, count_parts=((self._store(self.counts, "counts"), "all"),))

    def insert(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               keys_per_shard: int = 200_000) -> LineIndex:
        """Add documents (ids not in the index, or deleted from it).  Shards are numbered so that a shard's
        keys fit a task; an index that has outgrown its shards twice over is cut anew."""
        ship(self.spark)
        refs = self._store(references(docs, self.min_chars, id_col, text_col), "refs")
        batch = _per_key(self._load(refs))
        grown = replace(self, ref_parts=(*self.ref_parts, refs))
        if not self.shards:
            # Their number is an estimate, and the size of a shard no more than a guide.
            n = self._load(refs).agg(F.approx_count_distinct("key")).first()[0]
            shards = max(1, -(-n // keys_per_shard))
            counts = self._store(batch.withColumn("shard", _shard(F.col("key"), shards)).select(*_COUNTS), "counts")
            return replace(grown, shards=shards, count_parts=((counts, "all"),), filter_part=self._store(_fill(self._load(counts)), "filters"))
        path = self._probe(batch.withColumn("shard", _shard(F.col("key"), self.shards)))
        probed = self._load(path)
        old = self.counts.select("key", *[F.col(c).alias(f"o_{c}") for c in _COUNTS[2:]])
        again = probed.where("known").join(old, "key", "left")
        # Keys that the filter took for others' are new as well: they have no old row.
        changed = again.select(
            "shard", "key", (F.col("n_refs") + F.coalesce("o_n_refs", F.lit(0).cast("long"))).alias("n_refs"),
            F.least("first_doc", "o_first_doc").alias("first_doc"), F.greatest("last_doc", "o_last_doc").alias("last_doc"),
            F.col("o_n_refs").isNull().alias("missed"))
        over = self._store(changed, "counts")
        grown = replace(grown, count_parts=(*self.count_parts, (path, "new"), (over, "over")))
        grown = replace(grown, filter_part=grown._refilled(probed, grown.counts))
        # They must enter the filter, or deleting those others would make it forget them.
        full = probed.where("key IS NULL").where(F.length("filter") == 0).select("shard")
        missed = self._load(over).where("missed").select(*_COUNTS).join(full, "shard", "left_anti")
        if not missed.isEmpty():
            grown = replace(grown, filter_part=grown._refilled(self._load(grown._probe(missed, sure=True)), grown.counts))
        grown = grown._merged()
        held = grown.filters.agg(F.sum("keys")).first()[0] or 0
        if held > 2 * keys_per_shard * self.shards:
            shards = -(-held // keys_per_shard)
            counts = self._store(grown.counts.withColumn("shard", _shard(F.col("key"), shards)).select(*_COUNTS), "counts")
            grown = replace(grown, shards=shards, count_parts=((counts, "all"),), filter_part=self._store(_fill(self._load(counts)), "filters"))
        return grown

    def delete(self, ids: DataFrame, id_col: str = "doc_id") -> LineIndex:
        """Take documents out again by their ids."""
        ship(self.spark)
        gone = self._store(ids.select(F.col(id_col).alias("doc_id")).where("doc_id IS NOT NULL").distinct(), "gone")
        mine = broadcast_if_small(self._load(gone))
        touched = self._load(self._store(self.refs.join(mine, "doc_id", "left_semi").select("key").distinct(), "touched"))
        left = replace(self, gone=(*self.gone, (gone, len(self.ref_parts))))
        now = _per_key(left.refs.join(broadcast_if_small(touched), "key", "left_semi"))
        over = touched.join(now, "key", "left").select(
            _shard(F.col("key"), self.shards).alias("shard"), "key", F.coalesce("n_refs", F.lit(0).cast("long")).alias("n_refs"),
            "first_doc", "last_doc")
        left = replace(left, count_parts=(*self.count_parts, (self._store(over, "counts"), "over")))
        dead = self._load(left.count_parts[-1][0]).where("n_refs = 0")
        return replace(left, filter_part=left._refilled(self._load(left._probe(dead, gone=True)), left.counts))._merged()

    def dedup(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              counts: bool = True) -> DataFrame:
        """``docs`` with ``text`` without its dropped lines and, with ``counts``, two more columns:
        ``n_lines`` (before dropping) and ``n_dropped``, in place of columns of these names."""
        ship(self.spark)
        repeated = self.counts.where("first_doc <> last_doc").select("key", "first_doc")
        drop = (references(docs, self.min_chars, id_col, text_col).join(repeated, "key")
                .where("doc_id <> first_doc")
                .groupBy(F.col("doc_id").alias("__line_doc")).agg(F.collect_set("key").alias("__line_keys")))
        text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
        strip = F.pandas_udf(_without, "text string, n long")
        cut = (docs.join(drop, F.col(id_col) == F.col("__line_doc"), "left")
               .withColumn("__line_cut", strip(text, "__line_keys")))
        n_lines = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1
        out = [F.col("__line_cut.text").alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns
               if not (counts and c in ("n_lines", "n_dropped"))]
        more = [n_lines.cast("long").alias("n_lines"), F.col("__line_cut.n").alias("n_dropped")]
        return cut.select(*out, *(more if counts else []))
