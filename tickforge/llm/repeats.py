"""Operator 11: removal of repeated byte strings by bucket-pointer refinement of sampled suffixes.

Every byte goes that lies in a string of ``length`` bytes which also starts elsewhere, in the same or
another document.  Sorting the suffix of every byte would shuffle many times the input, so only
sampled suffixes are sorted: of the ``width`` strings of q bytes inside a window of ``length`` bytes
(width + q - 1 = length) the one with the least hash, leftmost on ties, is the window's anchor.  It
depends on the window's own bytes alone, so equal windows have equal anchors at equal offsets,
and a window is the pair (anchor, bytes to its left); an anchor serves a run of such pairs.

1. *Initial buckets.*  Anchors are counted by the hash of their q bytes.  A bucket of one holds no
   repeat.  A bitmap of fixed size tells the next scan which buckets hold more; its errors
   only let needless rows through.
2. *Refinement.*  Within its bucket an anchor is told apart by an identifier of the bytes up to the
   outermost offsets of its run (``outer``).  Members with equal identifiers repeat in their
   whole run: resolved.  Tasks fold equal members before the shuffle, so a passage that a
   third of all documents hold is one row per task.
3. *Recursion.*  Of a class of equal members only one goes on, beside all members that are
   alone, if their bucket holds both or several.  Runs are halved: the bytes that all windows of a half
   share make the sub-buckets (``inner``), those up to its ends the identifiers, until a single window is left.
   Buckets of up to ``bucket_rows`` anchors are sorted in a task; larger ones are split by
   the sub-buckets of an eighth of the run with a shuffle, and by single windows after that,
   which are counted like the anchors in step 2, so no bucket has to fit a task.

Identifiers are 64 bits of bucket and 64 bits of content; a sorted bucket compares bytes.

A document is known by its text's hash and length: repeated rows, NULL and repeated ids need no
care, and rows with one text lose the same bytes.  A NULL text is empty.  Texts shorter than
``length`` lose nothing.  An empty table gives no rows.  Columns of the input that have the name of a
returned one are replaced by it; all others are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickforge.llm.common import blocks, mix, ship, utf8
from tickforge.session import staging_dir

#: Window starts handled by one numpy pass.
PASS = 1 << 18
#: Cells of the bitmaps (8 MB).
CELLS = 1 << 26
#: Tasks that the members of one bucket are dealt over when they are joined with it.
_SALTS = 16
#: Anchors folded together in a task before they are passed on.
FOLD = 200_000

_BASE = 0x9E3779B97F4A7C15
_U = np.uint64
_powers: dict[str, np.ndarray] = {}

_STEP = "kind int, tid long, len int, a int, lo int, hi int, inner long, outer long, w int"
_ROW = ["tid", "len", "a", "lo", "hi"]


def shape(length: int) -> tuple[int, int]:
    """(width, q): the sampled strings per window and their bytes; width is a power of two."""
    width = 1 << max(0, (length * 2 // 3).bit_length() - 1)
    return width, length - width + 1


# --------------------------------------------------------------- anchors

def _gram_hashes(raw: np.ndarray, q: int) -> np.ndarray:
    """A hash of the q bytes from every offset."""
    n = len(raw)
    if len(_powers.get("up", ())) < n:
        for name, b in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(max(n, PASS + 1024), b, dtype=_U)
            steps[0] = 1
            _powers[name] = np.cumprod(steps, dtype=_U)
    prefix = np.zeros(n + 1, _U)
    np.cumsum((raw.astype(_U) + _U(1)) * _powers["up"][:n], out=prefix[1:])
    return mix((prefix[q:] - prefix[:-q]) * _powers["down"][:n - q + 1])


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` values in a row: prefix and suffix minima of blocks."""
    n = len(x)
    padded = np.full(-(-n // width) * width, ~_U(0))
    padded[:n] = x
    grid = padded.reshape(-1, width)
    after = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    before = np.minimum.accumulate(grid, axis=1).ravel()
    return np.minimum(after[:n - width + 1], before[width - 1:n])


def anchors(raw: np.ndarray, offs: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(offset, lo, hi, hash of q bytes) of the anchors of all windows inside documents: an anchor
    serves the windows that start lo..hi bytes before it.  A long text is read in passes."""
    width, q = shape(length)
    low_bits = _U((1 << 23) - 1)
    for s in range(0, len(raw) - length + 1, PASS):
        part = raw[s:s + PASS + length - 1]
        h = _gram_hashes(part, q)
        key = (h & ~low_bits) | np.arange(len(h), dtype=_U)
        at = (_sliding_min(key, width) & low_bits).astype(np.int64)
        start = np.arange(len(at))
        # The document of each start must hold the whole window.
        ends = offs[1:][np.searchsorted(offs[1:], start + s, side="right")]
        start = start[start + s + length <= ends]
        if not len(start):
            continue
        a = at[start]
        new = np.concatenate(([True], (a[1:] != a[:-1]) | (start[1:] != start[:-1] + 1)))
        first = np.flatnonzero(new)
        last = np.concatenate((first[1:] - 1, [len(start) - 1]))
        yield a[first] + s, a[first] - start[last], a[first] - start[first], h[a[first]].view(np.int64)


def _bucket_keys(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, text in blocks(batches, "text"):
            for *_, h in anchors(*utf8(text), length):
                key, n = np.unique(h, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(np.minimum(n, 2).astype(np.int32))], ["key", "w"])
    return run


# --------------------------------------------------------------- bitmaps of a fixed size

def _bitmap(keys: DataFrame, col: str) -> np.ndarray:
    """The cells that the keys fall in, as 64-bit words: at most CELLS / 64 rows reach the driver."""
    cell = F.pmod(F.col(col), F.lit(CELLS))
    words = (keys.select(F.shiftright(cell, 6).alias("at"), F.expr(f"shiftleft(1L, cast(pmod({col}, 64) AS int))").alias("bit"))
             .groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow())
    out = np.zeros(CELLS // 64, np.int64)
    out[words.column("at").to_numpy()] = words.column("bits").to_numpy()
    return out


def _marked(words: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = keys & (CELLS - 1)
    return (words[at >> 6] >> (at & 63)) & 1 == 1


# --------------------------------------------------------------- refinement

def _ident(data: bytes, seed: int) -> int:
    x = xxhash.xxh3_64_intdigest(data, seed)
    return x - (1 << 64) if x >> 63 else x


def _merged(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted by start: the union of ranges as separate ranges."""
    reach = np.maximum.accumulate(end)
    new = np.concatenate(([True], start[1:] > reach[:-1]))
    first = np.flatnonzero(new)
    return start[first], reach[np.concatenate((first[1:] - 1, [len(start) - 1]))]


class _Folder:
    """Folds equal members within a task.  Emits kind 0: a member for the shuffle, w = 2 if the task
    met it again; kind 1: ranges [lo, hi) of a text already known to repeat."""

    def __init__(self, length: int):
        self.length, self.cols = length, []
        self.size = 0

    def add(self, *cols: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.cols.append(cols)
        self.size += len(cols[0])
        if self.size > FOLD:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.size:
            return
        tid, size, a, lo, hi, inner, outer = (np.concatenate(c) for c in zip(*self.cols))
        self.cols, self.size = [], 0
        order = np.lexsort((outer, inner))
        o, i = outer[order], inner[order]
        new = np.concatenate(([True], (o[1:] != o[:-1]) | (i[1:] != i[:-1])))
        n = np.diff(np.concatenate((np.flatnonzero(new), [len(new)])))
        pick = order[new]
        yield self._rows(0, tid[pick], size[pick], a[pick], lo[pick], hi[pick], inner[pick], outer[pick], np.minimum(n, 2))
        known = order[np.repeat(n, n) > 1]
        if len(known):
            tid, size, start, end = tid[known], size[known], a[known] - hi[known], a[known] - lo[known] + self.length
            order = np.lexsort((end, start, tid))
            tid, size, start, end = tid[order], size[order], start[order], end[order]
            cut = np.flatnonzero(np.concatenate(([True], tid[1:] != tid[:-1], [True])))
            # Texts side by side on one line, so that ranges of two texts never meet.
            shift = np.repeat(np.arange(len(cut) - 1, dtype=np.int64) << 32, np.diff(cut))
            s, e = _merged(start + shift, end + shift)
            doc = cut[:-1][s >> 32]
            z = np.zeros(len(s), np.int64)
            yield self._rows(1, tid[doc], size[doc], z, s & 0xFFFFFFFF, e & 0xFFFFFFFF, z, z, z)

    @staticmethod
    def _rows(kind, tid, size, a, lo, hi, inner, outer, w) -> pa.RecordBatch:
        ints = [pa.array(np.asarray(x).astype(np.int32)) for x in (size, a, lo, hi)]
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(tid), kind, np.int32)), pa.array(tid), *ints, pa.array(inner), pa.array(outer),
             pa.array(np.asarray(w).astype(np.int32))],
            names=["kind", "tid", "len", "a", "lo", "hi", "inner", "outer", "w"])


def _members(length: int, words):
    """The anchors of marked buckets, with the identifier of their whole run."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks, folder = words.value, _Folder(length)
        for rows, text in blocks(batches, "text"):
            raw, offs = utf8(text)
            tids = rows.column("tid").to_numpy(zero_copy_only=False)
            for at, lo, hi, h in anchors(raw, offs, length):
                here = _marked(marks, h)
                at, lo, hi, h = at[here], lo[here], hi[here], h[here]
                if not len(at):
                    continue
                base = int(at[0] - hi[0])
                data = raw[base:int((at - lo).max()) + length].tobytes()
                outer = np.array([_ident(data[x - r - base:x - l - base + length], l << 20 | r)
                                  for x, l, r in zip(at.tolist(), lo.tolist(), hi.tolist())], np.int64)
                doc = np.searchsorted(offs, at, side="right") - 1
                yield from folder.add(tids[doc], (offs[doc + 1] - offs[doc]), at - offs[doc], lo, hi, h, outer)
        yield from folder.flush()
    return run


def _resolve(members: DataFrame) -> DataFrame:
    """``n``: how many equal members a member has, itself included (2 stands for more);
    ``first``: whether it stands for them in the next round."""
    same = Window.partitionBy("inner", "outer")
    return members.select(*_ROW, "inner", F.sum("w").over(same).alias("n"),
                          (F.row_number().over(same.orderBy("tid", "a", "lo")) == 1).alias("first"))


def _chosen_texts(words):
    """Texts whose documents hold marked anchors; copies that a task meets again are left out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks, seen = words.value, set()
        for batch in batches:
            tids = batch.column("tid").to_numpy(zero_copy_only=False)
            keep = []
            for i in np.flatnonzero(_marked(marks, tids)).tolist():
                if tids[i] not in seen:
                    if len(seen) > 1_000_000:
                        seen.clear()
                    seen.add(tids[i])
                    keep.append(i)
            if keep:
                yield batch.take(pa.array(keep))
    return run


def _lists(column: pa.Array) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Offsets and fields of a column of lists of structs without NULL structs, as arrays."""
    offs = column.offsets.to_numpy()
    flat = column.values.slice(offs[0], offs[-1] - offs[0])
    return offs - offs[0], {f.name: flat.field(f.name).to_numpy(zero_copy_only=False) for f in flat.type}


def _contexts(length: int):
    """The bytes of every chosen anchor's run, cut from its text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, text in blocks(batches, "text"):
            raw, offs = utf8(text)
            cuts, node = _lists(rows.column("nodes"))
            of = np.repeat(np.arange(len(text)), np.diff(cuts))
            start = offs[of] + node["a"] - node["hi"]
            end = offs[of] + node["a"] - node["lo"] + length
            ctx = [raw[x:y].tobytes() for x, y in zip(start.tolist(), end.tolist())]
            tids = rows.column("tid").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [pa.array(tids[of]), pa.array((offs[of + 1] - offs[of]).astype(np.int32)),
                 *(pa.array(node[c]) for c in ("inner", "m", "a", "lo", "hi")), pa.array(ctx, pa.binary())],
                names=["tid", "len", "inner", "m", "a", "lo", "hi", "ctx"])
    return run


def _slice(node: tuple, lo: int, hi: int, length: int) -> bytes:
    """The bytes from ``lo`` before the anchor to the end of the window that starts ``hi`` before it."""
    _, ctx, left, *_ = node
    return ctx[left - lo:left - hi + length]


def _refine(nodes: list[tuple], lo: int, hi: int, length: int, found: list) -> None:
    """Sort a bucket by the bytes that all windows lo..hi share, then each part by their outermost bytes;
    what stays alone goes on in the halves of the run.  A node is (number, context, left, lo, hi)."""
    nodes = [x for x in nodes if x[3] <= hi and x[4] >= lo]
    buckets: dict[bytes, list] = {}
    for x in nodes:
        buckets.setdefault(_slice(x, lo, hi, length), []).append(x)
    for bucket in buckets.values():
        if len(bucket) < 2:
            continue
        classes: dict[tuple, list] = {}
        for x in bucket:
            l, r = max(lo, x[3]), min(hi, x[4])
            classes.setdefault((l, r, _slice(x, r, l, length)), []).append(x)
        for (l, r, _), same in classes.items():
            if len(same) > 1:
                found.extend((x[0], l, r) for x in same)
        if lo < hi and len(classes) > 1:
            rest = [same[0] for same in classes.values()]
            mid = (lo + hi + 1) // 2
            _refine(rest, lo, mid - 1, length, found)
            _refine(rest, mid, hi, length, found)


def _sorted_buckets(length: int, width: int):
    """Rows sorted by bucket, each refined to the end when its last row has come."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, nodes, meta = None, [], []

        def flush():
            found: list = []
            if len(nodes) > 1:
                base = min(x[3] for x in nodes) // width * width
                _refine(nodes, base, base + width - 1, length, found)
            if not found:
                return
            at, lo, hi = (np.array(c, np.int64) for c in zip(*found))
            tid, size, a = (np.array(c, np.int64)[at] for c in zip(*meta))
            yield pa.RecordBatch.from_arrays(
                [pa.array(tid), *(pa.array(c.astype(np.int32)) for c in (size, a - hi, a - lo + length))],
                names=["tid", "len", "lo", "hi"])

        for batch in batches:
            for inner, tid, size, a, lo, hi, ctx in zip(*(batch.column(c).to_pylist() for c in (
                    "inner", "tid", "len", "a", "lo", "hi", "ctx"))):
                if inner != last:
                    yield from flush()
                    last, nodes, meta = inner, [], []
                nodes.append((len(nodes), ctx, hi, lo, hi))
                meta.append((tid, size, a))
        yield from flush()
    return run


def _split(length: int, width: int):
    """Anchors of large buckets cut into runs of ``width`` windows, each with its sub-bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list = [[] for _ in range(7)]
            for inner, tid, size, a, lo, hi, ctx in zip(*(batch.column(c).to_pylist() for c in (
                    "inner", "tid", "len", "a", "lo", "hi", "ctx"))):
                node = (0, ctx, hi, lo, hi)
                for base in range(lo // width * width, hi + 1, width):
                    l, r = max(lo, base), min(hi, base + width - 1)
                    sub = _ident(_slice(node, base, base + width - 1, length), (inner + base) & 0xFFFFFFFF)
                    for c, v in zip(out, (sub, tid, size, a, l, r, _slice(node, r, l, length))):
                        c.append(v)
            types = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)],
                                             names=["inner", "tid", "len", "a", "lo", "hi", "ctx"])
    return run


def _windows(length: int):
    """Single windows of anchors whose buckets are still large, as members for ``_resolve``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        folder = _Folder(length)
        for batch in batches:
            for inner, tid, size, a, lo, hi, ctx in zip(*(batch.column(c).to_pylist() for c in (
                    "inner", "tid", "len", "a", "lo", "hi", "ctx"))):
                r = np.arange(lo, hi + 1, dtype=np.int64)
                ids = np.array([xxhash.xxh3_128_digest(ctx[hi - k:hi - k + length], k) for k in r.tolist()], "S16")
                pair = np.frombuffer(ids.tobytes(), np.int64).reshape(-1, 2)
                same = np.full(len(r), 1, np.int64)
                yield from folder.add(same * tid, same * size, same * a, r, r, pair[:, 0].copy(), pair[:, 1].copy())
        yield from folder.flush()
    return run


def _salted(members: DataFrame, buckets: DataFrame) -> DataFrame:
    """Members joined with their bucket's row; a bucket with many is dealt over several tasks."""
    salt = F.pmod(F.xxhash64("tid", "a"), F.lit(_SALTS)).cast("int")
    every = buckets.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
    # One key of both, so that neither side can be dealt out by the bucket alone.
    key = F.struct("inner", "salt").alias("key")
    return (members.withColumn("salt", salt).select(*members.columns, key)
            .join(every.select(key, *[c for c in buckets.columns if c != "inner"]), "key").drop("key"))


_NODE = "inner long, tid long, len int, a int, lo int, hi int, ctx binary"
_RANGE = "tid long, len int, lo int, hi int"


def repeated_ranges(docs: DataFrame, length: int = 200, text_col: str = "text", bucket_rows: int = 2000) -> DataFrame:
    """(tid, len, ranges): per distinct text the byte ranges that lie in repeated strings; ``tid``
    is the text's ``xxhash64`` and ``len`` its bytes."""
    spark = docs.sparkSession
    ship(spark)
    base = staging_dir(spark, "repeats")

    def stored(df, name):
        df.write.parquet(f"{base}/{name}")
        return spark.read.parquet(f"{base}/{name}")

    def marks(df, col):
        return spark.sparkContext.broadcast(_bitmap(df, col))
    texts = keyed(docs, text_col).select("tid", "len", F.col("__text").alias("text")).where(F.col("len") >= length)
    width, _ = shape(length)

    # 1. Initial buckets of at least two anchors.
    keys = texts.select("tid", "text").mapInArrow(_bucket_keys(length), "key long, w int")
    repeated = keys.groupBy("key").agg(F.sum("w").alias("w")).where("w > 1")
    # 2. Members of these, by the identifier of their run.
    members = stored(texts.select("tid", "text").mapInArrow(_members(length, marks(repeated, "key")), _STEP), "members")
    ranges = [members.where("kind = 1").select("tid", "len", "lo", "hi")]

    def resolved(df):
        return df.where("n > 1").select("tid", "len", (F.col("a") - F.col("hi")).alias("lo"),
                                        (F.col("a") - F.col("lo") + length).alias("hi"))
    met = stored(_resolve(members.where("kind = 0")), "met")
    ranges.append(resolved(met))
    # 3. What is left of buckets with several classes, one anchor per class.
    classes = met.where("first")
    mixed = (classes.groupBy("inner").agg(F.count(F.lit(1)).alias("m"), F.min("n").alias("least"))
             .where("m > 1 AND least = 1").select("inner", "m"))
    nodes = stored(_salted(classes, mixed).groupBy("tid", "len")
                   .agg(F.collect_list(F.struct("inner", "m", "a", "lo", "hi")).alias("nodes")), "nodes")
    chosen = texts.mapInArrow(_chosen_texts(marks(nodes, "tid")), "tid long, len int, text string")
    left = stored(chosen.join(nodes, ["tid", "len"])
                  .mapInArrow(_contexts(length), "tid long, len int, inner long, m long, a int, lo int, hi int, ctx binary"),
                  "contexts")
    step = width
    while True:
        few = left.where(F.col("m") <= bucket_rows).drop("m").repartition("inner").sortWithinPartitions("inner")
        ranges.append(few.mapInArrow(_sorted_buckets(length, step), _RANGE))
        many = left.where(F.col("m") > bucket_rows).drop("m")
        if step == width and width >= 16 and not many.isEmpty():
            step = width // 8
            sub = stored(many.mapInArrow(_split(length, step), _NODE), "split")
            sizes = sub.groupBy("inner").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
            left = stored(_salted(sub, sizes), "parts")
            continue
        break
    single = stored(many.mapInArrow(_windows(length), _STEP), "windows")
    ranges += [single.where("kind = 1").select("tid", "len", "lo", "hi"), resolved(_resolve(single.where("kind = 0")))]
    whole = ranges[0]
    for r in ranges[1:]:
        whole = whole.unionByName(r)
    # Copies of a text give the same ranges: once each, then they are at most the text's own.
    return stored(whole.distinct().groupBy("tid", "len").agg(F.collect_list(F.struct("lo", "hi")).alias("ranges")), "ranges")


def keyed(docs: DataFrame, text_col: str) -> DataFrame:
    """``docs`` with its text made whole, and the text's key."""
    text = docs.withColumn("__text", F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    return text.withColumn("tid", F.xxhash64("__text")).withColumn("len", F.octet_length("__text"))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, text in blocks(batches, "__text"):
        raw, offs = utf8(text)
        cuts, ranges = _lists(pc.fill_null(rows.column("ranges"), []))
        kept, removed, spans = [], [], []
        for i in range(len(text)):
            part = raw[offs[i]:offs[i + 1]]
            lo, hi = (ranges[c][cuts[i]:cuts[i + 1]].astype(np.int64) for c in ("lo", "hi"))
            if not len(lo):
                kept.append(part.tobytes())
                removed.append(0)
                spans.append(0)
                continue
            order = np.lexsort((hi, lo))
            s, e = _merged(lo[order], hi[order])
            edges = np.concatenate(([0], np.column_stack((s, e)).ravel(), [len(part)])).reshape(-1, 2)
            kept.append(b"".join(part[x:y].tobytes() for x, y in edges.tolist()))
            removed.append(int((e - s).sum()))
            spans.append(len(s))
        names = [c for c in rows.schema.names if c not in ("__text", "ranges")]
        yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in names), pa.array(kept, pa.binary()), pa.array(removed, pa.int64()),
                                          pa.array(spans, pa.int64())], names=[*names, "kept", "n_removed", "n_spans"])


def remove_repeats(docs: DataFrame, length: int = 200, text_col: str = "text", bucket_rows: int = 2000) -> DataFrame:
    """``docs`` with ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept``, the bytes that remain (BINARY,
    since a cut may fall inside a character)."""
    if length < 4:
        raise ValueError("repeated strings must be at least 4 bytes long")
    ranges = repeated_ranges(docs, length, text_col, bucket_rows)
    own = ["n_bytes", "n_removed", "n_spans", "kept"]
    rest = [c for c in docs.columns if c not in own]
    rows = keyed(docs.select(*(F.col(f"`{c}`").alias(f"__{i}") for i, c in enumerate(rest))), f"__{rest.index(text_col)}")
    met = rows.join(ranges, ["tid", "len"], "left").withColumn("n_bytes", F.col("len").cast("long")).drop("tid", "len")
    kept = [c for c in met.columns if c not in ("__text", "ranges")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in met.select(*kept).schema)
    cut = met.mapInArrow(_cut, f"{schema}, kept binary, n_removed long, n_spans long")
    return cut.select(*(F.col(f"__{i}").alias(c) for i, c in enumerate(rest)), *own)
