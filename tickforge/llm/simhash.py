"""Operator 8: SimHash near-duplicates by the generalised pigeonhole principle.

A fingerprint has one bit per position, set when more than half of the hashes of
the document's word shingles have it.  Documents link when their fingerprints
differ in at most ``max_bits`` bits.  To find every such pair without comparing
all of them:

1. equal fingerprints collapse to one row (smallest ``doc_id``);
2. bit statistics over all fingerprints give the joint distribution of every bit
   pair; correlated bits are grouped into the same partition, so the other
   partitions stay close to independent and selective;
3. if a pair differs in at most r bits in all, then for any thresholds t_i >= -1
   with sum(t_i + 1) = r + 1 there is a partition i with at most t_i differing
   bits.  Thresholds are allocated by dynamic programming over the estimated
   candidates and emitted rows of every partition and threshold (-1: the
   partition is not probed), for several partition counts; the cheapest wins;
4. a partition probed with threshold t emits one row for every choice of t masked
   bits, so fingerprints within t bits of each other meet in a bucket;
5. buckets are verified by XOR and popcount.  A bucket over ``block`` rows is cut
   into blocks and every pair of blocks is a task's group of its own, so no bucket
   is ever held whole;
6. verified links become components.

Nulls: a NULL text has no words (fingerprint zero); rows with a NULL ``doc_id``
get a fingerprint, link with nothing and have a NULL component.  Rows that share
a ``doc_id`` are separate documents.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickforge.llm.common import blocks, connected_components, forest, reliable, ship
from tickforge.session import staging_dir

BITS = 64
_CHUNK = 1 << 15


def fingerprint_of(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """SimHash of one text as an unsigned 64-bit integer."""
    words = (text or "").encode("utf-8").lower().split()   # bytes: ASCII only, on both counts
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(line, seed)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = len(words) - shingle + 1
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(BITS, np.int64)
    for lo in range(0, n, _CHUNK):      # bounds the unpacked bits of a very long text
        hi = min(n, lo + _CHUNK)
        hashes = np.fromiter((digest(line[a:b], seed) for a, b in
                              zip(starts[lo:hi].tolist(), ends[lo + shingle - 1:hi + shingle - 1].tolist())),
                             np.uint64, hi - lo)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int((np.uint64(1) << np.arange(BITS, dtype=np.uint64))[ones * 2 > n].sum())


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``fp`` (the fingerprint's bits as a signed long), a row per input row."""
    ship(docs.sparkSession)

    def scan(batches):
        for rows, text in blocks(batches, "text"):
            fp = np.fromiter((fingerprint_of(t, shingle) for t in text.to_pylist()), np.uint64, len(text))
            yield pa.RecordBatch.from_arrays([rows.column("doc_id").cast(pa.int64()), pa.array(fp.view(np.int64))],
                                             names=["doc_id", "fp"])

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(scan, "doc_id long, fp long"))


# --------------------------------------------------------------- the plan

def bit_statistics(fps: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints, and the 64 x 64 counts of two bits both set (over all rows)."""
    def count(batches):
        both, n = np.zeros((BITS, BITS), np.int64), 0
        for b in batches:
            v = b.column("fp").to_numpy().view(np.uint64)
            for lo in range(0, len(v), _CHUNK):
                x = np.unpackbits(v[lo:lo + _CHUNK].copy().view(np.uint8).reshape(-1, 8), axis=1,
                                  bitorder="little").astype(np.float32)
                both += (x.T @ x).astype(np.int64)      # exact: counts stay far below 2**24
                n += len(x)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(BITS * BITS + 1)),
                                              pa.array(np.append(both.ravel(), n))], names=["cell", "n"])

    got = fps.select("fp").mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    flat = np.zeros(BITS * BITS + 1, np.int64)
    for r in got.collect():             # 4,097 rows whatever the input
        flat[r.cell] = r.n
    return int(flat[-1]), flat[:-1].reshape(BITS, BITS)


def group_bits(n: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """Partitions of nearly equal width; each grows by the bit most correlated with it."""
    p = both / max(n, 1)
    one = np.diag(p)
    sd = np.sqrt(np.maximum(one * (1 - one), 1e-12))
    corr = np.abs((p - np.outer(one, one)) / np.outer(sd, sd))
    np.fill_diagonal(corr, 0)
    free, out = set(range(BITS)), []
    for k in range(parts):
        width = BITS // parts + (k < BITS % parts)
        left = sorted(free)
        seed = max(left, key=lambda b: (corr[b, left].max(), -b))
        group = [seed]
        free.discard(seed)
        while len(group) < width:
            b = max(sorted(free), key=lambda b: (corr[b, group].max(), -b))
            group.append(b)
            free.discard(b)
        out.append(group)
    return out


def _agreement(n: int, both: np.ndarray, group: list[int]) -> tuple[float, np.ndarray]:
    """Estimated probability that two rows agree on all bits of a group (a chain of
    pairwise joint distributions), and each bit's probability of differing."""
    p = both / max(n, 1)
    one = np.diag(p)
    same = one ** 2 + (1 - one) ** 2
    prob = same[group[0]]
    for i, b in enumerate(group[1:], 1):
        best = 0.0
        for a in group[:i]:
            c = [p[a, b], one[a] - p[a, b], one[b] - p[a, b], 1 - one[a] - one[b] + p[a, b]]
            best = max(best, sum(x * x for x in c) / max(same[a], 1e-12))
        prob *= min(1.0, best)
    return prob, 1 - same[group]


def allocate(n: int, both: np.ndarray, max_bits: int, row_cost: float = 16.0,
             max_masks: int = 128) -> tuple[list[list[int]], list[int]]:
    """The cheapest partitions and thresholds for ``n`` fingerprints.

    The cost of probing a partition with threshold t: ``row_cost`` for every row
    emitted plus one for every pair of rows expected in a bucket.  ``row_cost`` is
    what shuffling a row costs in comparisons.  Thresholds that need more than
    ``max_masks`` masks are not considered; max_bits + 1 partitions probed exactly always remain.
    """
    best = None
    for parts in range(1, max_bits + 3):
        groups = group_bits(n, both, parts)
        costs = []
        for g in groups:
            prob, differ = _agreement(n, both, g)
            odds = differ / np.maximum(1 - differ, 1e-9)
            within = np.zeros(max_bits + 1)             # elementary symmetric sums of the odds
            within[0] = 1.0
            for o in odds:
                within[1:] += within[:-1] * o
            row = [0.0]
            masks = 1
            for t in range(max_bits + 1):
                if t:
                    masks = masks * (len(g) - t + 1) // t
                pairs = n * (n - 1) / 2 * min(1.0, prob * within[:t + 1].sum())
                row.append(row_cost * (n + 1) * masks + pairs * (1 + t) if 0 < masks <= max_masks else np.inf)
            costs.append(row)
        units = max_bits + 1
        table = [(0.0, [])] + [(np.inf, [])] * units    # units spent -> cost, thresholds
        for row in costs:
            new = [(np.inf, [])] * (units + 1)
            for spent, (cost, chosen) in enumerate(table):
                for u in range(units - spent + 1):
                    if cost + row[u] < new[spent + u][0]:
                        new[spent + u] = (cost + row[u], [*chosen, u - 1])
            table = new
        if best is None or table[units][0] < best[0]:
            best = (table[units][0], groups, table[units][1])
    return best[1], best[2]


def probes(groups: list[list[int]], thresholds: list[int]) -> list[int]:
    """The masks to probe: each keeps a partition's bits but for t of them."""
    out = []
    for g, t in zip(groups, thresholds):
        if t >= 0:
            whole = sum(1 << b for b in g)
            out += [whole & ~sum(1 << b for b in drop) for drop in combinations(sorted(g), t)]
    return out


# --------------------------------------------------------------- buckets

def _near(v: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning set of links of one bucket: breadth-first, each row compared with the rows
    not reached yet, so a dense bucket shrinks at once."""
    left = np.arange(len(v))
    a, b = [], []
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            x = queue.pop()
            hit = np.bitwise_count(v[left] ^ v[x]) <= max_bits
            if hit.any():
                got = left[hit]
                a.append(np.full(len(got), x))
                b.append(got)
                queue.extend(got.tolist())
                left = left[~hit]
    none = np.zeros(0, np.int64)
    return (np.concatenate(a), np.concatenate(b)) if a else (none, none)


def _verify(max_bits: int, small: int = 16):
    """Links within the runs of equal ``bucket`` of sorted batches."""
    def links(bucket, fp, rep):
        cut = np.flatnonzero(np.diff(bucket)) + 1
        lo = np.concatenate(([0], cut))
        size = np.diff(np.concatenate((lo, [len(bucket)])))
        at = np.repeat(np.arange(len(lo)), size)
        few = size[at] <= small
        a, b = [], []
        for step in range(1, min(small, int(size.max(initial=0)))):
            i = np.flatnonzero(few[:-step] & (at[:-step] == at[step:]))
            ok = np.bitwise_count(fp[i] ^ fp[i + step]) <= max_bits
            a.append(i[ok])
            b.append(i[ok] + step)
        for k in np.flatnonzero(size > small):
            x, y = _near(fp[lo[k]:lo[k] + size[k]], max_bits)
            a.append(x + lo[k])
            b.append(y + lo[k])
        if not a:
            return None
        a, b = np.concatenate(a), np.concatenate(b)
        if not len(a):
            return None
        ids, inv = np.unique(np.concatenate((rep[a], rep[b])), return_inverse=True)
        low = ids[forest(len(ids), inv[:len(a)], inv[len(a):])]
        keep = ids != low
        return pa.RecordBatch.from_arrays([pa.array(ids[keep]), pa.array(low[keep])], names=["a", "b"])

    def run(batches):
        held = [np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)]
        for batch in batches:
            new = [batch.column("bucket").to_numpy(), batch.column("fp").to_numpy().view(np.uint64),
                   batch.column("rep").to_numpy()]
            held = [np.concatenate(x) for x in zip(held, new)]
            whole = int(np.searchsorted(held[0], held[0][-1])) if len(held[0]) else 0   # the last run may go on
            if whole:
                out = links(*[x[:whole] for x in held])
                held = [x[whole:] for x in held]
                if out is not None:
                    yield out
        if len(held[0]):
            out = links(*held)
            if out is not None:
                yield out

    return run


def simhash_links(distinct: DataFrame, max_bits: int = 3, block: int = 8192) -> DataFrame:
    """Links (a, b) between representatives, enough to connect every pair of distinct
    fingerprints within ``max_bits`` bits.  ``distinct``: ``fp``, ``rep`` (one row per fp)."""
    ship(distinct.sparkSession)
    n, both = bit_statistics(distinct)
    groups, thresholds = allocate(n, both, max_bits)
    masks = probes(groups, thresholds)
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    keys = F.array(*[F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(m).cast("long")))
                     for i, m in enumerate(signed)])
    rows = distinct.select("fp", "rep", F.explode(keys).alias("key"))
    sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    rows = rows.join(sizes, "key").withColumn("g", F.ceil(F.col("n") / block).cast("int"))
    me = F.pmod(F.xxhash64("fp"), F.col("g")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("g") - 1),
                        lambda j: F.xxhash64(F.col("key"), F.least(j, me), F.greatest(j, me)))
    rows = rows.select("fp", "rep", F.explode(F.when(F.col("g") == 1, F.array("key")).otherwise(pairs))
                       .alias("bucket"))
    return (rows.repartition("bucket").sortWithinPartitions("bucket")
            .mapInArrow(_verify(max_bits), "a long, b long").distinct())


def _groups(fps: DataFrame, max_bits: int) -> DataFrame:
    """(fp, rep, component): per distinct fingerprint of rows with an id their smallest id and the
    smallest fingerprint reachable.  Ids may repeat, so fingerprints are the nodes."""
    distinct = reliable(fps.where("doc_id IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("rep")))
    nodes = distinct.select("fp", F.col("fp").alias("rep"))
    comp = connected_components(simhash_links(nodes, max_bits))
    return distinct.join(comp, distinct["fp"] == comp["node"], "left").select(
        "fp", "rep", F.coalesce("component", "fp").alias("component"))


def simhash_dedup(docs: DataFrame, shingle: int = 3, max_bits: int = 3, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id`` for every row of ``docs``.

    Repeated rows give repeated output rows; an empty table gives none.
    """
    fps = reliable(fingerprints(docs, shingle, id_col, text_col))
    joined = _groups(fps, max_bits)
    least = joined.groupBy("component").agg(F.min("rep").alias("component_id"))
    by_fp = joined.join(least, "component").select("fp", "component_id")
    return (fps.join(by_fp, "fp", "left")
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                    F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id")))


def keep_one_per_group(docs: DataFrame, shingle: int = 3, max_bits: int = 3, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each group of linked rows one stays.

    It is the row with the smallest id; among rows that share it the one with the smallest hash
    of text, then of its other columns.  Different texts under one id that do not link all stay, each for its own
    group; rows without an id link with nothing and stay.  Columns of any name are kept.
    """
    folder = staging_dir(docs.sparkSession, "simhash-rows")
    names = docs.columns
    plain = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])
    # Row numbers are written down with the rows, so that a retried task cannot renumber them.
    plain.withColumn("row", F.monotonically_increasing_id()).write.parquet(folder)
    rows = docs.sparkSession.read.parquet(folder)
    doc, text = f"c{names.index(id_col)}", f"c{names.index(text_col)}"
    fps = reliable(_row_fingerprints(rows.where(F.col(doc).isNotNull()), shingle, doc, text))
    by_fp = _groups(fps, max_bits).select("fp", "component")
    order = F.struct("doc_id", "text_hash", "row_hash", "row")
    # Copies are folded per fingerprint before they are joined with its group.
    best = fps.groupBy("fp").agg(F.min(order).alias("o"))
    first = best.join(by_fp, "fp").groupBy("component").agg(F.min("o").alias("o")).select(F.col("o.row").alias("row"))
    kept = rows.join(first, "row", "left_semi").unionByName(rows.where(F.col(doc).isNull()))
    return kept.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)])


def _row_fingerprints(rows: DataFrame, shingle: int, doc: str, text: str) -> DataFrame:
    """(row, doc_id, fp, text_hash, row_hash) of numbered rows."""
    def scan(batches):
        for batch, texts in blocks(batches, "text"):
            fp = np.fromiter((fingerprint_of(t, shingle) for t in texts.to_pylist()), np.uint64, len(texts))
            keep = [batch.column(c) for c in ("row", "doc_id", "text_hash", "row_hash")]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(fp.view(np.int64))], names=["row", "doc_id", "text_hash", "row_hash", "fp"])

    ship(rows.sparkSession)
    every = [F.col(c).cast("string") for c in rows.columns if c not in ("row", text)]
    return (rows.select("row", F.col(doc).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"),
                        F.xxhash64(*every).alias("row_hash"), F.col(text).cast("string").alias("text"))
            .mapInArrow(scan, "row long, doc_id long, text_hash long, row_hash long, fp long"))
