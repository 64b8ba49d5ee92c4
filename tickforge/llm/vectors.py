"""Operator 10: embedding near-duplicates through an inverted multi-index.

Vectors are cut in two halves, each half has its own codebook (k-means on a bounded sample), and
the product of the codebooks is a grid of cells.  Every vector is filed in one cell.  To find a
vector's neighbours the cells are visited in the order of the multi-sequence algorithm --
increasing sum of the two halves' distances, from two sorted lists and a heap -- and
the visit ends at the target recall: as many cells as it takes for ``recall`` of the trial
pairs to be met from either side.  The trial pairs are real: sample vectors with their exact
neighbours among all vectors, and sample vectors moved towards their nearest one to exactly the
threshold's cosine.  Everything met is verified by its cosine in double precision.

1. equal vectors collapse to one row with a weight and the smallest id;
2. codebooks are fitted on a bounded sample, the number of visits on the links that a bounded
   number of sample vectors have among all vectors; all vectors are indexed;
3. every vector is a resident of its own cell and a probe of the other visited cells;
4. a cell's residents and probes are cut into blocks of about ``block`` rows; every pair of resident
   blocks, and of a resident and a probe block, is a group of its own, so no cell is held whole;
5. links are counted and reduced to a spanning forest within each group, so that the pairs of
   a large group of near copies never leave the task; components follow.

A pair is judged in the cell of either vector; where both would find it, only the smaller id's
cell counts it.

Nulls: vectors that are NULL, zero, or hold NULL or non-finite components link with nothing and are
their own component.  Vectors of different lengths do not link.  Rows that share a ``vec_id``
are separate vectors in ``n_links``; a NULL id is never the smallest of its component.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickforge.llm.common import connected_components, forest, mix, reliable, ship


# --------------------------------------------------------------- codebooks

def kmeans(x: np.ndarray, k: int, rounds: int = 12, seed: int = 7) -> np.ndarray:
    """At most k centres of the rows of ``x``."""
    rng = np.random.default_rng(seed)
    centres = x[rng.permutation(len(x))[:k]].copy()
    for _ in range(rounds):
        near = (centres ** 2).sum(1) - 2 * x @ centres.T
        at = near.argmin(1)
        n = np.bincount(at, minlength=len(centres))
        for d in range(x.shape[1]):
            total = np.bincount(at, weights=x[:, d], minlength=len(centres))
            centres[n > 0, d] = total[n > 0] / n[n > 0]
    return centres


def multi_sequence(d1: np.ndarray, d2: np.ndarray, visits: int) -> list[tuple[int, int]]:
    """The first ``visits`` cells of the grid by increasing d1[i] + d2[j]."""
    o1, o2 = np.argsort(d1, kind="stable"), np.argsort(d2, kind="stable")
    a, b = d1[o1].tolist(), d2[o2].tolist()
    heap, pushed, out = [(a[0] + b[0], 0, 0)], {(0, 0)}, []
    while heap and len(out) < visits:
        _, i, j = heapq.heappop(heap)
        out.append((int(o1[i]), int(o2[j])))
        for x, y in ((i + 1, j), (i, j + 1)):
            if x < len(a) and y < len(b) and (x, y) not in pushed:
                pushed.add((x, y))
                heapq.heappush(heap, (a[x] + b[y], x, y))
    return out


class Grid:
    """Two codebooks and how many cells a query visits."""

    def __init__(self, one: np.ndarray, two: np.ndarray, visits: int = 1):
        self.one, self.two, self.visits = one, two, visits

    def distances(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h = self.one.shape[1]
        return (((self.one ** 2).sum(1) - 2 * x[:, :h] @ self.one.T), ((self.two ** 2).sum(1) - 2 * x[:, h:] @ self.two.T))

    def cells(self, x: np.ndarray) -> np.ndarray:
        d1, d2 = self.distances(x)
        return d1.argmin(1).astype(np.int64) * len(self.two) + d2.argmin(1)

    def visited(self, x: np.ndarray, visits: int | None = None) -> np.ndarray:
        """(rows, visits) cell numbers, nearest first; the first is the row's own cell."""
        d1, d2 = self.distances(x)
        m = len(self.two)
        n = min(visits or self.visits, len(self.one) * m)
        out = np.empty((len(x), n), np.int64)
        for i in range(len(x)):
            out[i] = [a * m + b for a, b in multi_sequence(d1[i], d2[i], n)]
        return out

    def need(self, x: np.ndarray, y: np.ndarray, step: int = 256) -> np.ndarray:
        """Visits after which either vector of each pair (x[i], y[i]) has met the other's cell."""
        out = np.empty(len(x), np.int64)
        for lo in range(0, len(x), step):
            a, b = x[lo:lo + step], y[lo:lo + step]
            k, sides = np.arange(len(a)), []
            for d, cell in ((self.distances(a), self.cells(b)), (self.distances(b), self.cells(a))):
                at = d[0][k, cell // len(self.two)] + d[1][k, cell % len(self.two)]
                sides.append((d[0][:, :, None] + d[1][:, None, :] <= at[:, None, None]).sum((1, 2)))
            out[lo:lo + step] = np.minimum(*sides)
        return out


def visits_for(need: np.ndarray, weight: np.ndarray, recall: float) -> int:
    """The fewest visits that are enough for ``recall`` of the weight (1 without trials)."""
    if not len(need):
        return 1
    order = np.argsort(need, kind="stable")
    sums = np.cumsum(weight[order])
    return int(need[order][min(np.searchsorted(sums, recall * sums[-1] * (1 - 1e-12)), len(need) - 1)])


def fit_grid(x: np.ndarray, threshold: float, centres: int, recall: float, trials: int = 2000) -> Grid:
    """Codebooks on the unit rows of ``x``, and visits for the target recall of pairs at exactly the
    threshold's cosine: rows of ``x`` and the same moved towards their nearest other row."""
    h = max(1, x.shape[1] // 2)
    grid = Grid(kmeans(x[:, :h], centres), kmeans(x[:, h:], centres) if x.shape[1] > h else np.zeros((1, 0)))
    q = x[:trials]
    near = np.zeros(len(q), np.int64)
    for lo in range(0, len(q), 256):
        cosine = q[lo:lo + 256] @ x.T
        cosine[np.arange(len(cosine)), np.arange(lo, lo + len(cosine))] = -2
        near[lo:lo + 256] = cosine.argmax(1)
    away = x[near] - (x[near] * q).sum(1, keepdims=True) * q
    norm = np.linalg.norm(away, axis=1, keepdims=True)
    moved = threshold * q + np.sqrt(max(0.0, 1 - threshold ** 2)) * away / np.maximum(norm, 1e-12)
    ok = norm[:, 0] > 1e-9
    need = grid.need(q[ok], moved[ok])
    grid.visits = visits_for(need, np.ones(len(need)), recall)
    return grid


# --------------------------------------------------------------- cells

def _unit(flat: np.ndarray, dim: int) -> np.ndarray:
    x = flat.reshape(-1, dim).astype(np.float64)
    # By a power of two first, which is exact, so that no square over- or underflows.
    x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _floats(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False)


def _file(grid: Grid, dim: int):
    """Distinct vectors -> one row per visited cell; ``own`` marks the cell a vector lives in."""
    def run(batches):
        for b in batches:
            for lo in range(0, b.num_rows, 2048):
                part = b.slice(lo, 2048)
                x = _unit(_floats(part.column("v")), dim)
                seen = grid.visited(x)
                n, m = seen.shape
                at = np.repeat(np.arange(n), m)
                take = part.take(pa.array(at))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(seen.ravel()), pa.array(np.tile(np.arange(m) == 0, n)), pa.array(seen[at, 0]),
                     take.column("node"), take.column("weight"), take.column("v")],
                    names=["cell", "own", "home", "node", "weight", "v"])

    return run


def _least(q: np.ndarray, h: np.ndarray, keep: int) -> np.ndarray:
    """Positions of the ``keep`` smallest h of each q."""
    order = np.lexsort((h, q))
    q = q[order]
    return order[np.arange(len(q)) - np.searchsorted(q, q) < keep]


def _trials(grid: Grid, dim: int, node: np.ndarray, x: np.ndarray, threshold: float, keep: int):
    """Vectors -> per sample vector ``x[q]`` (``node[q]``) that has links here: what ``keep`` of them,
    drawn by hash, need in visits; ``n``, on one of these rows, counts all."""
    def run(batches):
        total = np.zeros(len(x), np.int64)
        held = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)]
        for b in batches:
            for lo in range(0, b.num_rows, 2048):
                part = b.slice(lo, 2048)
                y, other = _unit(_floats(part.column("v")), dim), part.column("node").to_numpy()
                q, j = np.nonzero(x @ y.T >= threshold)
                ok = node[q] != other[j]
                q, j = q[ok], j[ok]
                total += np.bincount(q, minlength=len(x))
                h = (mix(mix(node[q].astype(np.uint64)) ^ other[j].astype(np.uint64)) >> np.uint64(1)).astype(np.int64)
                at = _least(q, h, keep)
                held = [np.concatenate(c) for c in zip(held, (q[at], h[at], grid.need(x[q[at]], y[j[at]])))]
                at = _least(held[0], held[1], keep)
                held = [c[at] for c in held]
        q, h, need = held
        first = np.diff(q, prepend=-1) != 0
        yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(h), pa.array(need), pa.array(np.where(first, total[q], 0))],
                                         names=["q", "h", "need", "n"])

    return run


def _judge(threshold: float, dim: int, grid: Grid, step: int = 512):
    """One group of a cell: residents of block ``bi`` against residents of block ``bj``, or against
    probes (``bj`` < 0).  Gives per vector the weight of the links counted here and a forest link."""
    def run(t):
        own, block, node, weight = t["own"], t["block"], t["node"], t["weight"]
        x = _unit(t["v"], dim)
        bi, bj = t["bi"][0], t["bj"][0]
        res = np.flatnonzero(own & (block == bi))
        other = np.flatnonzero(~own) if bj < 0 else np.flatnonzero(own & (block == bj))
        pairs = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for lo in range(0, len(other), step):
            r = other[lo:lo + step]
            i, j = np.nonzero(x[r] @ x[res].T >= threshold)
            pairs.append((r[i], res[j]))
        a, b = (np.concatenate(p) for p in zip(*pairs))
        if bi == bj:
            a, b = a[a < b], b[a < b]
        elif bj < 0 and len(b):
            # The resident finds the same pair in the probe's own cell if it visits that.
            hit, at = np.unique(b, return_inverse=True)
            back = (grid.visited(x[hit])[at] == t["home"][a][:, None]).any(1)
            ok = ~back | (node[a] < node[b])
            a, b = a[ok], b[ok]
        used, inv = np.unique(np.concatenate((node[a], node[b])), return_inverse=True)
        n = np.bincount(inv, weights=np.concatenate((weight[b], weight[a])), minlength=len(used)).astype(np.int64)
        return used, n, used[forest(len(used), inv[:len(a)], inv[len(a):])]

    return run


def _groups(judge, dim: int):
    """Runs of equal (cell, bi, bj) in sorted batches; a run can go over batch ends."""
    names = ["cell", "bi", "bj", "own", "block", "home", "node", "weight"]

    def parts(batch):
        out = {k: batch.column(k).to_numpy(zero_copy_only=False) for k in names}
        out["v"] = _floats(batch.column("v")).reshape(-1, dim)
        return out

    def emit(t, whole):
        key = np.stack([t["cell"][:whole], t["bi"][:whole], t["bj"][:whole]], axis=1)
        if not len(key):
            return
        cut = np.flatnonzero((np.diff(key, axis=0) != 0).any(1)) + 1
        for lo, hi in zip(np.concatenate(([0], cut)), np.concatenate((cut, [whole]))):
            if hi - lo > 1:
                used, n, low = judge({k: v[lo:hi] for k, v in t.items()})
                if len(used):
                    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(n), pa.array(low)],
                                                     names=["node", "n", "low"])

    def run(batches):
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            new = parts(batch)
            held = new if held is None else {k: np.concatenate((held[k], new[k])) for k in new}
            same = np.ones(len(held["cell"]), bool)
            for k in ("cell", "bi", "bj"):
                same &= held[k] == held[k][-1]
            whole = len(same) - (int(np.argmin(same[::-1])) if not same.all() else len(same))
            yield from emit(held, whole)
            held = {k: v[whole:] for k, v in held.items()}
        if held is not None:
            yield from emit(held, len(held["cell"]))

    return run


def embedding_dedup(vectors: DataFrame, threshold: float = 0.95, recall: float = 0.99, sample: int = 20_000,
                    centres: int = 64, block: int = 4096, id_col: str = "vec_id",
                    vec_col: str = "embedding") -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id``, ``kept`` for every row of ``vectors``.

    ``sample`` bounds the vectors that codebooks and visits are fitted on; all are indexed.  Visits
    are as many as ``recall`` takes, up to the whole grid.
    """
    ship(vectors.sparkSession)
    kind = "array<float>" if dict(vectors.dtypes)[vec_col] == "array<float>" else "array<double>"
    v = F.col(vec_col).cast(kind)               # floats widen exactly; cosines are in double
    sound = (F.coalesce(F.size(v) > 0, F.lit(False))
             & F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
             & F.coalesce(F.exists(v, lambda x: x != 0), F.lit(False)))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.when(sound, v).alias("v"))
    distinct = reliable(rows.where("v IS NOT NULL").groupBy("v")
                        .agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("weight"))
                        .withColumn("node", F.monotonically_increasing_id()))
    dims = [r.d for r in distinct.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n"))
            .where("n > 0").collect()]
    found = None
    for dim in sorted(dims):
        part = _links_of(distinct.where(F.size("v") == dim), dim, threshold, recall, sample, centres, block)
        found = part if found is None else found.unionAll(part)
    nodes = distinct.select("node", "rep", "weight", "v")
    if found is None:
        return rows.select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"),
                           F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    found = reliable(found)
    n_links = found.groupBy("node").agg(F.sum("n").alias("n"))
    comp = connected_components(found.select(F.col("node").alias("a"), F.col("low").alias("b")))
    whole = (nodes.join(n_links, "node", "left").join(comp, "node", "left")
             .withColumn("component", F.coalesce("component", "node")))
    least = whole.groupBy("component").agg(F.min("rep").alias("component_id"))
    whole = whole.join(least, "component").select(
        "v", "component_id", (F.coalesce("n", F.lit(0).cast("long")) + F.col("weight") - 1).alias("n_links"))
    out = rows.select("id", "v").join(whole, "v", "left")
    component = F.coalesce("component_id", "id")
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
                      component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))


def _visits(distinct: DataFrame, grid: Grid, dim: int, node: np.ndarray, x: np.ndarray, threshold: float,
            recall: float, trials: int = 2000, keep: int = 8) -> int:
    """Visits for the target recall of the links that ``trials`` sample vectors have among all
    vectors, with every link counted alike and with every linked vector counted alike."""
    seen = distinct.select("node", "v").mapInArrow(
        _trials(grid, dim, node[:trials], x[:trials], threshold, keep), "q long, h long, need long, n long")
    of = Window.partitionBy("q")
    seen = (seen.select("q", "need", F.sum("n").over(of).alias("n"), F.row_number().over(of.orderBy("h", "need")).alias("r"))
            .where(F.col("r") <= keep).select("q", "need", "n").collect())      # at most trials * keep rows
    q, need, n = np.array(seen, dtype=np.int64).reshape(-1, 3).T
    kept = np.bincount(q)[q] if len(q) else n
    return max(visits_for(need, n / kept, recall), visits_for(need, 1 / kept, recall))


def _links_of(distinct: DataFrame, dim: int, threshold: float, recall: float, sample: int, centres: int,
              block: int) -> DataFrame:
    """(node, n, low): per group and node, the weight of its links there and a forest link."""
    drawn = distinct.orderBy(F.xxhash64("v"), "node").limit(sample).select("node", "v").collect()   # at most `sample` rows
    x = _unit(np.array([r.v for r in drawn], dtype=np.float64), dim)
    grid = fit_grid(x, threshold, min(centres, max(1, len(x) // 8)), recall)
    grid.visits = max(grid.visits, _visits(distinct, grid, dim, np.array([r.node for r in drawn]), x, threshold, recall))
    filed = distinct.select("node", "weight", "v").mapInArrow(
        _file(grid, dim), f"cell long, own boolean, home long, node long, weight long, v {dict(distinct.dtypes)['v']}")
    filed = reliable(filed)
    sizes = filed.groupBy("cell").agg(F.count_if("own").alias("n"), F.count_if(~F.col("own")).alias("p"))
    rows = filed.join(sizes.where("n > 0 AND n + p > 1"), "cell").withColumns(
        {"g": F.ceil(F.col("n") / block).cast("int"), "gp": F.ceil(F.col("p") / block).cast("int")})
    me = F.pmod(F.xxhash64("node"), F.when(F.col("own"), F.col("g")).otherwise(F.col("gp"))).cast("int")

    def upto(n):
        return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))

    def key(bi, bj):
        return F.struct(bi.cast("int").alias("bi"), bj.cast("int").alias("bj"))

    mine = F.concat(F.transform(upto(F.col("g")), lambda j: key(F.least(j, me), F.greatest(j, me))),
                    F.transform(upto(F.col("gp")), lambda k: key(me, -k - 1)))
    theirs = F.transform(upto(F.col("g")), lambda j: key(j, -me - 1))
    rows = rows.select("cell", "own", "home", "node", "weight", "v", me.cast("long").alias("block"),
                       F.explode(F.when(F.col("own"), mine).otherwise(theirs)).alias("p"))
    rows = rows.select("cell", F.col("p.bi").cast("long").alias("bi"), F.col("p.bj").cast("long").alias("bj"), "own",
                       "block", "home", "node", "weight", "v")
    return (rows.repartition("cell", "bi", "bj").sortWithinPartitions("cell", "bi", "bj")
            .mapInArrow(_groups(_judge(threshold, dim, grid), dim), "node long, n long, low long"))
