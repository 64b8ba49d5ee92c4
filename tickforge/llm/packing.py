"""Operator 6: best-fit packing of token sequences by bin completion.

Documents become token ids (plus an end id), over-long ones are cut into pieces of the
capacity.  Only the number of pieces of each length matters for the packing, and that
is at most ``capacity`` counts, however many documents there are.  On those counts:

* the incumbent is best-fit decreasing, done for all pieces of a length at once;
* a lower bound (Martello and Toth's L2) ends the search when the incumbent meets it;
* otherwise bin completion: take the longest length left, enumerate the fillings of
  the bin around it that no other filling dominates, best fit first, apply one as
  often as the counts allow and go on depth first (later also once, so that fillings
  mix freely); a branch is cut only when its waste exceeds what a better solution than
  the incumbent could waste.  Fillings are enumerated one at a time, as the search comes
  back for them, so none is left out.  The search ends when all is searched, or after
  ``max_nodes`` nodes (by default several descents) with the best incumbent.

The result is a list of patterns (a filling and how often it is used).  Each piece
gets its rank among the pieces of its length -- numbered without holding a length in one
task -- and the rank alone says which sequence and offset it takes.

Nulls: a NULL text is an empty document (one end id).  Rows that share a ``doc_id`` are
packed separately.  An empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import itertools
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickforge.llm.common import blocks, reliable, ship
from tickforge.llm.tokens import WordEncoder
from tickforge.operators.sequencing import ordinal_within


# --------------------------------------------------------------- solving the counts

def lower_bound(counts: dict[int, int], cap: int) -> int:
    """Martello and Toth's L2: over thresholds a, pieces over cap - a are alone, those
    over cap / 2 open a bin each, and the rest above a must fit what those leave."""
    size = np.zeros(cap + 1, dtype=np.int64)
    for length, n in counts.items():
        size[length] = n
    total = size * np.arange(cap + 1)
    best = -(-int(total.sum()) // cap)
    for a in range(0, cap // 2 + 1):
        alone = int(size[cap - a + 1:].sum()) if a else 0
        half = slice(cap // 2 + 1, cap - a + 1)
        n_half = int(size[half].sum())
        room = n_half * cap - int(total[half].sum())
        rest = int(total[max(a, 1):cap // 2 + 1].sum())
        best = max(best, alone + n_half + max(0, -(-(rest - room) // cap)))
    return best


def best_fit(counts: dict[int, int], cap: int) -> list[tuple[int, tuple[int, ...]]]:
    """Best-fit decreasing over counts: (times, lengths in a bin)."""
    open_: dict[int, list[list]] = {}       # room left -> [[times, lengths]]
    for length in sorted(counts, reverse=True):
        left = counts[length]
        rooms = sorted(r for r in open_ if r >= length)
        while left and rooms:
            room = rooms.pop(0)
            k = room // length              # the same bin stays the best fit until it is full
            for group in list(open_.get(room, ())):
                bins = min(group[0], left // k)
                for put, n in ((k, bins), (left - bins * k if bins < group[0] else 0, 1)):
                    if n and put:
                        open_.setdefault(room - put * length, []).append([n, group[1] + (length,) * put])
                        group[0] -= n
                        left -= put * n
                if not group[0]:
                    open_[room].remove(group)
                if not left:
                    break
            if not open_.get(room):
                open_.pop(room, None)
        k = cap // length
        if left // k:
            open_.setdefault(cap - k * length, []).append([left // k, (length,) * k])
        if left % k:
            put = left % k
            open_.setdefault(cap - put * length, []).append([1, (length,) * put])
    return [(n, lengths) for groups in open_.values() for n, lengths in groups]


def dominated(extra: tuple[int, ...], waste: int, spare: int) -> bool:
    """Whether a piece in ``spare`` (a bit per length) fits in place of several pieces of ``extra``,
    of a shorter one, or in the room that is wasted."""
    one = more = 0                          # bit s: one piece, several pieces are s long together
    for x in extra:
        more |= (one | more) << x
        one |= 1 << x

    def upto(bits, n):                      # every bit also 1..n higher
        width = 1
        while width <= n:
            step = min(width, n + 1 - width)
            bits |= bits << step
            width += step
        return bits

    longer = upto(one | 1, waste - 1) << 1 if waste else 0
    return bool((upto(more, waste) | longer) & spare)


def fillings(left: np.ndarray, most: int):
    """Every undominated filling of ``len(left) - 1`` that wastes at most ``most``, best fit and then
    longest pieces first, one at a time; None for each dominated one, so that the caller counts it.
    ``left``: how many pieces there are of each length.

    A filling is dominated if another one differs only by a single piece where this has shorter
    ones, or none: whatever packs the rest beside this one also packs it beside the other.
    """
    room = len(left) - 1
    present = np.flatnonzero(left).tolist()
    have = left[present].tolist()
    inside, sums = (1 << (room + 1)) - 1, [1]           # sums[i], bit s: lengths before the i-th make s
    for x, n in zip(present, have):
        s, n, k = sums[-1], min(n, room // x), 1
        while n:
            k = min(k, n)
            s |= (s << k * x) & inside
            n, k = n - k, 2 * k
        sums.append(s)

    def exact(i, t):
        """Pieces of the first ``i`` lengths that are ``t`` long together."""
        if not t:
            yield ()
            return
        for k in range(min(i, bisect.bisect_right(present, t)) - 1, -1, -1):
            if not sums[k + 1] >> t & 1:
                return
            x = present[k]
            for c in range(min(have[k], t // x), 0, -1):
                if sums[k] >> (t - c * x) & 1:
                    for rest in exact(k, t - c * x):
                        yield (x,) * c + rest

    every = sum(1 << x for x in present)
    for waste in range(min(most, room) + 1):
        if sums[-1] >> (room - waste) & 1:
            for extra in exact(len(present), room - waste):
                spare = every
                for x in set(extra):
                    if extra.count(x) == left[x]:
                        spare &= ~(1 << x)
                yield None if dominated(extra, waste, spare) else extra


def choices(left: np.ndarray, top: int, cap: int, most: int):
    """(times, lengths) of the bins around ``top``: each filling as often as the counts allow, then
    each once, so that any mixture of them can be reached."""
    beside = left[:cap - top + 1].copy()
    if top < len(beside):
        beside[top] -= 1
    for once in (False, True):
        for extra in fillings(beside, most):
            if extra is None:
                yield None
                continue
            lengths = (top, *extra)
            times = int(min(left[x] // lengths.count(x) for x in set(lengths)))
            if not once or times > 1:
                yield 1 if once else times, lengths


def search_bins(counts: dict[int, int], cap: int, max_nodes: int | None = None):
    """Patterns for all pieces, the lower bound, nodes and whether the nodes ran out.

    One descent takes about two nodes per distinct length, however many pieces there are;
    by default there are nodes for eight descents.
    """
    counts = {int(k): int(v) for k, v in counts.items() if v}
    best = best_fit(counts, cap)
    bins, bound = sum(n for n, _ in best), lower_bound(counts, cap)
    total = sum(k * v for k, v in counts.items())
    max_nodes = max(2000, 16 * len(counts)) if max_nodes is None else max_nodes
    left = np.zeros(cap + 1, dtype=np.int64)
    for k, v in counts.items():
        left[k] = v
    path, used, waste, nodes, deeper = [], 0, 0, 0, True    # path: [length, chosen bin, further choices]
    while bins > bound and nodes < max_nodes:
        if deeper:
            present = np.flatnonzero(left)
            if not len(present):
                bins, best, deeper = used, [put for _, put, _ in path], False
                continue
            path.append([int(present[-1]), None, None])
        elif not path:
            break                                           # all is searched
        at = path[-1]
        if at[1]:
            times, lengths = at[1]
            for x in lengths:
                left[x] += times
            used, waste = used - times, waste - times * (cap - sum(lengths))
            if at[2] is None:       # made anew only when the search comes back: it holds all partial sums
                at[2] = itertools.islice(choices(left, at[0], cap, (bins - 1) * cap - total - waste), 1, None)
            put = next(at[2], False)
            while put is None and nodes < max_nodes:
                put, nodes = next(at[2], False), nodes + 1
        else:                       # the first filling is never dominated
            put = next(choices(left, at[0], cap, (bins - 1) * cap - total - waste), False)
        nodes += 1
        if not put:
            path.pop()
            deeper = False
            continue
        at[1], (times, lengths) = put, put
        for x in lengths:
            left[x] -= times
        used, waste = used + times, waste + times * (cap - sum(lengths))
        deeper = waste <= (bins - 1) * cap - total          # what a better solution may waste in all
    return best, bound, nodes, bins > bound and nodes >= max_nodes


def complete_bins(counts: dict[int, int], cap: int, max_nodes: int | None = None):
    """Patterns for all pieces: (times, lengths).  See the module text for the search."""
    return search_bins(counts, cap, max_nodes)[0]


# --------------------------------------------------------------- pieces and places

def token_pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int = 0,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, ``piece``, ``start``, ``length``, ``ids_crc32`` of every piece of every document."""
    ship(docs.sparkSession)

    def cut(batches):
        encoder = WordEncoder.shared(tokenizer)
        for rows, text in blocks(batches, "text"):
            ids, first = encoder.ids(text)
            n = np.diff(first)
            ends = first[1:] + np.arange(1, len(n) + 1)     # with an end id after each document
            flat = np.full(len(ids) + len(n), end_id, dtype="<u4")
            flat[np.arange(len(ids)) + np.repeat(np.arange(len(n)), n)] = ids
            starts = ends - n - 1
            pieces = -(-(n + 1) // capacity)
            doc = np.repeat(np.arange(len(n)), pieces)
            no = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            lo = no * capacity
            length = np.minimum(n[doc] + 1 - lo, capacity)
            view = memoryview(flat).cast("B")
            crc = [zlib.crc32(view[4 * a:4 * (a + m)]) for a, m in zip((starts[doc] + lo).tolist(), length.tolist())]
            yield pa.RecordBatch.from_arrays(
                [rows.column("id").take(pa.array(doc)), pa.array(no.astype(np.int32)),
                 pa.array(lo.astype(np.int64)), pa.array(length.astype(np.int64)), pa.array(crc, pa.int64())],
                names=[id_col, "piece", "start", "length", "ids_crc32"])

    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(cut, f"`{id_col}` {dict(docs.dtypes)[id_col]}, piece int, start long, length long, ids_crc32 long"))


def _slots(patterns, stride: int) -> dict[str, np.ndarray]:
    """Where the ranks of each length go: sorted by length * stride + first rank."""
    rows, sequence, taken = [], 0, {}
    for times, lengths in patterns:
        offset = 0
        for length in sorted(set(lengths), reverse=True):
            copies = lengths.count(length)
            rank = taken.get(length, 0)
            rows.append((length * stride + rank, copies, sequence, offset))
            taken[length] = rank + times * copies
            offset += copies * length
        sequence += times
    rows.sort()
    key, copies, seq, offset = (np.array(x, dtype=np.int64) for x in zip(*rows)) if rows else [np.zeros(0, np.int64)] * 4
    return {"key": key, "copies": copies, "seq": seq, "offset": offset}


def pack(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, max_nodes: int | None = None,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every piece with its ``sequence_id`` and ``offset``."""
    pieces = reliable(token_pieces(docs, tokenizer, capacity, end_id, id_col, text_col))
    counts = {r.length: r.n for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    stride = 1 << 45                        # more than pieces of one length; lengths stay below 2**18
    slots = _slots(complete_bins(counts, capacity, max_nodes), stride)  # at most a few per length and pattern
    ranked = ordinal_within(pieces, ["length"], [id_col, "piece", "ids_crc32"], out="rank")

    names = [*pieces.columns, "sequence_id", "offset"]

    def place(batches):
        for b in batches:
            length = b.column("length").to_numpy().astype(np.int64)
            at = length * stride + b.column("rank").to_numpy().astype(np.int64) - 1
            i = np.searchsorted(slots["key"], at, side="right") - 1
            nth = at - slots["key"][i]
            copies = slots["copies"][i]
            seq = slots["seq"][i] + nth // copies
            offset = slots["offset"][i] + (nth % copies) * length
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(seq), pa.array(offset)],
                                             names=names)

    fields = ", ".join(f"`{c}` {t}" for c, t in pieces.dtypes)
    return ranked.mapInArrow(place, f"{fields}, sequence_id long, offset long")
