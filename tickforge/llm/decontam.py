"""Operator 5: benchmark decontamination by winnowing.

A window is ``window`` consecutive words of a benchmark item; a shorter item is one
window of its own length.  For a window of L words the fingerprint is the smallest
hash of its k-grams (k = min(``gram``, L)), i.e. winnowing with L - k + 1 grams per
sliding window: equal windows have equal fingerprints wherever they stand, so every
shared span of at least L words shares one.

1. benchmark texts give their windows with fingerprints;
2. a bitmap of fixed size (2**``bitmap_bits`` cells, whatever the benchmark's size)
   marks the fingerprints' low bits and is all that is broadcast; it can only
   let too much through, never too little;
3. documents are scanned once: windows whose fingerprint is marked are kept,
   extended over their consecutive neighbours to one span of words;
4. span windows join benchmark windows on fingerprint, length and the words themselves,
   so hash collisions never count;
5. hit words are the union of the matching windows.

Nulls: a NULL text has no words.  A NULL item id's windows make hits but name no item;
repeated item ids count once.  Rows that share a ``doc_id`` are judged separately.  Empty
tables give empty results or no hits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickforge.llm.common import Words, blocks, mix, reliable, ship

_SPAN = "array<struct<len:int,start:long,words:string,prints:array<long>>>"
_U64 = np.uint64


def _grams(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of k word hashes (empty if there are fewer words)."""
    m = len(h) - k + 1
    if m <= 0:
        return np.zeros(0, _U64)
    g = np.zeros(m, _U64)
    for j in range(k):
        g = g * _U64(0x9DDFEA08EB382D69) + h[j:j + m]
    return mix(g)


def _prints(h: np.ndarray, length: int, gram: int) -> np.ndarray:
    """Fingerprint of the window of ``length`` words at every word position."""
    k = min(gram, length)
    g = _grams(h, k)
    m = len(h) - length + 1
    if m <= 0:
        return np.zeros(0, _U64)
    low = g[:m].copy()
    for j in range(1, length - k + 1):
        np.minimum(low, g[j:j + m], out=low)
    return mix(low + _U64(length))


def _scan(lengths, window: int, gram: int, marked: np.ndarray | None):
    """Rows -> id, n_words and spans.  Without ``marked`` (benchmark side) every item is
    kept whole, with the one window length that holds for it."""
    def spans_of(words: Words, h: np.ndarray):
        per_doc: dict[int, list] = {}
        counts = np.diff(words.first)
        owner = words.owner()
        for length in (lengths if marked is not None else range(1, window + 1)):
            prints = _prints(h, length, gram)
            at = np.arange(len(prints))
            ok = words.first[1:][owner[:len(prints)]] >= at + length     # ends inside its document
            if marked is not None:
                ok &= marked[(prints & _U64(len(marked) - 1)).astype(np.int64)]
            else:
                n = counts[owner[:len(prints)]]
                ok &= (n >= window) if length == window else (n == length)
            hit = at[ok]
            if not len(hit):
                continue
            cut = np.flatnonzero((np.diff(hit) > 1) | (np.diff(owner[hit]) > 0)) + 1
            for lo, hi in zip(np.concatenate(([0], cut)), np.concatenate((cut, [len(hit)]))):
                a, b = int(hit[lo]), int(hit[hi - 1])
                doc = int(owner[a])
                per_doc.setdefault(doc, []).append(
                    {"len": length, "start": a - int(words.first[doc]), "words": words.joined(a, b + length),
                     "prints": prints[a:b + 1].view(np.int64)})
        return counts, per_doc

    def run(batches):
        for rows, text in blocks(batches, "text"):
            words = Words(text)
            counts, per_doc = spans_of(words, words.hashes())
            spans = pa.array([per_doc.get(i, []) for i in range(len(text))],
                             pa.list_(pa.struct([("len", pa.int32()), ("start", pa.int64()), ("words", pa.string()),
                                                 ("prints", pa.list_(pa.int64()))])))
            yield pa.RecordBatch.from_arrays([rows.column("id"), pa.array(counts.astype(np.int64)), spans],
                                             names=["id", "n_words", "spans"])

    return run


def _windows(scanned: DataFrame, *keep: str) -> DataFrame:
    """One row per kept window: fingerprint, length, words and its place."""
    span = scanned.select(*keep, F.explode("spans").alias("s"))
    runs = span.select(*keep, "s.len", "s.start", F.split("s.words", " ").alias("w"),
                       F.posexplode("s.prints").alias("i", "print"))
    return runs.select(*keep, "print", "len", (F.col("start") + F.col("i")).alias("at"),
                       F.array_join(F.slice("w", F.col("i") + 1, F.col("len")), " ").alias("words"))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10, gram: int = 6,
                  bitmap_bits: int = 22, id_col: str = "doc_id", text_col: str = "text",
                  item_id: str = "item_id", item_text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(per document, hit spans).

    Per document: id, ``n_words``, ``n_hit``, ``n_items``, ``items_sha256``, ``contaminated``.
    Hit spans: id, ``start`` and ``end`` word positions of every matching window.
    """
    ship(docs.sparkSession)
    items = reliable(benchmark.select(F.col(item_id).alias("id"), F.col(item_text).cast("string").alias("text"))
                     .mapInArrow(_scan(None, window, gram, None),
                                 f"id {dict(benchmark.dtypes)[item_id]}, n_words long, spans {_SPAN}"))
    known = reliable(_windows(items, "id").select("print", "len", "words", F.col("id").alias("item")).distinct())
    cells = 1 << bitmap_bits
    lengths = sorted(r.len for r in known.select("len").distinct().collect())           # at most `window` rows
    marked = np.zeros(cells, dtype=bool)
    bits = known.select((F.col("print").bitwiseAND(F.lit(cells - 1).cast("long"))).cast("int").alias("c")).distinct()
    marked[[r.c for r in bits.toLocalIterator()]] = True                                # at most `cells` numbers
    spread = docs.sparkSession.sparkContext.broadcast(np.packbits(marked))

    def scan(batches):
        yield from _scan(lengths, window, gram, np.unpackbits(spread.value).astype(bool))(batches)

    scanned = reliable(docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
                       .mapInArrow(scan, f"id {dict(docs.dtypes)[id_col]}, n_words long, spans {_SPAN}")
                       .withColumn("row", F.monotonically_increasing_id()))     # fixed by the checkpoint
    found = _windows(scanned.where(F.size("spans") > 0), "row")
    match = ["print", "len", "words"]
    hits = found.join(known.select(*match).distinct(), match, "left_semi")
    before = Window.partitionBy("row").orderBy("at", "len").rowsBetween(Window.unboundedPreceding, -1)
    fresh = hits.select("row", "at", (F.col("at") + F.col("len")).alias("end")).withColumn(
        "len", F.col("end") - F.col("at"))
    fresh = fresh.withColumn("reach", F.coalesce(F.max("end").over(before), F.lit(0)))
    n_hit = (fresh.groupBy("row")
             .agg(F.sum(F.greatest(F.lit(0), F.col("end") - F.greatest("at", "reach"))).alias("n_hit")))
    item = (found.select("row", *match).distinct().join(known.where("item IS NOT NULL"), match)
            .select("row", F.col("item").cast("string").alias("item")).distinct())
    named = item.groupBy("row").agg(
        F.count(F.lit(1)).alias("n_items"),
        F.sha2(F.array_join(F.sort_array(F.collect_list("item")), ","), 256).alias("items_sha256"))
    per_doc = (scanned.select("row", "id", "n_words").join(n_hit, "row", "left").join(named, "row", "left")
               .select(F.col("id").alias(id_col), "n_words",
                       F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
                       F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
                       F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
                       (F.coalesce("n_hit", F.lit(0).cast("long")) > 0).alias("contaminated")))
    spans = (hits.join(scanned.select("row", "id"), "row")
             .select(F.col("id").alias(id_col), F.col("at").alias("start"),
                     (F.col("at") + F.col("len")).alias("end")))
    return per_doc, spans


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The documents without a benchmark window; rows that share the id of a contaminated
    row go with it, rows with a NULL id stay."""
    per_doc, _ = contamination(docs, benchmark, id_col=id_col, **options)
    bad = per_doc.where("contaminated").select(id_col).distinct()
    return docs.join(bad, id_col, "left_anti").select(*docs.columns)
