"""Operator 13: source divergence audit over collapsed duplicate texts.

Which sources of a language use its vocabulary alike, and which terms set one apart?  Identical
texts of a language are collapsed first: every task folds its own rows into one row per text
with a count per source, a shuffle by the text's digest brings the folds of a text together, and
each distinct text is tokenized once.  Its terms then enter the counts weighted by how often each
source holds the text; document frequencies likewise.

Terms are runs of ASCII letters and non-ASCII characters, A-Z lower-cased.  A language keeps the
terms in at least ``min_docs`` of its documents.  With count c of a term in a group, N the group's
count over kept terms and V kept terms, p = 1 + floor(scale * (c + 1) / (N + V)); q likewise for
the language (part ``term``) or another source (part ``pair``); f = floor((p - q)^2 / q).

Pairs are evaluated sparsely.  For terms that one source lacks, p is that source's constant, so
their sum comes from a histogram of the other's counts; terms that both lack add a multiple of
one value; only terms that both hold are met one by one, as a correction.  All sums are exact
integers; counts are multiplied as DECIMAL(38).

Defined cases: NULL text, lang and source are ''.  A document is a row, so repeated rows count each
time; ids are not read.  Groups without terms are groups (N = 0).  Without kept terms pairs have
value 0 and there is no ``term`` row; a language with one source has no pair.  An empty table
gives no rows.  Further columns are not read, so their names cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickforge.llm.common import ship, utf8
from tickforge.session import staging_dir

SCALE = 1_000_000_000
#: Bytes of distinct text that a task folds before it passes them on.
FOLD_BYTES = 32 << 20
#: Bytes of text tokenized by one numpy pass.
PASS_BYTES = 2 << 20
#: Counted rows that a task holds before it adds them up.
HELD_ROWS = 1_500_000

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_TERM = np.zeros(256, dtype=bool)
_TERM[97:123] = _TERM[128:] = True

_FOLDED = "lang string, digest binary, text string, sources array<string>, times array<long>"


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, text) rows to one row per text with its sources' counts."""
    held: dict[tuple[str, bytes], list] = {}
    size = 0

    def flush():
        keys = list(held)
        return pa.RecordBatch.from_arrays([
            pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.binary()),
            pa.array([held[k][0] for k in keys], pa.string()),
            pa.array([list(held[k][1]) for k in keys], pa.list_(pa.string())),
            pa.array([list(held[k][1].values()) for k in keys], pa.list_(pa.int64()))],
            names=["lang", "digest", "text", "sources", "times"])

    for batch in batches:
        for lang, source, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
            key = (lang, hashlib.sha256(text.encode("utf-8", "surrogatepass")).digest())
            row = held.get(key)
            if row is None:
                row = held[key] = [text, {}]
                size += len(text) + 200
            row[1][source] = row[1].get(source, 0) + 1
            if size > FOLD_BYTES:
                yield flush()
                held.clear()
                size = 0
    if held:
        yield flush()


def _terms(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All terms of the texts, in order, and the index of the text that each is from."""
    raw, offs = utf8(texts)
    low = _LOWER[raw]
    inside = _TERM[low]
    edge = np.zeros(len(raw) + 1, bool)
    edge[offs] = True
    before = np.concatenate(([False], inside[:-1])) if len(raw) else inside
    after = np.concatenate((inside[1:], [False])) if len(raw) else inside
    start = np.flatnonzero(inside & (~before | edge[:-1]))
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    width = end - start
    bounds = np.concatenate(([0], np.cumsum(width)))
    # Terms lie apart in the text: keep only their bytes, side by side.
    terms = pa.Array.from_buffers(pa.large_string(), len(start), [
        None, pa.py_buffer(bounds.astype(np.int64).tobytes()), pa.py_buffer(low[inside].tobytes())])
    return terms, np.searchsorted(offs, start, side="right") - 1


def _count_texts(lang: str, rows: list[tuple[str, dict[str, int]]]) -> pa.Table:
    """One tokenization of distinct texts: (lang, term, source, n, df), weighted by their copies."""
    out = []
    lo = 0
    while lo < len(rows):
        hi, size = lo, 0
        while hi < len(rows) and (hi == lo or size + len(rows[hi][0]) <= PASS_BYTES):
            size += len(rows[hi][0])
            hi += 1
        part = rows[lo:hi]
        lo = hi
        terms, owner = _terms(pa.array([t for t, _ in part], pa.large_string()))
        if not len(terms):
            continue
        coded = terms.dictionary_encode()
        code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        words = coded.dictionary
        # (text, term) with its frequency there.
        pair, tf = np.unique(owner.astype(np.int64) * len(words) + code, return_counts=True)
        text_of, word_of = pair // len(words), pair % len(words)
        names = sorted({s for _, m in part for s in m})
        where = {s: i for i, s in enumerate(names)}
        held = [(i, where[s], k) for i, (_, m) in enumerate(part) for s, k in m.items()]
        t, s, k = (np.array(x, np.int64) for x in zip(*held))
        # Every (text, term) once per source of the text.
        first = np.searchsorted(text_of, t)
        span = np.searchsorted(text_of, t, side="right") - first
        pick = np.repeat(first - np.concatenate(([0], np.cumsum(span)[:-1])), span) + np.arange(span.sum())
        src, mult = np.repeat(s, span), np.repeat(k, span)
        key, inv = np.unique(src * len(words) + word_of[pick], return_inverse=True)
        n = np.zeros(len(key), np.int64)
        df = np.zeros(len(key), np.int64)
        np.add.at(n, inv, tf[pick] * mult)
        np.add.at(df, inv, mult)
        out.append(pa.table({
            "lang": pa.array([lang] * len(key), pa.string()),
            "term": words.take(pa.array(key % len(words))).cast(pa.string()),
            "source": pa.array(names, pa.string()).take(pa.array(key // len(words))),
            "n": pa.array(n), "df": pa.array(df)}))
    return pa.concat_tables(out) if out else None


def _added(tables: list[pa.Table]) -> pa.Table:
    """Counts of equal (lang, term, source) added up."""
    whole = pa.concat_tables(tables).combine_chunks()
    out = whole.group_by(["lang", "term", "source"]).aggregate([("n", "sum"), ("df", "sum")])
    return out.select(["lang", "term", "source", "n_sum", "df_sum"]).rename_columns(["lang", "term", "source", "n", "df"])


def _tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Folds sorted by (lang, digest): those of one text meet, then it is tokenized once.  Counts
    are added up within the task before they are passed on."""
    lang, rows, size, last = None, [], 0, None
    counted: list[pa.Table] = []
    held = 0

    def count():
        nonlocal held
        table = _count_texts(lang, rows)
        if table is not None:
            counted.append(table)
            held += table.num_rows

    for batch in batches:
        for la, digest, text, sources, times in zip(*(batch.column(i).to_pylist() for i in range(5))):
            if (la, digest) == last:
                by_source = rows[-1][1]
                for s, k in zip(sources, times):
                    by_source[s] = by_source.get(s, 0) + k
                continue
            if rows and (la != lang or size > PASS_BYTES):
                count()
                rows, size = [], 0
                if held > HELD_ROWS:
                    counted, held = [_added(counted)], 0
                    if counted[0].num_rows > HELD_ROWS // 2:
                        yield from counted.pop().to_batches(max_chunksize=100_000)
            lang, last = la, (la, digest)
            rows.append((text, dict(zip(sources, times))))
            size += len(text)
    if rows:
        count()
    if counted:
        yield from _added(counted).to_batches(max_chunksize=100_000)


def collapse(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """One row per text of a language and task that holds it: its sources and their counts."""
    def read(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = docs.select(read(lang_col).alias("lang"), read(source_col).alias("source"), read(text_col).alias("text"))
    return rows.mapInArrow(_fold, _FOLDED)


def term_counts(folded: DataFrame, min_docs: int) -> DataFrame:
    """(lang, term, source, n, lang_n): occurrences in a source and in the language of the terms that
    at least ``min_docs`` of its documents hold."""
    met = folded.repartition("lang", "digest").sortWithinPartitions("lang", "digest")
    counted = met.mapInArrow(_tokenize, "lang string, term string, source string, n long, df long")
    # One shuffle by term serves both the counts per source and those of the language.
    counts = (counted.repartition("lang", "term").groupBy("lang", "term", "source")
              .agg(F.sum("n").alias("n"), F.sum("df").alias("df")))
    term = Window.partitionBy("lang", "term")
    return (counts.withColumns({"lang_n": F.sum("n").over(term), "lang_df": F.sum("df").over(term)})
            .where(F.col("lang_df") >= min_docs).select("lang", "term", "source", "n", "lang_n"))


def _p(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(scale * (count + 1) / (total + kept)), exact for any count; never above the
    scale by more than one, so it is a long."""
    top = (count + 1).cast("decimal(28,0)") * F.lit(SCALE).cast("decimal(10,0)")
    exact = F.call_function("div", top, (total + kept).cast("decimal(28,0)"))
    # Up to here the product is a long itself.
    fits = count < (1 << 63) // SCALE - 1
    return F.when(fits, F.call_function("div", (count + 1) * F.lit(SCALE), total + kept)).otherwise(exact) + 1


def _f(p: Column, q: Column) -> Column:
    # (p - q)^2 is at most 10^18, which a long holds.
    return F.call_function("div", (p - q) * (p - q), q)


def source_divergence(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
                      min_docs: int = 3, top_terms: int = 200) -> DataFrame:
    """Rows (lang, source, part, item, value, rank) for every group of a language and source."""
    spark = docs.sparkSession
    ship(spark)
    base = staging_dir(spark, "divergence")

    def stored(df, name):
        df.write.parquet(f"{base}/{name}")
        return spark.read.parquet(f"{base}/{name}")

    def read(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(""))
    held = stored(term_counts(collapse(docs, text_col, lang_col, source_col), min_docs), "held")

    # One row per group, terms or not: size, terms it holds, the p of a term it lacks.
    lang = (held.groupBy("lang", "term").agg(F.first("lang_n").alias("c"))
            .groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("c").alias("lang_total")))
    sums = held.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("terms"))
    groups = (docs.select(read(lang_col).alias("lang"), read(source_col).alias("source")).distinct()
              .join(sums, ["lang", "source"], "left").join(lang, "lang", "left")
              .select("lang", "source", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("total", "terms", "v", "lang_total"))))
    zero = F.when(F.col("v") > 0, _p(F.lit(0), F.col("total"), F.col("v")))
    groups = stored(groups.withColumn("p0", zero), "groups")

    own = held.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", _p(F.col("n"), F.col("total"), F.col("v")).alias("p"), "p0",
        _p(F.col("lang_n"), F.col("lang_total"), F.col("v")).alias("q"))

    by_value = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    term = (own.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                                      _f(F.col("p"), F.col("q")).alias("value"))
            .withColumn("rank", F.row_number().over(by_value)).where(F.col("rank") <= top_terms))

    # Terms that only one side of a pair holds, as if the other lacked all: by count.
    shape = own.groupBy("lang", "source", "p").agg(F.count(F.lit(1)).alias("k"))
    other = groups.where("v > 0").select("lang", F.col("source").alias("item"), F.col("p0").alias("q0"))
    lone = shape.join(other, "lang").where("source <> item")
    mine = lone.groupBy("lang", "source", "item").agg(F.sum(F.col("k") * _f(F.col("p"), F.col("q0"))).alias("value"))
    theirs = (lone.groupBy("lang", F.col("item").alias("source"), F.col("source").alias("item"))
              .agg(F.sum(F.col("k") * _f(F.col("q0"), F.col("p"))).alias("value")))
    # Terms that both hold: their value, without what the two sums above took for them.
    a = own.select("lang", "term", "source", "p", "p0")
    b = own.select("lang", "term", F.col("source").alias("item"), F.col("p").alias("q"), F.col("p0").alias("q0"))
    p, q, p0, q0 = (F.col(c) for c in ("p", "q", "p0", "q0"))
    shared = (a.join(b, ["lang", "term"]).where("source <> item").groupBy("lang", "source", "item")
              .agg(F.sum(_f(p, q) - _f(p, q0) - _f(p0, q) + _f(p0, q0)).alias("value")))
    # Terms that neither holds (terms of both are counted twice here, and put right above).
    g, o = groups.alias("g"), groups.alias("o")
    pairs = (g.join(o, F.col("g.lang") == F.col("o.lang")).where("g.source <> o.source")
             .select("g.lang", "g.source", F.col("o.source").alias("item"),
                     F.coalesce((F.col("g.v") - F.col("g.terms") - F.col("o.terms"))
                                * _f(F.col("g.p0"), F.col("o.p0")), F.lit(0)).alias("value")))
    pair = (pairs.unionByName(mine).unionByName(theirs).unionByName(shared)
            .groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
            .select("lang", "source", F.lit("pair").alias("part"), "item", "value")
            .withColumn("rank", F.row_number().over(by_value)))
    return pair.unionByName(term).select("lang", "source", "part", "item", "value", F.col("rank").cast("int").alias("rank"))
