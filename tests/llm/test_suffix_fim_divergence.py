"""Operators 11 to 13 against brute force, round trips and edge cases."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickforge.llm.divergence import source_divergence
from tickforge.llm.fim import fill_in_middle, fim_digests, restore, units
from tickforge.llm.repeats import _refine, anchors, remove_repeats, shape

DOC = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                    *[T.StructField(c, T.StringType()) for c in ("n", "tid", "len", "ranges", "kept", "form", "__text")]])


def frame(spark, rows):
    return spark.createDataFrame([(i, t, *["x"] * 7) for i, t in rows], DOC)


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


# --------------------------------------------------------------- 11 repeated byte strings

def brute_repeats(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(b[i:i + length] for b in data for i in range(len(b) - length + 1))
    out = []
    for b in data:
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = True
        kept = bytes(x for x, g in zip(b, gone) if not g)
        rises = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        out.append((len(b), int(gone.sum()), rises, sha(kept)))
    return out


def repeat_corpus(seed, length):
    rnd = random.Random(seed)
    abc = "abcdefghij é"

    def noise(k):
        return "".join(rnd.choice(abc) for _ in range(rnd.randint(1, k)))
    parts = [noise(3 * length) for _ in range(12)]
    texts = [None, "", "a" * 900, "ab" * 600, "é" * 300, "a" * (length - 1), "xyz" * length]
    texts += ["".join(rnd.choice(parts) if rnd.random() < .5 else noise(2 * length) for _ in range(rnd.randint(1, 6)))
              for _ in range(40)]
    return texts + texts[8:12]


@pytest.mark.parametrize("seed,length,bucket_rows", [(0, 200, 2000), (1, 20, 2000), (2, 8, 2), (3, 50, 2), (4, 33, 4)])
def test_repeats_against_brute_force(spark, seed, length, bucket_rows):
    """Small ``bucket_rows`` send buckets through the shuffled splits and single windows."""
    texts = repeat_corpus(seed, length)
    rows = [(None if k % 9 == 5 else k // 2, t) for k, t in enumerate(texts)]       # ids null and repeated
    got = (remove_repeats(frame(spark, rows).repartition(3), length, bucket_rows=bucket_rows)
           .select("doc_id", "text", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)).collect())
    want = [(i, t, *x) for (i, t), x in zip(rows, brute_repeats(texts, length))]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_repeats_hot_passage_and_frame_columns(spark):
    """A passage in two thirds of the documents, each time in other surroundings; own columns stay."""
    rnd = random.Random(5)
    passage = "".join(rnd.choice("klmnopq ") for _ in range(260))
    texts = ["".join(rnd.choice("abcdef") for _ in range(rnd.randint(0, 90))) + (passage if k % 3 else "") +
             "".join(rnd.choice("abcdef") for _ in range(rnd.randint(0, 90))) for k in range(90)]
    df = remove_repeats(frame(spark, list(enumerate(texts))).repartition(8), 200, bucket_rows=10)
    assert df.columns == ["doc_id", "text", "n", "tid", "len", "ranges", "form", "__text", "n_bytes", "n_removed", "n_spans", "kept"]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, sha(bytes(r.kept))) for r in df.collect()}
    assert [got[k] for k in range(90)] == brute_repeats(texts, 200)
    assert {r.tid for r in df.select("tid").distinct().collect()} == {"x"}


def test_repeats_empty_table(spark):
    df = remove_repeats(frame(spark, []))
    assert df.collect() == [] and "kept" in df.columns
    with pytest.raises(ValueError):
        remove_repeats(frame(spark, []), 3)


def test_anchor_of_a_window_depends_on_the_window_alone():
    rng = np.random.default_rng(1)
    length = 50
    width, q = shape(length)
    assert width + q - 1 == length and width & (width - 1) == 0
    window = rng.integers(97, 103, length).astype(np.uint8)
    seen = set()
    for k in range(20):
        left = rng.integers(97, 103, rng.integers(0, 80)).astype(np.uint8)
        raw = np.concatenate((left, window, rng.integers(97, 103, 60).astype(np.uint8)))
        at = [a - len(left) for a4, lo4, hi4, _ in anchors(raw, np.array([0, len(raw)]), length)
              for a, lo, hi in zip(a4, lo4, hi4) if a - hi <= len(left) <= a - lo]
        assert len(at) == 1                       # every window has one anchor
        seen.add(at[0])
    assert len(seen) == 1 and 0 <= seen.pop() < width


def test_long_text_is_read_in_passes(monkeypatch):
    import tickforge.llm.repeats as repeats
    rng = np.random.default_rng(2)
    raw = rng.integers(97, 100, 5000).astype(np.uint8)
    offs = np.array([0, 10, 10, 2300, 5000])

    def windows():
        return sorted((int(a), int(a) - r) for a4, lo4, hi4, _ in anchors(raw, offs, 40)
                      for a, lo, hi in zip(a4, lo4, hi4) for r in range(lo, hi + 1))
    whole = windows()
    monkeypatch.setattr(repeats, "PASS", 333)
    assert windows() == whole
    assert [s for _, s in sorted(whole, key=lambda x: x[1])] == [*range(10, 2300 - 39), *range(2300, 5000 - 39)]


def test_refine_finds_equal_windows_only():
    found = []
    # contexts around the anchor: 3 bytes left, windows of 6 bytes, runs 0..3
    _refine([(0, b"xyzabcdef", 3, 0, 3), (1, b"uyzabcdeg", 3, 0, 3)], 0, 3, 6, found)
    assert sorted((n, r) for n, lo, hi in found for r in range(lo, hi + 1)) == [(0, 1), (0, 2), (1, 1), (1, 2)]


# --------------------------------------------------------------- 12 fill in middle

def brute_fim(doc_id, text):
    text = text or ""
    n = len(text)
    d = sha(f"1:{'' if doc_id is None else doc_id}")
    h = [int(d[8 * k:8 * k + 8], 16) for k in range(4)]
    if not n or any(t in text for t in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    pre, mid, suf = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return n, "spm", a, b - a, f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", a, b - a, f"<P>{pre}<S>{suf}<M>{mid}"


def fim_rows():
    rnd = random.Random(3)
    odd = ["a", "é", "\U0001F600", "\n", "\r\n", " ", "$1", "\\", "<", "P", ">", "S", "M", "\x00", "é"]
    rows = [(1, None), (2, ""), (3, "x"), (4, "<P>"), (5, "a<S>b"), (6, "<M"), (7, "\U0001F600" * 1500), (None, "null id text"),
            (8, "twice"), (8, "twice"), (9, "ab" * 40000), (-5, "negative id")]
    return rows + [(100 + k, "".join(rnd.choice(odd) for _ in range(rnd.randint(1, 60)))) for k in range(300)]


def test_fim_against_brute_force(spark):
    rows = fim_rows()
    out = fill_in_middle(frame(spark, rows).repartition(3))
    got = out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output",
                     restore(F.col("output"), F.col("form")).alias("back")).collect()
    want = [(i, *brute_fim(i, t), t or "") for i, t in rows]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_fim_long_text_and_units(spark):
    """Millions of code points neither overflow the matcher's stack nor become an array of characters."""
    text = "ab\U0001F600\n" * 600_000 + "tail"
    row = fim_digests(fill_in_middle(spark.createDataFrame([(1, text)], "doc_id long, text string"), fim_percent=100)).first()
    assert row.n == len(text) and row.form != "plain" and row.restored_sha256 == sha(text)
    sizes = [0, 1, 1023, 1024, 1025, 2048, 5000]
    df = spark.createDataFrame([("é" * k,) for k in sizes], "t string").select(units(F.col("t")).alias("u"))
    assert [r.u for r in df.collect()] == sizes


def test_fim_parameters_and_empty_table(spark):
    assert fill_in_middle(frame(spark, [])).collect() == []
    assert {r.form for r in fill_in_middle(frame(spark, fim_rows()), fim_percent=0).collect()} == {"plain"}
    assert "psm" not in {r.form for r in fill_in_middle(frame(spark, fim_rows()), fim_percent=100, spm_percent=100).collect()}
    own = ("|pre|$", "|suf|$", "|mid|$")
    with pytest.raises(ValueError):
        fill_in_middle(frame(spark, []), sentinels=own)          # their first character comes again
    own = ("|pre$", "|suf$", "|mid\\")
    out = fill_in_middle(frame(spark, [(k, f"text | number {k} |pre") for k in range(30)]), sentinels=own)
    back = out.select("doc_id", restore(F.col("output"), F.col("form"), own).alias("t")).collect()
    assert all(r.t == f"text | number {r.doc_id} |pre" for r in back)


# --------------------------------------------------------------- 13 source divergence

def brute_divergence(rows, min_docs=3, top=200):
    docs = [((la or ""), (s or ""), re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", "".join(
        chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in (t or "")))) for t, la, s in rows]
    df, groups = defaultdict(Counter), defaultdict(Counter)
    for la, s, w in docs:
        df[la].update(set(w))
        groups[la, s].update(w)
    out = []
    for (la, s), count in groups.items():
        kept = sorted(t for t, n in df[la].items() if n >= min_docs)

        def share(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 1) // (total + len(kept)) for t in kept}
        p = share(count)
        every = Counter()
        for (l2, _), c in groups.items():
            if l2 == la:
                every.update(c)
        q = share(every)
        terms = [(-((p[t] - q[t]) ** 2 // q[t]), t) for t in kept if count[t] > 0 and p[t] > q[t]]
        pairs = []
        for (l2, s2), c in groups.items():
            if l2 == la and s2 != s:
                o = share(c)
                pairs.append((-sum((p[t] - o[t]) ** 2 // o[t] for t in kept), s2))
        for part, found, limit in (("term", terms, top), ("pair", pairs, None)):
            found.sort(key=lambda x: (x[0], x[1].encode()))
            out += [(la, s, part, item, -v, k + 1) for k, (v, item) in enumerate(found[:limit])]
    return out


def divergence_rows():
    rnd = random.Random(9)
    vocab = [f"{a}{b}" for a in "abcé" for b in "xyzßÉ"] + ["Word", "WORD", "naïve", "日本"]
    rows = [(None, None, None), ("", "", ""), ("123 !?", "en", "digits"), ("one Two", "xx", "only"), (None, "en", "null")]
    for k in range(160):
        text = " ".join(rnd.choice(vocab[: 5 + k % 20]) for _ in range(rnd.randint(1, 30)))
        rows.append((text, rnd.choice(["en", "de", None]), rnd.choice(["a", "b", "c", "é", None])))
    copy = "ax ay az Word naïve copy"
    return rows + [(copy, "en", s) for s in "abcab" * 40] + [(copy, "de", "a")] * 3


@pytest.mark.parametrize("parts,top", [(1, 200), (7, 4)])
def test_divergence_against_brute_force(spark, parts, top):
    rows = divergence_rows()
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "text string, lang string, source string, term string, n int")
    got = [tuple(r) for r in source_divergence(df.repartition(parts), top_terms=top).collect()]
    assert sorted(got) == sorted(brute_divergence(rows, top=top))


def test_divergence_folds_copies_within_bounds(spark, monkeypatch):
    import tickforge.llm.divergence as divergence
    monkeypatch.setattr(divergence, "FOLD_BYTES", 500)
    monkeypatch.setattr(divergence, "PASS_BYTES", 300)
    monkeypatch.setattr(divergence, "HELD_ROWS", 40)
    import pyarrow as pa
    rows = divergence_rows()
    batch = pa.RecordBatch.from_arrays([pa.array([x or "" for x in c]) for c in zip(*[(la, s, t) for t, la, s in rows])],
                                       names=["lang", "source", "text"])
    folded = pa.Table.from_batches(list(divergence._fold(iter([batch])))).sort_by([("lang", "ascending"), ("digest", "ascending")])
    counted = pa.Table.from_batches(list(divergence._tokenize(iter(folded.to_batches()))))
    have = Counter()
    for r in counted.to_pylist():
        have[r["lang"], r["source"], r["term"]] += r["n"]
    want = Counter()
    for t, la, s in rows:
        for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t or ""):
            want[la or "", s or "", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w)] += 1
    assert have == want


def test_divergence_empty_and_single(spark):
    schema = "text string, lang string, source string"
    assert source_divergence(spark.createDataFrame([], schema)).collect() == []
    one = source_divergence(spark.createDataFrame([("a b c", "en", "s")] * 3, schema)).collect()
    assert one == []                                            # one source: p = q, and no other
    few = source_divergence(spark.createDataFrame([("a", "en", "s"), ("b", "en", "t")], schema)).collect()
    assert sorted(tuple(r) for r in few) == [("en", "s", "pair", "t", 0, 1), ("en", "t", "pair", "s", 0, 1)]
