"""The five pipeline stages, each held against a plain-Python version of its own input."""

import math
from collections import defaultdict

import corpus_pipeline as pipe
from tickforge.llm.simhash import fingerprint_of
from tickforge.llm.toxicity import drop_toxic

from test_llm_operators import (
    brute_components, brute_hits, brute_lines, check_packing, corpus, tokens, words_of,
)

DOCS = "doc_id long, text string, lang string, source string, n_chars long, words string, key string"
M64 = (1 << 64) - 1


def bag(rows):
    return sorted((tuple(r) for r in rows), key=repr)


def word_hash(word):
    h = sum((c + 1) * pow(0x9E3779B97F4A7C15, i, 1 << 64) for i, c in enumerate(word.encode()))
    h = (h + len(word.encode()) * 0xD6E8FEB86659FD93) & M64
    h = ((h ^ h >> 30) * 0xBF58476D1CE4E5B9) & M64
    h = ((h ^ h >> 27) * 0x94D049BB133111EB) & M64
    return h ^ h >> 31


def toxic_by_hand(chain, text):
    at = {int(w): k for k, w in enumerate(chain.words)}
    present = {at[h] for h in map(word_hash, set(tokens(text))) if h in at}
    earlier = []
    for w in chain.weights:
        z = float(w[-1]) + sum(float(w[k]) for k in present)
        z += sum(float(w[len(at) + k]) * p for k, p in enumerate(earlier))
        earlier.append(1 / (1 + math.exp(-z)))
    return max(earlier) >= 0.5


def tables(spark, tmp_path):
    leak = words_of(40, 7, 3000)
    texts = corpus()
    texts += [(201, " ".join(words_of(30, 5) + leak[5:22] + words_of(30, 6))), (202, "leak free text of its own")]
    texts += [(k, " ".join(words_of(40, k)) + (" idiot SCUM moron" if k % 3 == 0 else "")) for k in range(1000, 1090)]
    texts += [(1003, " ".join(words_of(60, 3003))), (1001, " ".join(words_of(60, 3001)))]       # other texts under known ids
    texts += [(2000 + k, " ".join(words_of(200, 9)[:198 + k % 3])) for k in range(12)]
    docs = [(i, t, "en", "s", None if t is None else len(t), "x", "x") for i, t in texts]
    marks = [(k, 1, int(k % 3 == 0)) for k in range(1000, 1060)] + [(None, 1, 1), (1000, None, None)]
    spark.createDataFrame(docs, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, " ".join(leak)), (2, None)], "item_id long, text string") \
        .write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def test_each_stage_against_brute_force(spark, tmp_path):
    d = tables(spark, tmp_path)
    docs = spark.read.parquet(f"{d}/documents.parquet")
    chain = pipe.toxicity_chain(docs, spark.read.parquet(f"{d}/labels.parquet"))

    def by_toxicity(rows):
        assert bag(drop_toxic(docs, chain).collect()) == bag(r for r in rows if not toxic_by_hand(chain, r.text or ""))
        return [r for r in rows if not toxic_by_hand(chain, r.text or "")]

    def by_lines(rows):
        text = {(i, n): t for n, (i, t) in enumerate((r.doc_id, r.text) for r in rows)}
        cut = defaultdict(list)
        for i, t, _, _ in brute_lines([(r.doc_id, r.text) for r in rows]):
            cut[i].append(t)
        assert sum(map(len, cut.values())) == len(text)
        return sorted(((i, t) for i, ts in cut.items() for t in ts), key=repr)

    def by_fingerprint(rows):
        fp = {(r.doc_id, r.text): fingerprint_of(r.text) for r in rows if r.doc_id is not None}
        nodes = sorted(set(fp.values()))
        group = brute_components(nodes, [(a, b) for a in nodes for b in nodes if a < b and (a ^ b).bit_count() <= 3])
        least = {}
        for (i, t), f in fp.items():
            least[group[f]] = min(least.get(group[f], i), i)
        # A row stays for each group, with its smallest id.
        return sorted([*least.values(), *[None for r in rows if r.doc_id is None]], key=repr), {
            (i, t) for (i, t), f in fp.items() if least[group[f]] == i}

    def by_leak(rows):
        bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{d}/benchmark.parquet").collect()]
        bad = {h[0] for h in brute_hits([(r.doc_id, r.text) for r in rows], bench) if h[-1] and h[0] is not None}
        assert 201 in bad
        return [r for r in rows if r.doc_id not in bad]

    stages = dict(pipe.STAGES)
    assert list(stages) == ["toxicity", "line_dedup", "simhash_near_dedup", "benchmark_decontamination", "best_fit_packing"]
    before = docs.collect()
    for k, (name, stage) in enumerate(pipe.STAGES):
        out = f"{tmp_path}/stage{k}"
        stage(spark, docs, d).write.parquet(out)
        docs_after = spark.read.parquet(out)
        after = docs_after.collect()
        if name == "best_fit_packing":
            bins, total = check_packing(after, [(r.doc_id, r.text) for r in before], 2048)
            assert bins <= 1.05 * total / 2048 + 1
            break
        assert docs_after.columns == docs.columns
        if name == "toxicity":
            assert bag(after) == bag(by_toxicity(before))
            held = {r.doc_id for r in after}
            assert all((k in held) == (k % 3 != 0) for k in range(1060, 1090))
        elif name == "line_dedup":
            assert sorted(((r.doc_id, r.text) for r in after), key=repr) == by_lines(before)
        elif name == "simhash_near_dedup":
            ids, rows = by_fingerprint(before)
            assert sorted((r.doc_id for r in after), key=repr) == ids
            assert {(r.doc_id, r.text) for r in after if r.doc_id is not None} <= rows
            assert set(bag(after)) <= set(bag(before))
        else:
            assert bag(after) == bag(by_leak(before))
        docs, before = docs_after, after
    packed = pipe.run(spark, d).collect()
    key = lambda r: (r.doc_id, r.piece, r.start, r.length, r.ids_crc32)
    assert sorted(map(key, packed), key=repr) == sorted(map(key, after), key=repr)


def test_empty_tables(spark, tmp_path):
    d = tables(spark, tmp_path / "full")
    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{d}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/none/{t}.parquet")
    assert pipe.run(spark, f"{tmp_path}/none").count() == 0
