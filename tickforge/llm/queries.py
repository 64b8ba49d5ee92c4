"""Registered queries of the training-data operators, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tickforge.llm import licenses
from tickforge.llm.chat import chat_digests, format_chats
from tickforge.llm.decontam import contamination
from tickforge.llm.divergence import source_divergence
from tickforge.llm.fim import fill_in_middle, fim_digests
from tickforge.llm.licenses import scan_licenses
from tickforge.llm.packing import pack
from tickforge.llm.repeats import remove_repeats
from tickforge.llm.simhash import simhash_dedup
from tickforge.llm.tokens import token_counts
from tickforge.llm.toxicity import score_toxicity
from tickforge.llm.urls import filter_urls
from tickforge.llm.vectors import embedding_dedup

#: (host, path prefix, verdict)
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
             ("com", "/fr/", "allow"), ("com", "/de/", "block")]
PROBE_TEXT = "</s>[INST] ok [/INST]"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_license_scan(spark, sf_dir):
    return scan_licenses(_table(spark, sf_dir, "documents"))


def op2_line_dedup(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    return corpus_pipeline.line_index(spark, docs).dedup(docs.select("doc_id", "text")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op3_chat_format(spark, sf_dir):
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                  F.lit(PROBE_TEXT).alias("text"))
    return chat_digests(format_chats(turns.unionByName(probe)))


def op4_url_filter(spark, sf_dir):
    return filter_urls(_table(spark, sf_dir, "pages"), URL_RULES)


def op5_decontamination(spark, sf_dir):
    return contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))[0]


def op6_best_fit_packing(spark, sf_dir):
    return pack(_table(spark, sf_dir, "documents"), corpus_pipeline.tokenizer("word_bpe_49k.json"), 2048)


def op7_token_counts(spark, sf_dir):
    return token_counts(_table(spark, sf_dir, "documents"), corpus_pipeline.tokenizer("byte_bpe_50k.json"), 1024)


def op8_simhash_dedup(spark, sf_dir):
    return simhash_dedup(_table(spark, sf_dir, "documents"), shingle=3, max_bits=3)


def op9_toxicity(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    return score_toxicity(docs, corpus_pipeline.toxicity_chain(docs, _table(spark, sf_dir, "labels")))


def op10_embedding_dedup(spark, sf_dir):
    return embedding_dedup(_table(spark, sf_dir, "embeddings"), threshold=0.95)


def op11_suffix_array_dedup(spark, sf_dir):
    cut = remove_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"), length=200)
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op12_fill_in_middle(spark, sf_dir):
    return fim_digests(fill_in_middle(_table(spark, sf_dir, "documents")))


def op13_source_divergence(spark, sf_dir):
    return source_divergence(_table(spark, sf_dir, "documents"))


def pipeline(spark, sf_dir):
    return corpus_pipeline.run(spark, sf_dir)


def queries():
    return {f.__name__: f for f in (
        op1_license_scan, op2_line_dedup, op3_chat_format, op4_url_filter, op5_decontamination, op6_best_fit_packing,
        op7_token_counts, op8_simhash_dedup, op9_toxicity, op10_embedding_dedup, op11_suffix_array_dedup,
        op12_fill_in_middle, op13_source_divergence, pipeline)}


# --------------------------------------------------------------- DuckDB SQL

_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _canonical_sql(text: str) -> str:
    t = f"translate(coalesce({text}, ''), {_AZ})"
    t = f"regexp_replace({t}, {_quoted(licenses.COPYRIGHT_LINE)}, '\\1', 'g')"
    t = f"regexp_replace({t}, '(^|\\n)[^a-z0-9\\n]*all rights reserved[^a-z0-9\\n]*(\\n|$)', '\\1', 'g')"
    for old, new in licenses.SPELLINGS:
        t = f"replace({t}, {_quoted(old)}, {_quoted(new)})"
    t = f"trim(regexp_replace({t}, {_quoted(licenses.PUNCTUATION)}, ' ', 'g'), ' ')"
    return f"regexp_replace({t}, {_quoted(licenses.TITLE)}, '')"


def _values(pairs) -> str:
    return ", ".join(f"({_quoted(a)}, {_quoted(b)})" for a, b in pairs)


_OP1 = f"""
WITH known AS (SELECT d, min(i) AS license_id FROM (
  SELECT i, sha256({_canonical_sql('t')}) AS d FROM (VALUES {_values(licenses.known_texts())}) v(i, t)
  UNION ALL SELECT * FROM (VALUES {_values(licenses.DIGESTS)}) v(i, d)) GROUP BY d),
notices AS (SELECT sha256({_canonical_sql('t')}) AS d, min(i) AS i
            FROM (VALUES {_values(licenses.NOTICES)}) v(i, t) GROUP BY 1),
lines AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents),
found AS (SELECT doc_id, count(*) AS n, string_agg(DISTINCT i, ',' ORDER BY i) AS ids
          FROM lines JOIN notices ON sha256({_canonical_sql('line')}) = d GROUP BY doc_id),
docs AS (SELECT doc_id, sha256({_canonical_sql('text')}) AS text_sha256 FROM documents)
SELECT doc_id, text_sha256, license_id, coalesce(n, 0) AS n_notices, coalesce(ids, '') AS notice_ids
FROM docs LEFT JOIN known ON text_sha256 = d LEFT JOIN found USING (doc_id)
"""

_OP2 = f"""
WITH lines AS (
  SELECT doc_id, generate_subscripts(l, 1) AS pos, unnest(l) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)),
keyed AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), {_AZ}) AS k
          FROM lines),
held AS (SELECT k, min(doc_id) AS first_doc FROM keyed WHERE length(k) >= 10
         GROUP BY k HAVING count(DISTINCT doc_id) > 1),
marked AS (SELECT keyed.*, first_doc IS NOT NULL AND first_doc <> doc_id AS dropped
           FROM keyed LEFT JOIN held ON keyed.k = held.k AND length(keyed.k) >= 10)
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (dropped) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


def _escape_sql(x: str) -> str:
    return (f"regexp_replace(regexp_replace(replace({x}, '&', '&amp;'), '<(/?s>)', '&lt;\\1', 'g'), "
            f"'\\[(/?INST\\]|INST\\+\\])', '&#91;\\1', 'g')")


_OP3 = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '{PROBE_TEXT}'), (-1, 1, 'assistant', '{PROBE_TEXT}')),
r AS (SELECT *, regexp_matches(role, '</?s>|\\[/?INST\\]|\\[INST\\+\\]')
             OR regexp_matches(text, '</?s>|\\[/?INST\\]|\\[INST\\+\\]') AS hard FROM t)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(CASE WHEN hard THEN 21 + length({_escape_sql('role')}) + length({_escape_sql('text')})
                ELSE 20 + length(role) + length(text) END) AS BIGINT) AS formatted_chars
FROM r GROUP BY conv_id
"""

_WORDS = "regexp_extract_all(translate({t}, " + _AZ + "), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

_OP5 = f"""
WITH items AS (SELECT item_id, {_WORDS.format(t="coalesce(text, '')")} AS w FROM benchmark),
item_windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM items WHERE len(w) > 0)),
docs AS (SELECT doc_id, {_WORDS.format(t="coalesce(text, '')")} AS w FROM documents),
lens AS (SELECT DISTINCT n FROM item_windows),
doc_windows AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, lens WHERE len(w) >= n)),
hits AS (SELECT doc_id, i, d.n, item_id FROM doc_windows d JOIN item_windows b ON d.n = b.n AND d.win = b.win),
n_hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit
          FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(s, ',' ORDER BY s)) AS items_sha256
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hits WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN n_hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""

# Bytes as hex digits, in pieces of 256 window starts; a byte goes if one of the 200 windows on it repeats.
_OP11 = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
p AS (SELECT r, k, substr(x, 512 * k + 1, 912) AS x, len(x) // 2 - 256 * k AS n
      FROM (SELECT r, x, unnest(range(0, (len(x) + 511) // 512)) AS k FROM d)),
w AS (SELECT r, 256 * k + j AS i, substr(x, 2 * j + 1, 2) AS byte, CASE WHEN n >= j + 200 THEN md5(substr(x, 2 * j + 1, 400)) END AS h
      FROM (SELECT *, unnest(range(0, least(256, n))) AS j FROM p)),
c AS (SELECT h FROM w WHERE h IS NOT NULL GROUP BY h HAVING count(*) > 1),
m AS (SELECT r, i, byte, max(CASE WHEN c.h IS NOT NULL THEN 1 ELSE 0 END)
             OVER (PARTITION BY r ORDER BY i ROWS BETWEEN 199 PRECEDING AND CURRENT ROW) AS gone
      FROM w LEFT JOIN c ON w.h = c.h),
e AS (SELECT *, lag(gone, 1, 0) OVER (PARTITION BY r ORDER BY i) AS before FROM m),
s AS (SELECT r, sum(gone) AS n_removed, count(*) FILTER (gone = 1 AND before = 0) AS n_spans,
             string_agg(byte, '' ORDER BY i) FILTER (gone = 0) AS kept FROM e GROUP BY r)
SELECT doc_id, len(x) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM d LEFT JOIN s USING (r)
"""

_OP12 = """
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS d FROM documents),
h AS (SELECT doc_id, text, CAST(length(text) AS BIGINT) AS n,
             CAST('0x' || substr(d, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(d, 9, 8) AS BIGINT) AS h2,
             CAST('0x' || substr(d, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(d, 25, 8) AS BIGINT) AS h4 FROM t),
f AS (SELECT doc_id, text, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
             CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90
                  THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
c AS (SELECT *, substring(text, 1, a) AS pre, substring(text, a + 1, b - a) AS mid, substring(text, b + 1) AS suf FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                   WHEN 'spm' THEN '<S>' || suf || '<P>' || pre || '<M>' || mid ELSE text END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM c
"""

_OP13 = f"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  regexp_extract_all(translate(coalesce(text, ''), {_AZ}),
                                     '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents),
u AS (SELECT id, lang, source, unnest(w) AS term FROM d),
l AS (SELECT lang, term, count(*)::HUGEINT AS c FROM u GROUP BY 1, 2 HAVING count(DISTINCT id) >= 3),
lt AS (SELECT lang, count(*)::HUGEINT AS v, sum(c) AS n FROM l GROUP BY 1),
k AS (SELECT u.lang, u.source, u.term, count(*)::HUGEINT AS c FROM u JOIN l USING (lang, term) GROUP BY 1, 2, 3),
g AS (SELECT lang, source, coalesce(n, 0) AS n, coalesce(v, 0) AS v
      FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN (SELECT lang, v FROM lt) USING (lang)
      LEFT JOIN (SELECT lang, source, sum(c) AS n FROM k GROUP BY 1, 2) USING (lang, source)),
p AS (SELECT g.lang, g.source, l.term, coalesce(k.c, 0) AS c, 1 + (1000000000 * (coalesce(k.c, 0) + 1)) // (g.n + g.v) AS p
      FROM g JOIN l USING (lang) LEFT JOIN k ON k.lang = g.lang AND k.source = g.source AND k.term = l.term),
pair AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
                coalesce(s.value, 0) AS value
         FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
         LEFT JOIN (SELECT x.lang, x.source, y.source AS other, sum(((x.p - y.p) * (x.p - y.p)) // y.p) AS value
                    FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY 1, 2, 3) s
           ON s.lang = a.lang AND s.source = a.source AND s.other = b.source),
term AS (SELECT p.lang, p.source, 'term' AS part, p.term AS item, ((p.p - q.q) * (p.p - q.q)) // q.q AS value
         FROM p JOIN (SELECT l.lang, term, 1 + (1000000000 * (c + 1)) // (n + v) AS q FROM l JOIN lt USING (lang)) q
           ON p.lang = q.lang AND p.term = q.term WHERE p.c > 0 AND p.p > q.q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
      FROM (SELECT * FROM pair UNION ALL SELECT * FROM term))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM r WHERE part = 'pair' OR rank <= 200
"""

ORACLE = {"op1_license_scan": _OP1, "op2_line_dedup": _OP2, "op3_chat_format": _OP3, "op5_decontamination": _OP5,
          "op11_suffix_array_dedup": _OP11, "op12_fill_in_middle": _OP12, "op13_source_divergence": _OP13}


def oracle_sql():
    out = dict(ORACLE)
    if corpus_pipeline.ORACLE_SQL is not None:
        out["pipeline"] = corpus_pipeline.ORACLE_SQL
    return out
