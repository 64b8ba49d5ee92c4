"""A training corpus in five stages, each one of the operators in ``tickforge.llm``.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of
``documents``.  ``run`` writes each stage's rows to the shared folder and hands the next stage what
was written, so a lost executor costs at most one stage's tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge.llm.decontam import drop_contaminated
from tickforge.llm.lines import LineIndex
from tickforge.llm.packing import pack
from tickforge.llm.simhash import keep_one_per_group
from tickforge.llm.toxicity import Chain, drop_toxic, train_chain
from tickforge.session import staging_dir


def tokenizer(name: str) -> str:
    """Where a public tokenizer's file lies on this machine (and on every worker)."""
    import public_tokenizers
    return public_tokenizers.path(name)


def toxicity_chain(docs: DataFrame, labels: DataFrame) -> Chain:
    """Two categories, in chain order: toxic at all, and toxic in a document of low quality."""
    toxic = F.col("toxic") == 1
    return train_chain(docs, labels, {"toxic": toxic, "toxic_junk": toxic & (F.col("quality") == 0)})


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return drop_toxic(docs, toxicity_chain(docs, labels))


def line_index(spark: SparkSession, docs: DataFrame) -> LineIndex:
    """All documents in an index with references, as an index grows: half of the ids (by hash), then the
    other half; the document with the smallest id is deleted and put back."""
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    lines = docs.select("doc_id", "text")
    index = LineIndex.create(spark).insert(lines.where(half)).insert(lines.where(~half))
    first = docs.agg(F.min("doc_id").alias("doc_id"))
    return index.delete(first).insert(lines.join(F.broadcast(first), "doc_id", "left_semi"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_index(spark, docs).dedup(docs, counts=False)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: the smallest id; rows without an id all stay."""
    return keep_one_per_group(docs, shingle=3, max_bits=3)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, tokenizer("word_bpe_49k.json"), 2048)


STAGES = [
    ("toxicity", reject_toxic),
    ("line_dedup", dedup_lines),
    ("simhash_near_dedup", dedup_documents),
    ("benchmark_decontamination", decontaminate),
    ("best_fit_packing", pack_sequences),
]

#: Fitted models, fingerprints and a packing search are beyond SQL; tests/llm holds the pipeline
#: against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        out = staging_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
