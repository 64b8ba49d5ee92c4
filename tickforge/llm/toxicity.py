"""Operator 9: toxicity by classifier chains.

Categories are predicted one after another; each category's linear model sees the document's
words and the probabilities of all earlier categories.  The earlier probabilities that a
later model is trained on are out-of-fold predictions, so they carry the errors that they have on
unseen documents.

Training, on at most ``sample`` labelled texts (smallest hash of the id first; the bound is a
parameter, and holds for rows: labels without a document use up none of it, and copies of one text
under one id are one): their distinct words are counted per category over the cluster, the ``features``
words with the largest G statistic are kept, and logistic models are fitted on their
presence.  That design matrix is at most ``sample`` x ``features`` bits.  Scoring scans
every whole text once, hashing a block's words together.

Words are those of ``common.Words`` (A-Z lower-cased digits, letters and non-ASCII characters),
known by 64-bit hash.

Nulls: a NULL text has no words; rows with a NULL id are scored like others.  Labels that
are NULL, or whose document does not exist, do not train; several labels of a document
count as the largest.  Without labels of both kinds a category's probability is its observed
share (0 without any).
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickforge.llm.common import Words, blocks, reliable, ship


# --------------------------------------------------------------- linear models

def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35, 35)))


def fit_logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1.0, steps: int = 30) -> np.ndarray:
    """Weights (bias last) of an L2-penalised logistic model, by Newton's method."""
    if not len(y) or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.0
        bias = np.log((share + 1e-6) / (1 - share + 1e-6))
        return np.append(np.zeros(x.shape[1]), bias)
    x1 = np.column_stack([x, np.ones(len(x))])
    ridge = np.append(np.full(x.shape[1], penalty), 1e-6)
    w = np.zeros(x1.shape[1])
    for _ in range(steps):
        p = _sigmoid(x1 @ w)
        grad = x1.T @ (p - y) + ridge * w
        hess = (x1 * (p * (1 - p))[:, None]).T @ x1 + np.diag(ridge)
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


@dataclass
class Chain:
    """One linear model per category over word features and earlier probabilities."""

    categories: list[str]
    words: np.ndarray                       # sorted 64-bit hashes
    weights: list[np.ndarray] = field(default_factory=list)

    def fit(self, x: np.ndarray, labels: np.ndarray, fold: np.ndarray, folds: int, penalty: float) -> Chain:
        earlier = np.zeros((len(x), 0))
        for k in range(len(self.categories)):
            inputs = np.column_stack([x, earlier])
            out = np.zeros(len(x))
            for f in range(folds):
                rest = fold != f
                w = fit_logistic(inputs[rest], labels[rest, k], penalty)
                out[~rest] = _sigmoid(inputs[~rest] @ w[:-1] + w[-1])
            self.weights.append(fit_logistic(inputs, labels[:, k], penalty))
            earlier = np.column_stack([earlier, out])
        return self

    def predict(self, doc: np.ndarray, word: np.ndarray, n: int) -> np.ndarray:
        """Probabilities (n x categories) from the (document, feature) pairs that are present."""
        out = np.zeros((n, 0))
        for w in self.weights:
            z = np.bincount(doc, weights=w[word], minlength=n) + w[-1]
            z += out @ w[len(self.words):-1]
            out = np.column_stack([out, _sigmoid(z)])
        return out


# --------------------------------------------------------------- training

def _distinct_words(batches):
    for rows, text in blocks(batches, "text"):
        words = Words(text)
        pairs = np.unique(np.stack([words.owner().astype(np.uint64), words.hashes()], axis=1), axis=0) \
            if len(words) else np.zeros((0, 2), np.uint64)
        cuts = np.searchsorted(pairs[:, 0], np.arange(len(text) + 1, dtype=np.uint64))
        hashes = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(pairs[:, 1].copy().view(np.int64)))
        yield pa.RecordBatch.from_arrays([rows.column("id"), rows.column("h"), hashes], names=["id", "h", "words"])


def _g(a: Column, b: Column, c: Column, d: Column) -> Column:
    """Signed G statistic of a 2 x 2 table; positive when the word goes with the label."""
    def term(x: Column, row: Column, col: Column) -> Column:
        return F.when(x > 0, x * F.log(x * n / (row * col))).otherwise(0.0)
    n = a + b + c + d
    g = term(a, a + b, a + c) + term(b, a + b, b + d) + term(c, c + d, a + c) + term(d, c + d, b + d)
    return 2 * F.when(a * d >= b * c, g).otherwise(-g)


def train_chain(docs: DataFrame, labels: DataFrame, categories: dict[str, Column], sample: int = 20_000,
                features: int = 128, folds: int = 5, penalty: float = 0.1, min_docs: int = 3,
                id_col: str = "doc_id", text_col: str = "text") -> Chain:
    """Fit the chain.  ``categories``: name -> 0/1 column over ``labels``, in chain order."""
    ship(docs.sparkSession)
    names = list(categories)
    known = labels.select(F.col(id_col).alias("id"), *[c.cast("int").alias(f"y{k}") for k, c in
                                                       enumerate(categories.values())])
    known = known.dropna().groupBy("id").agg(*[F.max(f"y{k}").alias(f"y{k}") for k in range(len(names))])
    text = F.col(text_col).cast("string")
    texts = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("h"), text.alias("text"))
    # Bounded rows are drawn from those that exist; an id held by many rows is folded before it is shuffled.
    pairs = (texts.select("id", "h").distinct().join(known, "id")
             .orderBy(F.xxhash64("id"), "id", "h").limit(sample))
    pairs = reliable(pairs)
    drawn = texts.join(F.broadcast(pairs.select("id", "h")), ["id", "h"], "left_semi")
    words = (drawn.mapInArrow(_distinct_words, f"id {dict(docs.dtypes)[id_col]}, h long, words array<long>")
             .dropDuplicates(["id", "h"]))
    rows = reliable(words.join(F.broadcast(pairs), ["id", "h"]))
    ys = [f"y{k}" for k in range(len(names))]
    totals = rows.agg(F.count(F.lit(1)).alias("n"), *[F.coalesce(F.sum(y), F.lit(0)).alias(y) for y in ys]).first()
    per_word = (rows.select(*ys, F.explode("words").alias("word")).groupBy("word")
                .agg(F.count(F.lit(1)).cast("double").alias("n"), *[F.sum(y).cast("double").alias(y) for y in ys])
                .where(F.col("n") >= min_docs))
    best = F.greatest(*[_g(F.col(y), F.col("n") - F.col(y), F.lit(float(totals[y])) - F.col(y),
                           F.lit(float(totals.n - totals[y])) - F.col("n") + F.col(y)) for y in ys], F.lit(0.0))
    top = per_word.select("word", best.alias("g")).where("g > 0").orderBy(F.desc("g"), "word").limit(features)
    chosen = np.array(sorted(r.word for r in top.collect()), dtype=np.int64)        # at most `features` words
    chain = Chain(names, np.sort(chosen.view(np.uint64)))
    keep = F.array(*[F.lit(int(w)) for w in chosen]).cast("array<long>") if len(chosen) else F.array().cast("array<long>")
    seen = rows.select(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(folds)).cast("int").alias("fold"), *ys,
                       F.array_intersect("words", keep).alias("words")).collect()   # at most `sample` rows
    x = np.zeros((len(seen), len(chosen)))
    for i, r in enumerate(seen):
        x[i, np.searchsorted(chain.words, np.array(r.words, dtype=np.int64).view(np.uint64))] = 1.0
    y = np.array([[r[c] for c in ys] for r in seen], dtype=float).reshape(len(seen), len(ys))
    return chain.fit(x, y, np.array([r.fold for r in seen]), folds, penalty)


# --------------------------------------------------------------- scoring

def _score(chain: Chain):
    lut = np.zeros(1 << 16, dtype=bool)
    lut[(chain.words & np.uint64(0xFFFF)).astype(np.int64)] = True

    def run(batches):
        for rows, text in blocks(batches, "text"):
            words = Words(text)
            h = words.hashes()
            maybe = np.flatnonzero(lut[(h & np.uint64(0xFFFF)).astype(np.int64)])
            at = np.searchsorted(chain.words, h[maybe])
            hit = at < len(chain.words)
            hit[hit] = chain.words[at[hit]] == h[maybe][hit]
            doc = np.searchsorted(words.first, maybe[hit], side="right") - 1
            pairs = np.unique(doc * (len(chain.words) + 1) + at[hit])
            p = chain.predict(pairs // (len(chain.words) + 1), pairs % (len(chain.words) + 1), len(text))
            yield pa.RecordBatch.from_arrays(
                [*(rows.column(c) for c in rows.schema.names if c != "text"),
                 *(pa.array(p[:, k]) for k in range(len(chain.categories)))],
                names=[*(c for c in rows.schema.names if c != "text"), *[f"p_{c}" for c in chain.categories]])

    return run


def score_toxicity(docs: DataFrame, chain: Chain, threshold: float = 0.5, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """id, a probability ``p_<category>`` each, ``toxic`` (some category reaches the threshold)."""
    ship(docs.sparkSession)
    p = [f"p_{c}" for c in chain.categories]
    schema = f"id {dict(docs.dtypes)[id_col]}, " + ", ".join(f"`{c}` double" for c in p)
    scored = (docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
              .mapInArrow(_score(chain), schema))
    toxic = F.lit(False)
    for c in p:
        toxic = toxic | (F.col(c) >= threshold)
    return scored.select(F.col("id").alias(id_col), *p, toxic.alias("toxic"))


def drop_toxic(docs: DataFrame, chain: Chain, threshold: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that no category rejects, with their columns, judged row by row."""
    ship(docs.sparkSession)
    score = _score(chain)

    def judge(batches):
        for batch in batches:
            text = batch.column(text_col).cast(pa.string())
            one = pa.RecordBatch.from_arrays([text], names=["text"])
            p = [np.column_stack([c.to_numpy() for c in out.columns]).max(axis=1) for out in score([one])]
            keep = np.concatenate(p) < threshold if p else np.zeros(0, bool)
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(judge, docs.schema)
