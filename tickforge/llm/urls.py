"""Operator 4: URL filter with rules and gradient-boosted trees (DataFrame functions only).

Rules decide first: a rule is a host and a path prefix; it fits its host and all subdomains
when the url's path starts with the rule's, and the longest fitting rule wins.  The urls that
rules decide are the labelled urls; trees are boosted on their lexical features -- length,
depth, digit ratio, entropy, parameter and hyphen counts, host labels, and how often urls of the
same host suffix and domain are blocked -- and judge the urls that no rule fits.

Suffix and domain statistics are taken from all distinct labelled urls, by aggregation and a
shuffle join.  The trees are fitted on urls of one half (by hash) with the rates of the other half, so
no training row's label shows in its rates -- leaving out just its own would show it, reversed.  Only the rows that the trees
are fitted on are bounded: ``sample`` distinct urls of their half, smallest hash first.  So neither the
cut of the table, nor repeats of a url, nor further rows of other domains change what a page's
features are.  The rules are a bounded parameter and become part of the expression.

Nulls: a NULL url, or one without ``://``, has an empty host and path.  Without labelled
urls of both kinds there is nothing to learn: the rest is allowed (or takes the only, or the more frequent, label).
Repeated rows give repeated rows, judged alike; an empty table gives none.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickforge.llm.common import reliable

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FEATURES = ["n_chars", "n_host", "n_path", "depth", "digit_ratio", "entropy", "n_params", "n_hyphens", "n_labels",
            "is_https", "suffix_rate", "domain_rate"]


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path) of a url."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """The longest fitting rule as a struct (rule, verdict), or NULL.  ``rules``: (host, path, verdict)."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for h, p, verdict in sorted(rules, key=lambda r: (len(r[0]) + len(r[1]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def lexical(urls: DataFrame) -> DataFrame:
    """Features of ``url``, ``host``, ``path`` (all from the url's characters)."""
    url = F.coalesce("url", F.lit(""))
    chars = F.split(url, "")
    n = F.greatest(F.length(url), F.lit(1))

    def count(c: Column, pattern: str) -> Column:
        return (F.length(c) - F.length(F.regexp_replace(c, pattern, ""))).cast("double")

    def share(c: Column) -> Column:
        p = F.size(F.filter("_chars", lambda x: x == c)) / F.size("_chars")
        return -p * F.log2(p)

    labels = F.split("host", r"\.")
    return (urls.withColumn("_chars", chars)
            .withColumns({
                "n_chars": F.length(url).cast("double"), "n_host": F.length("host").cast("double"),
                "n_path": F.length("path").cast("double"), "depth": count(F.col("path"), "/"),
                "digit_ratio": count(url, "[0-9]") / n,
                "entropy": F.aggregate(F.array_distinct("_chars"), F.lit(0.0), lambda a, c: a + share(c)),
                "n_params": count(F.regexp_extract(url, r"\?([^#]*)", 1), "=").cast("double"),
                "n_hyphens": count(F.col("host"), "-"), "n_labels": F.size(labels).cast("double"),
                "is_https": url.startswith("https://").cast("double"),
                "suffix": F.element_at(labels, -1),
                "domain": F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2), ".")})
            .drop("_chars"))


#: Tasks that the urls of one suffix or domain are dealt over when they are joined with its rate.
_SALTS = 16


def _with_rates(rows: DataFrame, stats: dict[str, DataFrame], prior: float, weight: float,
                half: bool = False) -> DataFrame:
    """``<k>_rate`` per suffix and domain, drawn to ``prior`` with ``weight``; ``half``: of the urls that no
    tree is fitted on."""
    salt = F.pmod(F.xxhash64("url"), F.lit(_SALTS))
    bad, n = ("_half_bad", "_half_n") if half else ("_bad", "_n")
    for k, table in stats.items():
        every = table.select(k, F.col(bad).alias("_b"), F.col(n).alias("_k"),
                             F.explode(F.sequence(F.lit(0).cast("long"), F.lit(_SALTS - 1).cast("long"))).alias("_salt"))
        # One key of both, so that neither side can be dealt out by the suffix alone.
        every = every.select(F.struct(k, "_salt").alias("_key"), "_b", "_k")
        rate = (F.coalesce("_b", F.lit(0.0)) + weight * prior) / (F.coalesce("_k", F.lit(0.0)) + weight)
        rows = (rows.withColumn("_key", F.struct(F.col(k), salt.alias("_salt"))).join(every, "_key", "left")
                .withColumn(f"{k}_rate", rate).drop("_key", "_b", "_k"))
    return rows


def _fitted_half() -> Column:
    """Whether trees may be fitted on a url."""
    return F.pmod(F.xxhash64("url", F.lit(1)), F.lit(2)) == 0


class UrlModel:
    """Boosted trees over lexical features; ``constant`` when there was nothing to learn."""

    def __init__(self, trees, stats: dict[str, DataFrame], prior: float, weight: float, constant: str | None):
        self.trees, self.stats, self.prior, self.weight, self.constant = trees, stats, prior, weight, constant

    def judge(self, urls: DataFrame) -> DataFrame:
        """``urls`` (with url, host, path) plus ``score``, the probability of block."""
        if self.constant is not None:
            return urls.withColumn("score", F.lit(1.0 if self.constant == "block" else 0.0))
        rows = _with_rates(lexical(urls), self.stats, self.prior, self.weight)
        rows = VectorAssembler(inputCols=FEATURES, outputCol="_features").transform(rows)
        scored = self.trees.transform(rows).withColumn("score", vector_to_array("probability")[1])
        return scored.select(*urls.columns, "score")


def train_urls(labelled: DataFrame, sample: int = 20_000, trees: int = 10, depth: int = 4, weight: float = 10.0) -> UrlModel:
    """Statistics from all distinct rows of ``labelled`` (url, host, path, label: 1.0 for block); trees
    fitted on at most ``sample`` of them."""
    known = reliable(lexical(labelled.distinct()).select("url", "host", "path", "label", "suffix", "domain"))
    seen = known.agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("bad")).first()
    if not seen.n or seen.bad in (0, seen.n):
        return UrlModel(None, {}, 0.0, weight, "block" if seen.n and seen.bad else "allow")
    prior = seen.bad / seen.n
    other = F.when(_fitted_half(), 0.0).otherwise(1.0)
    stats = {k: reliable(known.groupBy(k).agg(
        F.sum("label").alias("_bad"), F.sum(F.lit(1.0)).alias("_n"), F.sum(other * F.col("label")).alias("_half_bad"),
        F.sum(other).alias("_half_n"))) for k in ("suffix", "domain")}
    drawn = (known.where(_fitted_half()).select("url", "host", "path", "label")
             .orderBy(F.xxhash64("url"), "url", "label").limit(sample))
    if drawn.select("label").distinct().count() < 2:
        return UrlModel(None, {}, prior, weight, "block" if prior >= 0.5 else "allow")
    rows = _with_rates(lexical(drawn), stats, prior, weight, half=True)
    rows = VectorAssembler(inputCols=FEATURES, outputCol="_features").transform(rows)
    # At most `sample` rows, in a fixed order, so that a fit can be repeated.
    rows = reliable(rows.select("_features", "label", "url").orderBy(F.xxhash64("url"), "url", "label").limit(sample)
                    .select("_features", "label"))
    # Each split sees a third of the features: where several tell the urls apart, all have a say.
    fit = GBTClassifier(featuresCol="_features", labelCol="label", maxIter=trees, maxDepth=depth, stepSize=0.3, seed=1,
                        featureSubsetStrategy="onethird", predictionCol="_prediction").fit(rows)
    return UrlModel(fit, stats, prior, weight, None)


def filter_urls(pages: DataFrame, rules: list[tuple[str, str, str]], threshold: float = 0.5, id_col: str = "page_id",
                url_col: str = "url", **training) -> DataFrame:
    """id, ``host``, ``path``, ``rule``, ``verdict`` (allow or block), ``score`` (NULL where a rule decided)."""
    url = F.col(url_col).cast("string")
    host, path = url_parts(url)
    rows = pages.select(F.col(id_col), url.alias("url"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("_r", rule_for(F.col("host"), F.col("path"), rules))
    ruled = rows.where("_r IS NOT NULL").select("url", "host", "path",
                                                (F.col("_r.verdict") == "block").cast("double").alias("label"))
    model = train_urls(ruled, **training)
    judged = model.judge(rows)
    return judged.select(id_col, "host", "path", F.col("_r.rule").alias("rule"),
                         F.coalesce("_r.verdict", F.when(F.col("score") >= threshold, "block").otherwise("allow"))
                         .alias("verdict"),
                         F.when(F.col("_r").isNull(), F.col("score")).alias("score"))
