"""Operator 12: fill-in-middle transformation by one counted-quantifier match per row.

``regexp_count`` gives a text's length n in units (code points, ``.`` in dot-all mode).  Two hashed
cut points a <= b make the row's own pattern, ``\\A(.{a}+)(.{b-a}+)(.*+)\\z``: possessive counted
quantifiers take prefix and middle without ever giving a unit back, so one match reads each text
once, left to right, and its three groups are put into the output by ``regexp_replace``.  Counting
goes by runs of 1024 units and then by the units after the last run, so that no text becomes an
array of single characters.

Forms: ``psm`` is <P>prefix<S>suffix<M>middle, ``spm`` <S>suffix<P>prefix<M>middle, ``plain`` the
text as it is: when it is empty, holds a sentinel itself, or is drawn to stay.  Sentinels must start
with a character that is nowhere else in them, so that none can arise where pieces meet;
``restore`` then finds them again by the first of each and gives back the exact text.

The draws are the first four 8-digit groups of sha256(``<salt>:<id>``), so they do not depend on
partitions, order or retries.

Nulls: a NULL text is empty and stays plain; a NULL id draws with an empty id.  Rows sharing an id
share their draws, not their cuts; repeated rows give repeated rows.  Only the columns named here
are returned, so further columns of the input cannot clash.  An empty table gives no rows.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SENTINELS = ("<P>", "<S>", "<M>")
_RUN = 1024


def units(text: Column) -> Column:
    """Code points of a text, counted by regexp."""
    runs = F.regexp_count(text, F.lit(f"(?s).{{{_RUN}}}+"))
    rest = F.regexp_extract(text, rf"(?s)\A(?:.{{{_RUN}}}+)*+(.*+)\z", 1)
    return (runs * _RUN + F.regexp_count(rest, F.lit("(?s)."))).cast("long")


def _draw(digest: Column, k: int) -> Column:
    return F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long")


def _checked(sentinels: tuple[str, str, str]) -> tuple[str, str, str]:
    if len(set(sentinels)) != 3 or any(not s or s[0] in s[1:] or s[0] != sentinels[0][0] for s in sentinels) \
            or any(a != b and b.startswith(a) for a in sentinels for b in sentinels):
        raise ValueError("sentinels must differ, share a first character that they hold nowhere else, "
                         "and none may begin another")
    return sentinels


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salt: str = "1",
                   fim_percent: int = 90, spm_percent: int = 20,
                   sentinels: tuple[str, str, str] = SENTINELS) -> DataFrame:
    """Per row: ``doc_id``, ``n``, ``form``, ``prefix_chars``, ``middle_chars`` and the ``output`` text."""
    p, s, m = _checked(sentinels)
    text, key = F.col("text"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    rows = (docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
            .withColumn("n", units(text))
            .withColumn("d", F.sha2(F.concat(F.lit(f"{salt}:"), key), 256)))
    cut = rows.select("doc_id", "text", "n", *(_draw(F.col("d"), k).alias(f"h{k + 1}") for k in range(4)))
    cut = cut.select("doc_id", "text", "n", "h3", "h4", (F.col("h1") % (F.col("n") + 1)).alias("x"),
                     (F.col("h2") % (F.col("n") + 1)).alias("y"))
    holds = F.lit(False)
    for t in (p, s, m):
        holds = holds | F.contains(text, F.lit(t))
    plain = (F.col("n") == 0) | holds | (F.col("h3") % 100 >= fim_percent)
    form = F.when(plain, "plain").when(F.col("h4") % 100 < spm_percent, "spm").otherwise("psm")
    formed = cut.select("doc_id", "text", "n", form.alias("form"), F.least("x", "y").alias("a"),
                        F.abs(F.col("x") - F.col("y")).alias("b_a"))
    kept = F.col("form") == "plain"
    pattern = F.format_string(r"(?s)\A(.{%d}+)(.{%d}+)(.*+)\z", "a", "b_a")
    quoted = [t.replace("\\", "\\\\").replace("$", "\\$") for t in (p, s, m)]
    psm, spm = (quoted[0] + "$1" + quoted[1] + "$3" + quoted[2] + "$2",
                quoted[1] + "$3" + quoted[0] + "$1" + quoted[2] + "$2")
    order = F.when(F.col("form") == "psm", psm).otherwise(spm)
    output = F.when(kept, text).otherwise(F.regexp_replace(text, pattern, order))
    return formed.select("doc_id", "n", "form", F.when(~kept, F.col("a")).alias("prefix_chars"),
                         F.when(~kept, F.col("b_a")).alias("middle_chars"), output.alias("output"))


def restore(output: Column, form: Column, sentinels: tuple[str, str, str] = SENTINELS) -> Column:
    """The text that ``fill_in_middle`` was given, from its output and form alone."""
    p, s, m = (re.escape(t) for t in _checked(sentinels))
    # In psm, prefix and suffix end where the next sentinel first occurs; so in spm.
    psm = F.regexp_replace(output, rf"(?s)\A{p}(.*?){s}(.*?){m}(.*+)\z", "$1$3$2")
    spm = F.regexp_replace(output, rf"(?s)\A{s}(.*?){p}(.*?){m}(.*+)\z", "$2$3$1")
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def fim_digests(formed: DataFrame) -> DataFrame:
    """The rows of ``fill_in_middle`` with digests in place of texts."""
    return formed.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                         F.sha2("output", 256).alias("output_sha256"),
                         F.sha2(restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"))
