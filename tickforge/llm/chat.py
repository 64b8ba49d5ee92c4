"""Operator 3: chat formatting checked by a grammar round trip (DataFrame functions only).

Grammar of the rendered text::

    conversation = { turn }
    turn         = "<s>" mark role "[/INST]" text "</s>"
    mark         = "[INST]" (role and text as they are) | "[INST+]" (both escaped)

Control strings are ``<s>``, ``</s>``, ``[INST]``, ``[INST+]`` and ``[/INST]``.  The parser is
deterministic: split at ``<s>``, then read the mark, the role up to the first ``[/INST]`` and
the text up to the closing ``</s>``.  Every turn is first rendered as it is and parsed
back; a turn that does not come back as itself alone, or holds a control string, is rendered
escaped (``&`` -> ``&amp;``, the first character of a control string -> ``&lt;`` or ``&#91;``).  The
whole conversation is then parsed back and compared with the source; one that still differs
has all turns escaped, and the operator's ``identical`` column says what the last reading gave.

The loss mask covers the text of assistant turns; its spans are code point ranges of the
rendered text.

Nulls: NULL role or text is empty, a NULL turn sorts first, rows with a NULL conversation id are
one conversation.  Equal turns are ordered by role, then text; repeated rows are repeated
turns.  A conversation is one text and so one row; its turns meet in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_CONTROL = r"</?s>|\[/?INST\]|\[INST\+\]"


def escape(text: Column) -> Column:
    plain = F.replace(text, F.lit("&"), F.lit("&amp;"))
    plain = F.regexp_replace(plain, r"<(/?s>)", "&lt;$1")
    return F.regexp_replace(plain, r"\[(/?INST\]|INST\+\])", "&#91;$1")


def unescape(text: Column) -> Column:
    for code, char in (("&#91;", "["), ("&lt;", "<"), ("&amp;", "&")):
        text = F.replace(text, F.lit(code), F.lit(char))
    return text


def _turn(role: Column, text: Column, escaped: bool) -> Column:
    mark = "<s>[INST+]" if escaped else "<s>[INST]"
    body = [escape(role), F.lit("[/INST]"), escape(text)] if escaped else [role, F.lit("[/INST]"), text]
    return F.concat(F.lit(mark), *body, F.lit("</s>"))


_GRAMMAR = r"(?s)^\[INST(\+?)\](.*?)\[/INST\](.*)</s>$"


def parse(formatted: Column) -> Column:
    """Rendered text -> array of (role, text); text outside the grammar gives NULL fields."""
    def read(part: Column) -> Column:
        ok = part.rlike(_GRAMMAR)
        raw = F.regexp_extract(part, _GRAMMAR, 1) == ""
        role, text = F.regexp_extract(part, _GRAMMAR, 2), F.regexp_extract(part, _GRAMMAR, 3)
        return F.struct(F.when(ok, F.when(raw, role).otherwise(unescape(role))).alias("role"),
                        F.when(ok, F.when(raw, text).otherwise(unescape(text))).alias("text"))

    parts = F.split(formatted, "<s>", -1)
    return F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), read)


def format_chats(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text") -> DataFrame:
    """One row per conversation: id, ``formatted``, ``loss_spans`` (array of start, length in code
    points), ``n_turns``, ``identical``."""
    role = F.coalesce(F.col(role_col).cast("string"), F.lit(""))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = turns.select(F.col(conv_col).alias("_conv"), F.col(turn_col).alias("t"), role.alias("role"),
                        text.alias("text"))
    raw = _turn(F.col("role"), F.col("text"), False)
    back = parse(raw)
    same = ((F.size(back) == 1) & F.coalesce(back[0]["role"] == F.col("role"), F.lit(False))
            & F.coalesce(back[0]["text"] == F.col("text"), F.lit(False)))
    clean = same & ~F.col("role").rlike(_CONTROL) & ~F.col("text").rlike(_CONTROL)
    rows = rows.withColumns({"soft": F.when(clean, raw).otherwise(_turn(F.col("role"), F.col("text"), True)),
                             "hard": _turn(F.col("role"), F.col("text"), True), "plain": clean})
    earlier = (Window.partitionBy("_conv").orderBy(F.col("t").asc_nulls_first(), "role", "text")
               .rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumns({f"{k}_at": F.coalesce(F.sum(F.length(k)).over(earlier), F.lit(0).cast("long"))
                             for k in ("soft", "hard")})
    turn = F.struct("t", "role", "text", "soft_at", "hard_at", "soft", "hard", "plain")
    convs = rows.groupBy("_conv").agg(F.sort_array(F.collect_list(turn)).alias("rs"))

    def text_of(variant: str) -> Column:
        return F.array_join(F.transform("rs", lambda r: r[variant]), "")

    def spans_of(variant: str) -> Column:
        def span(r: Column) -> Column:
            head = F.instr(r[variant], "[/INST]") + 6           # code points up to the text
            return F.struct((r[f"{variant}_at"] + head).alias("start"),
                            (F.length(r[variant]) - head - 4).cast("long").alias("length"),
                            (F.lit(True) if variant == "hard" else ~r["plain"]).alias("escaped"))
        return F.transform(F.filter("rs", lambda r: r["role"] == "assistant"), span)

    source = F.transform("rs", lambda r: F.struct(r["role"].alias("role"), r["text"].alias("text")))
    convs = convs.withColumns({"source": source, "soft": text_of("soft")})
    convs = convs.withColumn("ok", parse(F.col("soft")) == F.col("source"))
    convs = convs.withColumns({"formatted": F.when(F.col("ok"), F.col("soft")).otherwise(text_of("hard")),
                               "loss_spans": F.when(F.col("ok"), spans_of("soft")).otherwise(spans_of("hard"))})
    return convs.select(F.col("_conv").alias(conv_col), "formatted", "loss_spans",
                        F.size("rs").cast("long").alias("n_turns"),
                        (F.col("ok") | (parse(F.col("formatted")) == F.col("source"))).alias("identical"))


def read_chats(formatted: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """What the rendered text says, from nothing but ``formatted`` and ``loss_spans``: the turns, and
    the unescaped text under the loss mask."""
    def masked(s: Column) -> Column:
        part = F.substring("formatted", (s["start"] + 1).cast("int"), s["length"].cast("int"))
        return F.when(s["escaped"], unescape(part)).otherwise(part)

    return formatted.select(conv_col, "formatted", parse(F.col("formatted")).alias("turns"),
                            F.array_join(F.transform("loss_spans", masked), "").alias("loss_text"))


def chat_digests(formatted: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """Counts and digests of what ``read_chats`` reads back."""
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read_chats(formatted, conv_col).select(
        conv_col, F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))
