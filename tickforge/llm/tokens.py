"""Operator 7: exact token counts with overlap resynchronisation, and the word-wise
encoder that packing uses.

A document of more than ``huge`` characters is cut into chunks with an overlap, each row a
task's work of its own, so no document is encoded as a whole.  A chunk's encoding
starts in the middle of things, so its first tokens may differ from the document's; both
neighbours' encodings are therefore compared in the overlap and spliced at a boundary
that is proven stable: a token ends there in both, a white space follows a character
that is none, and no special string runs across.  The tokenizer's split never joins a
character to a white space after it, so from such a place on the encoding depends only
on what follows, and up to it only on what went before.  Where an overlap
holds no such place (a long run without white space) the pair's chunks are encoded again
with a doubled overlap, until all splices hold or the overlap is the rest of the document.

Within a task, texts are split at single spaces and line ends -- stable places -- and each
distinct piece is encoded once by the library; texts with any other white space go through
the library whole.

Nulls: a NULL text is empty.  Rows that share a ``doc_id`` are counted separately.
"""

from __future__ import annotations

import itertools
import json
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickforge.llm.common import blocks, reliable, ship

# White space of the tokenizers' patterns and Python's that the fast split does not handle.
_OTHER_SPACE = "[\\t\\r\\x0b\\x0c\\x1c-\\x1f\\x{85}\\x{180e}\\x{200b}]|[\\p{Zl}\\p{Zp}]|\\x{a0}|\\x{1680}|[\\x{2000}-\\x{200a}]|\\x{202f}|\\x{205f}|\\x{3000}"
_NOT_PLAIN = "^ | $|[ \\n]{2}|" + _OTHER_SPACE
# What a worker remembers: words (about 200 bytes each) and their characters in all.
_CACHE_WORDS = 1_000_000
_CACHE_CHARS = 1 << 25
_GROUP = 500


def _library(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


# A normalizer and a split that, within a word of printable ASCII, only lower-case it and cut it where the pattern says.
_SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
_NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
_PRE_TOKENIZERS = [
    {"type": "Split", "pattern": {"Regex": _SPLIT}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
]
# The same split for lower-cased printable ASCII.
_PIECES = "'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+"


def _plain_library(path: str, library):
    """The library with the same model for pieces already lower-cased and cut, or None for other normalizers and splits."""
    with open(path, encoding="utf-8") as f:
        said = json.load(f)
    if ((said["normalizer"] or {}).get("normalizers") != _NORMALIZERS
            or (said["pre_tokenizer"] or {}).get("pretokenizers") != _PRE_TOKENIZERS):
        return None
    from tokenizers import Tokenizer
    from tokenizers.pre_tokenizers import WhitespaceSplit
    plain = Tokenizer(library.model)
    plain.pre_tokenizer = WhitespaceSplit()
    return plain


class WordEncoder:
    """Ids of texts whose tokenizer drops white space: every word is encoded on its own.

    A word of printable ASCII is lower-cased and cut into the pieces that the tokenizer's
    pattern makes of it ("Word," is "word" and ","), and a worker remembers pieces; a word
    with any other character or a special string is one piece, marked as ``WHOLE``.  The
    distinct pieces of a block that are not in the worker's memory are encoded together.
    Whole words are separated by a control character standing as a word of its own; a word
    that holds that character, or any text in which the character's id is ambiguous, is
    encoded alone.
    """

    _made: dict[str, WordEncoder] = {}
    MARK = "\x07"
    WHOLE = "\n"

    @classmethod
    def shared(cls, path: str) -> WordEncoder:
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def __init__(self, path: str):
        self.library = _library(path)
        self.plain = _plain_library(path, self.library)
        specials = [re.escape(t.content.lower()) for t in self.library.get_added_tokens_decoder().values()]
        self.odd = "|".join(["[^!-~]", *specials])      # in a lower-cased word
        ids = self.library.encode(self.MARK, add_special_tokens=False).ids
        self.mark = ids[0] if len(ids) == 1 else None
        self.place: dict[str, int] = {"": 0}    # piece -> its number
        self.first = np.zeros(2, np.int64)  # where each piece's ids start, and their end
        self.pool = np.zeros(0, np.uint32)
        self.chars = 0

    def _forget_but(self, pieces: list[str]) -> None:
        """Make room, keeping the given pieces where known: those seen now are the likeliest to come again."""
        kept = ["", *(p for p in pieces if p and p in self.place)]
        old = np.fromiter((self.place[p] for p in kept), np.int64, len(kept))
        start, n = self.first[old], self.first[old + 1] - self.first[old]
        self.first = np.concatenate(([0], np.cumsum(n)))
        self.pool = self.pool[np.arange(self.first[-1]) + np.repeat(start - self.first[:-1], n)]
        self.place = {p: i for i, p in enumerate(kept)}
        self.chars = sum(map(len, kept))

    def _learn(self, pieces: list[str]) -> None:
        plain = [p for p in pieces if p[0] != self.WHOLE]
        words = [p[1:] for p in pieces if p[0] == self.WHOLE]
        together = [w for w in words if self.mark is not None and self.MARK not in w]
        alone = [w for w in words if self.mark is None or self.MARK in w]
        parts, counts = [], []
        groups = [plain[i:i + _GROUP] for i in range(0, len(plain), _GROUP)]
        if groups:
            encoded = self.plain.encode_batch([" ".join(g) for g in groups], add_special_tokens=False)
            for group, enc in zip(groups, encoded):
                parts.append(np.array(enc.ids, dtype=np.uint32))
                counts.append(np.bincount(np.array(enc.word_ids, dtype=np.int64), minlength=len(group)))
        groups = [together[i:i + _GROUP] for i in range(0, len(together), _GROUP)]
        sep = f" {self.MARK} "
        encoded = self.library.encode_batch_fast([sep.join(g) for g in groups], add_special_tokens=False)
        for group, enc in zip(groups, encoded):
            ids = np.array(enc.ids, dtype=np.uint32)
            cuts = np.flatnonzero(ids == self.mark)
            if len(cuts) != len(group) - 1:     # a word shares the mark's id
                alone += group
                groups = [g for g in groups if g is not group]
                continue
            parts.append(np.delete(ids, cuts))
            counts.append(np.diff(np.concatenate(([-1], cuts, [len(ids)]))) - 1)
        for w, enc in zip(alone, self.library.encode_batch_fast(alone, add_special_tokens=False)):
            parts.append(np.array(enc.ids, dtype=np.uint32))
            counts.append(np.array([len(enc.ids)]))
        whole = [self.WHOLE + w for w in [*(w for g in groups for w in g), *alone]]
        self.place.update(zip(plain + whole, range(len(self.place), len(self.place) + len(pieces))))
        self.pool = np.concatenate([self.pool, *parts])
        self.first = np.concatenate((self.first, self.first[-1] + np.cumsum(np.concatenate(counts))))

    def _numbers(self, pieces: np.ndarray) -> np.ndarray:
        """The number of each piece, -1 if it is not known."""
        return np.fromiter(map(self.place.get, pieces, itertools.repeat(-1)), np.int64, len(pieces))

    def _cut(self, words: pa.Array) -> pa.ListArray:
        """The pieces of each word, with empty ones between."""
        whole = pc.binary_join_element_wise(self.WHOLE, words, "")
        if self.plain is None:
            return pc.split_pattern(whole, " ")
        low = pc.ascii_lower(words)
        odd = pc.match_substring_regex(low, self.odd)
        return pc.split_pattern(pc.if_else(odd, whole, pc.replace_substring_regex(low, _PIECES, "\\0 ")), " ")

    def _word_ids(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of distinct words one after another, and the n + 1 places where words begin."""
        pieces = self._cut(words)
        coded = pieces.flatten().dictionary_encode()
        names = coded.dictionary.to_numpy(zero_copy_only=False)
        number = self._numbers(names)
        new = names[number < 0]
        if len(new):
            if len(self.place) + len(new) > _CACHE_WORDS or self.chars > _CACHE_CHARS:
                self._forget_but(names.tolist())
                number = self._numbers(names)
            self._learn(new.tolist())
            number[number < 0] = self._numbers(new)
            self.chars += sum(map(len, new))
        ids, first = _runs(self.pool, self.first, number[coded.indices.to_numpy()])
        return ids, first[np.asarray(pieces.offsets)]

    def ids(self, text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts one after another, and the n + 1 places where texts begin."""
        spaced = pc.replace_substring_regex(text, "[\\t\\n\\r]", " ") if _has(text, "[\\t\\n\\r]") else text
        words = pc.split_pattern(spaced, " ")
        offsets = np.asarray(words.offsets).astype(np.int64)
        coded = words.flatten().dictionary_encode()
        ids, first = _runs(*self._word_ids(coded.dictionary), coded.indices.to_numpy())
        return ids, first[offsets - offsets[0]]


def _runs(pool: np.ndarray, first: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of ``pool`` with these numbers one after another, and the n + 1 places where they begin."""
    start = first[number]
    n = first[number + 1] - start
    total = np.concatenate(([0], np.cumsum(n)))
    return pool[np.arange(total[-1]) + np.repeat(start - total[:-1], n)], total


def _has(text: pa.Array, pattern: str) -> bool:
    return bool(pc.any(pc.match_substring_regex(text, pattern)).as_py())


class PieceCounter:
    """Token counts for a byte-level tokenizer whose pieces carry the space before them."""

    _made: dict[str, PieceCounter] = {}

    @classmethod
    def shared(cls, path: str) -> PieceCounter:
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def __init__(self, path: str):
        self.library = _library(path)
        lone = self.library.encode("\n", add_special_tokens=False).ids
        probe = self.library.encode("a\n b\nc.\nd", add_special_tokens=False).ids
        # The split below holds for tokenizers that keep a single line end as one token.
        self.line = lone[0] if len(lone) == 1 and probe.count(lone[0]) == 3 else None
        self.counts: dict[str, int] = {}
        self.chars = 0

    def _learn(self, pieces: list[str]) -> None:
        groups = [pieces[i:i + _GROUP] for i in range(0, len(pieces), _GROUP)]
        for group, enc in zip(groups, self.library.encode_batch_fast(["\n".join(g) for g in groups],
                                                                     add_special_tokens=False)):
            ids = np.array(enc.ids, dtype=np.int64)
            cuts = np.flatnonzero(ids == self.line)
            if len(cuts) == len(group) - 1:
                n = np.diff(np.concatenate(([-1], cuts, [len(ids)]))) - 1
            else:
                n = [len(e.ids) for e in self.library.encode_batch_fast(group, add_special_tokens=False)]
            self.counts.update(zip(group, map(int, n)))

    def count(self, text: pa.Array) -> np.ndarray:
        out = np.zeros(len(text), np.int64)
        plain = np.zeros(len(text), bool)
        if self.line is not None:
            plain = ~np.asarray(pc.match_substring_regex(text, _NOT_PLAIN))
        odd = np.flatnonzero(~plain)
        if len(odd):
            encoded = self.library.encode_batch_fast(text.take(pa.array(odd)).to_pylist(), add_special_tokens=False)
            out[odd] = [len(e.ids) for e in encoded]
        keep = np.flatnonzero(plain)
        if not len(keep):
            return out
        # "\nX" marks a piece at a line start, "X" one after a space; the first is marked too.
        marked = pc.binary_join_element_wise(
            "\n", pc.replace_substring(text.take(pa.array(keep)), "\n", " \n"), "")
        pieces = pc.split_pattern(marked, " ")
        offsets = np.asarray(pieces.offsets).astype(np.int64)
        offsets = offsets - offsets[0]
        coded = pieces.flatten().dictionary_encode()
        names = coded.dictionary.to_pylist()
        keys = [w[1:] if w[:1] == "\n" else " " + w for w in names]
        extra = np.fromiter((w[:1] == "\n" for w in names), np.int64, len(names))
        new = list({k for k in keys if k not in self.counts})
        if len(self.counts) + len(new) > _CACHE_WORDS or self.chars > _CACHE_CHARS:
            self.counts = {k: self.counts[k] for k in keys if k in self.counts}    # the likeliest to come again
            self.chars = sum(map(len, self.counts))
        self._learn(new)
        self.chars += sum(map(len, new))
        n = np.fromiter(map(self.counts.__getitem__, keys), np.int64, len(keys)) + extra
        total = np.concatenate(([0], np.cumsum(n[coded.indices.to_numpy()])))
        out[keep] = np.diff(total[offsets]) - 1         # the first piece's mark is not in the text
        return out


# --------------------------------------------------------------- huge documents

def _stable(text: str, lo: int, hi: int, specials: list[str]) -> list[int]:
    """Places in (lo, hi) where white space follows a character that is none, outside specials."""
    out = []
    for p in range(max(lo, 1), min(hi, len(text) - 1)):
        if text[p] in " \n" and not text[p - 1].isspace() and text[p - 1] not in "\x85᠎​":
            out.append(p)
    for s in specials:
        at = text.find(s, max(0, lo - len(s)))
        while 0 <= at < hi:
            out = [p for p in out if not at < p < at + len(s)]
            at = text.find(s, at + 1)
    return out


def _encode_chunks(tokenizer: str):
    """Chunk rows -> tokens in all, and in both overlaps the stable token ends (document
    positions) with the number of the chunk's tokens before them."""
    def run(batches):
        library = _library(tokenizer)
        specials = [t.content for t in library.get_added_tokens_decoder().values()]
        for b in batches:
            cols = [b.column(k).to_pylist() for k in ("start", "head", "tail", "text")]
            n, heads, tails = [], [], []
            for start, head, tail, text in zip(*cols):
                enc = library.encode(text, add_special_tokens=False)
                spans = np.array(enc.offsets, dtype=np.int64).reshape(-1, 2)
                n.append(len(spans))
                for places, lo, hi in ((heads, 0, head), (tails, len(text) - tail, len(text))):
                    good = []
                    if tail or head:
                        for p in _stable(text, lo, hi, specials):
                            k = int(np.searchsorted(spans[:, 0], p))    # tokens that begin before p
                            if k and spans[k - 1, 1] == p:
                                good.append({"at": start + p, "before": k})
                    places.append(good)
            mark = pa.list_(pa.struct([("at", pa.int64()), ("before", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [*(b.column(k) for k in ("row", "chunk", "last")), pa.array(n, pa.int64()),
                 pa.array(heads, mark), pa.array(tails, mark)],
                names=["row", "chunk", "last", "n", "heads", "tails"])

    return run


def _cut(chunk: int, overlap: int):
    """Document rows -> chunk rows; ``head`` and ``tail`` are the characters shared with the neighbours."""
    kinds = [pa.int64(), pa.int32(), pa.bool_(), pa.int64(), pa.int32(), pa.int32(), pa.string()]
    names = ["row", "chunk", "last", "start", "head", "tail", "text"]

    def run(batches):
        for b in batches:
            for row, text in zip(b.column("row").to_pylist(), b.column("text").to_pylist()):
                starts = range(0, max(len(text), 1), chunk)
                rows = [(row, k, k == len(starts) - 1, at, overlap if k else 0,
                         max(0, min(overlap, len(text) - at - chunk)), text[at:at + chunk + overlap])
                        for k, at in enumerate(starts)]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

    return run


def huge_counts(docs: DataFrame, tokenizer: str, chunk: int, overlap: int) -> DataFrame:
    """``row`` and ``n_tokens`` of documents (``row``, ``text``) longer than a chunk.

    Chunk k covers [k * chunk, (k + 1) * chunk + overlap) characters.  Rows whose
    splices do not all hold go round again with a doubled overlap.
    """
    ship(docs.sparkSession)
    done, left = [], docs
    places = "array<struct<at:long,before:long>>"
    while True:
        rows = left.mapInArrow(_cut(chunk, overlap), "row long, chunk int, last boolean, start long, "
                                                     "head int, tail int, text string")
        coded = reliable(rows.repartition("row", "chunk")
                         .mapInArrow(_encode_chunks(tokenizer),
                                     f"row long, chunk int, last boolean, n long, heads {places}, tails {places}"))
        # The splice of chunk k - 1 and k is the first stable end both of them have.
        order = Window.partitionBy("row").orderBy("chunk")
        both = coded.withColumn("left", F.lag("tails").over(order))
        common = F.transform(
            F.filter("heads", lambda h: F.exists("left", lambda t: t["at"] == h["at"])),
            lambda h: F.struct(h["at"].alias("at"), h["before"].alias("skip"),
                               F.filter("left", lambda t: t["at"] == h["at"])[0]["before"].alias("upto")))
        both = both.withColumn("splice", F.when(F.col("chunk") > 0, F.try_element_at(common, F.lit(1))))
        per = both.select("row", "chunk", "n", "splice",
                          F.lead(F.col("splice")).over(order).alias("next"), "last")
        whole = per.groupBy("row").agg(
            F.sum(F.when(F.col("last"), F.col("n")).otherwise(F.col("next.upto"))
                  - F.when(F.col("chunk") == 0, F.lit(0)).otherwise(F.col("splice.skip"))).alias("n_tokens"),
            F.bool_or((F.col("chunk") > 0) & F.col("splice").isNull()).alias("torn"))
        whole = reliable(whole)
        done.append(whole.where("NOT torn").select("row", "n_tokens"))
        torn = whole.where("torn").select("row")
        if torn.isEmpty():
            break
        left = left.join(torn, "row", "left_semi")
        chunk, overlap = chunk * 2, overlap * 2     # in the end one chunk holds the document
    out = done[0]
    for d in done[1:]:
        out = out.unionAll(d)
    return out


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 1024, huge: int = 1 << 16, chunk: int = 1 << 15,
                 overlap: int = 1 << 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, ``n_bytes``, ``n_tokens``, ``over_limit`` per row of ``docs``."""
    ship(docs.sparkSession)
    id_type = dict(docs.dtypes)[id_col]
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))

    def count(batches):
        counter = PieceCounter.shared(tokenizer)
        for rows, text in blocks(batches, "text"):
            yield pa.RecordBatch.from_arrays(
                [rows.column("id"), pc.cast(pc.binary_length(text), pa.int64()), pa.array(counter.count(text))],
                names=["id", "n_bytes", "n_tokens"])

    small = (texts.where(F.length("text") <= huge)
             .mapInArrow(count, f"id {id_type}, n_bytes long, n_tokens long"))
    large = reliable(texts.where(F.length("text") > huge).withColumn("row", F.monotonically_increasing_id()))
    if not large.isEmpty():
        counted = huge_counts(large.select("row", "text"), tokenizer, chunk, overlap)
        large = large.select("row", "id", F.octet_length("text").cast("long").alias("n_bytes")).join(counted, "row")
        small = small.unionAll(large.select("id", "n_bytes", "n_tokens"))
    return small.select(F.col("id").alias(id_col), "n_bytes", "n_tokens",
                        (F.col("n_tokens") > limit).alias("over_limit"))
