"""Quality rules by tokeniser fertility.

How many tokens a public vocabulary needs for a text tells ordinary text from
noise: characters per token fall where letters stand in no known order, the
share of tokens that are single bytes of a character rises where the script is
broken, and the entropy of the tokens falls where a text says little. Texts are
measured under each vocabulary; a band around the median of its language and
length decides which measures are ordinary.

Bands come from the counts of all values, in thousandths, so they are exact and
the same on each run. A text counts once, however often it is copied, and medians
and median deviations stand with up to half of the texts being noise.
"""

from __future__ import annotations

import base64
import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webfacts.llm.columns import free_names, small, staged

MIN_WORDS = 50
MAX_REPEATED = 50
# A band needs so many different texts; with fewer, a wider group's is taken.
MIN_TEXTS = 50
# Half the width of a band in median deviations, and the least half width in
# thousandths of the median and in thousandths.
DEVIATIONS = 12.0
LEAST_SHARE = 200
LEAST_WIDTH = {"chars": 0, "bytes": 50, "entropy": 0}
SCRIPTS = ["Latin", "Cyrillic", "Greek", "Han", "Hiragana", "Katakana", "Hangul", "Arabic", "Hebrew",
           "Devanagari", "Thai"]
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_SYMBOLS = "#*$%&|<>"
_BLANKS = " \t\n\x0b\x0c\r"
OWN = [*BASE, "base_failed", "kept", "language", "failed", "measures"]


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """``BASE`` of one text. Words are runs without ASCII white space; a repeated
    word lies in a window of three words that the text has twice or more."""
    words = text.encode("utf-8", "surrogatepass").split()
    characters = len(text) - sum(map(text.count, _BLANKS))
    symbols = sum(map(text.count, _SYMBOLS))
    seen: set[str] = set()
    again = 0
    for line in text.split("\n"):
        if line in seen:
            again += 1
        elif line.strip(_BLANKS):
            seen.add(line)
    windows = list(zip(words, words[1:], words[2:]))
    counts = Counter(windows)
    repeated = 0
    if len(counts) < len(windows):
        covered = 0
        for i, w in enumerate(windows):
            if counts[w] > 1:
                # Words from ``covered`` on are not counted yet.
                repeated += i + 3 - max(covered, i)
                covered = i + 3
    return len(words), characters, symbols, again, repeated


class Pieces:
    """A sentencepiece model, whose tokens may be single bytes."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.is_bytes = np.array([self.model.is_byte(i) or self.model.is_unknown(i)
                                  for i in range(self.model.get_piece_size())])

    def ids(self, text: str) -> list[int]:
        return self.model.encode(text, num_threads=1)


class Ranks:
    """A byte-level vocabulary given as ranks; a token that is no whole
    characters counts as bytes."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.model = tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.is_bytes = np.zeros(max(ranks.values()) + 1, dtype=bool)
        for token, rank in ranks.items():
            try:
                token.decode()
            except UnicodeDecodeError:
                self.is_bytes[rank] = True

    def ids(self, text: str) -> list[int]:
        return self.model.encode_ordinary(text)


def vocabulary(path: str) -> Pieces | Ranks:
    return Ranks(path) if path.endswith(".tiktoken") else Pieces(path)


def measures(ids: list[int], is_bytes: np.ndarray, characters: int) -> tuple[int, int, int]:
    """Characters per token, share of byte tokens and entropy of the tokens in
    bits, in thousandths."""
    if not ids:
        return 0, 0, 0
    kinds, counts = np.unique(np.asarray(ids), return_counts=True)
    n = len(ids)
    entropy = np.log2(n) - float((counts * np.log2(counts)).sum()) / n
    return (round(1000 * characters / n), round(1000 * int(counts[is_bytes[kinds]].sum()) / n),
            round(1000 * max(entropy, 0.0)))


def script_of(text: str) -> str:
    """The script of most letters, first of ``SCRIPTS`` among equals; ``none``
    without letters of any."""
    import regex

    counts = [len(regex.findall(rf"\p{{{s}}}", text)) for s in SCRIPTS]
    most = max(counts)
    return SCRIPTS[counts.index(most)] if most else "none"


def measured(docs: DataFrame, paths: tuple[str, ...], text: str, lang: str) -> DataFrame:
    """``docs`` without the text, with ``BASE``, ``language``, ``digest`` of the
    text and ``measures``: three numbers for each vocabulary. Narrow."""
    fields = [f for f in docs.schema.fields if f.name != text]
    kept = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabularies = [vocabulary(p) for p in paths]
        for batch in batches:
            table = pa.Table.from_batches([batch])
            base, languages, digests, found = [], [], [], []
            for own, tag in zip(table[text].to_pylist(), table[lang].to_pylist()):
                own = own or ""
                counts = base_counts(own)
                base.append(counts)
                languages.append(f"lang:{tag}" if tag is not None else f"script:{script_of(own)}")
                digests.append(hashlib.md5(own.encode("utf-8", "surrogatepass")).hexdigest())
                line = " ".join(own.split())
                found.append([m for v in vocabularies for m in measures(v.ids(line), v.is_bytes, counts[1])])
            out = table.select(kept)
            for name, values in zip(BASE, zip(*base)):
                out = out.append_column(name, pa.array(values, pa.int64()))
            out = (out.append_column("language", pa.array(languages, pa.string()))
                   .append_column("digest", pa.array(digests, pa.string()))
                   .append_column("measures", pa.array(found, pa.list_(pa.int64()))))
            yield from out.to_batches()

    types = [f"`{f.name}` {f.dataType.simpleString()}" for f in fields] + [f"{b} long" for b in BASE]
    return docs.mapInArrow(run, ", ".join(
        [*types, "language string, digest string, measures array<long>"]))


def _length_class(words: Column) -> Column:
    """The power of two at or below the number of words: entropy grows with length."""
    return F.length(F.bin(words)) - 1


def bands(rows: DataFrame, least: list[int], min_texts: int = MIN_TEXTS,
          deviations: float = DEVIATIONS) -> DataFrame:
    """``(language, length, low array, high array)`` for each language and length
    of ``rows`` (``language, length, digest, measures``).

    The band of a measure is its median, more and less ``deviations`` times the
    median deviation from it, at least ``LEAST_SHARE`` thousandths of the median
    and at least ``least`` of the measure. Fewer than ``min_texts`` different
    texts take the band of their language at any length, of their length in any
    language or of all texts, whichever is first to have enough; else none.
    """
    texts = rows.groupBy("language", "length", "digest").agg(F.first("measures").alias("measures"))
    values = staged(
        texts.select("language", "length", F.posexplode("measures").alias("measure", "value"))
        .groupBy("language", "length", "measure", "value").agg(F.count(F.lit(1)).alias("n")))
    def key(rank: int, language: Column, length: Column) -> Column:
        return F.struct(F.lit(rank).alias("rank"), language.alias("l"), length.alias("s"))

    language, length = F.col("language"), F.col("length")
    no_language, no_length = F.lit(""), F.lit(-1)
    keys = F.inline(F.array(
        key(0, language, length), key(1, language, no_length), key(2, no_language, length),
        key(3, no_language, no_length)))
    group = ["rank", "l", "s", "measure"]
    counts = staged(
        values.select(keys, "measure", "value", "n")
        .groupBy(*group, "value").agg(F.sum("n").alias("n")))

    def median(of: DataFrame, name: str) -> DataFrame:
        """The least value with half of the texts at or below it."""
        along = Window.partitionBy(*group).orderBy(name)
        sums = (of.withColumn("below", F.sum("n").over(along.rowsBetween(Window.unboundedPreceding, 0)))
                .withColumn("texts", F.sum("n").over(Window.partitionBy(*group))))
        return sums.where("2 * below >= texts").groupBy(*group).agg(
            F.min(name).alias(f"median_{name}"), F.first("texts").alias("texts"))

    middle = staged(median(counts, "value"))
    off = (
        counts.join(small(middle), group)
        .withColumn("off", F.abs(F.col("value") - F.col("median_value")))
        .groupBy(*group, "off").agg(F.sum("n").alias("n")))
    width = F.greatest(F.lit(deviations) * F.col("median_off"),
                       F.lit(LEAST_SHARE / 1000) * F.col("median_value"),
                       F.element_at(F.array(*map(F.lit, least)), F.col("measure") + 1))
    found = (
        middle.join(staged(median(off, "off").drop("texts")), group).where(F.col("texts") >= min_texts)
        .withColumn("low", F.col("median_value") - width).withColumn("high", F.col("median_value") + width)
        .groupBy(*group[:3]).agg(F.array_sort(F.collect_list(F.struct("measure", "low", "high"))).alias("band")))
    wanted = values.select("language", "length").distinct()
    choice = (
        wanted.select("language", "length", keys).join(small(found), group[:3])
        .groupBy("language", "length").agg(F.min_by("band", "rank").alias("band")))
    return choice.select("language", "length", F.col("band.low").alias("low"), F.col("band.high").alias("high"))


def judge(
    docs: DataFrame, *paths: str, text: str = "text", lang: str = "lang", min_words: int = MIN_WORDS,
    max_repeated: int = MAX_REPEATED, min_texts: int = MIN_TEXTS, deviations: float = DEVIATIONS,
) -> DataFrame:
    """``docs`` without the text, with ``BASE``, ``base_failed``, ``kept``,
    ``language`` (``lang:`` and the label, or ``script:`` and the script of most
    letters where there is no label), ``measures`` (for each vocabulary file of
    ``paths`` characters per token, share of byte tokens and entropy, in
    thousandths) and ``failed``, the numbers of the measures out of their bands.

    A text fails the base rules with fewer than ``min_words`` words or with more
    than ``max_repeated`` of 100 words repeated. Bands are those of the texts
    that pass. Defined cases: a null text is empty and fails the base rules;
    without a band nothing more is rejected; an empty table gives an empty
    table; rows that repeat are judged alike and count once; input columns called
    as one of the new columns are replaced.
    """
    kept = [c for c in free_names(docs, [*OWN, "digest", "length"]) if c not in (text, lang)]
    tagged = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(text).alias("_text"), F.col(lang).alias("_lang"))
    few = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeated * F.col("n_words"))
    rows = staged(
        measured(tagged, paths, "_text", "_lang").withColumn("base_failed", few)
        .withColumn("length", _length_class(F.col("n_words"))))
    least = [w for _ in paths for w in LEAST_WIDTH.values()]
    known = small(bands(rows.where("NOT base_failed").select("language", "length", "digest", "measures"),
                        least, min_texts, deviations))
    failed = F.filter(
        F.sequence(F.lit(0), F.lit(3 * len(paths) - 1)),
        lambda i: (F.get("measures", i) < F.get("low", i)) | (F.get("measures", i) > F.get("high", i)))
    shown = [F.col(f"`{c}`") for c in kept] + ([F.col("_lang").alias(lang)] if lang in docs.columns else [])
    return (
        rows.join(known, ["language", "length"], "left")
        .withColumn("failed", F.when(F.col("base_failed") | F.col("low").isNull(), F.array().cast("array<int>"))
                    .otherwise(failed))
        .withColumn("kept", ~F.col("base_failed") & (F.size("failed") == 0))
        .select(*shown, *OWN))
