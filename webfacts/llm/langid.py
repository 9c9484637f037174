"""Language by compression: the language whose dictionary makes a text smallest.

Each language has a raw-content dictionary for zstandard, made of pieces of its
labelled texts. A text is compressed in blocks under every dictionary, so that
the dictionary counts all along a long text, and the smallest total wins. Totals
are whole bytes, and a few words are stored as they are; so where one byte is more
than the least margin and the smallest totals are equal, the text is measured in
parts of bits: the ideal code length of its bytes, each predicted from up to four
bytes before it by their counts in the dictionary. A text is rejected when the
second smallest measure is hardly larger.

Texts are lower-cased and everything but letters becomes a blank, in the
dictionaries as in the texts: capitals and ornaments say nothing about language.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from webfacts.llm.columns import leading, seeded

UNKNOWN = "und"
# The fit takes this many labelled rows of a language and this many characters
# of each, from a place in the text that its id decides.
ROWS_PER_LANGUAGE = 200
CHARACTERS_PER_ROW = 500
LEVEL = 5
BLOCK = 4096
MIN_MARGIN = 0.002
# Bytes before a byte that predict it, and what the shorter ones weigh against
# the counts of the longer, where small totals are equal.
ORDER = 4
BACKOFF = 4.0
_NO_LETTER = re.compile(r"[\W\d_]+")
_RESULT = "lang_pred string, score double, rejected boolean"


def _plain(text: str) -> str:
    return _NO_LETTER.sub(" ", text.lower())


def fit(
    labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id",
    rows: int = ROWS_PER_LANGUAGE, characters: int = CHARACTERS_PER_ROW, seed: int = 10,
) -> dict[str, bytes]:
    """Dictionaries by language from a bounded sample of labelled rows.

    The rows of a language with the smallest seeded hash of their key are taken;
    a threshold from the language's count leaves a few times as many before
    they are ranked, so a language with most rows is no load on one task. Rows
    without text or language are left out. What reaches the driver is at most
    ``rows * characters`` per language.
    """
    usable = labelled.where(F.col(lang).isNotNull() & (F.length(text) > 0)).select(
        F.col(lang).alias("_lang"), F.col(key).alias("_key"), F.col(text).alias("_text"))
    hashed = seeded(seed, F.col("_key"))
    counts = {r["_lang"]: r["count"] for r in usable.groupBy("_lang").count().collect()}
    if not counts:
        return {}
    share = F.create_map(*[F.lit(x) for k, n in counts.items()
                           for x in (k, min(1.0, (3.0 * rows + 100) / n))])
    few = (usable.withColumn("_hash", hashed)
           .where(leading(F.col("_hash")) < F.element_at(share, F.col("_lang")) * F.lit(2.0 ** 32)))
    spare = F.greatest(F.length("_text") - F.lit(characters), F.lit(0))
    begin = (leading(F.substring("_hash", 9, 8)) % (spare + 1)).cast("int")
    ranked = few.select(
        "_lang", "_hash", F.substr(F.col("_text"), begin + 1, F.lit(characters)).alias("_piece"))
    first = Window.partitionBy("_lang").orderBy("_hash", "_piece")
    sample = (ranked.withColumn("_at", F.row_number().over(first)).where(F.col("_at") <= rows)
              .groupBy("_lang").agg(F.array_sort(F.collect_list(F.struct("_hash", "_piece"))).alias("_all"))
              .collect())
    return {r["_lang"]: _plain("\n".join(p["_piece"] for p in r["_all"])).encode()
            for r in sorted(sample, key=lambda r: (-counts[r["_lang"]], r["_lang"]))}


@lru_cache(maxsize=1 << 16)
def _count(content: bytes, part: bytes) -> int:
    return content.count(part)


def _code_length(data: bytes, content: bytes) -> float:
    """Bits of ``data`` by the counts of ``content``."""
    framed = b" " + data.strip() + b" "
    total = 0.0
    for window, n in Counter(framed[max(0, i - ORDER):i + 1] for i in range(1, len(framed))).items():
        chance = 1 / 256
        for known in range(len(window)):
            before = window[len(window) - 1 - known:-1]
            of = _count(content, before) if before else len(content)
            chance = (_count(content, before + window[-1:]) + BACKOFF * chance) / (of + BACKOFF)
        # Counts leave out overlaps, so that a chance could pass one.
        total -= n * math.log2(min(chance, 1.0))
    return total


def _compressors(dictionaries: dict[str, bytes], level: int, block: int) -> list:
    import zstandard

    out = []
    for lang, content in dictionaries.items():
        known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        setting = zstandard.ZstdCompressionParameters.from_level(
            level, dict_size=len(content), source_size=block, write_content_size=False,
            write_checksum=False, write_dict_id=False)
        known.precompute_compress(compression_params=setting)
        out.append((lang, zstandard.ZstdCompressor(dict_data=known, compression_params=setting), content))
    return out


def classify(text: str | None, compressors: list, block: int, min_margin: float) -> tuple:
    """``(language, score, rejected)`` of one text; the score is the margin of
    the smallest measure to the second, as a part of the second."""
    if not text or not compressors or not any(map(str.isalpha, text)):
        return UNKNOWN, 0.0, True
    data = _plain(text).encode("utf-8", "replace")
    blocks = [data[i:i + block] for i in range(0, len(data), block)]
    sizes = sorted((sum(len(c.compress(b)) for b in blocks), i) for i, (_, c, _) in enumerate(compressors))
    best = compressors[sizes[0][1]][0]
    if len(sizes) == 1:
        return best, 1.0, False
    if sizes[0][0] == sizes[1][0] and sizes[0][0] * min_margin < 1:
        sizes = sorted((_code_length(data, compressors[i][2]), i)
                       for size, i in sizes if size == sizes[0][0])
        best = compressors[sizes[0][1]][0]
    margin = (sizes[1][0] - sizes[0][0]) / sizes[1][0]
    return best, margin, margin < min_margin


def identify(
    docs: DataFrame, dictionaries: dict[str, bytes], text: str = "text", level: int = LEVEL,
    block: int = BLOCK, min_margin: float = MIN_MARGIN,
) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``rejected``.

    Defined cases: a null, empty or letterless text, and any text when nothing
    was learned, is ``und`` with score 0 and rejected; with one language only,
    each text is of it with score 1; equal measures go to the language that comes
    first in ``dictionaries`` (``fit`` puts the most frequent first) with score
    0; repeated rows agree; columns of the new
    names are replaced. Narrow; no shuffle.
    """
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        compressors = _compressors(dictionaries, level, block)
        for texts in batches:
            rows = [classify(t if isinstance(t, str) else None, compressors, block, min_margin)
                    for t in texts]
            yield pd.DataFrame(rows, columns=["lang_pred", "score", "rejected"])

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    udf = F.pandas_udf(run, _RESULT)
    kept = [c for c in docs.columns if c.lower() not in ("lang_pred", "score", "rejected")]
    return (docs.select(*[F.col(f"`{c}`") for c in kept], udf(F.col(text)).alias("_found"))
            .select(*[F.col(f"`{c}`") for c in kept], "_found.*"))
