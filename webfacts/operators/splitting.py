"""A split into two parts of exact sizes."""

from __future__ import annotations

import math
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webfacts.constants import TRAIN_SHARE
from webfacts.operators.joins import cut_lineage

# Digits that a histogram refines at once; it has at most 16 ** DIGITS bars.
DIGITS = 3
_PLACE = "_place"


def _md5(value: Column) -> Column:
    """A digest that also a null has, unlike that of any value."""
    return F.coalesce(F.md5(F.concat(F.lit("="), value.cast("string"))), F.md5(F.lit("")))


def _bars(rows: DataFrame, digest: Column, prefix: str) -> list[tuple[str, int]]:
    bar = F.substring(digest, 1, len(prefix) + DIGITS).alias("bar")
    found = rows.where(digest.startswith(prefix)).groupBy(bar).agg(F.count(F.lit(1)).alias("n"))
    return sorted((r["bar"], r["n"]) for r in found.collect())


def smallest(
    rows: DataFrame, digest: Column, wanted: int, bars: list[tuple[str, int]] | None = None,
) -> tuple[str, int]:
    """``(prefix, missing)``: rows whose digest begins below ``prefix`` are among the
    ``wanted`` smallest, and ``missing`` of those that begin with it.

    ``digest`` is a column of hexadecimal digits, equally long in all rows. Counts of its
    first digits tell the bar that holds the last wanted row, and that bar alone is
    counted anew by its next digits, until it is wanted whole or its digests are all equal.
    Each count is one combined aggregate of at most ``16 ** DIGITS`` rows.
    """
    prefix, missing = "", wanted
    while True:
        bars = bars if bars is not None else _bars(rows, digest, prefix)
        for bar, n in bars:
            if missing <= n:
                break
            missing -= n
        if missing == n or len(bar) < len(prefix) + DIGITS or bar == prefix:
            return bar, missing
        prefix, bars = bar, None


def split_exact(df: DataFrame, key: str, share: float = TRAIN_SHARE) -> tuple[DataFrame, DataFrame]:
    """``(train, test)`` with exactly the rest of ``share``, rounded up, in ``test``.

    ``test`` gets the rows of the smallest md5 of the key; rows of one key that
    lies on the border go by the md5 of the whole row, and of equal rows as many as
    are missing. So the parts hold the same rows for any partitions. No row is sorted or
    sent to one task, also where most rows share a key. Defined cases: null is a key like
    others; an empty table gives two empty parts; a share of 0 or 1 gives one.
    """
    by_key = _md5(F.col(f"`{key}`"))
    bars = _bars(df, by_key, "")
    rows = sum(n for _, n in bars)
    wanted = math.ceil((1 - Fraction(str(share))) * rows)
    if wanted in (0, rows):
        all_rows, none = df, df.where(F.lit(False))
        return (none, all_rows) if wanted else (all_rows, none)
    below, border = F.lit(False), F.lit(True)
    held, missing = df, wanted
    for level in (by_key, F.md5(F.to_json(F.struct(*(F.col(f"`{c}`") for c in df.columns))))):
        prefix, missing = smallest(held, level, missing, bars)
        bars = None
        begins = F.substring(level, 1, len(prefix))
        below |= border & (begins < prefix)
        border &= begins == prefix
        held = df.where(border)
        if held.count() == missing:
            return df.where(~(below | border)), df.where(below | border)
    # Equal rows alone: stored with a number, which then stays the same.
    place = _free(df)
    equal = cut_lineage(held.withColumn(place, F.monotonically_increasing_id()))
    number = F.lpad(F.lower(F.hex(place)), 16, "0")
    prefix, _ = smallest(equal, number, missing)
    begins = F.substring(number, 1, len(prefix))
    return (
        df.where(~(below | border)).unionByName(equal.where(begins > prefix).drop(place)),
        df.where(below).unionByName(equal.where(begins <= prefix).drop(place)))


def _free(df: DataFrame) -> str:
    """A name that no column has."""
    taken = {c.lower() for c in df.columns}
    name = _PLACE
    while name in taken:
        name += "_"
    return name
