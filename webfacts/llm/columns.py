"""Small helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webfacts.operators.joins import shared_folder

SMALL_ROWS = 50_000


def staged(df: DataFrame) -> DataFrame:
    """The frame, written to the shared folder and read again.

    Cuts the lineage: a lost executor costs no earlier step.
    """
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame) -> DataFrame:
    """A stored table of groups, with a broadcast hint if it is short."""
    stored = staged(df)
    return F.broadcast(stored) if stored.count() <= SMALL_ROWS else stored


def group_key(c: Column) -> Column:
    """A value as a text that is never null, so that nulls are a group."""
    return F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("~"))


def seeded(seed: int, c: Column) -> Column:
    """Hexadecimal digest of a value under a seed."""
    return F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(c.cast("string"), F.lit("~"))))


def leading(digest: Column) -> Column:
    """The first 32 bits of a hexadecimal digest as a number."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def word_count(text: Column) -> Column:
    """Number of runs without ASCII white space; null counts as no text."""
    return F.coalesce(F.regexp_count(text, F.lit("[^ \\t-\\r]+")), F.lit(0)).cast("long")


def free_names(df: DataFrame, names: list[str]) -> list[str]:
    """Columns of ``df`` that clash with none of ``names``, ignoring case."""
    taken = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in taken]
