"""Sharding by proportional stratified interleaving.

Rows are ranked within their source in a seeded order; the fractional rank
``(rank + 1/2) / rows of the source`` spreads each source evenly over 0 to 1.
Sorting by it interleaves the sources in proportion, and equal cuts of that
order are shards that all have the mixture and differ by one row at most.

Both orders are counted, never gathered: rows fall into ranges of the sort key
of about ``PIECE`` rows, are numbered within the range, and the ranges are
summed up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webfacts.llm.columns import group_key, leading, seeded, small

PIECE = 1024


def interleave(
    rows: DataFrame, shards: int = 16, seed: int = 8, source: str = "source",
    doc_id: str = "doc_id", ties: tuple[str, ...] = (), piece: int = PIECE,
) -> DataFrame:
    """``rows`` with ``shard`` (0 to ``shards - 1``) and ``slot`` (0 to the
    shard's last, without gaps).

    Give narrow rows; they are shuffled twice. ``ties`` order rows of the same
    id. Defined cases: null sources are one source, null ids are ids like any
    other, rows alike in all named columns take their places in any order, an
    empty table gives an empty table. Input columns ``shard`` and ``slot`` are
    replaced.
    """
    rows = rows.drop("shard", "slot")
    keyed = (rows.withColumn("_skey", group_key(F.col(source)))
             .withColumn("_hash", seeded(seed, F.col(doc_id))))
    sizes = small(keyed.groupBy("_skey").agg(F.count(F.lit(1)).alias("_n")))
    part = _range(leading(F.col("_hash")) / F.lit(2.0 ** 32), F.ceil(F.col("_n") / piece))
    cut = keyed.join(sizes, "_skey").withColumn("_part", part)
    counts = cut.groupBy("_skey", "_part").agg(F.count(F.lit(1)).alias("_rows"))
    bases = small(counts.select("_skey", "_part", _before(
        "_rows", Window.partitionBy("_skey").orderBy("_part")).alias("_base")))
    seeded_order = ["_hash", doc_id, *ties]
    ranked = (
        cut.withColumn("_at", F.row_number().over(
            Window.partitionBy("_skey", "_part").orderBy(*seeded_order)))
        .join(bases, ["_skey", "_part"])
        .withColumn("_frac", (F.col("_base") + F.col("_at") - F.lit(0.5)) / F.col("_n"))
        .drop("_part", "_base", "_at", "_n"))
    total = sizes.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    ranges = max(1, -(-total // piece))
    spread = ranked.withColumn("_range", _range(F.col("_frac"), F.lit(ranges)))
    starts = small(
        spread.groupBy("_range").agg(F.count(F.lit(1)).alias("_rows"))
        .select("_range", _before("_rows", Window.orderBy("_range")).alias("_start")))
    place = (
        F.col("_start") - 1 + F.row_number().over(
            Window.partitionBy("_range").orderBy("_frac", "_skey", *seeded_order)))
    shard = F.floor(F.col("_place") * shards / F.lit(total or 1))
    first = F.ceil(F.col("_shard") * total / F.lit(shards))
    return (
        spread.join(starts, "_range").withColumn("_place", place)
        .withColumn("_shard", shard)
        .withColumn("shard", F.col("_shard").cast("int"))
        .withColumn("slot", (F.col("_place") - first).cast("long"))
        .select(*[F.col(f"`{c}`") for c in rows.columns], "shard", "slot"))


def _range(value: Column, ranges: Column) -> Column:
    """Which of ``ranges`` equal parts of 0 to 1; keeps the order."""
    return F.least(F.floor(value * ranges), ranges - 1).cast("long")


def _before(c: str, window) -> Column:
    return F.coalesce(
        F.sum(c).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def text_rows(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without the text but with ``size`` (its UTF-8 bytes and one)
    and ``text_crc32``."""
    filled = F.coalesce(F.col(text), F.lit(""))
    return (docs.withColumn("size", (F.octet_length(filled) + 1).cast("long"))
            .withColumn("text_crc32", F.crc32(filled)).drop(text))
