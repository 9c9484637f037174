"""Mixing sources to target weights by systematic sampling.

Each document of a source is expected ``rate = target / source size`` times.
The expected copies are summed up along the source, an offset is added, and a
document is emitted once for each whole number that its interval crosses. The
offset of a source is the nearest to its target of some seeded draws. The documents of a source stand in order of size (two leading
digits), then in a seeded order, so that long documents are spread evenly and
the words taken come close to the target.

No group is ever gathered: a source and size with many documents is cut by the
seeded hash into pieces of about ``PIECE`` rows, positions are counted within a
piece and the pieces are summed up by source.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webfacts.llm.columns import group_key, leading, seeded, small, staged, word_count

PIECE = 1024
# The offset of a source is the one of so many seeded draws that takes its words
# closest to the target.
OFFSETS = 16
# Columns that the operator works with; input columns of these names are
# replaced, all others are kept.
OWN = ["size", "source_size", "target", "copies", "taken"]


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.5, cap: float = 2.0,
) -> DataFrame:
    """``(_skey, source_size, target)`` from ``(_skey, source, source_size)``.

    Sources in code point order, null last, weigh ``weights`` in turn and share
    ``share`` times all words. No target exceeds ``cap`` times its source; what
    is left over is shared again by weight. That is filling vessels to one
    level: with the sources in order of cap per weight, a vessel is full if the
    level that the rest would reach without it is above its rim.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_rim = Window.orderBy("_rim", F.col("source").asc_nulls_last())
    before = by_rim.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]),
                          ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    return (
        sizes.withColumn("_w", weight)
        .withColumn("_cap", F.col("source_size") * F.lit(cap))
        .withColumn("_rim", F.col("_cap") / F.col("_w"))
        .withColumn("_total", F.sum("source_size").over(whole) * F.lit(share))
        .withColumn("_weights", F.sum("_w").over(whole))
        .withColumn("_level",
                    (F.col("_total") - F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
                    / (F.col("_weights") - F.coalesce(F.sum("_w").over(before), F.lit(0))))
        .withColumn("_full", F.col("_level") * F.col("_w") >= F.col("_cap"))
        .withColumn("_end", F.coalesce(
            F.max(F.when(~F.col("_full"), F.struct(-F.col("_rim"), F.col("_level")))).over(whole)
            .getField("_level"), F.lit(0.0)))
        .select("_skey", "source_size",
                F.when(F.col("_full"), F.col("_cap"))
                .otherwise(F.least(F.col("_cap"), F.col("_end") * F.col("_w"))).alias("target")))


def mix(
    docs: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.5, cap: float = 2.0,
    seed: int = 9, text: str = "text", source: str = "source", doc_id: str = "doc_id",
    piece: int = PIECE, words: str | None = None,
) -> DataFrame:
    """Every row of ``docs`` with ``size``, ``source_size``, ``target``,
    ``copies`` and ``taken`` (copies times size). The size is the number of
    words of ``text``, or the column ``words`` where it is known.

    Defined cases: a null text has size 0; a null source is a source of its
    own, last in order; a source without words has target 0 and is not taken;
    a null id is an id like any other; rows that agree in id and size share
    their places in any order, as they are alike to the sampling; an empty table
    gives an empty table. Rates never exceed ``cap``, so with a cap of 2 no
    document is emitted more than twice. Input columns called as one of the new
    columns are replaced.
    """
    size = F.col("_size")
    sized = (
        docs.drop(*[c for c in docs.columns if c.lower() in OWN and c not in (text, source, doc_id, words)])
        .withColumn("_size", F.col(words) if words else word_count(F.col(text)))
        .withColumn("_skey", group_key(F.col(source)))
        .withColumn("_digits", F.length(size.cast("string")))
        .withColumn("_head", F.substring(size.cast("string"), 1, 2))
        .withColumn("_hash", seeded(seed, F.col(doc_id))))
    keys = staged(sized.select("_skey", "_digits", "_head", "_hash", "_size",
                               F.col(source).alias("source")))
    bands = staged(
        keys.groupBy("_skey", "_digits", "_head")
        .agg(F.count(F.lit(1)).alias("_n"), F.sum("_size").alias("_words"),
             F.first("source").alias("source")))
    targets = source_targets(
        bands.groupBy("_skey").agg(F.first("source").alias("source"),
                                   F.sum("_words").cast("long").alias("source_size")),
        weights, share, cap)
    cuts = small(
        bands.join(targets, "_skey")
        .select("_skey", "_digits", "_head", "source_size", "target",
                F.ceil(F.col("_n") / piece).cast("long").alias("_pieces")))
    cut = _piece(leading(F.col("_hash")), F.col("_pieces"))
    place = ["_skey", "_digits", "_head", "_part"]
    counts = (
        keys.drop("_size", "source").join(cuts, ["_skey", "_digits", "_head"]).withColumn("_part", cut)
        .groupBy(*place).agg(F.count(F.lit(1)).alias("_rows")))
    along = (Window.partitionBy("_skey").orderBy("_digits", "_head", "_part")
             .rowsBetween(Window.unboundedPreceding, -1))
    bases = small(counts.select(
        *place, F.coalesce(F.sum("_rows").over(along), F.lit(0)).alias("_base")))
    within = Window.partitionBy(*place).orderBy("_hash", "_size")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)

    def ranked(rows: DataFrame) -> DataFrame:
        return (
            rows.join(cuts, ["_skey", "_digits", "_head"]).withColumn("_part", cut)
            .withColumn("_at", F.row_number().over(within))
            .join(bases, place)
            .withColumn("_rank", F.col("_base") + F.col("_at")))

    def copies(offset: Column) -> Column:
        crossed = lambda rank: F.floor(offset + rate * rank)
        return (crossed(F.col("_rank")) - crossed(F.col("_rank") - 1)).cast("long")

    drawn = [leading(seeded(seed, F.concat(F.lit(f"{i}|"), F.col("_skey")))) / F.lit(2.0 ** 32)
             for i in range(OFFSETS)]
    words = (
        ranked(keys).groupBy("_skey").agg(
            F.first("target").alias("_target"),
            *[F.sum(copies(offset) * F.col("_size")).alias(f"_sum{i}") for i, offset in enumerate(drawn)]))
    nearest = F.array_min(F.array(*[
        F.struct(F.abs(F.col(f"_sum{i}") - F.col("_target")).alias("off"), F.lit(i).alias("i"),
                 offset.alias("offset")) for i, offset in enumerate(drawn)]))
    offsets = small(words.select("_skey", nearest["offset"].alias("_offset")))
    kept = [c for c in docs.columns if c in sized.columns]
    return (
        ranked(sized).join(offsets, "_skey").withColumn("copies", copies(F.col("_offset")))
        .select(*[F.col(f"`{c}`") for c in kept], F.col("_size").alias("size"), "source_size", "target",
                "copies", (F.col("copies") * F.col("_size")).alias("taken")))


def _piece(hashed: Column, pieces: Column) -> Column:
    """Which of ``pieces`` equal ranges of 32-bit numbers; keeps their order."""
    return F.floor(hashed * pieces / F.lit(2.0 ** 32)).cast("long")


def repeated(mixed: DataFrame) -> DataFrame:
    """The mix itself: each row as often as its ``copies`` say."""
    return (mixed.where("copies > 0")
            .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
            .drop("_copy"))
