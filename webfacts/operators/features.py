"""TF-IDF features in long form: one row per (row, branch, term)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from webfacts.constants import FEATURE_BRANCHES, NAN_COLUMNS, NAN_TEXT
from webfacts.functions.text import term_counts, terms
from webfacts.operators.joins import cut_lineage, lookup_join

Branch = tuple[str, str, str]


def fill_missing(df: DataFrame, columns: Sequence[str] = tuple(NAN_COLUMNS)) -> DataFrame:
    """Missing values of the named columns become the text ``nan``."""
    return df.na.fill(NAN_TEXT, [c for c in columns if c in df.columns])


def class_label(df: DataFrame) -> DataFrame:
    """Add ``label``: relation and direction, after ``fill_missing``."""
    return df.withColumn("label", F.concat_ws(" ", "relation", "direction"))


def term_rows(df: DataFrame, row: str, branches: Sequence[Branch], *keep: str) -> DataFrame:
    """``(row, *keep, branch, term, tf)`` of all branches, in one pass and no shuffle."""
    counted = F.array(*[
        F.struct(F.lit(name).alias("branch"),
                 term_counts(terms(F.coalesce(F.col(column), F.lit("")), kind)).alias("counts"))
        for name, column, kind in branches])
    return df.select(row, *keep, F.inline(counted)).select(row, *keep, "branch", F.inline("counts"))


def term_idf(rows: DataFrame, counted: DataFrame) -> DataFrame:
    """``(branch, term, idf)`` with smoothed idf over the number of ``rows``."""
    total = rows.agg(F.count(F.lit(1)).alias("n")).scalar()
    found = counted.groupBy("branch", "term").agg(F.count(F.lit(1)).alias("df"))
    return found.select(
        "branch", "term", (F.log((1 + total) / (1 + F.col("df"))) + 1).alias("idf"))


def weigh(counted: DataFrame, idf: DataFrame, row: str) -> DataFrame:
    """Add ``weight``: tf times idf, scaled to length 1 per row and branch.

    Terms without an idf are left out. The window holds the terms of one row.
    """
    raw = lookup_join(counted, idf, ["branch", "term"]).withColumn("_w", F.col("tf") * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(W.partitionBy(row, "branch")))
    return raw.withColumn("weight", F.col("_w") / norm).drop("_w")


def tfidf(df: DataFrame, row: str, branches: Sequence[Branch]) -> DataFrame:
    """``(row, branch, term, tf, idf, weight)`` fitted on and applied to ``df``.

    The rows are dealt by ``row`` before their terms are made: with a vocabulary that is
    broadcast, that moves texts and not their terms.
    """
    idf = cut_lineage(term_idf(df, term_rows(df, row, branches)))
    places = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.select(*dict.fromkeys([row, *[column for _, column, _ in branches]])).repartition(places, row)
    return weigh(term_rows(dealt, row, branches), idf, row)


def number_terms(idf: DataFrame, *key: str) -> DataFrame:
    """Add ``idx``, 0 … n-1 without gaps, numbered in parallel. The ``key`` of a
    row is branch and term if none is named.

    Terms are numbered within hash buckets, four for each shuffle partition; each
    bucket starts where the ones before end.
    """
    key = key or ("branch", "term")
    buckets = 4 * int(idf.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bucketed = idf.withColumn("_b", F.pmod(F.xxhash64(*key), F.lit(buckets)))
    sizes = bucketed.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
    earlier = W.orderBy("_b").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select("_b", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    place = F.row_number().over(W.partitionBy("_b").orderBy(*key))
    return (bucketed.withColumn("_place", place).join(F.broadcast(starts), "_b")
            .withColumn("idx", (F.col("_start") + F.col("_place") - 1).cast("int"))
            .drop("_b", "_place", "_start"))


def vectorise(df: DataFrame, row: str, vocabulary: DataFrame, size: int,
              branches: Sequence[Branch] = tuple(FEATURE_BRANCHES)) -> DataFrame:
    """Add ``features``: all branches of a row in one sparse vector, a struct of
    ``size``, ``indices`` and ``values`` in rising order of the index."""
    weighted = weigh(term_rows(df, row, branches), vocabulary, row)
    cells = weighted.groupBy(row).agg(
        F.array_sort(F.collect_list(F.struct("idx", "weight"))).alias("_cells"))
    empty = F.array().cast("array<struct<idx:int,weight:double>>")
    return (df.join(cells, row, "left").withColumn("_cells", F.coalesce("_cells", empty))
            .withColumn("features", F.struct(
                F.lit(size).alias("size"), F.col("_cells.idx").alias("indices"),
                F.col("_cells.weight").alias("values"))).drop("_cells"))
