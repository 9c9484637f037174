"""Rows in the order of an id, cut into ranges that fit a task.

The cut points come from the ids of all rows, so ranges have about equal
numbers of rows whatever the ids look like. A range is never split between
tasks, and tasks stream their rows in order.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Ranges for each shuffle partition, so that their sizes even out in a task.
RANGES_PER_PARTITION = 4


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def cut_points(rows: DataFrame, key: str, ranges: int | None = None) -> list[int]:
    """Ids that begin a range, ascending; the first range begins before all."""
    ranges = ranges or RANGES_PER_PARTITION * shuffle_partitions(rows.sparkSession)
    shares = [i / ranges for i in range(1, ranges)]
    row = rows.agg(F.min(key).alias("least"), F.percentile_approx(
        key, shares or [0.5], max(10_000, 20 * ranges)).alias("cuts")).first()
    return sorted({c for c in row["cuts"] or [] if c > row["least"]})


def _longs(values: list[int]) -> Column:
    return F.array(*[F.lit(v).cast("long") for v in values])


def range_of(
    key: Column, cuts: list, literal: Callable[[list], Column] = _longs,
) -> Column:
    """Number of the range a key lies in; null keys are in the first.

    ``literal`` makes an array of cut points. Looks for the group of cut points
    first, then inside it.
    """
    if not cuts:
        return F.lit(0)
    step = math.isqrt(len(cuts)) or 1
    groups = [cuts[i:i + step] for i in range(0, len(cuts), step)]
    below = lambda c: c <= key
    group = F.size(F.filter(literal([g[0] for g in groups]), below))
    inside = F.size(F.filter(F.element_at(F.array(*map(literal, groups)), group), below))
    return F.when(key.isNull() | (key < F.element_at(literal(cuts[:1]), 1)), F.lit(0)).otherwise(
        (group - 1) * step + inside)


def in_ranges(rows: DataFrame, part: str, *order: Column, partitions: int = 0) -> DataFrame:
    """Each range whole in one task, its rows in order; in more ``partitions``
    than the session's, if so many are asked for, ranges meet less unevenly."""
    n = max(partitions, shuffle_partitions(rows.sparkSession))
    return rows.repartition(n, part).sortWithinPartitions(part, *order)
