from collections import Counter
from hashlib import md5
from math import ceil

import pytest
from pyspark.sql import functions as F

from webfacts.operators.splitting import smallest, split_exact

SCHEMA = "k string, v int, _place string"


def parts(spark, rows, share=0.7, pieces=4):
    df = spark.createDataFrame(rows, SCHEMA).repartition(pieces)
    train, test = split_exact(df, "k", share)
    assert train.columns == test.columns == df.columns
    got = [Counter(tuple(r) for r in part.collect()) for part in (train, test)]
    assert got[0] + got[1] == Counter(rows)
    return got


@pytest.mark.parametrize("n", [1, 2, 3, 10, 37, 1000])
def test_sizes_and_rows_as_by_sorting(spark, n):
    rows = [(str(i), i, None) for i in range(n)]
    _, test = parts(spark, rows)
    digests = sorted((md5(b"=" + k.encode()).hexdigest(), k) for k, _, _ in rows)
    assert {r[0] for r in test} == {k for _, k in digests[:ceil(3 * n / 10)]}


def test_one_key_equal_rows_and_nulls(spark):
    one_key = [("a", i, "x") for i in range(90)] + [("b", 1, None)] * 7 + [(None, 2, None)] * 4
    equal = [("a", 1, None)] * 50 + [(None, None, None)] * 51
    for rows in (one_key, equal, [("a", 1, "")] * 101):
        one = parts(spark, rows)
        assert one == parts(spark, rows, pieces=7)
        assert sum(one[1].values()) == ceil(0.3 * 101)


def test_empty_table_and_whole_shares(spark):
    assert parts(spark, []) == [Counter(), Counter()]
    rows = [("a", i, None) for i in range(5)]
    assert not parts(spark, rows, 1.0)[1] and not parts(spark, rows, 0.0)[0]
    # A float's 1 - 0.7 is more than three tenths.
    assert sum(parts(spark, [(str(i), i, None) for i in range(10)])[1].values()) == 3


def test_counts_stay_small(spark):
    df = spark.range(20_000).select(F.md5(F.col("id").cast("string")).alias("d"))
    prefix, missing = smallest(df, F.col("d"), 7_001)
    below = df.where(F.substring("d", 1, len(prefix)) < prefix).count()
    assert below + missing == 7_001
    # Three digits leave about five rows in a bar, six leave one.
    assert len(prefix) <= 9
