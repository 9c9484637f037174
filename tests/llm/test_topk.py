import random

import pytest
from pyspark.sql import functions as F

from webfacts.llm import topk


def brute(rows, queries, k):
    out = []
    for q, a in queries:
        scored = sorted(((-sum(x * y for x, y in zip(a, b)), i) for i, b in rows if i != q))
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize("blocks", [(4096, 2048), (3, 5)])
@pytest.mark.parametrize("density", [0.1, 0.9])
def test_against_all_pairs(spark, blocks, density):
    rng = random.Random(9)
    rows = [(i * 3 - 20, [rng.randrange(-9, 10) if rng.random() < density else 0 for _ in range(12)]) for i in range(90)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, weights array<long>, rank string")
    found = topk.search(df, df.where("vec_id % 5 = 0"), 4, *blocks)
    assert sorted(map(tuple, found.collect())) == brute(rows, [r for r in rows if r[0] % 5 == 0], 4)


def test_ties_repeats_and_odd_rows(spark):
    rows = [(1, [1, 0]), (2, [1, 0]), (3, [1, 0]), (4, [1, 0]), (5, []), (6, [1]), (7, None), (None, [1, 1]),
            (4, [1, 0]), (4, [0, 7])]
    df = spark.createDataFrame(rows, "vec_id long, weights array<long>")
    found = topk.search(df, df.where("vec_id IN (4, 5)"), 3)
    assert sorted(map(tuple, found.collect())) == [
        (4, 1, 1, 1), (4, 2, 1, 1), (4, 3, 2, 1), (5, 1, 1, 0), (5, 2, 2, 0), (5, 3, 3, 0)]


def test_rows_of_one_id_are_all_candidates(spark):
    rows = [(50, [1, 0]), (1, [0, 9]), (1, [5, 0]), (2, [3, 0]), (1, [5, 0]), (50, [0, 1])]
    df = spark.createDataFrame(rows, "vec_id long, weights array<long>")
    found = topk.search(df, df.where("vec_id = 50"), 4)
    assert sorted(map(tuple, found.collect())) == [(50, 1, 1, 9), (50, 2, 1, 5), (50, 3, 1, 5), (50, 4, 2, 3)]


def test_empty_searches(spark):
    df = spark.createDataFrame([(1, [1])], "vec_id long, weights array<long>")
    assert topk.search(df.where("vec_id = 1"), df.where("vec_id = 1")).collect() == []
    assert topk.search(df.where("false"), df.where("false")).collect() == []


def test_integer_weights(spark):
    rows = [([0.5, -0.001, 1.0],), (None,), ([1.0, None],), ([float("nan")],), ([float("-inf")],), ([],)]
    df = spark.createDataFrame(rows, "v array<float>").select(topk.integer_weights(F.col("v")).alias("w"))
    assert [r["w"] for r in df.collect()] == [[128, -1, 256], None, None, None, None, []]
