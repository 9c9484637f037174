import collections

import pytest

from webfacts.llm import sharding

SCHEMA = "doc_id long, text string, source string, Shard int, extra string"


def placed(spark, rows, **options):
    docs = spark.createDataFrame([(*r, 9, "x") for r in rows], SCHEMA)
    found = sharding.interleave(
        sharding.text_rows(docs), ties=("text_crc32", "size"), **options)
    assert found.columns == ["doc_id", "source", "extra", "size", "text_crc32", "shard", "slot"]
    return found.collect()


@pytest.mark.parametrize("piece", [5, 1024])
@pytest.mark.parametrize("shards", [1, 7, 16])
def test_shards_match_the_mixture(spark, shards, piece):
    names = ["a"] * 20 + ["b"] * 9 + ["c", None]
    rows = [(i, "t", names[i * 7 % len(names)]) for i in range(930)]
    found = placed(spark, rows, shards=shards, piece=piece)
    assert sorted(r["doc_id"] for r in found) == list(range(930))
    by = collections.defaultdict(list)
    for r in found:
        by[r["shard"]].append(r)
    assert sorted(by) == list(range(shards))
    sizes = [len(v) for v in by.values()]
    assert max(sizes) - min(sizes) <= 1
    total = collections.Counter(r["source"] for r in found)
    for own in by.values():
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
        count = collections.Counter(r["source"] for r in own)
        assert all(abs(count[s] - total[s] / shards) <= 2 for s in total)


def test_order_is_that_of_the_fractional_rank(spark):
    import hashlib

    rows = [(i, "t", "abc"[i % 3] if i % 5 else "a") for i in range(200)]
    digest = lambda i: hashlib.md5(f"8|{i}".encode()).hexdigest()
    ranked = []
    for source in "abc":
        own = sorted((r[0] for r in rows if r[2] == source), key=digest)
        ranked += [((k + 0.5) / len(own), f"={source}", i) for k, i in enumerate(own)]
    wanted = [i for _, _, i in sorted(ranked)]
    found = sorted(placed(spark, rows, piece=9), key=lambda r: (r["shard"], r["slot"]))
    assert [r["doc_id"] for r in found] == wanted


def test_odd_tables(spark):
    assert placed(spark, []) == []
    rows = [(None, None, None)] * 4 + [(1, "", "a"), (1, "é", "a"), (1, "é", "a"), (2, "x" * 100_000, "a")]
    found = placed(spark, rows, shards=3)
    assert sorted(r["size"] for r in found) == [1, 1, 1, 1, 1, 3, 3, 100_001]
    again = placed(spark, rows, shards=3)
    assert sorted(map(tuple, found), key=repr) == sorted(map(tuple, again), key=repr)
    assert [tuple(r)[-2:] for r in placed(spark, [(1, "a", "s")], shards=16)] == [(0, 0)]
