"""Shingle join against all pairs, and its parts."""

import random

import numpy as np
import pytest

from webfacts.llm import ngram_join as nj

SCHEMA = "doc_id long, text string, Node string, prefix int"


def brute(rows, k, num, den):
    sets = []
    for _, text in rows:
        words = (text or "").encode().lower().split()
        width = min(k, len(words))
        sets.append({b" ".join(words[i:i + width]) for i in range(len(words) - width + 1)} if words else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if rows[i][0] is None or rows[j][0] is None or not sets[i] or not sets[j]:
                continue
            if len(sets[i] & sets[j]) * den >= len(sets[i] | sets[j]) * num:
                root[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[find(i)] = min(key, least.get(find(i), key))
    return sorted(
        ((key, len(sets[i]), least[find(i)] if key is not None else None) for i, (key, _) in enumerate(rows)),
        key=repr)


def joined(spark, rows, k, similarity, **options):
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], SCHEMA)
    found = nj.join_shingles(docs, k=k, similarity=similarity, **options)
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found.collect()), key=repr)


def test_random_families(spark):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(60)]
    rows = []
    for _ in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([1, 3, 5, 12, 40, 120]))]
        for _ in range(rng.choice([1, 2, 6, 14])):
            words = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            rows.append((len(rows) * 7 % 1000, " ".join(words)))
    for k, similarity in ((4, (85, 100)), (5, (80, 100)), (1, (1, 2))):
        assert joined(spark, rows, k, similarity) == brute(rows, k, *similarity)


def test_odd_rows(spark):
    long = " ".join(f"t{i}" for i in range(30_000))
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (None, "a b c d e f"), (5, "a b c d e f"), (4, "A B\tC\nD E F"),
        (6, "one"), (7, "ONE"), (8, "é É"), (9, "É É"), (10, long), (11, long + " end"), (5, "a b c d e f"),
        (12, "p q r s"), (12, "x y z u")]
    assert joined(spark, rows, 4, (85, 100)) == brute(rows, 4, 85, 100)


def test_empty_table(spark):
    assert joined(spark, [], 4, (85, 100)) == []


def test_large_group_of_near_copies(spark):
    rng = random.Random(7)
    base = [f"b{i}" for i in range(80)]
    rows = [(0, " ".join(base))]
    for i in range(1, 300):
        words = list(base)
        for _ in range(rng.choice([0, 1, 2, 3])):
            words[rng.randrange(80)] = f"x{rng.randrange(10_000)}"
        rows.append((i, " ".join(words)))
    assert joined(spark, rows, 5, (80, 100)) == brute(rows, 5, 80, 100)


def test_components_of_chains_and_stars(spark):
    links = [(f"c{i:03}", f"c{i + 1:03}") for i in range(40)] + [("s0", f"s{i}") for i in range(1, 9)]
    random.Random(1).shuffle(links)
    found = {r["node"]: r["root"] for r in nj.components(spark.createDataFrame(links, "a string, b string")).collect()}
    assert found == {**{f"c{i:03}": "c000" for i in range(41)}, **{f"s{i}": "s0" for i in range(9)}}


@pytest.mark.parametrize("top", [0, 1, 255, 256, 1 << 40])
def test_packed_lists(top):
    values = np.unique(np.random.default_rng(3).integers(0, top + 1, 50).astype(np.uint64))
    assert (nj._unpacked(*nj._packed(values)) == values).all()
