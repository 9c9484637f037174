import collections
import hashlib
import math
import random

import pytest

from webfacts.llm import mixing

SCHEMA = "doc_id long, text string, source string, Target int, _n int"


def waterfill(sizes, weights=(5, 2, 1), share=1.5, cap=2.0):
    """Share by weight, and again what is over, until nothing is."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, left, rest = {}, set(names), share * sum(sizes.values())
    while left:
        total = sum(weight[s] for s in left)
        over = {s for s in left if rest * weight[s] / total >= cap * sizes[s]}
        if not over:
            target.update({s: rest * weight[s] / total for s in left})
            break
        for s in over:
            target[s] = cap * sizes[s]
        rest -= sum(target[s] for s in over)
        left -= over
    return target


def mixed(spark, rows, **options):
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA)
    out = mixing.mix(docs, **options)
    assert out.columns == ["doc_id", "text", "source", "_n", "size", "source_size", "target", "copies", "taken"]
    return out.collect()


@pytest.mark.parametrize("piece", [7, 1024])
def test_targets_and_words(spark, piece):
    rng = random.Random(3)
    rows = [(i, " ".join(["w"] * int(rng.paretovariate(1.2) * 5)) if i % 50 else None,
             rng.choice(["a"] * 6 + ["b", "c", "é", "Z", None])) for i in range(1500)]
    found = mixed(spark, rows, piece=piece)
    assert sorted(r["doc_id"] for r in found) == list(range(1500))
    sizes, taken, most = collections.Counter(), collections.Counter(), collections.Counter()
    for r in found:
        assert r["size"] == len((r["text"] or "").split())
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 2
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        most[r["source"]] = max(most[r["source"]], r["size"])
    wanted = waterfill(sizes)
    for r in found:
        assert r["source_size"] == sizes[r["source"]]
        assert abs(r["target"] - wanted[r["source"]]) < 1e-6 * (1 + r["target"])
    for source in sizes:
        assert abs(taken[source] - wanted[source]) <= most[source]
    assert sorted(map(tuple, mixed(spark, rows, piece=piece)), key=repr) == sorted(map(tuple, found), key=repr)


def test_pieces_do_not_matter(spark):
    rows = [(i, " ".join(["w"] * (i * 37 % 90)), "ab"[i % 2]) for i in range(400)]
    key = lambda found: sorted((r["doc_id"], r["copies"]) for r in found)
    assert key(mixed(spark, rows, piece=3)) == key(mixed(spark, rows, piece=10_000))


def test_odd_tables(spark):
    assert mixed(spark, []) == []
    assert [r["taken"] for r in mixed(spark, [(1, None, "a"), (2, "", None)])] == [0, 0]
    rows = [(None, "a b c", "s")] * 5 + [(1, "x " * 50_000, "s"), (2, " \t\n", "t")]
    found = mixed(spark, rows)
    assert len(found) == 7 and {r["size"] for r in found} == {3, 50_000, 0}


def test_repeated(spark):
    docs = spark.createDataFrame([(1, 0), (2, 1), (3, 2)], "doc_id long, copies long")
    assert sorted(r["doc_id"] for r in mixing.repeated(docs).collect()) == [2, 3, 3]


def test_nearest_of_the_drawn_offsets(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(["w"] * int(rng.paretovariate(1.1) * 9)), rng.choice(["a", "a", "b", None])) for i in range(300)]
    found = collections.defaultdict(list)
    for r in mixed(spark, rows):
        found[r["source"]].append(r)
    digest = lambda text: hashlib.md5(f"9|{text}".encode()).hexdigest()
    for source, own in found.items():
        own.sort(key=lambda r: (len(str(r["size"])), str(r["size"])[:2], digest(r["doc_id"]), r["size"]))
        rate, key = own[0]["target"] / own[0]["source_size"], "~" if source is None else f"={source}"
        tried = []
        for i in range(16):
            u = int(digest(f"{i}|{key}")[:8], 16) / 2 ** 32
            copies = [math.floor(u + rate * k) - math.floor(u + rate * (k - 1)) for k in range(1, len(own) + 1)]
            tried.append((abs(sum(c * r["size"] for c, r in zip(copies, own)) - own[0]["target"]), i, copies))
        assert [r["copies"] for r in own] == min(tried)[2]
