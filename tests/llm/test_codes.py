import hashlib
import math

import numpy as np
import pytest

from webfacts.llm import codes


def sign_changes(row):
    return int((np.diff(np.sign(row)) != 0).sum())


@pytest.mark.parametrize("width", [1, 2, 4, 8, 16])
def test_transform_is_in_sequency_order_and_keeps_distances(width):
    basis = codes.walsh_hadamard(np.eye(width, dtype=np.int64))
    assert [sign_changes(basis[:, s]) for s in range(width)] == list(range(width))
    rng = np.random.default_rng(width)
    a, b = rng.integers(-300, 300, (2, 20, width))
    left = ((codes.walsh_hadamard(a) - codes.walsh_hadamard(b)) ** 2).sum(axis=1)
    assert (left == width * ((a - b) ** 2).sum(axis=1)).all()


@pytest.mark.parametrize("size", [1, 3, 4, 5, 7])
def test_nearest_against_all_distances(size):
    rng = np.random.default_rng(size)
    parts, entries = rng.integers(-4, 4, (500, size)), rng.integers(-4, 4, (30, size))
    all_of_them = ((parts[:, None] - entries[None]) ** 2).sum(axis=2)
    found, distance = codes.nearest(parts, entries)
    assert (found == all_of_them.argmin(axis=1)).all()
    assert (distance == all_of_them.min(axis=1)).all()


def test_values_beyond_a_long_stay_exact():
    big = 1 << 40
    books = codes.Codebooks(np.array([[[0, 0, 0], [big, 1, 0]]]))
    found, error = codes.assign(np.array([[big, 0, 0], [big // 2 - 1, 0, 0]]), books)
    assert found.tolist() == [[1], [0]] and error[1, 0] == (big // 2 - 1) ** 2


def brute(rows, parts=16, entries=64, rounds=2):
    """``rows`` are (id, label, values); the same by plain loops."""
    width = -(-max(len(v) for *_, v in rows) // parts)
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    cut = [[(v + [0] * (parts * width - len(v)))[p * width:(p + 1) * width] for p in range(parts)]
           for *_, v in rows]
    books = [[cut[e][p] for e in range(min(entries, len(rows)))] for p in range(parts)]

    def near(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), i) for i, e in enumerate(books[p]))

    for _ in range(rounds):
        moved = []
        for p in range(parts):
            own = [[] for _ in books[p]]
            for c in cut:
                own[near(p, c[p])[1]].append(c[p])
            moved.append([[math.floor(sum(x) / len(xs)) if abs(sum(x)) < 2 ** 50 else sum(x) // len(xs)
                           for x in zip(*xs)] if xs else e for xs, e in zip(own, books[p])])
        books = moved
    found, by_label = [], {}
    for (key, label, _), c in zip(rows, cut):
        hits = [near(p, c[p]) for p in range(parts)]
        error = sum(d for d, _ in hits)
        found.append((key, label, "".join(f"{i:02x}" for _, i in hits), error))
        by_label[label] = by_label.get(label, 0) + error
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted((*r, by_label[r[1]], digest) for r in map(tuple, found))


def compressed(spark, rows):
    frame = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    return [tuple(r) for r in codes.compress(frame).select(
        "vec_id", "label", "code", "error", "label_error", "codebooks_sha256").collect()]


def test_against_plain_loops(spark):
    rng = np.random.default_rng(11)
    rows = [(int(i), int(i) % 3, [float(x) for x in rng.normal(size=40).astype("float32")]) for i in range(150)]
    rows += [(7, 1, rows[9][2]), (8, None, rows[8][2]), (200, None, [0.5] * 7)]
    usable = [(k, 99 if g is None else g, [math.floor(256 * x) for x in v]) for k, g, v in rows]
    wanted = [tuple(None if x == 99 and i == 1 else x for i, x in enumerate(r)) for r in brute(usable)]
    bad = [(300, 1, None), (301, 1, [None, 1.0]), (302, 1, [float("nan")]), (303, 1, [float("inf")])]
    assert sorted(map(repr, compressed(spark, rows + bad))) == sorted(map(repr, wanted))


def test_few_rows_and_none(spark):
    assert compressed(spark, []) == []
    assert compressed(spark, [(1, 1, None)]) == []
    (one,) = compressed(spark, [(None, None, [1.0, 2.0])])
    assert one[:5] == (None, None, "00" * 16, 0, 0)
    (empty,) = compressed(spark, [(1, 2, [])])
    assert empty[2:5] == ("00" * 16, 0, 0)


def test_clashing_columns_are_replaced(spark):
    rows = spark.createDataFrame(
        [(1, "x", 5, 6, [1.0]), (2, "x", 5, 6, [2.0])],
        "vec_id long, label string, code int, values int, embedding array<float>")
    found = codes.compress(rows)
    assert found.columns == ["vec_id", "label", *codes.OWN]
    assert found.where("label_error = 0 AND code IN ('" + "00" * 16 + "', '01" + "00" * 15 + "')").count() == 2


def test_a_hot_label_and_copies(spark):
    rows = spark.range(4000).selectExpr(
        "id AS vec_id", "1 AS label", "array(float(id % 2), float(0)) AS embedding")
    found = codes.compress(rows)
    assert found.count() == 4000
    assert [r["label_error"] for r in found.select("label_error").distinct().collect()] == [0]
