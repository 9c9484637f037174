import random
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from webfacts.llm import packing
from webfacts.llm.queries import tokenizer_file


def exact_differencing(sizes, windows):
    """The heuristic with whole vectors of sums."""
    parts = [(sorted([s] + [0] * (windows - 1), reverse=True)) for s in sizes]
    while len(parts) > 1:
        parts.sort(key=lambda p: p[0] - p[-1], reverse=True)
        one, two = parts.pop(0), parts.pop(0)
        parts.append(sorted((a + b for a, b in zip(one, reversed(two))), reverse=True))
    return parts[0] if parts else []


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 60), min_size=1, max_size=25), st.integers(1, 9))
def test_every_item_is_in_one_window(sizes, windows):
    found = packing.differencing(sizes, windows)
    assert sorted(i for w in found for i in w) == list(range(len(sizes)))
    assert len(found) <= windows


def test_two_windows_are_the_known_heuristic():
    sums = sorted(sum([8, 7, 6, 5, 4][i] for i in w) for w in packing.differencing([8, 7, 6, 5, 4], 2))
    assert sums == [14, 16]


def test_sums_are_those_of_whole_vectors():
    rng = random.Random(5)
    for windows in (2, 3, 8):
        # Distinct powers keep the order of merges the same in both.
        sizes = [3 ** i + rng.randrange(2) for i in range(12)]
        rng.shuffle(sizes)
        found = packing.differencing(sizes, windows)
        sums = sorted((sum(sizes[i] for i in w) for w in found), reverse=True)
        assert sums == [s for s in exact_differencing(sizes, windows) if s]


def test_windows_rise_until_all_fit():
    rng = random.Random(1)
    sizes = [rng.randrange(1, 513) for _ in range(1000)]
    found = packing.near_equal_windows(sizes)
    sums = [sum(sizes[i] for i in w) for w in found]
    assert max(sums) <= 2048 and min(sums) > 1900
    assert packing.near_equal_windows([2048, 1, 2048]) and packing.near_equal_windows([]) == []


def test_odd_rows(spark):
    path = tokenizer_file("byte_bpe_50k.json")
    rows = [(1, None), (2, ""), (None, "no id"), (3, "long text here " * 30_000), (4, "twin"), (4, "twin"), (5, " \n\n\t x")]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, Sequence_Id string, length int")
    found = packing.pack(docs, path, keep_ids=True).collect()
    encode = Tokenizer.from_file(path).encode
    by = {}
    for r in found:
        assert r["ids_crc32"] == zlib.crc32(r["ids"]) and len(r["ids"]) == 4 * r["length"]
        by.setdefault(r["doc_id"], []).append((r["start"], r["ids"]))
    for key, text in rows:
        own = sorted(by[key])
        ids = np.frombuffer(b"".join(d for _, d in own), "<u4").tolist()
        assert ids == (encode(text or "").ids + [1]) * (2 if key == 4 else 1)
    assert packing.pack(docs.where("false"), path).collect() == []
