import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from webfacts.functions.similarity import char_cosine, word_cosine

A, B = F.col("a"), F.col("b")
PAIRS = [("abc", "abc"), ("abc", "xyz"), ("", "abc"), ("", ""), ("aab", "ab"), ("Cat", "cat"),
         ("new york", "york news"), ("a b a", "a c")]


def cosine(u, v):
    if u == v:
        return 1.0
    if not u or not v:
        return 0.0
    return sum((Counter(u) & Counter(v)).values()) / math.sqrt(len(u) * len(v))


def test_characters(evaluate):
    assert evaluate(char_cosine(A, B), PAIRS, "a string, b string") == pytest.approx(
        [cosine(u, v) for u, v in PAIRS])
    assert evaluate(char_cosine(A, B, case_sensitive=False), [("Cat", "cat")], "a string, b string") == [1.0]


def test_words(evaluate):
    assert evaluate(word_cosine(A, B), PAIRS, "a string, b string") == pytest.approx(
        [cosine(u.split(), v.split()) for u, v in PAIRS])
