"""Cosine similarity of strings as multisets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from webfacts.functions.text import let


def _occurrences(text: Column, ch: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, ch, F.lit("")))


def _cosine(same: Column, size_a: Column, size_b: Column, shared: Column) -> Column:
    ratio = shared / F.sqrt(size_a.cast("double") * size_b.cast("double"))
    return F.when(same, F.lit(1.0)).when((size_a == 0) | (size_b == 0), F.lit(0.0)).otherwise(ratio)


def char_cosine(a: Column, b: Column, case_sensitive: bool = True) -> Column:
    """Shared characters over the geometric mean of the lengths."""
    if not case_sensitive:
        a, b = F.lower(a), F.lower(b)
    shared = F.aggregate(
        F.array_distinct(F.split(a, "")), F.lit(0),
        lambda n, ch: n + F.when(ch == "", F.lit(0)).otherwise(
            F.least(_occurrences(a, ch), _occurrences(b, ch))))
    return _cosine(a == b, F.length(a), F.length(b), shared)


def word_cosine(a: Column, b: Column) -> Column:
    """The same over blank-separated words."""
    def words(c: Column) -> Column:
        return F.filter(F.split(c, r"\s+"), lambda w: w != "")

    def count(arr: Column, w: Column) -> Column:
        return F.size(F.filter(arr, lambda x: x == w))

    def score(wa: Column, wb: Column) -> Column:
        shared = F.aggregate(
            F.array_distinct(wa), F.lit(0),
            lambda n, w: n + F.least(count(wa, w), count(wb, w)))
        return _cosine(wa == wb, F.size(wa), F.size(wb), shared)

    return let(words(a), lambda wa: let(words(b), lambda wb: score(wa, wb)))
