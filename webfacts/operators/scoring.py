"""Scoring of result lines against gold annotations.

Line frames have ``value`` and ``line_at``, an orderable line position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webfacts.constants import ENTITY_PREFIX, RELATION_PREFIX
from webfacts.functions.text import strip


def _fields(value: Column) -> Column:
    return F.split(strip(value), "\t")


def _at(n: int) -> Column:
    return F.get(F.col("_f"), F.lit(n))


def _last_per_key(rows: DataFrame, *values: str) -> DataFrame:
    """One row per ``(record, string)``: that of the last line."""
    return rows.groupBy("record", "string").agg(
        F.max_by(F.struct(*values), "line_at").alias("_v")).select("record", "string", "_v.*")


def gold_entities(lines: DataFrame) -> DataFrame:
    """``record, ENTITY, string, entity`` lines to ``(record, string, entity)``."""
    rows = lines.select("line_at", _fields(F.col("value")).alias("_f")).where(_at(1) == "ENTITY")
    return _last_per_key(rows.select(
        "line_at", _at(0).alias("record"), _at(2).alias("string"), _at(3).alias("entity")), "entity")


def gold_relations(lines: DataFrame) -> DataFrame:
    """``record, RELATION, string, s, o, rel_id`` lines to keyed rows."""
    rows = lines.select("line_at", _fields(F.col("value")).alias("_f")).where(_at(1) == "RELATION")
    return _last_per_key(rows.select(
        "line_at", _at(0).alias("record"), _at(2).alias("string"), _at(3).alias("s"),
        _at(4).alias("o"), _at(5).alias("rel_id")), "s", "o", "rel_id")


def _prefixed(lines: DataFrame, prefix: str) -> DataFrame:
    value = strip(F.col("value"))
    rest = F.substring(value, F.lit(len(prefix) + 1), F.length(value))
    return lines.where(F.startswith(value, F.lit(prefix))).select(
        "line_at", F.split(rest, "\t").alias("_f"))


def predicted_entities(lines: DataFrame) -> DataFrame:
    """``ENTITY: record, string, entity`` lines to keyed rows."""
    rows = _prefixed(lines, ENTITY_PREFIX)
    return _last_per_key(rows.select(
        "line_at", _at(0).alias("record"), _at(1).alias("string"), _at(2).alias("entity")), "entity")


def predicted_relations(lines: DataFrame) -> DataFrame:
    """``RELATION: record, s, o, string[, rel_id]`` lines to keyed rows."""
    rows = _prefixed(lines, RELATION_PREFIX)
    return _last_per_key(rows.select(
        "line_at", _at(0).alias("record"), _at(3).alias("string"), _at(1).alias("s"),
        _at(2).alias("o"), _at(4).alias("rel_id")), "s", "o", "rel_id")


def _score(gold: DataFrame, pred: DataFrame, *compare: str) -> DataFrame:
    """Counts, precision, recall and F1 as one row.

    One full outer join on the unique keys gives all three counts; a ratio
    over zero is null.
    """
    left = gold.select("record", "string", F.struct(*compare).alias("_g"), F.lit(1).alias("_in_gold"))
    right = pred.select("record", "string", F.struct(*compare).alias("_p"), F.lit(1).alias("_in_pred"))
    correct = F.col("_in_gold").isNotNull() & F.col("_in_pred").isNotNull() & (F.col("_g") == F.col("_p"))
    counts = left.join(right, ["record", "string"], "full").agg(
        F.count("_in_gold").alias("gold"), F.count("_in_pred").alias("predicted"),
        F.count(F.when(correct, 1)).alias("correct"))
    n = F.col("correct").cast("double")
    return counts.withColumns({
        "precision": F.try_divide(n, F.col("predicted").cast("double")),
        "recall": F.try_divide(n, F.col("gold").cast("double")),
    }).withColumn("f1", F.try_divide(
        F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")) * 2)


def score_entities(gold: DataFrame, pred: DataFrame) -> DataFrame:
    """Entity links: right when the link of the same record and string is equal."""
    return _score(gold_entities(gold), predicted_entities(pred), "entity")


def score_relations(gold: DataFrame, pred: DataFrame) -> DataFrame:
    """Relations: right when subject and object are equal; the id is ignored."""
    return _score(gold_relations(gold), predicted_relations(pred), "s", "o")
