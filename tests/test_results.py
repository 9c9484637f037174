import pytest

from webfacts.operators import joins, results, scoring


@pytest.mark.parametrize("limit", [joins.BROADCAST_BYTES, 0])
def test_result_lines(spark, limit, monkeypatch):
    monkeypatch.setattr(joins.lookup_join, "__defaults__", ("inner", limit, False))
    rel = spark.createDataFrame([
        ("p1", "Cat", "Dog", "has cause", "P828"), ("p1", "Cat", "Emu", "x", "y"),
        ("p2", "Cat", "Dog", "x", "y"), ("p1", "Dog", "Nil", None, None), ("p1", "it's", "Dog", "r", "l")],
        "id string, e1 string, e2 string, relation_name string, link string")
    links = spark.createDataFrame([
        ("p1", "cat", "u-cat"), ("p1", "cat", "u-cat"), ("p1", "dog", "u-dog"), ("p1", "nil", None),
        ("p1", "it's", "u-its")], "id string, entity string, linking string")
    assert sorted(r["value"] for r in results.result_lines(rel, links).collect()) == sorted([
        "ENTITY: p1\tCat\tu-cat", "ENTITY: p1\tDog\tu-dog", "RELATION: p1\tu-cat\tu-dog\thas cause\tP828",
        "ENTITY: p1\tDog\tu-dog", "ENTITY: p1\tNil\tNone", "RELATION: p1\tu-dog\tNone\tnan\tnan",
        "ENTITY: p1\tit's\tu-its", "ENTITY: p1\tDog\tu-dog", "RELATION: p1\tu-its\tu-dog\tr\tl"])


def test_find_link(spark):
    links = spark.createDataFrame([("p'1", "it's", "u"), ("p2", "it's", "v")],
                                  "id string, entity string, linking string")
    assert [tuple(r) for r in results.find_link(links, "p'1", "IT'S").collect()] == [("it's", "u", "p'1")]
    assert results.find_link(links, "p'1", "other").count() == 0


def lines(spark, *values):
    return spark.createDataFrame(list(enumerate(values)), "line_at int, value string")


GOLD = ("r1\tENTITY\tCat\tu1", "r1\tENTITY\tDog\tu2", "r1\tENTITY\tDog\tu3", "r2\tENTITY\tCat\tu1",
        "r1\tRELATION\tpart of\ts\to\tP1", "r2\tRELATION\tpart of\ts\to\tP1", "r3\tRELATION\tENTITY of\ts\to\tP1")
PRED = ("ENTITY: r1\tCat\tu1", "ENTITY: r1\tDog\tu9", "ENTITY: r1\tDog\tu3", "ENTITY: r9\tCat\tu1",
        "RELATION: r1\ts\to\tpart of\tP9", "RELATION: r2\ts\tx\tpart of", "RELATION: r3\ts\to\tENTITY of")


def test_rows(spark):
    gold, pred = lines(spark, *GOLD), lines(spark, *PRED)
    assert sorted(map(tuple, scoring.gold_entities(gold).collect())) == [
        ("r1", "Cat", "u1"), ("r1", "Dog", "u3"), ("r2", "Cat", "u1")]
    assert sorted(map(tuple, scoring.predicted_relations(pred).collect())) == [
        ("r1", "part of", "s", "o", "P9"), ("r2", "part of", "s", "x", None), ("r3", "ENTITY of", "s", "o", None)]
    assert scoring.gold_relations(gold).count() == 3 and scoring.predicted_entities(pred).count() == 3


def test_scores(spark):
    gold, pred = lines(spark, *GOLD), lines(spark, *PRED)
    e = scoring.score_entities(gold, pred).first()
    assert (e["gold"], e["predicted"], e["correct"]) == (3, 3, 2)
    assert (e["precision"], e["recall"], e["f1"]) == pytest.approx((2 / 3, 2 / 3, 2 / 3))
    r = scoring.score_relations(gold, pred).first()
    assert (r["gold"], r["predicted"], r["correct"]) == (3, 3, 2)


def test_scores_of_nothing_are_null(spark):
    empty = lines(spark, "x")
    row = scoring.score_entities(lines(spark, *GOLD), empty).first()
    assert (row["predicted"], row["correct"], row["precision"], row["recall"], row["f1"]) == (0, 0, None, 0.0, None)
    assert scoring.score_relations(empty, empty).first()["f1"] is None
    missed = scoring.score_entities(lines(spark, GOLD[0]), lines(spark, "ENTITY: r1\tCat\tzz")).first()
    assert (missed["correct"], missed["f1"]) == (0, None)


def test_sentences_of_the_query_are_tagged_once(spark, monkeypatch):
    from conftest import DATA
    from webfacts.plans import inputs, queries
    calls, tagged = [], inputs.tagged
    monkeypatch.setattr(inputs, "tagged", lambda *a, **k: calls.append(a) or tagged(*a, **k))
    lines = queries.result_lines(spark, DATA)
    assert len(calls) == 1 and lines.columns == ["value"]
