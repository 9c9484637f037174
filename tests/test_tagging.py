import pytest

from conftest import plan_text
from webfacts.operators import joins, tagging
from webfacts.plans import facts

GAZETTEER = [("cat", "ANIMAL"), ("big cat", "ANIMAL"), ("cat food", "PRODUCT"), ("food", "PRODUCT"),
             ("monday", "DATE"), ("cat", "BEAST")]
LEXICON = [("cat", "NOUN"), ("big", "ADJ")]


@pytest.fixture
def dictionary(spark):
    return tagging.prepare_gazetteer(
        spark.createDataFrame(GAZETTEER, "alias string, label string"),
        spark.createDataFrame(LEXICON, "token string, pos string"))


def sentences(spark, *texts):
    return spark.createDataFrame(
        [(f"p{i}", 0, t.title(), t) for i, t in enumerate(texts)],
        "id string, sent_no int, org_text string, text string")


def entities(df):
    return {r["id"]: [tuple(e) for e in r["entity"]] for r in df.collect()}


def test_dictionary(dictionary):
    assert sorted(map(tuple, dictionary.collect())) == [
        ("big cat", "ANIMAL", "ADJ-NOUN", 2), ("cat", "ANIMAL", "NOUN", 1),
        ("cat food", "PRODUCT", "NOUN- ", 2), ("food", "PRODUCT", " ", 1)]


def test_dictionary_without_lexicon(spark):
    got = tagging.prepare_gazetteer(spark.createDataFrame(GAZETTEER, "alias string, label string"))
    assert {r["alias"]: r["pos_tags"] for r in got.collect()}["big cat"] == " - "


def test_single_words_in_text_order(spark, dictionary):
    df = sentences(spark, "food cat monday cat", "nothing", "")
    assert entities(tagging.tag_entities(df, dictionary)) == {
        "p0": [("food", "PRODUCT", " "), ("cat", "ANIMAL", "NOUN"), ("cat", "ANIMAL", "NOUN")],
        "p1": [], "p2": []}


def test_phrases_leftmost_longest(spark, dictionary):
    df = sentences(spark, "big cat food", "cat food cat", "big", "cat")
    assert {k: [e[0] for e in v] for k, v in entities(
        tagging.tag_entities(df, dictionary)).items()} == {
        "p0": ["big cat", "food"], "p1": ["cat food", "cat"], "p2": [], "p3": ["cat"]}


@pytest.mark.parametrize("limit", [joins.BROADCAST_BYTES, 0])
def test_copies_keep_their_number(spark, dictionary, limit, monkeypatch):
    monkeypatch.setattr(joins.lookup_join, "__defaults__", ("inner", limit, False))
    one = sentences(spark, "cat here", "none here")
    copies = one
    for _ in range(5):
        copies = copies.unionAll(one)
    tagged = tagging.tag_entities(copies, dictionary)
    assert tagged.columns == [*one.columns, "entity"]
    assert tagged.count() == 12
    assert {len(r["entity"]) for r in tagged.where("id = 'p0'").collect()} == {1}
    assert tagging.tag_entities(copies, dictionary, mentioned_only=True).count() == 6


def test_same_key_different_text(spark, dictionary):
    df = spark.createDataFrame(
        [("p", 0, "A", "cat"), ("p", 0, "B", "food"), ("p", 0, None, "cat"), ("p", 0, "cat", None)],
        "id string, sent_no int, org_text string, text string")
    got = sorted((str(r["org_text"]), [e["text"] for e in r["entity"]])
                 for r in tagging.tag_entities(df, dictionary).collect())
    assert got == [("A", ["cat"]), ("B", ["food"]), ("None", ["cat"]), ("cat", [])]


def test_mark_and_flatten(spark, dictionary):
    tagged = tagging.mark_pairs(tagging.tag_entities(sentences(spark, "cat eats food"), dictionary))
    assert tagged.first()["labeled_text"] == "<e1>Cat</e1> Eats <e2>Food</e2>"
    assert [tuple(r) for r in tagging.entity_rows(tagged, "id").collect()] == [
        ("p0", 0, "cat", "ANIMAL", "NOUN"), ("p0", 1, "food", "PRODUCT", " ")]


def test_pos_map_last_wins(spark):
    tokens = spark.createDataFrame(
        [("s", 1, "run", "VERB"), ("s", 2, "cat", "NOUN"), ("s", 3, "run", "NOUN")],
        "sent_id string, pos int, token string, tag string")
    row = tagging.pos_map(tokens, "sent_id").select(
        "pos_map", tagging.pos_string(tagging.F.lit("cat run x"), tagging.F.col("pos_map"))).first()
    assert row[0] == {"run": "NOUN", "cat": "NOUN"}
    assert row[1] == "NOUN-NOUN- "


def test_model_plug_in(spark):
    def find_all(batches):
        for b in batches:
            yield b.assign(entity=[[{"text": w, "label": "W", "pos-tags": "X"} for w in t.split()]
                                   for t in b["text"]])
    got = tagging.tag_with_model(sentences(spark, "a b"), find_all)
    assert entities(got) == {"p0": [("a", "W", "X"), ("b", "W", "X")]}


def test_plan_has_no_python_and_one_sentence_shuffle(spark, dictionary):
    tagged = facts.tag_and_mark(
        sentences(spark, "cat"), spark.createDataFrame(GAZETTEER, "alias string, label string"))
    plan = plan_text(tagged)
    assert "EvalPython" not in plan and "CartesianProduct" not in plan
    physical = tagged._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in physical
    assert physical.count("Exchange hashpartitioning(id") == 1


def test_sentences_without_an_entity_are_not_shuffled(spark, dictionary, monkeypatch):
    one = sentences(spark, "cat here", "none here", "cat cat", "")
    rows = one.unionAll(one).unionAll(one.where("text = 'cat cat'"))
    got = tagging.tag_entities(rows, dictionary, mentioned_only=True)
    physical = got._jdf.queryExecution().executedPlan().toString()
    assert "Inner, BuildRight" in physical and "LeftOuter" not in physical
    # Beyond the limit the sentences are shuffled, with the same result.
    monkeypatch.setattr(joins.lookup_join, "__defaults__", ("inner", 0, False))
    other = tagging.tag_entities(rows, dictionary, mentioned_only=True, limit=0)
    assert sorted(map(str, got.collect())) == sorted(map(str, other.collect()))
    assert sorted((r["id"], len(r["entity"])) for r in got.collect()) == [
        ("p0", 1), ("p0", 1), ("p2", 2), ("p2", 2), ("p2", 2)]
