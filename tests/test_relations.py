from webfacts.operators import paths
from webfacts.operators import relations

ENTITY = "array<struct<text:string,label:string,`pos-tags`:string>>"


def test_candidates(spark):
    e = [("cat", "A", "N"), ("dog", "B", "N")]
    rows = spark.createDataFrame([
        ("p", 3, "<e1>cat</e1> <e2>dog</e2>", e), ("p", 1, "<e1>cat</e1> <e2>dog</e2>", e),
        ("q", 0, "<e1>cat</e1>", e), ("r", 0, "<e1>cat</e1> <e2>x</e2>", e[:1]),
        ("t", 0, "<e1>cat</e1> <e2>x</e2>", None)], f"id string, sent_no int, labeled_text string, entity {ENTITY}")
    assert relations.relation_candidates(rows).count() == 1
    assert relations.relation_candidates(rows, "sent_no").first()["sent_no"] == 1


def test_prediction_features(spark):
    rows = spark.createDataFrame([(
        "The <e1>Big Cat</e1> saw a <e2>Dog</e2> run", [("big cat", "A", "J-N"), ("dog", "B", "N")], "p1")],
        f"labeled_text string, entity {ENTITY}, id string")
    got = relations.relation_features(rows).first().asDict()
    assert got == {
        "input_sentence": "The <e1>Big Cat</e1> saw a <e2>Dog</e2> run", "input_relation": None, "id": "p1",
        "e1": "Big Cat", "e2": "Dog", "e1_e2": "Big Cat Dog", "head_e1": "Big", "head_e2": "Dog",
        "head_e1_e2": "Big Dog", "before_e1": "The", "between_e1_e2": "saw a", "after_e2": "run",
        "e1_ner": "A", "e2_ner": "B", "e1_postag": "J-N", "e2_postag": "N", "e1_e2_ner": "A B",
        "relation": None, "direction": None,
        "sentence_string": "The  Big Cat  saw a  Dog  run", "shortest_path": ""}


def test_training_features(spark):
    blocks = spark.createDataFrame(
        [('1\t"A <e1>cat</e1> and <e2>dogs</e2>."', "Part(e2,e1)\n")], "line string, input_relation string")
    rows = relations.labelled_sentences(blocks).selectExpr(
        "*", "array(named_struct('text','cat','label','A','pos-tags','N')) AS entity",
        "array(named_struct('text','cat','tag','N1'), named_struct('text','dogs','tag','N2')) AS parse_list")
    got = relations.relation_features(rows, training=True).first()
    assert (got["relation"], got["direction"], got["input_relation"]) == ("Part", "e2,e1", "Part**e2,e1")
    assert (got["e1_ner"], got["e2_ner"], got["e1_e2_ner"]) == ("A", None, None)
    assert (got["e1_postag"], got["e2_postag"]) == ("N1", "N2")
    assert got["id"] is None and len(got["parse_list"]) == 2
    bare = relations.relation_features(rows.drop("parse_list"), training=True).first()
    assert bare["e1_postag"] is None


def test_costly_rows_are_not_put_into_one_task(spark):
    from webfacts.operators.model import prediction_features
    word = "struct<text:string,label:string,`pos-tags`:string>"
    tagged = spark.range(64).selectExpr(
        "concat('d', id) id", "1 sent_no", "concat('<e1>a', id, '</e1> of <e2>b</e2>') labeled_text",
        f"cast(array(struct('a', 'ORG', 'X'), struct('b', 'ORG', 'X')) as array<{word}>) entity")
    tokens = tagged.selectExpr("concat(id, '-1') sent_id", "posexplode(array('a', 'of', 'b')) as (pos, token)").selectExpr(
        "sent_id", "pos + 1 pos", "1 head", "token", "'X' tag", "'d' dep")
    parts = prediction_features(tagged, tokens).selectExpr("spark_partition_id() p").distinct().count()
    edges = paths.token_edges(tokens).selectExpr("spark_partition_id() p").distinct().count()
    assert parts > 1 and edges > 1


def test_sentences_are_cut_once_and_of_labelled_documents_only(spark, monkeypatch):
    from conftest import DATA
    from webfacts.plans import inputs, queries
    calls, cut = [], inputs.doc_sentences
    monkeypatch.setattr(inputs, "doc_sentences", lambda *a, **k: calls.append(a) or cut(*a, **k))
    queries._feature_rows(spark, DATA)
    inputs.labelled_features(spark, DATA)
    assert len(calls) == 2
    ids = spark.createDataFrame([("doc-1",), ("doc-3",), ("doc-3",), (None,)], "id string")
    some, every = cut(spark, DATA, ids), cut(spark, DATA).where("id IN ('doc-1', 'doc-3')")
    assert some.count() == every.count() > 0 and some.exceptAll(every).isEmpty()
