import math
import os
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import plan_text
from webfacts.constants import FEATURE_BRANCHES
from webfacts.operators import features, model, relations, svm
from webfacts.operators.joins import cut_lineage

ENTITY = "array<struct<text:string,label:string,`pos-tags`:string>>"


def labelled(spark, n=40):
    """Two relations told apart by the word between the entities, and a rest."""
    kinds = [("caused by", "Cause-Effect(e2,e1)"), ("holds", "Content-Container(e2,e1)"), ("near", "Other")]
    rows = []
    for i in range(n):
        between, relation = kinds[i % 3]
        rows.append((f"p{i}", f"No {i % 7} <e1>thing{i % 5}</e1> {between} <e2>item{i % 4}</e2> here",
                     relation, [(f"thing{i % 5}", "A", "NOUN"), (f"item{i % 4}", "B", "NOUN")]))
    df = spark.createDataFrame(rows, f"id string, input_sentence string, input_relation string, entity {ENTITY}")
    return model.training_rows(relations.relation_features(df, training=True))


def test_branches_are_complete():
    kinds = Counter(kind for _, _, kind in FEATURE_BRANCHES)
    assert (len(FEATURE_BRANCHES), kinds["word"], kinds["whitespace"], kinds["bigram"]) == (21, 11, 5, 5)
    assert {c for _, c, _ in FEATURE_BRANCHES} <= set(relations.FEATURE_COLUMNS) | {"shortest_path"}


def test_tfidf(spark):
    docs = {1: "aa bb aa", 2: "bb cc", 3: "", 4: "x"}
    got = features.tfidf(
        spark.createDataFrame(list(docs.items()), "id int, t string"), "id", [("t", "t", "word")])
    want = {}
    words = {d: Counter(w for w in t.split() if len(w) > 1) for d, t in docs.items()}
    df = Counter(w for c in words.values() for w in c)
    for d, c in words.items():
        raw = {w: n * (math.log((1 + len(docs)) / (1 + df[w])) + 1) for w, n in c.items()}
        norm = math.sqrt(sum(x * x for x in raw.values()))
        want.update({(d, w): pytest.approx(x / norm) for w, x in raw.items()})
    assert {(r["id"], r["term"]): r["weight"] for r in got.collect()} == want


def test_missing_and_label(spark):
    df = spark.createDataFrame([("Other", None, None), ("A", "e1,e2", "x")],
                               "relation string, direction string, e1_ner string")
    got = features.class_label(features.fill_missing(df)).collect()
    assert [tuple(r) for r in got] == [("Other", "nan", "nan", "Other nan"), ("A", "e1,e2", "x", "A e1,e2")]


def test_term_numbers_have_no_gaps(spark):
    idf = spark.range(500).select(
        F.concat(F.lit("b"), F.col("id") % 3).alias("branch"), F.col("id").cast("string").alias("term"),
        F.lit(1.0).alias("idf"))
    got = sorted(r["idx"] for r in features.number_terms(idf).collect())
    assert got == list(range(500))


def test_split_depends_on_the_key_only(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    train, test = model.split_by_key(df, "k")
    again, _ = model.split_by_key(df.repartition(7), "k")
    assert {r["k"] for r in train.collect()} == {r["k"] for r in again.collect()}
    assert train.count() + test.count() == 1000 and 640 < train.count() < 760
    assert sum(d.count() for d in model.split_random(df)) == 1000


def test_fit_predict_link(spark):
    rows = labelled(spark)
    fitted = model.fit_relations(rows)
    assert fitted.labels == ["Cause-Effect e2,e1", "Content-Container e2,e1", "Other nan"]
    predicted = model.predict_relations(rows, fitted)
    assert predicted.count() == rows.count()
    assert model.evaluate(predicted, fitted) == 1.0
    assert model.evaluate(predicted, fitted, "f1") == 1.0
    plan = plan_text(predicted)
    assert "EvalPython" not in plan and "Cartesian" not in plan

    dictionary = spark.createDataFrame(
        [("Other nan", None, None), ("Cause-Effect e2,e1", "has effect ", "link")],
        "relation string, relation_name string, link string")
    linked = {r["preds"]: (r["relation_name"], r["link"])
              for r in model.link_relations(predicted, dictionary).collect()}
    assert linked == {"Other nan": (None, None), "Cause-Effect e2,e1": ("has effect ", "link"),
                      "Content-Container e2,e1": (None, None)}

    tagged = rows.select("id", F.col("input_sentence").alias("labeled_text")).withColumn(
        "entity", F.expr(f"cast(array(named_struct('text','thing1','label','A','pos-tags','N'),"
                         f"named_struct('text','item1','label','B','pos-tags','N')) as {ENTITY})"))
    facts = model.extract_relations(tagged, fitted, dictionary)
    assert facts.count() == 40
    assert facts.where("between_e1_e2 = 'near' AND preds <> 'Other nan'").count() == 0


def dense(rows, fold=None):
    """Vectors with the constant 1, labels and copies of training rows, in plain
    Python; with a fold, the vocabulary is that of the rows outside it."""
    cells = features.term_rows(rows, model.ROW, FEATURE_BRANCHES).collect()
    labels = {r[model.ROW]: (r["label"], r["copies"]) for r in rows.collect()}
    train = {k for k in labels if fold is None or fold[k]}
    df = Counter((c["branch"], c["term"]) for c in cells if c[model.ROW] in train)
    place = {t: i + 1 for i, t in enumerate(sorted(df))}
    at = {k: i for i, k in enumerate(sorted(labels))}
    x = np.zeros((len(at), len(place) + 1))
    for c in cells:
        term = (c["branch"], c["term"])
        if term in place:
            x[at[c[model.ROW]], place[term]] = c["tf"] * (math.log((1 + len(train)) / (1 + df[term])) + 1)
    for branch in {b for b, _ in place}:
        own = [i for (b, _), i in place.items() if b == branch]
        norm = np.linalg.norm(x[:, own], axis=1, keepdims=True)
        x[:, own] = np.divide(x[:, own], norm, out=np.zeros_like(x[:, own]), where=norm > 0)
    x[:, 0] = 1.0
    keys = sorted(labels)
    return x, [labels[k][0] for k in keys], np.array([labels[k][1] for k in keys]), np.array([k in train for k in keys])


def objective(w, x, sign, weight):
    return w @ w / 2 + (weight * np.maximum(0, 1 - sign * (x @ w)) ** 2).sum()


def newton(x, sign, weight):
    """The minimum of the objective by Newton steps with halving."""
    w = np.zeros(x.shape[1])
    for _ in range(200):
        slack = 1 - sign * (x @ w)
        on = slack > 0
        slope = w - 2 * x[on].T @ (weight[on] * sign[on] * slack[on])
        if np.linalg.norm(slope) < 1e-9:
            break
        step = np.linalg.solve(np.eye(len(w)) + 2 * (x[on].T * weight[on]) @ x[on], slope)
        t = 1.0
        while objective(w - t * step, x, sign, weight) > objective(w, x, sign, weight) - 1e-4 * t * slope @ step and t > 1e-9:
            t /= 2
        w = w - t * step
    return w


@pytest.mark.parametrize("cells, c", [(svm.CELLS_PER_BLOCK, 1000.0), (svm.CELLS_PER_BLOCK, 1.0), (40, 0.1)])
def test_fit_equals_a_dense_fit(spark, monkeypatch, cells, c):
    """In one block and in several, the objective and the labels are those of
    Newton's method on dense vectors."""
    monkeypatch.setattr(svm, "CELLS_PER_BLOCK", cells)
    rows = labelled(spark, 36)
    noisy = rows.withColumn("label", F.when(F.col("e1") == "thing3", "Other nan").otherwise(F.col("label")))
    noisy = noisy.withColumn("copies", F.when(F.col("e2") == "item1", 3.0).otherwise(F.col("copies")))
    fitted = model.fit_relations(noisy, c)
    x, labels, copies, _ = dense(noisy)
    assert fitted.labels == sorted(set(labels))
    terms = sorted((r["branch"], r["term"], r["coef"]) for r in fitted.terms.collect())
    w = np.vstack([fitted.intercepts, [t[2] for t in terms]])
    assert len(w) == x.shape[1]
    best = []
    for k, name in enumerate(fitted.labels):
        sign = np.where(np.array(labels) == name, 1.0, -1.0)
        best.append(newton(x, sign, c * copies))
        wanted = objective(best[-1], x, sign, c * copies)
        assert wanted - 1e-9 <= objective(w[:, k], x, sign, c * copies) <= wanted * (1 + 1e-4) + 1e-9
    said = [fitted.labels[k] for k in (x @ np.array(best).T).argmax(axis=1)]
    got = {r[model.ROW]: r["preds"] for r in model.predict_relations(noisy, fitted).collect()}
    assert [got[k] for k in sorted(got)] == said


def test_rows_that_look_alike_are_one_example(spark):
    """Rows that differ in their id alone train as one, with the idf and weight of all."""
    rows = labelled(spark, 12).drop(model.ROW)
    again = rows.withColumn("id", F.concat("id", F.lit("-again"))).where("e1 <> 'thing3'")
    both = model.with_row_id(rows.unionAll(again).withColumn(
        "label", F.when(F.col("e2") == "item1", "Other nan").otherwise(F.col("label"))))
    assert both.count() > 12
    examples, _ = model._examples(both.withColumn("_fold", F.lit(0)), 0)
    assert examples.count() == 12 and examples.agg(F.sum("copies")).first()[0] == both.count()
    fitted = model.fit_relations(both)
    x, labels, copies, _ = dense(both)
    terms = sorted((r["branch"], r["term"], r["coef"]) for r in fitted.terms.collect())
    w = np.vstack([fitted.intercepts, [t[2] for t in terms]])
    for k, name in enumerate(fitted.labels):
        sign = np.where(np.array(labels) == name, 1.0, -1.0)
        assert w[:, k] == pytest.approx(newton(x, sign, 1000.0 * copies), abs=1e-6)


def test_stored_model(spark, tmp_path):
    rows = labelled(spark, 12)
    fitted = model.fit_relations(rows)
    model.write_model(fitted, str(tmp_path / "m"))
    again = model.read_model(spark, str(tmp_path / "m"))
    assert (again.labels, again.intercepts) == (fitted.labels, fitted.intercepts)
    one, two = (sorted((r[model.ROW], r["preds"]) for r in model.predict_relations(rows, m).collect())
                for m in (fitted, again))
    assert one == two


def test_vectors_equal_the_long_form(spark):
    rows = labelled(spark, 6)
    idf = features.number_terms(features.term_idf(rows, features.term_rows(rows, model.ROW, FEATURE_BRANCHES)))
    size = idf.count()
    empty = rows.limit(1).select(F.lit("none").alias(model.ROW), *[
        F.lit("").alias(c) for c in sorted({c for _, c, _ in FEATURE_BRANCHES})])
    found = features.vectorise(rows.unionByName(empty, allowMissingColumns=True), model.ROW, idf, size)
    assert "Python" not in plan_text(found)
    by_row = {}
    place = {r["idx"]: (r["branch"], r["term"]) for r in idf.collect()}
    for r in found.collect():
        assert r["features"]["size"] == size and r["features"]["indices"] == sorted(r["features"]["indices"])
        by_row[r[model.ROW]] = {place[i]: v for i, v in zip(r["features"]["indices"], r["features"]["values"])}
    assert by_row.pop("none") == {}
    wanted = {}
    for r in features.tfidf(rows, model.ROW, FEATURE_BRANCHES).collect():
        wanted.setdefault(r[model.ROW], {})[r["branch"], r["term"]] = pytest.approx(r["weight"])
    assert by_row == wanted


def test_weighted_f1(spark):
    counts = spark.createDataFrame(
        [(0, "a", "a", 3.0), (0, "a", "b", 1.0), (0, "b", "a", 2.0), (0, "c", "b", 1.0), (1, "a", "a", 2.0)],
        "i int, label string, preds string, n double")
    got = {r["i"]: r["f1"] for r in model.weighted_f1(counts, ["i"]).collect()}
    a, rest = 2 * 3 / (4 + 5), 0.0
    assert got == {0: pytest.approx(a * 4 / 7 + rest), 1: 1.0}


def test_tuning_equals_dense_folds(spark):
    rows = labelled(spark, 24)
    noisy = rows.withColumn("label", F.when(F.col("e1") == "thing3", "Other nan").otherwise(F.col("label")))
    folds, grid = 2, (0.1, 100.0)
    fold_of = {r[model.ROW]: r["f"] for r in noisy.select(model.ROW, F.pmod(
        F.xxhash64(model.ROW, F.lit(model.SPLIT_SEED)), F.lit(folds)).alias("f")).collect()}
    wanted = [0.0] * len(grid)
    for f in range(folds):
        x, labels, copies, train = dense(noisy, {k: v != f for k, v in fold_of.items()})
        labels = np.array(labels)
        known = sorted(set(labels[train]))
        for i, c in enumerate(grid):
            scores = np.stack([x @ newton(x[train], np.where(labels[train] == k, 1.0, -1.0), c * copies[train])
                               for k in known], axis=1)
            said = np.array([known[j] for j in scores.argmax(axis=1)])[~train]
            true, n = labels[~train], copies[~train]
            for k in set(true):
                hits, of, as_k = n[(true == k) & (said == k)].sum(), n[true == k].sum(), n[said == k].sum()
                wanted[i] += 2 * hits / (of + as_k) * of / n.sum() / folds
    got = [r["score"] for r in model.tune_relations(noisy, grid, folds, tolerance=1e-6, refit=False).scores.collect()]
    assert got == pytest.approx(wanted, abs=1e-6)


def test_rows_without_any_known_term_keep_a_class(spark):
    fitted = model.fit_relations(labelled(spark, 12))
    empty = model.with_row_id(spark.createDataFrame([("q",)], "id string").select(
        "id", *[F.lit("").alias(c) for c in {c for _, c, _ in FEATURE_BRANCHES}]))
    row = model.predict_relations(empty, fitted).first()
    assert row["preds"] == fitted.labels[max(range(3), key=lambda k: fitted.intercepts[k])]


def test_blocks_to_classes(spark):
    """Labelled blocks with repeated rows, end to end; copies count and stay apart."""
    from webfacts.operators import tagging
    kinds = [("caused by", "Cause-Effect(e2,e1)"), ("near", "Other")]
    blocks = spark.createDataFrame(
        [(f'{i}\t"The <e1>cat</e1> {kinds[i % 2][0]} <e2>dog</e2> {i % 3}."', kinds[i % 2][1]) for i in range(24)],
        "line string, input_relation string")
    gazetteer = tagging.prepare_gazetteer(spark.createDataFrame([("cat", "A"), ("dog", "B")], "alias string, label string"))
    rows = model.training_table(blocks, gazetteer)
    got = rows.select("e1_e2_ner", "label", "copies", "input_relation", model.ROW).collect()
    assert len(got) == 6 and len({r[model.ROW] for r in got}) == 6
    assert {(r["e1_e2_ner"], r["copies"]) for r in got} == {("A B", 4.0)}
    assert {(r["label"], r["input_relation"]) for r in got} == {
        ("Cause-Effect e2,e1", "Cause-Effect**e2,e1"), ("Other nan", "Other")}
    fitted = model.fit_relations(rows)
    predicted = model.predict_relations(rows, fitted)
    assert model.evaluate(predicted, fitted) == 1.0
    twice = model.predict_relations(rows.unionAll(rows), fitted)
    assert twice.count() == 12 and twice.where("preds <> label").count() == 0


def test_tuning(spark):
    rows = labelled(spark, 18)
    tuned = model.tune_relations(rows, grid=(1.0, 100.0), folds=2)
    got = tuned.scores.collect()
    assert [r["c"] for r in got] == [1.0, 100.0] and all(0 <= r["score"] <= 1 for r in got)
    assert model.evaluate(model.predict_relations(rows, tuned.best), tuned.best) > 0.5


def test_rows_with_one_id_are_scored_once(spark):
    rows = labelled(spark, 12)
    fitted = model.fit_relations(rows)
    once = {r[model.ROW]: r["preds"] for r in model.predict_relations(rows, fitted).collect()}
    thrice = model.predict_relations(rows.unionAll(rows).unionAll(rows), fitted).collect()
    assert len(thrice) == 3 * len(once)
    assert all(r["preds"] == once[r[model.ROW]] for r in thrice)


def test_append(spark):
    a = spark.createDataFrame([(1, "x")], "i int, s string")
    b = spark.createDataFrame([("y", 2)], "s string, i int")
    assert sorted(map(tuple, model.append_labelled(a, b).collect())) == [(1, "x"), (2, "y")]


def test_rounds_keep_one_state(spark, monkeypatch):
    """Of the coefficients and past steps that each round stores, the last ones alone stay."""
    stored = []

    def store(df):
        stored.append(cut_lineage(df))
        return stored[-1]

    monkeypatch.setattr(svm, "CELLS_PER_BLOCK", 40)
    monkeypatch.setattr(svm, "cut_lineage", store)
    model.fit_relations(labelled(spark, 36), 1.0)
    states = [d for d in stored if "past" in d.columns]
    left = [d for d in states if os.path.exists(d.inputFiles()[0].removeprefix("file:"))]
    assert len(states) > 2 and len(left) == 1 and left[0] is states[-1]
