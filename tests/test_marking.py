import random

from pyspark.sql import functions as F

from webfacts.functions import marking as M

X, E = F.col("x"), F.col("e")


def mark(text, names):
    """The rule, in plain Python."""
    low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    names = [n for n in dict.fromkeys(names) if n]
    first = min(((low.find(n), -len(n), n) for n in names if n in low), default=None)
    if first is None:
        return text
    at, end, name = first[0], first[0] - first[1], first[2]
    out = f"{text[:at]}<e1>{text[at:end]}</e1>"
    second = min(((low.find(n, end), -len(n)) for n in names if n != name and low.find(n, end) >= 0),
                 default=None)
    if second is None:
        return out + text[end:]
    stop = second[0] - second[1]
    return f"{out}{text[end:second[0]]}<e2>{text[second[0]:stop]}</e2>{text[stop:]}"


def test_mark_pair_by_hand(evaluate):
    rows = [("None here", ["x9"]), ("One Cat only", ["cat"]), ("A cat and a Dog", ["dog", "cat"]),
            ("Big Apple Inc", ["apple", "big apple", "big"]), ("dog then cat", ["cat", "dog", "cat"]),
            ("cat cat dog", ["cat", "dog"]), ("empty", []), ("İx cat", ["cat"])]
    assert evaluate(M.mark_pair(X, E), rows, "x string, e array<string>") == [
        "None here", "One <e1>Cat</e1> only", "A <e1>cat</e1> and a <e2>Dog</e2>",
        "<e1>Big Apple</e1> Inc", "<e1>dog</e1> then <e2>cat</e2>", "<e1>cat</e1> cat <e2>dog</e2>",
        "empty", "İx <e1>cat</e1>"]


def test_mark_pair_random(evaluate):
    rng = random.Random(3)
    rows = [("".join(rng.choice("abAB ") for _ in range(rng.randrange(12))),
             ["".join(rng.choice("ab ") for _ in range(rng.randrange(3))) for _ in range(rng.randrange(4))])
            for _ in range(400)]
    assert evaluate(M.mark_pair(X, E), rows, "x string, e array<string>") == [mark(*r) for r in rows]


def test_parts(spark):
    t = " In an arrayed <e1>big set</e1> of antenna <e2> elements</e2>. "
    row = spark.createDataFrame([(t,)], "x string").select(
        M.plain_sentence(X), M.entity_part(X, 1), M.entity_part(X, 2), M.before_first(X),
        M.between_entities(X), M.after_second(X), M.head_word(M.entity_part(X, 1))).first()
    assert tuple(row) == (" In an arrayed  big set  of antenna   elements . ", "big set", "elements",
                          "In an arrayed", "of antenna", ".", "big")


def test_quoted(evaluate):
    assert evaluate(M.quoted(X), [('8\t"The <e1>a</e1>."',), ("none",)], "x string") == [
        "The <e1>a</e1>.", ""]


def test_last_entity_and_pair(spark):
    rows = spark.createDataFrame(
        [([("cat", "A", "N"), ("Cat", "B", "V")],)], "e array<struct<text:string,label:string,`pos-tags`:string>>")
    got = rows.select(
        M.last_entity(E, F.lit("CAT"))["label"], M.last_entity(E, F.lit("cat"), exact=True)["label"],
        M.last_entity(E, F.lit("dog"))["label"], M.both(F.lit("x"), F.lit(None))).first()
    assert tuple(got) == ("B", "A", None, None)


def test_relation_labels(evaluate):
    rows = [("Cause-Effect(e1,e2)",), ("Other",), (" Part Of ( e2,e1 )\n",)]
    assert evaluate(M.relation_name(X), rows, "x string") == ["Cause-Effect", "Other", "Part Of"]
    assert evaluate(M.relation_direction(X), rows, "x string") == ["e1,e2", None, "e2,e1"]


def test_token_tags(spark):
    rows = spark.createDataFrame(
        [([("cat", "N"), ("cats", "P"), ("dog", "V")], "cat", "dog")],
        "tokens array<struct<text:string,tag:string>>, e1 string, e2 string")
    t, a, b = F.col("tokens"), F.col("e1"), F.col("e2")
    assert tuple(rows.select(M.token_tag(t, a), M.token_tag(t, b, unless=a),
                             M.token_tag(t, F.lit("emu"))).first()) == ("P", "V", None)


def test_clean_pair_sentence(evaluate):
    rows = [("an a-b and c.d", "a-b", "c.d")]
    got = evaluate(M.clean_pair_sentence(X, F.col("p"), F.col("q")), rows, "x string, p string, q string")
    assert got == ["an ab and cd"]
