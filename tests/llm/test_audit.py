import re
from collections import Counter
from itertools import permutations

from webfacts.llm import audit

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def failures(rows):
    out = []
    for key, text, lang in rows:
        text = text or ""
        words = WORD.findall(text)
        fails = ""
        fails += "A" if len(words) < 100 else ""
        fails += "B" if 100 * len(set(words)) < 80 * len(words) else ""
        fails += "C" if 100 * len(re.findall("[A-Z]", text)) > 10 * len(text) else ""
        fails += "D" if re.search(r"[#$%&*|]", text) else ""
        fails += "E" if key is not None and any(
            k is not None and k < key and (t or "") == text for k, t, _ in rows) else ""
        out.append((key, lang or "", fails))
    return out


def brute(rows, labels):
    marked = failures(rows)
    good = {k for k, q, _ in labels if q == 1 and k is not None}
    toxic = {k for k, _, t in labels if t == 1 and k is not None}
    out, removals = {}, Counter()
    for part in {p for _, p, _ in marked}:
        own = [(k, f) for k, p, f in marked if p == part]
        for order in map("".join, permutations("ABCDE")):
            left = own
            for step, name in enumerate(order, 1):
                gone = [(k, f) for k, f in left if name in f]
                left = [(k, f) for k, f in left if name not in f]
                removals[part, name] += len(gone)
                out[part, order, step] = [
                    len(left), len(gone), sum(name in f for _, f in own) - len(gone),
                    sum(f == name for _, f in own), sum(k in good for k, _ in gone), sum(k in toxic for k, _ in gone)]
    return {k: (*v, removals[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def audited(spark, rows, labels):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    return {tuple(r[:3]): tuple(r[3:]) for r in audit.audit(docs, known).collect()}


def test_against_plain_loops(spark):
    long_text = " ".join(f"w{i}" for i in range(120))
    rows = [
        (1, long_text, "en"), (2, long_text, "en"), (3, long_text, None), (4, "", "en"), (5, None, ""), (6, None, "fr"),
        (7, "a " * 150, "en"), (8, "SHOUT " * 120, "en"), (9, "a | b", "fr"), (9, "a | b", "fr"), (10, "A B C $", "en"),
        (None, long_text, "en"), (None, "", None), (11, "x" * 5000, "en"), (12, long_text + "\x85 y", "de"),
        (13, long_text.upper(), "de"), (2, "other", "en"), (2, long_text, "de")]
    labels = [(1, 1, 0), (2, 1, 1), (2, 0, 0), (4, None, 1), (None, 1, 1), (99, 1, 1), (9, 1, None)]
    found, wanted = audited(spark, rows, labels), brute(rows, labels)
    assert found == wanted
    assert len(found) == 4 * 600


def test_empty_table(spark):
    assert audited(spark, [], []) == {}


def test_many_copies_of_one_text(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "'same text' AS text", "'en' AS lang", "1 AS clash")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    row = audit.audit(docs, none).where("filter_order = 'EABCD' AND step = 1").first()
    assert (row["kept"], row["removed"], row["unique_fails"]) == (1, 2999, 0)


def test_copies_of_one_text_are_dealt_to_places(spark):
    docs = spark.range(2000).selectExpr("id AS doc_id", "'same' AS text", "'' AS part")
    facts = docs.selectExpr("doc_id", "md5(text) AS digest")
    found = audit.repeats(docs, facts)
    assert found.count() == 1999 and found.where("doc_id = 0").count() == 0
