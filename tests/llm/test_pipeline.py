"""The pipeline stage by stage against brute force, on rows with copies and oddities."""

import random
import zlib

import numpy as np
import pytest

import corpus_pipeline
from test_langid import texts

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def documents(spark):
    rng = random.Random(8)
    rows = []
    for lang in ("en", "de"):
        for i, text in enumerate(texts(lang, 60, 60, seed=5)):
            rows.append((text, lang, rng.choice(["a", "b", None])))
    base = texts("en", 1, 120, seed=6)[0].split()
    for i in range(10):
        words = list(base)
        words[i * 11] = "changed"
        rows.append((" ".join(words), "en", "a"))
    rows += [(rows[0][0], "en", "b"), (None, "en", "a"), ("", None, "b"), ("!!! 123", "de", "a")]
    return spark.createDataFrame(
        [(i, t, lang, s, len(t or "")) for i, (t, lang, s) in enumerate(rows)], SCHEMA)


def shingles(text):
    words = text.lower().split()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} or {tuple(words)}


def test_stages(spark, documents):
    kept = {}
    docs = documents
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "").cache()
        kept[name] = docs.collect()
        if name != "packing":
            assert docs.columns == documents.columns
    texts_of = {r["doc_id"]: r["text"] for r in documents.collect()}
    language = {r["doc_id"] for r in kept["language"]}
    assert len(language) == len(kept["language"]) and not {131, 132, 133} & language and len(language) >= 129

    group = {i: i for i in language}
    sets = {i: shingles(texts_of[i]) for i in language}
    for i in sorted(language):
        for j in sorted(language):
            if j < i and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                old, new = group[i], group[j]
                group = {k: min(old, new) if g in (old, new) else g for k, g in group.items()}
    assert sorted(r["doc_id"] for r in kept["near_copies"]) == sorted(set(group.values()))
    assert len(set(group.values())) < len(language) - 5

    copies = {}
    for r in kept["mixture"]:
        copies[r["doc_id"]] = copies.get(r["doc_id"], 0) + 1
    assert set(copies) <= set(group.values()) and max(copies.values()) <= 2
    words = lambda rows: sum(len(r["text"].split()) for r in rows)
    assert abs(words(kept["mixture"]) - 1.5 * words(kept["near_copies"])) < 3 * 120

    total = {}
    for r in kept["packing"]:
        assert r["ids_crc32"] == zlib.crc32(r["ids"])
        total[r["doc_id"]] = total.get(r["doc_id"], 0) + r["length"]
    from tokenizers import Tokenizer
    encode = Tokenizer.from_file(corpus_pipeline.tokenizer_file("byte_bpe_50k.json")).encode
    assert total == {i: n * (len(encode(texts_of[i]).ids) + 1) for i, n in copies.items()}


def test_run_is_the_stages(spark):
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    sequences = {}
    for r in rows:
        assert len(np.frombuffer(r["ids"], "<u4")) == r["length"]
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048


def test_empty_table(spark, documents):
    docs = documents.where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
        assert docs.collect() == []


def test_rows_of_one_id_are_documents_of_their_own(spark):
    one, two = texts("en", 2, 60, seed=21)
    near = " ".join(one.split()[:-1] + ["other"])
    rows = [(1, one, "en", "a"), (1, two, "en", "a"), (2, near, "en", "a"), (3, two, "en", "b"), (4, "", "en", "a"),
            (4, "", "en", "a"), (5, None, "en", "a"), (None, one, "en", "a"), (1, one, "de", "z"), (4, one + " x", "en", "a")]
    docs = spark.createDataFrame([(*r, 7) for r in rows], SCHEMA)
    for n in (1, 5):
        found = corpus_pipeline.drop_near_copies(spark, docs.repartition(n), "").collect()
        assert sorted((r["doc_id"] or 0, r["text"] or "", r["lang"]) for r in found) == sorted([
            (0, one, "en"), (1, one, "de"), (1, two, "en"), (4, "", "en"), (4, "", "en"), (5, "", "en")])
