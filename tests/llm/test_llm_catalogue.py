"""The registered queries against DuckDB or a brute-force version."""

import collections
import hashlib
import zlib

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry_points
from webfacts.llm import oracle, queries
from webfacts.llm.fingerprint import edited, fingerprint, likeness

DATA = "/root/testdata/sf0.001"
SQL = oracle.oracle_sql()
TABLES = ("documents", "embeddings", "pages", "conversations", "labels")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return connection


@pytest.fixture(scope="module")
def documents(duck):
    return dict(duck.execute("SELECT doc_id, coalesce(text, '') FROM documents").fetchall())


def result(spark, name):
    return getattr(queries, name)(spark, DATA)


def test_all_are_registered():
    named = entry_points.queries()
    numbers = [n.split("_")[0] for n in named if n.startswith("op")]
    assert sorted(numbers) == sorted(f"op{i}" for i in range(1, 14))
    assert "pipeline" in named
    assert set(SQL) <= set(named)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    found = result(spark, name)
    wanted = duck.execute(SQL[name])
    columns = [c[0] for c in wanted.description]
    assert sorted(columns) == sorted(found.columns)
    rows = wanted.fetchall()
    assert rows
    assert sorted(map(repr, rows)) == sorted(repr(tuple(r)) for r in found.select(*columns).collect())


@pytest.mark.parametrize("name", ["op5_chat_round_trip", "op9_mixture"])
def test_native_plans_have_no_python(spark, name):
    plan = result(spark, name)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def test_op2_against_single_texts(spark, documents):
    order = sorted(documents, reverse=True)
    following = dict(zip(order, order[1:] + order[:1]))
    rows = result(spark, "op2_piecewise_fingerprints").collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(documents)
    for r in rows:
        text, after = documents[r["doc_id"]], documents[following[r["doc_id"]]]
        changed = edited(text, after)
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        assert r["fingerprint"] == fingerprint(text)
        assert r["edited_fingerprint"] == fingerprint(changed)
        assert r["near_edited"] == likeness(fingerprint(text), fingerprint(changed))
        assert r["near_next"] == likeness(fingerprint(text), fingerprint(after))


def encoded(documents, name, end):
    tokenizer = Tokenizer.from_file(queries.tokenizer_file(name))
    return {k: np.array(tokenizer.encode(t, add_special_tokens=False).ids + [end], dtype="<u4")
            for k, t in documents.items()}


def test_op3_against_whole_texts(spark, documents):
    ids = encoded(documents, "word_bpe_49k.json", 2)
    before, wanted = 0, {}
    for key in sorted(ids):
        wanted[key] = (before, len(ids[key]), zlib.crc32(ids[key].tobytes()))
        before += len(ids[key])
    rows = result(spark, "op3_repair_token_files").collect()
    assert {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in rows} == wanted


def test_op4_keeps_articles_alone(spark, duck):
    import re
    from html import unescape

    wanted = {}
    for key, page in duck.execute("SELECT page_id, html FROM pages").fetchall():
        article = re.search(r"<article>(.*)</article>", page, re.S).group(1)
        blocks = re.split(r"</?(?:p|h1)>", article)
        lines = [" ".join(unescape(re.sub(r"<br>|<[^>]+>", lambda m: " " if m.group() == "<br>" else "", b)).split())
                 for b in blocks]
        wanted[key] = "\n".join(x for x in lines if x)
    rows = result(spark, "op4_page_differences").collect()
    assert {r["page_id"]: r["text"] for r in rows} == wanted
    assert all(r["n_chars"] == len(r["text"]) for r in rows)


def test_op7_places_every_id_once(spark, documents):
    ids = encoded(documents, "byte_bpe_50k.json", 1)
    pieces, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in result(spark, "op7_differenced_packing").collect():
        own = ids[r["doc_id"]]
        assert r["doc_tokens"] == len(own)
        assert r["ids_crc32"] == zlib.crc32(own[r["start"]:r["start"] + r["length"]].tobytes())
        pieces[r["doc_id"]].append((r["start"], r["length"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for found, whole in [(pieces[k], len(v)) for k, v in ids.items()] + [(s, None) for s in sequences.values()]:
        at = 0
        for start, length in sorted(found):
            assert start == at
            at += length
        assert at == whole if whole is not None else at <= 2048
    held = [sum(n for _, n in s) for s in sequences.values()]
    padding = sum(2048 - n for n in held if n & (n - 1))
    assert padding < 0.02 * sum(held)


def test_op8_deals_equal_mixtures(spark, duck, documents):
    rows = result(spark, "op8_interleaved_shards").collect()
    shards = collections.defaultdict(list)
    for r in rows:
        data = documents[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"]) == (len(data) + 1, zlib.crc32(data))
        assert r["law"] == "rows" and r["grown_shard"] is None
        shards[r["shard"]].append(r)
    assert sorted(r["doc_id"] for r in rows) == sorted(documents)
    sizes = [len(shards[i]) for i in range(16)]
    assert max(sizes) - min(sizes) <= 1
    for found in shards.values():
        assert sorted(r["slot"] for r in found) == list(range(len(found)))
    total = collections.Counter(r["source"] for r in rows)
    for found in shards.values():
        for source, n in collections.Counter(r["source"] for r in found).items():
            assert abs(n - total[source] / 16) <= 2


def test_op10_on_documents_not_learned_from(spark, duck):
    lang = dict(duck.execute("SELECT doc_id, lang FROM documents").fetchall())
    rows = result(spark, "op10_compressed_language").collect()
    assert len(rows) == len(lang)
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) >= 0.95 * len(held)


def test_op13_base_counts_and_verdicts(spark, duck, documents):
    from test_fertility import plain_base

    quality = dict(duck.execute("SELECT doc_id, quality FROM labels").fetchall())
    rows = result(spark, "op13_fertility_rules").collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(documents)
    for r in rows:
        counts = plain_base(documents[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == counts
        assert r["base_failed"] == (counts[0] < 50 or 100 * counts[4] > 50 * counts[0])
        assert not (r["kept"] and r["base_failed"])
        if quality.get(r["doc_id"]) == 1:
            assert r["kept"] or r["base_failed"]
