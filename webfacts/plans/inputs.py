"""Inputs of the query catalogue, derived from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from webfacts.constants import RELATION_DICTIONARY
from webfacts.functions import text as T
from webfacts.operators import model, pages, relations
from webfacts.operators.joins import cut_lineage, lookup_join
from webfacts.plans.facts import tag_and_mark
from webfacts.sources import files

# Classes and intercepts of the classifier that is made by rule.
RULED_LABELS = ["Cause-Effect e1,e2", "Cause-Effect e2,e1", "Other nan"]
RULED_INTERCEPTS = [0.05, -0.05, 0.0]

KNOWN_RELATIONS = [
    ("owned by", "https://kb.example.org/a", "https://kb.example.org/b", "https://kb.example.org/r1"),
    ("part of", "https://kb.example.org/c", "https://kb.example.org/d", "https://kb.example.org/r2"),
    ("near", "https://kb.example.org/e", "https://kb.example.org/f", "https://kb.example.org/r3"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return files.read_parquet(spark, f"{sf_dir}/{name}.parquet")


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive payloads made of the pages: one in ten without a key line, one in
    ten whose HTML does not start a line."""
    n = F.col("page_id") % 10
    key_line = F.when(n == 0, F.lit("")).otherwise(
        F.concat(F.lit("WARC-TREC-ID: page-"), F.col("page_id").cast("string"), F.lit("\n")))
    html = F.when(n == 1, F.col("html")).otherwise(F.replace(
        F.col("html"), F.lit("<!DOCTYPE html><html"), F.lit("<!DOCTYPE html>\n<html")))
    return table(spark, sf_dir, "pages").select(
        F.concat(F.lit("WARC-Type: response\n"), key_line, F.lit("\n"), html).alias("payload"))


def page_text_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select(
        "page_id", pages.page_text(F.col("html")).alias("text"))


def doc_sentences(spark: SparkSession, sf_dir: str, ids: DataFrame | None = None) -> DataFrame:
    """``(id, sent_no, org_text, text)`` of all documents, or of those whose ``id`` is
    among ``ids``: the others leave before they are cut into sentences."""
    docs = table(spark, sf_dir, "documents").select(
        F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("id"), "text")
    if ids is not None:
        docs = lookup_join(docs, ids.select("id").distinct(), "id", "left_semi")
    return pages.explode_sentences(docs, T.collapse_ws(F.col("text")), "id").withColumn(
        "text", T.clean_sentence(F.col("org_text")))


def kept_sentences(spark: SparkSession, sf_dir: str, ids: DataFrame | None = None) -> DataFrame:
    """The same, stored: for queries that read them for entities and again for tokens."""
    return cut_lineage(doc_sentences(spark, sf_dir, ids))


def _pick(values: list[str], n: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (n % len(values) + 1).cast("int"))


def _labelled(aliases: DataFrame) -> DataFrame:
    return aliases.distinct().select("alias", _pick(
        ["PERSON", "ORG", "GPE", "LOC", "DATE"], F.length("alias")).alias("label"))


def _anchor_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    anchors = F.regexp_extract_all(F.col("html"), F.lit('<a href="[^"]*">([^<]*)</a>'), F.lit(1))
    return (table(spark, sf_dir, "pages").select(F.explode(anchors).alias("a"))
            .where(F.col("a").rlike("^[A-Za-z]{4,}$")).select(F.lower("a").alias("alias")))


def title(html: Column) -> Column:
    return F.regexp_extract(html, "(?s)<title>(.*?)</title>", 1)


def gazetteer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(alias, label)`` of the link texts of the pages."""
    return _labelled(_anchor_words(spark, sf_dir))


def phrase_gazetteer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the two-word phrases of the cleaned page titles."""
    phrases = table(spark, sf_dir, "pages").select(F.explode(
        T.bigrams(T.clean_tokens(title(F.col("html"))))).alias("alias"))
    return _labelled(_anchor_words(spark, sf_dir).unionAll(phrases))


def lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(token, pos)``; words of seven letters are left unknown."""
    words = _anchor_words(spark, sf_dir).distinct().where(F.length("alias") != 7)
    return words.select(F.col("alias").alias("token"), _pick(
        ["NOUN", "PROPN", "VERB"], F.length("alias")).alias("pos"))


def tagged(
    spark: SparkSession, sf_dir: str, mentioned_only: bool = False, sentences: DataFrame | None = None,
) -> DataFrame:
    """Tagged and marked sentences of all documents, or of ``sentences`` if they are at hand."""
    if sentences is None:
        sentences = doc_sentences(spark, sf_dir)
    return tag_and_mark(
        sentences, gazetteer(spark, sf_dir), lexicon(spark, sf_dir), mentioned_only=mentioned_only)


def kb(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, title, url, text)`` of the pages; some lack a title, some both."""
    n = F.col("page_id")
    return table(spark, sf_dir, "pages").select(
        n.alias("doc_id"),
        F.when(n % 25 != 0, title(F.col("html"))).alias("title"), "url",
        F.when(n % 50 != 0, pages.page_text(F.col("html"))).alias("text"))


def label_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(label, url, page_id)`` of the page titles; titles repeat."""
    return table(spark, sf_dir, "pages").select(
        title(F.col("html")).alias("label"), "url", "page_id")


def parsed(sentences: DataFrame) -> DataFrame:
    """A parsed-token table of ``(id, sent_no, text)``: the words of every
    sentence of four or more, each hanging on the word at half its position."""
    words = F.split("text", " ")
    return (
        sentences.where((F.col("text") != "") & (F.size(words) >= 4))
        .select(F.concat_ws("-", "id", "sent_no").alias("sent_id"),
                F.posexplode(words).alias("at", "token"))
        .select("sent_id", (F.col("at") + 1).alias("pos"),
                F.floor((F.col("at") + 1) / 2).cast("int").alias("head"), "token",
                _pick(["NOUN", "PROPN", "VERB"], F.length("token")).alias("tag"),
                F.concat(F.lit("dep"), (F.length("token") % 4).cast("string")).alias("dep")))


def tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parsed tokens of the documents."""
    return parsed(doc_sentences(spark, sf_dir))


def relation_dictionary(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        RELATION_DICTIONARY, "relation string, relation_name string, link string")


def known_relations(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        KNOWN_RELATIONS, "label string, subject_url string, object_url string, relation_url string")


def pairs(spark: SparkSession, sf_dir: str, marked: DataFrame | None = None) -> DataFrame:
    """Distinct marked sentences with both marks, split into their parts. ``marked``
    are the tagged sentences, if they are at hand."""
    if marked is None:
        marked = tagged(spark, sf_dir, mentioned_only=True)
    rows = relations.relation_candidates(marked)
    return relations.split_marked(rows, "labeled_text")


def ruled_relations(spark: SparkSession, sf_dir: str, marked: DataFrame | None = None) -> DataFrame:
    """Marked pairs with a relation label given by rule, and ``nan`` classes."""
    named = F.array(*[F.lit(r) for r, _, _ in RELATION_DICTIONARY] + [F.lit("Unheard of")])
    n = (F.length("between_e1_e2") % (len(RELATION_DICTIONARY) + 1) + 1).cast("int")
    return pairs(spark, sf_dir, marked).select("id", "e1", "e2", F.element_at(named, n).alias("preds"))


def ruled_links(spark: SparkSession, sf_dir: str, marked: DataFrame | None = None) -> DataFrame:
    """Link rows by rule: some entities have none, some a null link."""
    if marked is None:
        marked = tagged(spark, sf_dir, mentioned_only=True)
    rows = marked.select("id", F.explode("entity.text").alias("entity"))
    n = F.length("entity") % 4
    return rows.where(n != 3).select("id", "entity", F.when(
        n != 2, F.concat(F.lit("https://kb.example.org/"), F.col("entity"))).alias("linking"))


def _anchor_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of the pages: ``(page_id, n, a, href)``; repeats occur."""
    pattern = '<a href="([^"]*)">([^<]*)</a>'
    found = F.arrays_zip(
        F.regexp_extract_all(F.col("html"), F.lit(pattern), F.lit(2)).alias("a"),
        F.regexp_extract_all(F.col("html"), F.lit(pattern), F.lit(1)).alias("href"))
    return (table(spark, sf_dir, "pages").select("page_id", F.posexplode(found).alias("n", "x"))
            .select("page_id", "n", "x.a", "x.href"))


def _record() -> Column:
    return F.concat(F.lit("page-"), F.col("page_id").cast("string"))


def _tabbed(*parts: Column | str) -> Column:
    return F.concat_ws("\t", *parts)


def gold_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(line_at, value)``: an entity line per link, a relation line per second one."""
    rows = _anchor_lines(spark, sf_dir)
    at = F.col("page_id") * 1000 + F.col("n") * 10
    entity = rows.select(at.alias("line_at"), _tabbed(_record(), F.lit("ENTITY"), "a", "href").alias("value"))
    relation = rows.where("n % 2 = 0").select((at + 1).alias("line_at"), _tabbed(
        _record(), F.lit("RELATION"), F.concat(F.lit("links to "), "n"), F.lit("/"), "href",
        F.lit("P1")).alias("value"))
    return entity.unionAll(relation)


def pred_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prediction lines for the same: some wrong, some missing, some repeated,
    some relations without an id."""
    rows = _anchor_lines(spark, sf_dir)
    n, p = F.col("n"), F.col("page_id")
    at = p * 1000 + n * 10
    href = F.when((p + n) % 3 == 0, F.concat("href", F.lit("x"))).otherwise(F.col("href"))
    kept = rows.where((p + n) % 5 != 0)
    entity = kept.select(at.alias("line_at"), F.concat(
        F.lit("ENTITY: "), _tabbed(_record(), "a", href)).alias("value"))
    again = kept.where("n % 4 = 1").select((at + 2).alias("line_at"), F.concat(
        F.lit("ENTITY: "), _tabbed(_record(), "a", F.lit("/again"))).alias("value"))
    relation = kept.where("n % 2 = 0").select((at + 1).alias("line_at"), F.concat(
        F.lit("RELATION: "), _tabbed(_record(), F.lit("/"), href, F.concat(F.lit("links to "), "n")),
        F.when(p % 2 == 0, F.lit("\tP1")).otherwise(F.lit(""))).alias("value"))
    return entity.unionAll(again).unionAll(relation)


def labelled_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training features: marked sentences of the labelled documents, with path
    and tags from their tokens; the relation is told by the document's labels."""
    labels = table(spark, sf_dir, "labels").select(
        F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("id"), "quality", "toxic")
    sentences = kept_sentences(spark, sf_dir, labels)
    rows = relations.relation_candidates(
        tagged(spark, sf_dir, mentioned_only=True, sentences=sentences), "sent_no")
    relation = (F.when(F.col("quality") == 0, "Other")
                .when(F.col("toxic") == 1, "Cause-Effect(e2,e1)").otherwise("Cause-Effect(e1,e2)"))
    joined = rows.join(labels, "id").select(
        "id", F.concat_ws("-", "id", "sent_no").alias("sent_id"), "entity",
        F.col("labeled_text").alias("input_sentence"), relation.alias("input_relation"))
    return relations.relation_features(
        joined, training=True, tokens=parsed(sentences))


def labelled_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as training rows."""
    return model.training_rows(labelled_features(spark, sf_dir))
