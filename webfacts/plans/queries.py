"""Query catalogue: one query per operator, over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webfacts.constants import NAN_TEXT, RECORD_MARK
from webfacts.functions import marking as M
from webfacts.functions import similarity, sql
from webfacts.functions import text as T
from webfacts.operators import (
    containment, features, linking, model, pages, paths, relations, results, scoring, splitting,
    tagging)
from webfacts.operators.joins import cut_lineage, shared_folder
from webfacts.plans import facts, inputs
from webfacts.sources import archives, files


def _render(entity: str = "entity"):
    """An entity array as one string."""
    return F.array_join(F.transform(F.col(entity), lambda e: F.concat_ws(
        "/", e["text"], e["label"], e["pos-tags"])), ";")


# --- pages and text --------------------------------------------------------

def record_keys(spark, sf):
    return pages.page_bodies(inputs.records(spark, sf), anchor="anywhere").select("id")


def html_bodies(spark, sf):
    return pages.page_bodies(inputs.records(spark, sf)).select(
        "id", F.md5("html").alias("digest"), F.length("html").cast("long").alias("n_chars"))


def page_texts(spark, sf):
    return inputs.page_text_rows(spark, sf)


def page_sentences(spark, sf):
    return pages.page_sentences(inputs.records(spark, sf)).select(
        "id", F.col("sent_no").cast("long").alias("sent_no"), "org_text", "text")


def doc_sentences(spark, sf):
    docs = inputs.table(spark, sf, "documents")
    return pages.explode_sentences(docs, T.collapse_ws(F.col("text")), "doc_id").withColumn(
        "sent_no", F.col("sent_no").cast("long"))


def clean_sentences(spark, sf):
    return inputs.doc_sentences(spark, sf).select(
        "id", F.col("sent_no").cast("long").alias("sent_no"), F.lower("text").alias("text"))


def stopword_anti_join(spark, sf):
    docs = inputs.table(spark, sf, "documents")
    stop = files.local_table(spark, [(w,) for w in T.STOP_WORDS], "token string")
    tokens = docs.select("doc_id", F.explode(T.split_words(
        T.letters_only(T.keep_ascii_words(F.col("text"))))).alias("token"))
    return (tokens.join(F.broadcast(stop), "token", "left_anti")
            .groupBy("doc_id", "token").agg(F.count(F.lit(1)).alias("n")))


def printable_text(spark, sf):
    return inputs.table(spark, sf, "conversations").select(
        "conv_id", "turn", T.drop_unprintable(F.col("text")).alias("text"))


# --- files -----------------------------------------------------------------

def archive_records(spark, sf):
    """The records written as gzip archives and read back."""
    path = shared_folder(spark)
    mark = F.lit(f"{RECORD_MARK}\r\n")
    written = inputs.records(spark, sf).select(
        F.concat(mark, F.replace("payload", F.lit("\n"), F.lit("\r\n"))).alias("value"))
    written.write.option("lineSep", "\r\n").option("compression", "gzip").text(path)
    return archives.read_warc(spark, path).where("payload <> ''").select(
        pages.H.page_key(F.col("payload")).alias("id"), F.md5("payload").alias("digest"))


def labelled_blocks(spark, sf):
    """Documents written as labelled four-line blocks and read back."""
    path = shared_folder(spark)
    block = F.concat(F.col("doc_id").cast("string"), F.lit('\t"'), T.collapse_ws(F.col("text")),
                     F.lit('"\n'), F.initcap("lang"), F.lit("(e2,e1)\nComment:\n"))
    inputs.table(spark, sf, "documents").select(block.alias("value")).write.text(path)
    rows = relations.labelled_sentences(files.read_blocks(spark, path))
    return relations.add_relation(rows).select(
        F.md5("input_sentence").alias("digest"), "relation", "direction")


def stored_links(spark, sf):
    """The link table written in hash buckets and read back."""
    path = shared_folder(spark)
    files.write_links(inputs.ruled_links(spark, sf), path, buckets=8)
    return files.read_links(spark, path)


def stored_relations(spark, sf):
    """Relation rows written as CSV with a header line and read back."""
    path = shared_folder(spark)
    files.write_csv(inputs.ruled_relations(spark, sf), path)
    return files.read_csv(spark, path, "id string, e1 string, e2 string, preds string")


def appended_lines(spark, sf):
    """The entities that predictions of two runs in one folder leave: the second
    run's lines come after the first one's."""
    path = shared_folder(spark)
    lines = inputs.pred_lines(spark, sf).orderBy("line_at")
    late = F.col("value").rlike("/again$|^RELATION")
    files.write_lines(lines.where(~late), path)
    files.write_lines(lines.where(late), path, mode="append")
    return scoring.predicted_entities(files.read_lines(spark, path))


def stored_sentences(spark, sf):
    """The sentence table written as Parquet and read back."""
    path = shared_folder(spark)
    files.write_parquet(inputs.doc_sentences(spark, sf), path)
    return files.read_parquet(spark, path).select(
        "id", F.col("sent_no").cast("long").alias("sent_no"), F.md5("org_text").alias("digest"))


def label_file(spark, sf):
    """Page titles and addresses as a dictionary file; the last line of a title wins."""
    path = shared_folder(spark)
    rows = inputs.label_dictionary(spark, sf).orderBy("page_id")
    files.write_lines(rows.select(F.concat_ws("\t", "label", "url").alias("value")), path)
    return files.read_label_dictionary(spark, path)


def known_relation_file(spark, sf):
    """Links between pages as a file of known relations."""
    path = shared_folder(spark)
    line = F.concat_ws("\t", "string", "s", "o", "rel_id").alias("value")
    files.write_lines(scoring.gold_relations(inputs.gold_lines(spark, sf)).select(line), path)
    return files.read_known_relations(spark, path)


def relation_file(spark, sf):
    """Relations of the documents named by a headerless CSV dictionary."""
    path = shared_folder(spark)
    files.write_headerless_csv(inputs.relation_dictionary(spark), path)
    return model.link_relations(
        inputs.ruled_relations(spark, sf), files.read_relation_dictionary(spark, path)
    ).groupBy("preds", "relation_name", "link").agg(F.count(F.lit(1)).alias("n"))


# --- tagging and marking ---------------------------------------------------

def _tagged_phrases(spark, sf):
    return facts.tag_and_mark(
        inputs.doc_sentences(spark, sf), inputs.phrase_gazetteer(spark, sf),
        inputs.lexicon(spark, sf), mentioned_only=True)


def entities_flat(spark, sf):
    tagged = inputs.tagged(spark, sf, mentioned_only=True)
    return tagging.entity_rows(tagged, "id", "sent_no").select(
        "id", F.col("sent_no").cast("long").alias("sent_no"),
        F.col("ent_no").cast("long").alias("ent_no"), "text", "label")


def entities_multiword(spark, sf):
    return tagging.entity_rows(_tagged_phrases(spark, sf), "id", "sent_no").select(
        "id", F.col("sent_no").cast("long").alias("sent_no"),
        F.col("ent_no").cast("long").alias("ent_no"), "text", "label", "pos_tags")


def entity_arrays(spark, sf):
    return inputs.tagged(spark, sf).select(
        "id", F.col("sent_no").cast("long").alias("sent_no"), _render().alias("entity"))


def pos_strings(spark, sf):
    phrases = tagging.prepare_gazetteer(inputs.phrase_gazetteer(spark, sf), inputs.lexicon(spark, sf))
    return phrases.select("alias", "pos_tags", F.col("n_words").cast("long").alias("n_words"))


def token_pos(spark, sf):
    tags = tagging.pos_map(inputs.tree(spark, sf), "sent_id")
    return tags.select("sent_id", F.explode("pos_map").alias("token", "pos"))


def distinct_entities(spark, sf):
    tagged = inputs.tagged(spark, sf, mentioned_only=True)
    return tagged.select(
        "id", F.array_join(M.entity_texts(F.col("entity")), ";").alias("entities")).distinct()


def marked_pairs(spark, sf):
    return inputs.tagged(spark, sf, mentioned_only=True).select(
        "id", F.col("sent_no").cast("long").alias("sent_no"), "labeled_text")


def sql_marked_pairs(spark, sf):
    """The same by SQL text alone, on views and SQL functions."""
    sql.register(spark)
    views = {"raw_documents": inputs.table(spark, sf, "documents"), "gazetteer": cut_lineage(
        tagging.prepare_gazetteer(inputs.gazetteer(spark, sf)))}
    return spark.sql("""
        WITH sentences AS (
            SELECT concat('doc-', doc_id) AS id, CAST(s.sent_no AS BIGINT) AS sent_no, s.org_text, s.text
            FROM {raw_documents} d, LATERAL sentence_rows(d.text) s),
        words AS (SELECT id, sent_no, explode(split(text, ' ')) AS alias FROM sentences),
        named AS (
            SELECT id, sent_no, collect_set(alias) AS names FROM words JOIN {gazetteer} USING (alias)
            GROUP BY id, sent_no)
        SELECT id, sent_no, mark_pair(org_text, names) AS labeled_text
        FROM sentences JOIN named USING (id, sent_no)""", **views)


def label_containment(spark, sf):
    labels = files.last_label(inputs.label_dictionary(spark, sf), "page_id")
    rows = inputs.records(spark, sf).select(
        pages.H.page_key(F.col("payload")).alias("id"), "payload")
    return containment.match_contains(rows, labels)


def attached_relations(spark, sf):
    rows = inputs.records(spark, sf).select(pages.H.page_key(F.col("payload")).alias("id"))
    return containment.attach_relations(rows, inputs.known_relations(spark))


# --- linking ---------------------------------------------------------------

def _mentions(spark, sf):
    """The distinct entities of the documents and the distinct page titles."""
    tagged = inputs.tagged(spark, sf, mentioned_only=True)
    entities = linking.mention_rows(tagged).select(F.col("entity").alias("mention"))
    titles = inputs.label_dictionary(spark, sf).select(F.col("label").alias("mention"))
    return entities.unionAll(titles).distinct()


def _described(spark, sf):
    base = cut_lineage(inputs.kb(spark, sf))
    found = linking.candidates(_mentions(spark, sf), linking.build_index(base))
    return linking.describe_candidates(found, base)


def escaped_queries(spark, sf):
    return inputs.label_dictionary(spark, sf).select(
        "page_id", T.escape_query(F.col("label")).alias("query"))


def kb_candidates(spark, sf):
    return _described(spark, sf).select("mention", "doc_id", "label", "url", "score")


def char_cosine_rank(spark, sf):
    return linking.rank_candidates(_described(spark, sf)).select("mention", "doc_id", "cosine")


def word_cosine(spark, sf):
    rows = inputs.table(spark, sf, "conversations").select("conv_id", "turn", "text")
    after = rows.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("next_text"))
    score = similarity.word_cosine(F.col("text"), F.col("next_text"))
    return rows.join(after, ["conv_id", "turn"]).select(
        "conv_id", "turn", F.round(score, 9).alias("score"))


def entity_links(spark, sf):
    tagged = cut_lineage(inputs.tagged(spark, sf, mentioned_only=True).select("id", "entity"))
    return linking.link_entities(tagged, inputs.kb(spark, sf))


# --- relation features -----------------------------------------------------

def marked_parts(spark, sf):
    return inputs.pairs(spark, sf).select(
        "id", "labeled_text", "sentence_string", "e1", "e2", "e1_e2", "head_e1", "head_e2",
        "head_e1_e2", "before_e1", "between_e1_e2", "after_e2")


def quoted_lines(spark, sf):
    docs = inputs.table(spark, sf, "documents").select(
        F.concat(F.col("doc_id").cast("string"), F.lit('\t"'), T.collapse_ws(F.col("text")),
                 F.lit('"')).alias("line"), F.lit("Other").alias("input_relation"))
    return relations.labelled_sentences(docs).select(
        F.md5("input_sentence").alias("digest"), F.length("input_sentence").cast("long").alias("n_chars"))


def entity_types(spark, sf):
    return relations.add_types(inputs.pairs(spark, sf)).select(
        "id", "labeled_text", "e1_ner", "e2_ner", "e1_postag", "e2_postag", "e1_e2_ner")


def train_entity_types(spark, sf):
    return relations.add_types(inputs.pairs(spark, sf), exact=True).select(
        "id", "labeled_text", "e1_ner", "e2_ner", "e1_e2_ner")


def train_entity_pos(spark, sf):
    rows = relations.split_marked(relations.relation_candidates(
        inputs.tagged(spark, sf, mentioned_only=True), "sent_no"), "labeled_text")
    keyed = rows.withColumn("sent_id", F.concat_ws("-", "id", "sent_no"))
    parsed = keyed.join(paths.token_lists(inputs.tree(spark, sf)), "sent_id", "left")
    return relations.add_token_tags(parsed).select("sent_id", "labeled_text", "e1_postag", "e2_postag")


def relation_labels(spark, sf):
    named = inputs.ruled_relations(spark, sf).select("id", F.regexp_replace(
        F.regexp_replace("preds", "^(.*) (e[12],e[12])$", "$1($2)"), " nan$", "").alias("input_relation"))
    rows = relations.add_relation(named)
    return features.class_label(features.fill_missing(rows)).select(
        "id", "input_relation", "relation", "direction", "label")


def clean_pair_sentence(spark, sf):
    rows = inputs.pairs(spark, sf)
    return rows.select("id", "labeled_text", M.clean_pair_sentence(
        F.col("sentence_string"), F.col("e1"), F.col("e2")).alias("sentence"))


def connecting_paths(spark, sf):
    tree = cut_lineage(inputs.tree(spark, sf))
    ends = tree.groupBy("sent_id").agg(
        F.min_by("token", "pos").alias("source"), F.max_by("token", "pos").alias("target"))
    return paths.connecting_paths(ends, paths.token_edges(tree)).select(
        "sent_id", "source", "target", "path")


def token_lists(spark, sf):
    rows = paths.token_lists(inputs.tree(spark, sf))
    return rows.select("sent_id", F.array_join(F.transform("parse_list", lambda t: F.concat_ws(
        "/", t["text"], t["tag"], t["head"], t["dep"])), " ").alias("parse_list"))


def feature_rows(spark, sf):
    rows = relations.relation_candidates(inputs.tagged(spark, sf, mentioned_only=True))
    return relations.relation_features(rows).select(
        *[F.coalesce(c, F.lit(NAN_TEXT)).alias(c) if c in ("input_relation", "relation", "direction")
          else F.col(c) for c in relations.FEATURE_COLUMNS], "shortest_path")


def feature_paths(spark, sf):
    rows = relations.relation_candidates(inputs.tagged(spark, sf, mentioned_only=True), "sent_no")
    keyed = rows.withColumn("sent_id", F.concat_ws("-", "id", "sent_no"))
    parts = cut_lineage(relations.split_marked(keyed, "labeled_text"))
    tree = cut_lineage(paths.tokens_of(inputs.tree(spark, sf), parts))
    with_paths = relations.add_paths(parts, paths.token_edges(tree))
    return with_paths.select("sent_id", "labeled_text", "e1", "e2", "shortest_path")


def _features(rows):
    """A feature table, written and read back; ``nan`` for what is missing."""
    path = shared_folder(rows.sparkSession)
    files.write_parquet(features.fill_missing(rows), path)
    return files.read_parquet(rows.sparkSession, path).select(
        *relations.FEATURE_COLUMNS, "shortest_path")


def prediction_features(spark, sf):
    """Features of all marked sentences, with paths."""
    sentences = inputs.kept_sentences(spark, sf)
    tagged = inputs.tagged(spark, sf, mentioned_only=True, sentences=sentences)
    return _features(model.prediction_features(tagged, inputs.parsed(sentences)))


def training_features(spark, sf):
    """Features of the labelled sentences, with paths and token tags."""
    return _features(inputs.labelled_features(spark, sf))


# --- model -----------------------------------------------------------------

def _tfidf(spark, sf, kind):
    docs = inputs.table(spark, sf, "documents").select("doc_id", "text")
    return features.tfidf(docs, "doc_id", [("text", "text", kind)]).select(
        "doc_id", "term", F.col("tf").cast("long").alias("tf"), F.round("weight", 6).alias("weight"))


def tfidf_words(spark, sf):
    return _tfidf(spark, sf, "word")


def tfidf_whitespace(spark, sf):
    return _tfidf(spark, sf, "whitespace")


def tfidf_bigrams(spark, sf):
    return _tfidf(spark, sf, "bigram")


def _feature_rows(spark, sf):
    """Features of all marked sentences, ``id`` being a digest of the row."""
    sentences = inputs.kept_sentences(spark, sf)
    rows = relations.relation_candidates(
        inputs.tagged(spark, sf, mentioned_only=True, sentences=sentences), "sent_no")
    keyed = rows.withColumns({
        "sent_id": F.concat_ws("-", "id", "sent_no"),
        "id": F.md5(F.concat_ws("|", "id", "labeled_text", _render()))})
    return cut_lineage(features.fill_missing(relations.relation_features(
        keyed, tokens=inputs.parsed(sentences))))


def tfidf_branches(spark, sf):
    return features.tfidf(_feature_rows(spark, sf), "id", features.FEATURE_BRANCHES).select(
        F.col("id").alias("row_id"), "branch", "term", F.round("weight", 6).alias("weight"))


def ruled_predictions(spark, sf):
    """Classes by coefficients that a rule makes of each term of the vocabulary."""
    rows = _feature_rows(spark, sf)
    idf = features.term_idf(rows, features.term_rows(rows, "id", features.FEATURE_BRANCHES))
    coefficient = F.array(*[
        ((F.length("term") * 7 + F.length("branch") * (3 + k) + 5 * k) % 11 - 5) / F.lit(10.0)
        for k in range(len(inputs.RULED_LABELS))])
    ruled = model.RelationModel(
        cut_lineage(idf.withColumn("coef", coefficient)), inputs.RULED_LABELS,
        inputs.RULED_INTERCEPTS)
    return model.predict_relations(rows, ruled, "id").select(F.col("id").alias("row_id"), "preds")


def union_labelled(spark, sf):
    docs = inputs.table(spark, sf, "documents").select("doc_id", "lang")
    labels = inputs.table(spark, sf, "labels")
    rows = docs.join(labels, "doc_id")
    good, bad = rows.where("quality = 1"), rows.where("quality = 0")
    return model.append_labelled(good, bad.select("toxic", "quality", "lang", "doc_id"))


def split_md5(spark, sf):
    docs = inputs.table(spark, sf, "documents").select("doc_id")
    train, test = model.split_by_key(docs, "doc_id")
    return train.withColumn("part", F.lit("train")).unionAll(test.withColumn("part", F.lit("test")))


def split_exact(spark, sf):
    docs = inputs.table(spark, sf, "documents").select("doc_id")
    train, test = splitting.split_exact(docs, "doc_id")
    return train.withColumn("part", F.lit("train")).unionAll(test.withColumn("part", F.lit("test")))


def svm_predictions(spark, sf):
    train, test = model.split_by_key(inputs.labelled_pairs(spark, sf), "id")
    fitted = model.fit_relations(train)
    return model.predict_relations(test, fitted).select("id", "input_sentence", "label", "preds")


def svm_grid(spark, sf):
    """Cross-validated F1 of the six values of C."""
    return model.tune_relations(inputs.labelled_pairs(spark, sf), refit=False).scores


def relation_links(spark, sf):
    return model.link_relations(inputs.ruled_relations(spark, sf), inputs.relation_dictionary(spark))


# --- results and scoring ---------------------------------------------------

def result_lines(spark, sf):
    """Tagged sentences are stored, as both the relations and the links come from them."""
    marked = cut_lineage(inputs.tagged(spark, sf, mentioned_only=True))
    named = model.link_relations(
        inputs.ruled_relations(spark, sf, marked), inputs.relation_dictionary(spark))
    return results.result_lines(named, inputs.ruled_links(spark, sf, marked))


def link_lookup(spark, sf):
    links = cut_lineage(inputs.ruled_links(spark, sf))
    asked = links.agg(F.max(F.struct("id", "entity")).alias("k")).first()["k"]
    found = results.find_link(links, asked["id"], asked["entity"].upper())
    return found.unionAll(results.find_link(links, asked["id"], "it's"))


def one_link_per_entity(spark, sf):
    return results.one_link_per_entity(inputs.ruled_links(spark, sf))


def gold_rows(spark, sf):
    lines = inputs.gold_lines(spark, sf)
    entity = scoring.gold_entities(lines).select(
        "record", "string", F.col("entity").alias("o"), F.lit(None).cast("string").alias("rel_id"))
    relation = scoring.gold_relations(lines).select("record", "string", "o", "rel_id")
    return entity.unionAll(relation)


def pred_rows(spark, sf):
    lines = inputs.pred_lines(spark, sf)
    entity = scoring.predicted_entities(lines).select(
        "record", "string", F.col("entity").alias("o"), F.lit(None).cast("string").alias("rel_id"))
    relation = scoring.predicted_relations(lines).select("record", "string", "o", "rel_id")
    return entity.unionAll(relation)


def score_entities(spark, sf):
    return scoring.score_entities(inputs.gold_lines(spark, sf), inputs.pred_lines(spark, sf))


def score_relations(spark, sf):
    return scoring.score_relations(inputs.gold_lines(spark, sf), inputs.pred_lines(spark, sf))


def page_facts(spark, sf):
    """Pages to result lines, with a classifier trained on the labelled documents."""
    sentences = cut_lineage(pages.page_sentences(inputs.records(spark, sf)))
    tagged = cut_lineage(facts.tag_and_mark(
        sentences, inputs.gazetteer(spark, sf), inputs.lexicon(spark, sf), mentioned_only=True))
    fitted = model.fit_relations(inputs.labelled_pairs(spark, sf))
    return facts.fact_lines(
        tagged, inputs.kb(spark, sf), fitted, inputs.relation_dictionary(spark),
        tokens=inputs.parsed(sentences))


CATALOGUE: list[Callable[[SparkSession, str], DataFrame]] = [
    record_keys, html_bodies, page_texts, page_sentences, doc_sentences, clean_sentences,
    stopword_anti_join, printable_text,
    archive_records, labelled_blocks, stored_links, stored_relations, appended_lines,
    stored_sentences, label_file, known_relation_file, relation_file,
    entities_flat, entities_multiword, entity_arrays, pos_strings, token_pos, distinct_entities,
    marked_pairs, sql_marked_pairs, label_containment, attached_relations,
    escaped_queries, kb_candidates, char_cosine_rank, word_cosine, entity_links,
    marked_parts, quoted_lines, entity_types, train_entity_types, train_entity_pos,
    relation_labels, clean_pair_sentence, connecting_paths, token_lists, feature_rows,
    feature_paths, prediction_features, training_features,
    tfidf_words, tfidf_whitespace, tfidf_bigrams, tfidf_branches, union_labelled, split_md5, split_exact,
    ruled_predictions, svm_predictions, svm_grid, relation_links,
    result_lines, one_link_per_entity, link_lookup, gold_rows, pred_rows,
    score_entities, score_relations, page_facts,
]
