"""Relation features of marked sentences."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webfacts.functions import marking as M
from webfacts.functions.text import strip
from webfacts.operators.joins import cut_lineage, dealt
from webfacts.operators.paths import connecting_paths, token_edges, token_lists, tokens_of

# Column order of a feature row.
FEATURE_COLUMNS = [
    "input_sentence", "input_relation", "id", "e1", "e2", "e1_e2",
    "head_e1", "head_e2", "head_e1_e2", "before_e1", "between_e1_e2",
    "after_e2", "e1_ner", "e2_ner", "e1_postag", "e2_postag", "e1_e2_ner",
    "relation", "direction", "sentence_string",
]

PARSE_LIST = "array<struct<text:string,tag:string,head:string,dep:string>>"


def relation_candidates(tagged: DataFrame, sent_no: str | None = None) -> DataFrame:
    """Distinct ``(labeled_text, entity, id)`` with two entities and both marks.

    ``sent_no`` names a column of which the smallest value per row is kept, to
    find the sentence again.
    """
    pairs = tagged.where(
        (F.size("entity") >= 2) & F.contains("labeled_text", F.lit("</e2>")))
    if sent_no is None:
        return pairs.select("labeled_text", "entity", "id").distinct()
    return pairs.groupBy("labeled_text", "entity", "id").agg(F.min(sent_no).alias(sent_no))


def labelled_sentences(blocks: DataFrame) -> DataFrame:
    """``(line, input_relation)`` blocks to ``(input_sentence, input_relation)``."""
    return blocks.select(
        M.quoted(F.col("line")).alias("input_sentence"), strip(F.col("input_relation")).alias("input_relation"))


def split_marked(df: DataFrame, marked: str = "input_sentence") -> DataFrame:
    """Add the texts around, between and inside the marks, and the head words."""
    m = F.col(marked)
    return df.withColumns({
        "sentence_string": M.plain_sentence(m),
        "e1": M.entity_part(m, 1), "e2": M.entity_part(m, 2),
        "before_e1": M.before_first(m), "between_e1_e2": M.between_entities(m),
        "after_e2": M.after_second(m),
    }).withColumns({
        "e1_e2": F.concat_ws(" ", "e1", "e2"),
        "head_e1": M.head_word(F.col("e1")), "head_e2": M.head_word(F.col("e2")),
    }).withColumn("head_e1_e2", F.concat_ws(" ", "head_e1", "head_e2"))


def add_types(df: DataFrame, exact: bool = False) -> DataFrame:
    """Add type and part of speech of both entities from the ``entity`` array."""
    return df.withColumns({
        "_x1": M.last_entity(F.col("entity"), F.col("e1"), exact),
        "_x2": M.last_entity(F.col("entity"), F.col("e2"), exact),
    }).withColumns({
        "e1_ner": F.col("_x1.label"), "e2_ner": F.col("_x2.label"),
        "e1_postag": F.col("_x1.`pos-tags`"), "e2_postag": F.col("_x2.`pos-tags`"),
        "e1_e2_ner": M.both(F.col("_x1.label"), F.col("_x2.label")),
    }).drop("_x1", "_x2")


def add_token_tags(df: DataFrame) -> DataFrame:
    """Tags of both entities from the ``parse_list`` array: last token that
    contains the text; a token with the first entity does not count for the second."""
    tokens, e1, e2 = F.col("parse_list"), F.col("e1"), F.col("e2")
    return df.withColumns({
        "e1_postag": M.token_tag(tokens, e1), "e2_postag": M.token_tag(tokens, e2, unless=e1)})


def add_relation(df: DataFrame) -> DataFrame:
    """Add ``relation`` and ``direction`` of ``input_relation``, which keeps its
    form with ``**`` between the two."""
    return df.withColumns({
        "relation": M.relation_name(F.col("input_relation")),
        "direction": M.relation_direction(F.col("input_relation")),
        "input_relation": M.starred(F.col("input_relation"))})


def add_paths(df: DataFrame, edges: DataFrame, sent_id: str = "sent_id") -> DataFrame:
    """Add ``shortest_path`` between the head words, without punctuation, of a
    sentence with the given id; ``''`` when there is none. The rows are read
    twice, so a stored table is best."""
    heads = df.withColumns({
        "source": F.lower(M.head_word(M.strip_punctuation(F.col("e1")))),
        "target": F.lower(M.head_word(M.strip_punctuation(F.col("e2"))))})
    return (connecting_paths(heads.withColumnRenamed(sent_id, "sent_id"), edges)
            .withColumnsRenamed({"path": "shortest_path", "sent_id": sent_id})
            .drop("source", "target"))


def relation_features(
    df: DataFrame, training: bool = False, tokens: DataFrame | None = None, sent_id: str = "sent_id",
) -> DataFrame:
    """Feature rows.

    Prediction rows come from ``relation_candidates``. Training rows have
    ``input_sentence``, ``input_relation`` and an ``entity`` array matched
    exactly. ``tokens(sent_id, pos, head, token, tag, dep)`` are the parsed
    words of the sentences, which the column ``sent_id`` of the rows names: they
    give the path between the entities and, in training, their tags. It is
    read once. Without it the path is ``''`` and
    training tags are missing. Training rows also have ``parse_list``, the tokens
    of the sentence, empty without ``tokens``.
    """
    rows = df if training else df.withColumns({
        "input_sentence": F.col("labeled_text"), "input_relation": F.lit(None).cast("string")})
    if "id" not in rows.columns:
        rows = rows.withColumn("id", F.lit(None).cast("string"))
    rows = split_marked(dealt(rows, "input_sentence", "id"))
    if tokens is not None:
        # Tokens of the sentences asked for only, before they meet each other.
        rows = cut_lineage(rows)
        tokens = cut_lineage(tokens_of(tokens, rows.withColumnRenamed(sent_id, "sent_id")))
        rows = add_paths(rows, token_edges(tokens), sent_id)
        if training:
            lists = token_lists(tokens).withColumnRenamed("sent_id", sent_id)
            rows = rows.join(lists, sent_id, "left")
    rows = add_types(rows, exact=training)
    if training and "parse_list" in rows.columns:
        rows = add_token_tags(rows)
    elif training:
        rows = rows.withColumns({
            "parse_list": F.array().cast(PARSE_LIST),
            **{c: F.lit(None).cast("string") for c in ("e1_postag", "e2_postag")}})
    missing = F.lit(None).cast("string")
    rows = add_relation(rows) if training else rows.withColumns(
        {"relation": missing, "direction": missing})
    if "shortest_path" not in rows.columns:
        rows = rows.withColumn("shortest_path", F.lit(""))
    return rows.select(*FEATURE_COLUMNS, "shortest_path", *["parse_list"] * training)
