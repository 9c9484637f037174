"""The whole job: archive records to scored result lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webfacts.operators import linking, model, pages, results, tagging


def tag_and_mark(
    sentences: DataFrame, gazetteer: DataFrame, lexicon: DataFrame | None = None,
    max_words: int | None = None, mentioned_only: bool = False,
) -> DataFrame:
    """``(id, sent_no, org_text, text)`` to the tagged and marked sentence table."""
    dictionary = tagging.prepare_gazetteer(gazetteer, lexicon)
    return tagging.mark_pairs(tagging.tag_entities(
        sentences, dictionary, max_words=max_words, mentioned_only=mentioned_only))


def sentence_table(
    records: DataFrame, gazetteer: DataFrame, lexicon: DataFrame | None = None,
    anchor: str = "line", max_words: int | None = None,
) -> DataFrame:
    """Archive records to the tagged and marked sentence table."""
    return tag_and_mark(pages.page_sentences(records, anchor), gazetteer, lexicon, max_words)


def fact_lines(
    tagged: DataFrame, kb: DataFrame, relation_model: model.RelationModel,
    dictionary: DataFrame, index: linking.Index | None = None,
    tokens: DataFrame | None = None,
) -> DataFrame:
    """Tagged sentences to result lines: links, relations and their assembly.

    ``tagged`` is read for links and for relations; give a stored table when
    tagging is expensive. ``tokens`` are the parsed words of its sentences, see
    ``model.extract_relations``.
    """
    links = linking.link_entities(tagged, kb, index)
    relations = model.extract_relations(tagged, relation_model, dictionary, tokens)
    return results.result_lines(relations, links).select(F.col("value"))
