"""Page records to sentences: narrow projections, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webfacts.functions import html as H
from webfacts.functions import text as T


def page_bodies(records: DataFrame, anchor: str = "line", glue: str = "") -> DataFrame:
    """``(payload)`` to ``(id, html)``; records without key or HTML are dropped."""
    return (
        records.where(F.col("payload") != "")
        .select(H.page_key(F.col("payload")).alias("id"),
                H.html_body(F.col("payload"), anchor, glue).alias("html"))
        .where("id IS NOT NULL AND html IS NOT NULL"))


def page_text(html: Column) -> Column:
    """Text of a page on one line."""
    return T.collapse_ws(H.html_to_text(html))


def explode_sentences(pages: DataFrame, content: Column, *ids: str) -> DataFrame:
    """One row per sentence: the id columns, ``sent_no`` and ``org_text``."""
    return pages.select(*ids, F.posexplode(T.sentences(content)).alias("sent_no", "org_text"))


def page_sentences(records: DataFrame, anchor: str = "line", glue: str = "") -> DataFrame:
    """``(payload)`` to ``(id, sent_no, org_text, text)``, ``text`` cleaned."""
    bodies = page_bodies(records, anchor, glue)
    return explode_sentences(bodies, page_text(F.col("html")), "id").withColumn(
        "text", T.clean_sentence(F.col("org_text")))
