"""Result lines from relations and links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webfacts.constants import ENTITY_PREFIX, NAN_TEXT, NONE_TEXT, RELATION_PREFIX
from webfacts.operators.joins import cut_lineage, lookup_join


def one_link_per_entity(links: DataFrame) -> DataFrame:
    """One row per ``(id, entity)``; repeated mentions carry equal links."""
    return links.groupBy("id", "entity").agg(F.min("linking").alias("linking"))


def attach_links(relations: DataFrame, links: DataFrame) -> DataFrame:
    """Add ``e1_link`` and ``e2_link``; a relation whose entity has no link row
    is dropped, one whose link is null stays. The unique links are checkpointed,
    as both entities look them up."""
    unique = cut_lineage(one_link_per_entity(links))
    out = relations.withColumns({"_e1": F.lower("e1"), "_e2": F.lower("e2")})
    for n in ("1", "2"):
        side = unique.select("id", F.col("entity").alias(f"_e{n}"),
                             F.col("linking").alias(f"e{n}_link"))
        out = lookup_join(out, side, ["id", f"_e{n}"])
    return out.drop("_e1", "_e2")


def _line(prefix: str, *parts: Column) -> Column:
    return F.concat(F.lit(prefix), F.concat_ws("\t", *parts))


def result_lines(relations: DataFrame, links: DataFrame) -> DataFrame:
    """``(id, e1, e2, relation_name, link)`` rows to three lines each.

    Missing links print as ``None``, missing relation fields as ``nan``.
    """
    link1 = F.coalesce("e1_link", F.lit(NONE_TEXT))
    link2 = F.coalesce("e2_link", F.lit(NONE_TEXT))
    lines = F.array(
        _line(ENTITY_PREFIX, F.col("id"), F.col("e1"), link1),
        _line(ENTITY_PREFIX, F.col("id"), F.col("e2"), link2),
        _line(RELATION_PREFIX, F.col("id"), link1, link2,
              F.coalesce("relation_name", F.lit(NAN_TEXT)), F.coalesce("link", F.lit(NAN_TEXT))))
    return attach_links(relations, links).select(F.explode(lines).alias("value"))


def find_link(links: DataFrame, page_id: str, entity: str) -> DataFrame:
    """Link rows of one entity of one page, by a parameterised query."""
    links.createOrReplaceTempView("links")
    return links.sparkSession.sql(
        "SELECT entity, linking, id FROM links WHERE id = :id AND entity = lower(:entity)",
        args={"id": page_id, "entity": entity})
