"""Expressions over marked sentences (``<e1>…</e1> … <e2>…</e2>``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from webfacts.functions.text import BLANK, UNICODE, escape_query, let, strip


def mark_pair(text: Column, entities: Column) -> Column:
    """Mark up to two entities in ``text``; matching ignores case.

    The first is the one that starts first (the longest on a tie), the second
    the one that starts first after its end. Characters whose lower-case form
    is longer stay as they are in the comparison, as offsets would shift.
    """
    def folded(whole: Column) -> Column:
        def kept(ch: Column) -> Column:
            return F.when(F.length(F.lower(ch)) == 1, F.lower(ch)).otherwise(ch)
        return F.when(F.length(F.lower(whole)) == F.length(whole), F.lower(whole)).otherwise(
            F.array_join(F.transform(F.split(whole, ""), kept), ""))

    def earliest(low: Column, names: Column, start: Column, skip: Column | None = None) -> Column:
        spans = F.transform(names, lambda e: F.struct(
            F.position(e, low, start).alias("at"), (-F.length(e)).alias("neg"), e.alias("name")))
        keep = (lambda s: s["at"] > 0) if skip is None else (
            lambda s: (s["at"] > 0) & (s["name"] != skip))
        return F.array_min(F.filter(spans, keep))

    def cut(start: Column, stop: Column | None = None) -> Column:
        return F.substring(text, start, F.length(text) if stop is None else stop - start)

    def with_second(first: Column, end1: Column, found: Column) -> Column:
        end2 = found["at"] - found["neg"]
        head = F.concat(cut(F.lit(1), first["at"]), F.lit("<e1>"),
                        cut(first["at"], end1), F.lit("</e1>"))
        return F.when(found.isNull(), F.concat(head, cut(end1))).otherwise(F.concat(
            head, cut(end1, found["at"]), F.lit("<e2>"), cut(found["at"], end2),
            F.lit("</e2>"), cut(end2)))

    def with_first(low: Column, names: Column, first: Column) -> Column:
        end1 = first["at"] - first["neg"]
        return F.when(first.isNull(), text).otherwise(let(
            earliest(low, names, end1, first["name"]),
            lambda found: with_second(first, end1, found)))

    def marked(low: Column, names: Column) -> Column:
        return F.when(text.isNull() | (F.size(names) < 1), text).otherwise(let(
            earliest(low, names, F.lit(1)), lambda first: with_first(low, names, first)))

    distinct = F.filter(F.array_distinct(entities), lambda e: e != "")
    return let(folded(text), lambda low: let(distinct, lambda names: marked(low, names)))


def entity_texts(entity: Column) -> Column:
    """Distinct texts of an entity array."""
    return F.array_distinct(F.transform(entity, lambda e: e["text"]))


def quoted(line: Column) -> Column:
    """Quoted part of a labelled line, without its quotes."""
    return F.btrim(F.regexp_extract(line, r'("[^\n]*")', 1), F.lit('"'))


def plain_sentence(marked: Column) -> Column:
    """Each tag becomes one blank."""
    return F.regexp_replace(marked, "</?e[12]>", " ")


def _between(marked: Column, left: str, right: str) -> Column:
    return strip(F.regexp_extract(marked, rf"{left}([^\n]*){right}", 1))


def entity_part(marked: Column, n: int) -> Column:
    """Text of entity 1 or 2."""
    return _between(marked, f"<e{n}>", f"</e{n}>")


def before_first(marked: Column) -> Column:
    return _between(marked, "", "<e1>")


def between_entities(marked: Column) -> Column:
    return _between(marked, "</e1>", "<e2>")


def after_second(marked: Column) -> Column:
    return _between(marked, "</e2>", "")


def head_word(entity: Column) -> Column:
    """First blank-separated word."""
    return F.regexp_extract(entity, f"{UNICODE}[^{BLANK}]+", 0)


def last_entity(entity: Column, name: Column, exact: bool = False) -> Column:
    """Last element of the entity array whose text is ``name``, else null."""
    same = (lambda x: x["text"] == name) if exact else (
        lambda x: F.lower(x["text"]) == F.lower(name))
    return F.try_element_at(F.filter(entity, same), F.lit(-1))


def token_tag(tokens: Column, name: Column, unless: Column | None = None) -> Column:
    """Tag of the last token containing ``name`` (and not ``unless``)."""
    def hit(t: Column) -> Column:
        inside = F.contains(t["text"], name)
        return inside if unless is None else inside & ~F.contains(t["text"], unless)
    return F.try_element_at(F.filter(tokens, hit), F.lit(-1))["tag"]


def both(a: Column, b: Column) -> Column:
    """Blank-joined pair, null when either is missing."""
    return F.when(a.isNotNull() & b.isNotNull(), F.concat_ws(" ", a, b))


def starred(label: Column) -> Column:
    """``Rel(e1,e2)`` to ``Rel**e1,e2``."""
    return F.replace(F.replace(label, F.lit("("), F.lit("**")), F.lit(")"), F.lit(""))


def relation_pieces(label: Column) -> Column:
    """Relation and, if any, direction of ``Rel(e1,e2)``."""
    return F.transform(F.split(starred(label), r"\*\*"), strip)


def relation_name(label: Column) -> Column:
    return F.get(relation_pieces(label), F.lit(0))


def relation_direction(label: Column) -> Column:
    return F.get(relation_pieces(label), F.lit(1))


def strip_punctuation(c: Column) -> Column:
    return escape_query(c)


def clean_pair_sentence(sentence: Column, e1: Column, e2: Column) -> Column:
    """The sentence with both entities replaced by their punctuation-free form."""
    return F.replace(
        F.replace(sentence, e1, strip_punctuation(e1)), e2, strip_punctuation(e2))
