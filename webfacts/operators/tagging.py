"""Dictionary tagging of sentences and marking of entity pairs."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webfacts.constants import IGNORED_LABELS
from webfacts.functions import marking as M
from webfacts.operators.joins import BROADCAST_BYTES, cut_lineage, lookup_join, row_hash, text_bytes

ENTITY_TYPE = "array<struct<text:string,label:string,`pos-tags`:string>>"


def pos_string(text: Column, pos_map: Column) -> Column:
    """Part of speech of each word of ``text`` or a blank, joined by ``-``."""
    return F.array_join(
        F.transform(F.split(text, " "), lambda w: F.coalesce(pos_map[w], F.lit(" "))), "-")


def pos_map(tokens: DataFrame, *key: str) -> DataFrame:
    """``(key, token, tag, pos)`` rows to a token-to-tag map per sentence.

    The tag of the last occurrence wins. Works per (sentence, token) first, so
    only distinct tokens meet in one map.
    """
    last = tokens.groupBy(*key, "token").agg(F.max_by("tag", "pos").alias("tag"))
    return last.groupBy(*key).agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("token", "tag")))).alias("pos_map"))


def prepare_gazetteer(
    gazetteer: DataFrame, lexicon: DataFrame | None = None,
    ignored: Sequence[str] = tuple(IGNORED_LABELS),
) -> DataFrame:
    """``(alias, label)`` to ``(alias, label, pos_tags, n_words)``, one row per alias.

    Ignored labels leave the dictionary before any sentence is read. A lexicon
    gives each word one tag, so the tag string of an alias is worked out here,
    once per alias and not once per occurrence.
    """
    aliases = (
        gazetteer.where(~F.col("label").isin(list(ignored)) & (F.col("alias") != ""))
        .groupBy("alias").agg(F.min("label").alias("label")))
    n_words = F.size(F.split("alias", " ")).alias("n_words")
    if lexicon is None:
        words = F.split("alias", " ")
        blank = F.array_join(F.transform(words, lambda w: F.lit(" ")), "-")
        return aliases.select("alias", "label", blank.alias("pos_tags"), n_words)
    tags = lexicon.groupBy("token").agg(F.min("pos").alias("pos"))
    words = aliases.select("alias", "label", F.posexplode(F.split("alias", " ")).alias("at", "token"))
    tagged = lookup_join(words, tags, "token", "left")
    return (
        tagged.groupBy("alias", "label")
        .agg(F.array_join(F.transform(
            F.array_sort(F.collect_list(F.struct("at", F.coalesce("pos", F.lit(" ")).alias("pos")))),
            lambda x: x["pos"]), "-").alias("pos_tags"))
        .select("alias", "label", "pos_tags", n_words))


def _leftmost_longest(hits: Column) -> Column:
    """Hits in text order; one that starts inside an accepted hit is dropped."""
    kept = F.aggregate(
        F.array_sort(hits),
        F.struct(F.lit(0).alias("end"), F.array().cast(ENTITY_TYPE).alias("out")),
        lambda acc, h: F.when(h["at"] >= acc["end"], F.struct(
            (h["at"] - h["neg"]).alias("end"),
            F.concat(acc["out"], F.array(h["entity"])).alias("out"))).otherwise(acc))
    return kept["out"]


def tag_entities(
    df: DataFrame, gazetteer: DataFrame, key: Sequence[str] = ("id", "sent_no"),
    max_words: int | None = None, mentioned_only: bool = False, limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Add ``entity`` (texts, labels, tags in text order) to cleaned sentences.

    ``gazetteer`` comes from ``prepare_gazetteer``; it is stored here, and its
    longest alias tells how many words an n-gram may have (``max_words``
    restricts that). Each word of ``text`` starts n-grams, which probe the
    dictionary by a hash join. The first n-gram of each sentence alone carries
    the sentence itself, and only it and hits go on: one scan and one shuffle
    of the sentences, no join back. Equal rows meet in one group and come out as often as they
    went in, so copies cost nothing. ``mentioned_only`` leaves out sentences
    without an entity: with a dictionary within ``limit``, which is broadcast, hits alone
    carry their sentence and the others are never shuffled.
    """
    key = list(key)
    gazetteer = cut_lineage(gazetteer)
    longest = gazetteer.agg(F.max("n_words")).first()[0] or 1
    max_words = min(longest, max_words or longest)
    grams = df.select(
        *key, row_hash(df).alias("_copy"),
        F.struct(*df.columns).alias("_row"),
        F.filter(F.split("text", " "), lambda t: t != "").alias("_words"),
    ).select("*", F.posexplode_outer("_words").alias("_at", "_word"))
    if max_words > 1:
        lengths = F.sequence(F.lit(1), F.greatest(
            F.least(F.lit(max_words), F.size("_words") - F.col("_at")), F.lit(1)))
        grams = grams.withColumn("_n", F.explode(F.coalesce(lengths, F.array(F.lit(1)))))
        alias = F.array_join(F.slice("_words", F.col("_at") + 1, F.col("_n")), " ")
        grams = grams.withColumn("alias", F.when(F.col("_n") == 1, F.col("_word")).otherwise(alias))
    else:
        grams = grams.withColumns({"_n": F.lit(1), "alias": F.col("_word")})
    is_first = (F.coalesce("_at", F.lit(0)) == 0) & (F.col("_n") == 1)
    is_hit = F.col("label").isNotNull()
    hit = F.struct(
        F.col("_at").alias("at"), (-F.col("_n")).alias("neg"),
        F.struct(F.col("alias").alias("text"), "label",
                 F.col("pos_tags").alias("pos-tags")).alias("entity"))
    if mentioned_only and text_bytes(gazetteer) <= limit:
        # A copy of a sentence brings each hit once.
        grouped = (
            grams.join(F.broadcast(gazetteer), "alias")
            .select(*key, "_copy", "_row", hit.alias("_hit")).groupBy(*key, "_copy").agg(
                F.first("_row").alias("_row"), F.collect_set("_hit").alias("_hits"),
                F.count(F.lit(1)).alias("_found"))
            .withColumn("_copies", F.col("_found") / F.size("_hits")))
    else:
        probes = grams.withColumn("_row", F.when(is_first, F.col("_row"))).drop("_words", "_word")
        slim = (
            lookup_join(probes, gazetteer, "alias", "left", stored=True)
            .where(is_first | is_hit)
            .select(*key, "_copy", "_row",
                    F.when(is_hit, hit).alias("_hit"), is_first.cast("long").alias("_first")))
        grouped = slim.groupBy(*key, "_copy").agg(
            F.first("_row", ignorenulls=True).alias("_row"),
            F.collect_set("_hit").alias("_hits"),
            F.sum("_first").alias("_copies"))
        if mentioned_only:
            grouped = grouped.where(F.size("_hits") > 0)
    in_order = F.transform(F.array_sort("_hits"), lambda h: h["entity"])
    entity = in_order if max_words == 1 else _leftmost_longest(F.col("_hits"))
    return (
        grouped.select("_row", entity.cast(ENTITY_TYPE).alias("entity"), "_copies")
        .select("_row.*", "entity", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))).alias("_c"))
        .drop("_c"))


def tag_with_model(
    df: DataFrame, fn: Callable[[Iterator], Iterator],
) -> DataFrame:
    """Plug-in for a user's own recogniser in place of the dictionary.

    ``fn`` maps an iterator of pandas batches to the same batches with an
    ``entity`` column.
    """
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInPandas(fn, f"{fields}, entity {ENTITY_TYPE}")


def mark_pairs(df: DataFrame) -> DataFrame:
    """Add ``labeled_text``: up to two entities of ``org_text`` marked."""
    return df.withColumn(
        "labeled_text", M.mark_pair(F.col("org_text"), M.entity_texts(F.col("entity"))))


def entity_rows(tagged: DataFrame, *ids: str) -> DataFrame:
    """One row per mention: the id columns, its place in the array, text, label, tags."""
    return tagged.select(*ids, F.posexplode("entity").alias("ent_no", "e")).select(
        *ids, "ent_no", F.col("e.text").alias("text"), F.col("e.label").alias("label"),
        F.col("e.`pos-tags`").alias("pos_tags"))
