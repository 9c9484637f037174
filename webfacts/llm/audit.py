"""How filters interact: what each removes, repeats or alone removes, in any order.

Each failing row gives its id and the bits of the conditions it fails. The
conditions on a text alone come from one pass; that a text stands at a smaller
id, anywhere in the table, comes from a left-semi join of the table with itself
on hash, exact text and smaller id. The failures are united, combined by id and
counted by combination of bits. All orders of the filters are then read from the
counts of at most 32 combinations of each part of the table.

A text of very many copies is no load on one task: one side of the join has
each distinct text once, and the copies of a text are dealt to as many places
as their number asks for.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webfacts.llm.columns import staged
from webfacts.operators.joins import lookup_join

FILTERS = "ABCDE"
# Copies of one text that meet in one task.
COPIES_AT_ONCE = 256


def text_failures(text: Column) -> Column:
    """Bits 1, 2, 4 and 8 of the conditions A to D that a text fails."""
    words = F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")

    def bits(found: Column) -> Column:
        n, distinct = F.size(found).cast("long"), F.size(F.array_distinct(found))
        capitals = F.regexp_count(text, F.lit("[A-Z]")).cast("long")
        conditions = [
            n < 100, 100 * distinct.cast("long") < 80 * n,
            100 * capitals > 10 * F.length(text).cast("long"),
            text.rlike("[#$%&*|]")]
        return sum((F.when(c, 1 << i).otherwise(0) for i, c in enumerate(conditions)), F.lit(0))

    # The words are bound once; each use of an expression would cut the text again.
    return F.element_at(F.transform(F.array(words), bits), 1).cast("int")


def repeats(docs: DataFrame, facts: DataFrame) -> DataFrame:
    """``(doc_id, digest, part)`` of the rows whose text stands at a smaller id.

    ``docs`` is ``(doc_id, text, part)``, ``facts`` is ``(doc_id, digest)`` of the
    same rows and stored.
    """
    groups = (
        facts.groupBy("digest")
        .agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
        .where("most > least")
        .select("digest", F.ceil(F.col("n") / COPIES_AT_ONCE).cast("int").alias("places")))
    hashed = docs.where("doc_id IS NOT NULL").withColumn("digest", F.md5("text"))
    copies = lookup_join(hashed, groups, "digest")
    later = copies.withColumn("place", F.pmod(F.xxhash64("doc_id"), F.col("places")).cast("int"))
    first = (
        copies.groupBy("digest", "text")
        .agg(F.min("doc_id").alias("first_id"), F.first("places").alias("places"))
        .select("digest", "text", "first_id", F.explode(F.sequence(F.lit(0), F.col("places") - 1)).alias("place")))
    a, b = later.alias("a"), first.alias("b")
    same = (F.col("a.digest") == F.col("b.digest")) & (F.col("a.place") == F.col("b.place")) & (
        F.col("a.text") == F.col("b.text")) & (F.col("b.first_id") < F.col("a.doc_id"))
    return a.join(b, same, "left_semi").select("doc_id", "digest", "part")


def combinations(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(part, mask, n, good, toxic)``: documents of each part by the bits they
    fail, and how many of them are labelled good and toxic."""
    text = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"),
                       F.coalesce("lang", F.lit("")).alias("part"))
    facts = staged(text.select(
        "doc_id", F.md5("text").alias("digest"), "part", text_failures(F.col("text")).alias("bits")))
    later = repeats(text, facts.select("doc_id", "digest"))
    united = facts.withColumn("n", F.lit(1)).unionByName(
        later.select("*", F.lit(1 << FILTERS.index("E")).alias("bits"), F.lit(0).alias("n")))
    masks = united.groupBy("doc_id", "digest", "part").agg(
        F.bit_or("bits").alias("mask"), F.sum("n").alias("n"))
    known = (
        labels.where("doc_id IS NOT NULL").groupBy("doc_id")
        .agg(F.max(F.expr("int(quality <=> 1)")).alias("good"), F.max(F.expr("int(toxic <=> 1)")).alias("toxic")))
    return (
        lookup_join(masks, known, "doc_id", "left").groupBy("part", "mask")
        .agg(F.sum("n").alias("n"),
             F.sum(F.col("n") * F.coalesce("good", F.lit(0))).alias("good"),
             F.sum(F.col("n") * F.coalesce("toxic", F.lit(0))).alias("toxic")))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each part (``lang``), filter order and step.

    ``docs`` is read by ``doc_id``, ``text`` and ``lang``, ``labels`` by ``doc_id``,
    ``quality`` and ``toxic``. Defined cases: a null text is empty, a null
    ``lang`` the empty string; a null id is neither smaller nor larger than
    another, so such a row never fails E, and has no labels; rows that share id and text do not
    fail E by each other; of several label rows of an id any may say good or
    toxic; an empty table has no parts and gives no rows; other columns are not
    read.
    """
    parts = (
        staged(combinations(docs, labels)).groupBy("part")
        .agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("found")))
    orders = F.array(*[F.lit("".join(o)) for o in permutations(FILTERS)])
    steps = (
        parts.select("part", "found", F.explode(orders).alias("filter_order"))
        .select("part", "found", "filter_order", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))
        .withColumn("bit", _bits(F.substring("filter_order", F.col("step"), F.lit(1))))
        .withColumn("before", _bits(F.substring("filter_order", F.lit(1), F.col("step") - 1))))
    bit, before = F.col("bit"), F.col("before")
    has = lambda m, some: m.bitwiseAND(some) != 0

    def total(value: str, when) -> Column:
        return F.aggregate("found", F.lit(0).cast("long"), lambda acc, c: acc + F.when(
            when(c["mask"]), c[value]).otherwise(0))

    removed = lambda m: has(m, bit) & ~has(m, before)
    shapley = F.aggregate("found", F.lit(0).cast("long"), lambda acc, c: acc + F.when(
        has(c["mask"], bit), c["n"] * _among(c["mask"])).otherwise(0))
    return steps.select(
        "part", "filter_order", "step",
        total("n", lambda m: ~has(m, bit.bitwiseOR(before))).alias("kept"),
        total("n", removed).alias("removed"),
        total("n", lambda m: has(m, bit) & has(m, before)).alias("redundant"),
        total("n", lambda m: m == bit).alias("unique_fails"),
        total("good", removed).alias("good_lost"),
        total("toxic", removed).alias("toxic_lost"),
        shapley.alias("shapley"))


def _bits(letters: Column) -> Column:
    return sum((F.when(F.contains(letters, F.lit(f)), 1 << i).otherwise(0)
                for i, f in enumerate(FILTERS)), F.lit(0))


def _among(mask: Column) -> Column:
    """In how many of all orders a failed filter comes before the others that
    the row fails: all orders over the number of filters it fails."""
    shares = [factorial(len(FILTERS)) // k for k in range(1, len(FILTERS) + 1)]
    return F.element_at(F.array(*map(F.lit, shares)), F.greatest(F.bit_count(mask), F.lit(1)))
