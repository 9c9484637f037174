"""From raw documents to packed training sequences, in four stages.

Each stage takes ``(spark, docs, sf_dir)``; its result is written as Parquet to
the shared folder and read again as the documents of the next one. All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webfacts.llm import langid, mixing, ngram_join, packing
from webfacts.llm.columns import staged
from webfacts.llm.queries import tokenizer_file


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the classifier accepts, ``lang`` as labelled.

    Learns from a bounded sample of the labelled rows (``langid.fit``).
    """
    known = langid.fit(docs)
    judged = langid.identify(docs, known)
    return judged.where("NOT rejected").select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links of five-word shingles at a
    similarity of 0.8 or more connect: the one of the smallest id, then of the
    smallest digest of its text.

    Documents without words or without an id have no links and stay, all of
    them. Rows that share an id but are no near copies of each other are
    documents of their own. Of rows that agree in id and text, the smallest by
    their other columns stays.
    """
    groups = staged(ngram_join.join_shingles(docs, k=5, similarity=(80, 100)).where("doc_id IS NOT NULL"))
    kept = (
        groups.where("component IS NOT NULL").groupBy("component")
        .agg(F.min(F.struct("doc_id", "digest")).alias("kept")).select("kept.*", F.lit(True).alias("linked")))
    alone = groups.where("component IS NULL").select("doc_id", "digest", F.lit(False).alias("linked")).distinct()
    keep = staged(kept.unionByName(alone).select("doc_id", F.coalesce("digest", F.lit(b"")).alias("digest"), "linked"))
    found = (
        docs.where("doc_id IS NOT NULL")
        .withColumn("digest", F.coalesce(F.unhex(F.md5("text")), F.lit(b""))).join(keep, ["doc_id", "digest"]))
    one = found.where("linked").groupBy("doc_id", "digest").agg(
        F.min(F.struct(*docs.columns)).alias("row")).select("row.*")
    return (one.unionByName(found.where("NOT linked").select(*docs.columns))
            .unionByName(docs.where("doc_id IS NULL")).select(*docs.columns))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources at their target weights: each document as often as drawn."""
    return mixing.repeated(mixing.mix(docs)).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences, with their ids."""
    return packing.pack(docs, tokenizer_file("byte_bpe_50k.json"), end_id=1, keep_ids=True)


STAGES = [
    ("language", identify_language),
    ("near_copies", drop_near_copies),
    ("mixture", mix_sources),
    ("packing", pack_sequences),
]

# Compression, tokenization and differencing are beyond SQL; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir))
    return docs
