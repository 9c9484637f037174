"""Tables, dictionaries and text files in the shapes the job hands over."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

# Quotes are doubled inside quoted fields.
_CSV = {"header": "true", "escape": '"'}
_INFER = "spark.sql.sources.partitionColumnTypeInference.enabled"


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spread_scan(spark.read.parquet(path))


def spread_scan(scan: DataFrame) -> DataFrame:
    """Deal the rows of a scan out when it has fewer splits than there are cores.

    That happens with a few small or unsplittable files, whose text work would
    run on a core or two. A scan of many files is returned as it is.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with a header line; the schema is declared, never inferred."""
    return spark.read.options(**_CSV).schema(schema).csv(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header line; arrays and structs are written as JSON."""
    nested = {f.name: F.to_json(F.col(f"`{f.name}`")) for f in df.schema.fields
              if f.dataType.typeName() in ("array", "struct", "map")}
    (df.withColumns(nested) if nested else df).write.mode(mode).options(**_CSV).csv(path)


def write_headerless_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV without a header line; blanks inside fields are kept, missing values
    are empty fields."""
    df.write.mode(mode).options(
        escape='"', emptyValue='""', ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false").csv(path)


def read_headerless_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV without a header line; blanks inside fields are kept."""
    return spark.read.option("escape", '"').schema(schema).csv(path)


def read_relation_dictionary(spark: SparkSession, path: str) -> DataFrame:
    return read_headerless_csv(
        spark, path, "relation string, relation_name string, link string")


def local_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small local list as a DataFrame."""
    return spark.createDataFrame(rows, schema)


# --- text lines ------------------------------------------------------------

def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(line_at, value)``; ``line_at`` orders the lines of the input.

    Position is run (see ``write_lines``), file, split start, then arrival
    within the split, so that "the last line wins" means the same however the
    file is cut.
    """
    lines = spark.read.text(path)
    run = F.col("run").cast("int") if "run" in lines.columns else F.lit(-1)
    return lines.select(
        F.struct(
            run.alias("run"),
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("seq")).alias("line_at"),
        F.rtrim(F.col("value"), F.lit("\r")).alias("value"))


def _field(n: int) -> Column:
    return F.get(F.split(F.col("value"), "\t"), F.lit(n))


def read_label_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """``label <tab> url`` lines; the last line of a label wins."""
    return last_label(read_lines(spark, path).select(
        _field(0).alias("label"), _field(1).alias("url"), "line_at"), "line_at")


def last_label(labels: DataFrame, order: str) -> DataFrame:
    """One row per label: the one with the greatest ``order``."""
    return labels.groupBy("label").agg(F.max_by("url", order).alias("url"))


def read_known_relations(spark: SparkSession, path: str) -> DataFrame:
    """``label <tab> subject <tab> object <tab> relation`` lines."""
    return read_lines(spark, path).select(
        _field(0).alias("label"), _field(1).alias("subject_url"),
        _field(2).alias("object_url"), _field(3).alias("relation_url"))


def read_blocks(spark: SparkSession, path: str, line_end: str = "\n") -> DataFrame:
    """Labelled sentences: blocks of sentence, relation and a comment, each
    closed by an empty line, to ``(line, input_relation)`` rows."""
    lines = F.split(F.ltrim(F.col("value"), F.lit("\r\n")), "\r?\n")
    return (
        spark.read.option("lineSep", line_end * 2).text(path)
        .select(F.get(lines, F.lit(0)).alias("line"),
                F.get(lines, F.lit(1)).alias("input_relation"))
        .where("line <> '' AND input_relation IS NOT NULL"))


def write_lines(lines: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A ``value`` column as text, in a folder ``run=0``; ``mode="append"`` adds
    the next run, whose lines come after those of earlier ones.

    One writer at a time: the number of a run follows those that are there.
    """
    run = 0
    if mode == "append":
        try:
            there = lines.sparkSession.read.text(path)
        except AnalysisException:
            there = None
        if there is not None and "run" in there.columns:
            last = there.agg(F.max("run")).first()[0]
            run = 0 if last is None else int(last) + 1
    lines.select("value", F.lit(run).alias("run")).write.partitionBy("run").mode(mode).text(path)


# --- link table ------------------------------------------------------------

def write_links(
    links: DataFrame, path: str, buckets: int | None = 256, mode: str = "overwrite",
) -> None:
    """Link table, partitioned by a hash bucket of the page id.

    ``rebalance`` gives each bucket few files and still splits a bucket that
    holds far more rows than others. ``buckets=None`` partitions by the id
    itself, one folder per page, which suits small page sets only.
    """
    if buckets is None:
        links.hint("rebalance", F.col("id")).write.partitionBy("id").mode(mode).parquet(path)
        return
    (links.withColumn("bucket", F.pmod(F.xxhash64("id"), F.lit(buckets)).cast("int"))
     .hint("rebalance", F.col("bucket"))
     .write.partitionBy("bucket").mode(mode).parquet(path))


def read_links(spark: SparkSession, path: str) -> DataFrame:
    """Link table of either layout; ids stay text."""
    before = spark.conf.get(_INFER)
    spark.conf.set(_INFER, "false")
    try:
        return spark.read.parquet(path).select(
            F.col("id").cast("string").alias("id"), "entity", "linking")
    finally:
        spark.conf.set(_INFER, before)
