"""Web archives as rows of records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from webfacts.constants import RECORD_MARK

CRLF_SEPARATOR = f"\n{RECORD_MARK}\r\n"
LF_SEPARATOR = f"\n{RECORD_MARK}\n"
# Stands for a genuine replacement character while bad bytes become one.
_GENUINE = "\ufdd0\ufdd1\ufdd0"


def valid_text(c: Column) -> Column:
    """Text without its undecodable bytes; genuine replacement characters stay."""
    bad = F.make_valid_utf8(F.replace(c, F.lit("\ufffd"), F.lit(_GENUINE)))
    repaired = F.replace(F.replace(bad, F.lit("\ufffd"), F.lit("")), F.lit(_GENUINE), F.lit("\ufffd"))
    return F.when(F.is_valid_utf8(c), c).otherwise(repaired)


def record_payloads(chunk: Column) -> Column:
    """Payloads of one chunk: cut at lines holding only the record mark.

    A chunk normally is one record already; this also removes the mark that
    opens a file and cuts at marks with other line ends or blanks around them.
    """
    lines = F.regexp_replace(valid_text(chunk), "\r\n?", "\n")
    blank = "(?U)[^\\S\n]*"
    mark = RECORD_MARK.replace(".", r"\.")
    pieces = F.split(lines, f"(?:(?<=\n)|^){blank}{mark}{blank}(?:\n|$)")
    return F.transform(pieces, lambda p: F.rtrim(p, F.lit("\n")))


def records(chunks: DataFrame) -> DataFrame:
    """``(path, payload)`` rows from raw chunks; works on a stream too."""
    return chunks.select(
        F.col("_metadata.file_path").alias("path"),
        F.explode(record_payloads(F.col("value"))).alias("payload"))


def find_separator(spark: SparkSession, paths: str | Sequence[str]) -> str:
    """Separator for the line ends of the first line, which alone is read."""
    line = spark.read.option("lineSep", "\n").text(paths).first()
    crlf = line is not None and line["value"].endswith("\r")
    return CRLF_SEPARATOR if crlf else LF_SEPARATOR


def crlf_files(spark: SparkSession, paths: str | Sequence[str]) -> list[str]:
    """Files most of whose record marks end in CRLF, by a scan line by line.

    The scan holds one line at a time and brings only paths to the driver.
    """
    crlf = F.col("value") == f"{RECORD_MARK}\r"
    return [row["path"] for row in (
        spark.read.option("lineSep", "\n").text(paths)
        .filter(crlf | (F.col("value") == RECORD_MARK))
        .groupBy(F.col("_metadata.file_path").alias("path"))
        .agg(F.sum(F.when(crlf, 1).otherwise(-1)).alias("excess"))
        .filter("excess > 0").select("path").collect())]


def read_chunks(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Raw chunks, each file cut with its own line ends.

    The filters on the path reach the list of files: neither read opens the
    other's files.
    """
    crlf = crlf_files(spark, paths)
    lf_chunks = spark.read.option("lineSep", LF_SEPARATOR).text(paths)
    if not crlf:
        return lf_chunks.select("value", "_metadata")
    of_crlf = F.col("_metadata.file_path").isin(crlf)
    crlf_chunks = spark.read.option("lineSep", CRLF_SEPARATOR).text(paths)
    return (crlf_chunks.filter(of_crlf).select("value", "_metadata")
            .unionByName(lf_chunks.filter(~of_crlf).select("value", "_metadata")))


def read_warc(
    spark: SparkSession, paths: str | Sequence[str],
    line_sep: str | None = None, spread: int | None = None,
) -> DataFrame:
    """Archive files (plain or gzip) to ``(path, payload)`` rows.

    The text reader cuts at ``line_sep``, so one record and not one file is
    held at a time. Without one it is the mark's line with the line end that most
    marks of the same file have; finding it reads the files once more, line by
    line. Where all files have one known line end, name it (``find_separator`` looks
    at the first line alone) and save that read.
    Line ends become ``\\n`` and do not stay at the end of a payload. A gzip
    file is one task: scale comes from many files. ``spread`` shuffles the
    records over that many partitions, for few and large files.
    """
    chunks = spark.read.option("lineSep", line_sep).text(paths) if line_sep else read_chunks(spark, paths)
    out = records(chunks)
    return out.repartition(spread) if spread else out
