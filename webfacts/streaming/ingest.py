"""New archive files to the sentence table, as they arrive.

The steps from record to cleaned sentence look at one row at a time, so the
batch operators run unchanged on a stream: no state, no watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from webfacts.operators.pages import page_sentences
from webfacts.sources.archives import CRLF_SEPARATOR, records


def stream_warc(spark: SparkSession, path: str, line_sep: str = CRLF_SEPARATOR) -> DataFrame:
    """``(path, payload)`` rows of the archive files that land in a folder."""
    return records(spark.readStream.option("lineSep", line_sep).text(path))


def ingest_sentences(
    spark: SparkSession, source: str, target: str, checkpoint: str,
    line_sep: str = CRLF_SEPARATOR, anchor: str = "line",
) -> StreamingQuery:
    """Append the sentences of all files not seen before, then stop.

    The checkpoint remembers the files, so each is read once over all runs.
    """
    sentences = page_sentences(stream_warc(spark, source, line_sep), anchor)
    return (sentences.writeStream.format("parquet").outputMode("append")
            .option("path", target).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
