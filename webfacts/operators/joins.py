"""Joining a large frame with a dictionary-like one, whatever the key skew."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 * 1024 * 1024
# Rows without a key are dealt to so many places; they match nothing anywhere.
NULL_PLACES = 1 << 16
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def row_hash(df: DataFrame) -> Column:
    """Hash of a whole row; the null flags keep rows apart that differ in
    which column is missing."""
    return F.xxhash64(*df.columns, *[F.col(c).isNull() for c in df.columns])


def text_bytes(df: DataFrame) -> int:
    """Size of a frame as text: one distributed aggregate, one number back."""
    size = df.select(F.sum(F.octet_length(F.to_json(F.struct("*")))).alias("n"))
    return size.first()["n"] or 0


def dealt(df: DataFrame, *key: str) -> DataFrame:
    """The rows dealt by ``key`` to as many parts as the session shuffles to.

    Adaptive execution puts small parts together by their bytes; rows that are short but
    cost much work would meet in one task, so their parts are kept apart here.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *key)


def lookup_join(
    big: DataFrame, small: DataFrame, on: str | Sequence[str], how: str = "inner",
    limit: int = BROADCAST_BYTES, stored: bool = False,
) -> DataFrame:
    """Equi-join of ``big`` with a dictionary of any size.

    The dictionary is stored first, so it is evaluated once and measured where
    it lies; ``stored`` says that it already is a stored table. It is broadcast
    when it is within ``limit``; then ``big`` is not shuffled. Otherwise both
    sides are shuffled. ``how`` is ``inner``, ``left`` or ``left_semi``. Storing
    and measuring run while the plan is made.
    """
    on = [on] if isinstance(on, str) else list(on)
    table = small if stored else cut_lineage(small)
    if text_bytes(table) <= limit:
        return big.join(F.broadcast(table), on, how)
    return shuffled_join(big, table, on, how)


def shuffled_join(
    big: DataFrame, small: DataFrame, on: Sequence[str], how: str = "inner",
) -> DataFrame:
    """Shuffle join that evaluates both sides once.

    Adaptive execution cuts the partitions of hot keys, by their measured
    size. It cannot see that rows with a null key match nothing, so those are
    spread by a hash of the row, or left out where the join drops them anyway.
    """
    on = list(on)
    keyless = reduce(or_, [F.col(c).isNull() for c in on])
    if how != "left":
        return big.where(~keyless).join(small, on, how)
    place = F.when(keyless, F.pmod(row_hash(big), F.lit(NULL_PLACES)) + 1).otherwise(F.lit(0))
    # Always 0, but no constant, which the optimizer would take out of the keys.
    zero = F.pmod(F.xxhash64(*on), F.lit(1))
    return (big.withColumn("_place", place.cast("int"))
            .join(small.withColumn("_place", zero.cast("int")), [*on, "_place"], how).drop("_place"))


def cut_lineage(df: DataFrame) -> DataFrame:
    """The frame, written to the shared folder and read again.

    A lost executor cannot lose it, only the columns asked for are read, and
    its files go with the rest of the run. The shuffle files of the write go when
    it ends, as nothing reads them again.
    """
    path, conf = shared_folder(df.sparkSession), df.sparkSession.conf
    before = conf.get(_CLEANUP, "false")
    conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.set(_CLEANUP, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget(stored: DataFrame) -> None:
    """Delete the files of a frame of ``cut_lineage`` that nothing reads again."""
    context = stored.sparkSession.sparkContext
    for file in stored.inputFiles()[:1]:
        place = context._jvm.org.apache.hadoop.fs.Path(context._jvm.java.net.URI(file)).getParent()
        place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)


def shared_folder(spark: SparkSession) -> str:
    """A new folder, below the checkpoint folder that all nodes share, in the
    folder of this run, which goes when the application ends."""
    context = spark.sparkContext
    run = _RUNS.get(context.applicationId)
    if run is None:
        run = f"{_checkpoint_dir(spark)}/webfacts-{uuid.uuid4().hex}"
        place = context._jvm.org.apache.hadoop.fs.Path(run)
        files = place.getFileSystem(context._jsc.hadoopConfiguration())
        files.mkdirs(place)
        files.deleteOnExit(place)
        _RUNS[context.applicationId] = run
    return f"{run}/{uuid.uuid4().hex}"


_RUNS: dict[str, str] = {}


def _checkpoint_dir(spark: SparkSession) -> str:
    """The folder the cluster sets in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own.
    """
    context = spark.sparkContext
    if not context.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            master = context.master
            if not master.startswith("local") or master.startswith("local-cluster"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all nodes share")
            folder = tempfile.mkdtemp(prefix="webfacts-checkpoint-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()
