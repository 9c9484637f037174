"""Document fingerprints by context-triggered piecewise hashing.

A rolling hash of seven bytes ends a piece wherever its low bits are all set,
so pieces depend on near bytes only and an edit changes few of them. Each piece
gives three characters of its hash; the row of them is the signature. A run of
equal pieces is written as the piece and, in one more, the power of two at or
below its length. The block size is the largest power of two that still gives
``LEAST`` pieces, runs being joined, and a
fingerprint holds the signatures of that size and of twice that size. Where a
passage is repeated, triggers can jump from none to very many between two sizes;
pieces beyond ``MOST`` are then joined, level by level: equal neighbours in twos,
others up to the next that is smaller than both its neighbours. So each part of
the text weighs, and groups depend on near pieces only. Two
fingerprints are compared at a block size both have, by the edit distance (one
for an insertion or deletion, two for a replacement) of their pieces, joined to
the same level.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webfacts.llm.ranges import cut_points, in_ranges, range_of

WINDOW = 7
LEAST = 32
# A signature has this many pieces at most; more are joined.
MOST = 128
_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
_PAIRS = [a + b + c for a in _LETTERS for b in _LETTERS for c in _LETTERS]


def _triggers(data: bytes) -> np.ndarray:
    """A number for each byte; its low set bits tell the block sizes it ends."""
    byte = np.zeros(len(data) + WINDOW - 1, dtype=np.uint32)
    byte[WINDOW - 1:] = np.frombuffer(data, dtype=np.uint8)
    byte[WINDOW - 1:] += 1
    rolled = byte[:len(data)].copy()
    for i in range(1, WINDOW):
        rolled *= np.uint32(0x01000193)
        rolled += byte[i:i + len(data)]
    rolled *= np.uint32(0x9E3779B1)
    rolled ^= rolled >> np.uint32(15)
    rolled *= np.uint32(0x85EBCA77)
    return rolled ^ (rolled >> np.uint32(13))


def _cut(data: bytes, ends: np.ndarray) -> list[str]:
    """Pieces between the ends, runs joined."""
    pieces: list[str] = []
    begin, run = 0, 0
    stops = ends.tolist()
    if not stops or stops[-1] < len(data):
        stops.append(len(data))
    for end in stops:
        piece = _PAIRS[zlib.crc32(data[begin:end]) & 0x3FFFF]
        begin = end
        if run and piece == last:
            run += 1
            continue
        if run > 1:
            pieces.append(_run(last, run))
        pieces.append(piece)
        last, run = piece, 1
    if run > 1:
        pieces.append(_run(last, run))
    return pieces


def _run(piece: str, length: int) -> str:
    return _PAIRS[zlib.crc32(f"{piece}*{length.bit_length()}".encode()) & 0x3FFFF]


def _signature(pieces: list[str]) -> str:
    level = 0
    while len(pieces) > MOST:
        pieces, level = _joined(pieces), level + 1
    return (f"{level}*" if level else "") + "".join(pieces)


def _joined(pieces: list[str]) -> list[str]:
    """Pieces of the next level, about half as many or fewer."""
    out: list[str] = []
    group: list[str] = []

    def close() -> None:
        if group:
            out.append(_PAIRS[zlib.crc32("".join(group).encode()) & 0x3FFFF])
            group.clear()

    last = None
    for piece, following in zip(pieces, [*pieces[1:], None]):
        if piece == last:
            # The second of two equal pieces ends their group.
            group.append(piece)
            close()
            last = None
            continue
        if piece == following or following is not None and last is not None and piece < min(last, following):
            close()
        group.append(piece)
        last = piece
    close()
    return out


def fingerprint(text: str) -> str:
    """``block size:signature:signature of twice the size``; equal texts have
    equal fingerprints, the empty text has ``1::``."""
    data = text.encode("utf-8", "surrogatepass")
    if not data:
        return "1::"
    mark = _triggers(data)
    size = 1 << max(0, (len(data) // LEAST).bit_length())
    while True:
        ends = np.flatnonzero((mark & np.uint32(size - 1)) == size - 1) + 1
        if size == 1 or len(ends) >= LEAST:
            pieces = _cut(data, ends)
            if size == 1 or len(pieces) >= LEAST:
                break
        size //= 2
    double = np.flatnonzero((mark & np.uint32(2 * size - 1)) == 2 * size - 1) + 1
    return f"{size}:{_signature(pieces)}:{_signature(_cut(data, double))}"


def _pieces(signature: str) -> tuple[int, list[str]]:
    level, _, letters = signature.rpartition("*")
    return int(level or 0), [letters[i:i + 3] for i in range(0, len(letters), 3)]


def _same_size(a: str, b: str) -> float:
    if a == b:
        return 1.0
    (level, one), (other, two) = _pieces(a), _pieces(b)
    for _ in range(other - level):
        one = _joined(one)
    for _ in range(level - other):
        two = _joined(two)
    if not one or not two:
        return 0.0
    where: dict[str, int] = {}
    for i, piece in enumerate(one):
        where[piece] = where.get(piece, 0) | (1 << i)
    # Longest common subsequence, one machine word operation per piece.
    row = full = (1 << len(one)) - 1
    for piece in two:
        hit = row & where.get(piece, 0)
        row = ((row + hit) | (row - hit)) & full
    common = len(one) - row.bit_count()
    distance = len(one) + len(two) - 2 * common
    return 1.0 - distance / (len(one) + len(two))


def likeness(a: str, b: str) -> float:
    """0 (nothing in common, or no block size in common) to 1 (equal)."""
    if a == b:
        return 1.0
    (n, a1, a2), (m, b1, b2) = a.split(":"), b.split(":")
    if n == m:
        return max(_same_size(a1, b1), _same_size(a2, b2))
    if int(n) == 2 * int(m):
        return _same_size(a1, b2)
    if int(m) == 2 * int(n):
        return _same_size(a2, b1)
    return 0.0


def edited(text: str, following: str) -> str:
    """The last third of the code points gives way to as many of the beginning
    of the following text, or all of it."""
    third = len(text) // 3
    return text[:len(text) - third] + following[:third]


def add_fingerprint(docs: DataFrame, text: str = "text", name: str = "fingerprint") -> DataFrame:
    """``docs`` with the fingerprint of a text column; null texts are empty,
    a column of that name is replaced."""
    @F.pandas_udf("string")
    def prints(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t if isinstance(t, str) else "") for t in texts], dtype=object)

    return docs.withColumn(name, prints(F.col(text)))


_NEIGHBOURS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n_chars", T.LongType()),
    T.StructField("edited_sha256", T.StringType()), T.StructField("fingerprint", T.StringType()),
    T.StructField("edited_fingerprint", T.StringType()),
    T.StructField("near_edited", T.DoubleType()), T.StructField("near_next", T.DoubleType())])


def compare_neighbours(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", ranges: int | None = None,
) -> DataFrame:
    """Each document's fingerprint against that of its edited text and of the
    next document in descending order of the id; after the last comes the first.

    One shuffle of the texts. Each range of ids gets one more row, the first of
    the range that follows. Defined cases: a null text is empty; null ids come
    last; rows of one id stand in order of text, null before empty; a single
    row is its own next; an empty table gives an empty table; other columns are
    left out.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("_id"), F.col(text).alias("_text"))
    cuts = cut_points(rows, "_id", ranges)
    placed = rows.withColumn("_part", range_of(F.col("_id"), cuts))
    heads = [(r["_part"], r["_head"]) for r in
             placed.groupBy("_part").agg(F.max("_id").alias("_head")).collect()]
    heads.sort(reverse=True)
    follows = [(part, *heads[(i + 1) % len(heads)]) for i, (part, _) in enumerate(heads)]
    # One row for each range, whose number the session's partitions bound.
    wanted = docs.sparkSession.createDataFrame(follows, "_for int, _part int, _head long")
    first = (
        placed.join(F.broadcast(wanted.select("_part", F.col("_head").alias("_want"), "_for")), "_part")
        .where(F.col("_id").eqNullSafe(F.col("_want")))
        .groupBy("_for").agg(F.min(F.struct(F.col("_text").isNotNull(), F.col("_text"))).alias("_row"))
        .select(F.lit(None).cast("long").alias("_id"), F.col("_row._text").alias("_text"),
                F.col("_for").alias("_part"), F.lit(True).alias("_last")))
    both = placed.withColumn("_last", F.lit(False)).unionByName(first)
    ordered = in_ranges(both, "_part", F.asc("_last"), F.desc_nulls_last("_id"), F.asc("_text"))
    return ordered.select("_id", "_text", "_last").mapInArrow(_neighbours, _NEIGHBOURS)


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([
        ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
        ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
        ("near_edited", pa.float64()), ("near_next", pa.float64())])
    before = None
    for batch in batches:
        out = []
        columns = [batch.column(i) for i in range(3)]
        for i in range(batch.num_rows):
            key, text, last = (c[i].as_py() for c in columns)
            text = text or ""
            own = fingerprint(text)
            if before is not None:
                one, body, print_ = before
                changed = edited(body, text)
                other = fingerprint(changed)
                out.append((
                    one, len(body),
                    hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(),
                    print_, other, likeness(print_, other), likeness(print_, own)))
            # The row that closes a range is only looked at.
            before = None if last else (key, text, own)
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[j] for r in out], type=f.type) for j, f in enumerate(schema)], schema=schema)
