"""Compression of vectors to codes of a few bytes, by parts and codebooks.

A vector of integers is cut into equal parts, and each part is replaced by the
number of the nearest entry of its position's codebook. Nearest entries are
found in the Walsh-Hadamard domain: parts and entries are padded with zeros to
a power of two and transformed by sums and differences alone. The transform
keeps squared distances up to the factor ``width``, so squared differences of
coefficients are added up in sequency order (fewest sign changes first), and an
entry is out as soon as its sum is above the whole sum of another. All of it is
exact integer arithmetic.

Codebooks start as the parts of the vectors of smallest id and are moved a
fixed number of rounds to the floored means of their parts. A task sends one
count and sum for each entry; what the driver holds is the codebooks alone,
whose size is set by the parameters.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webfacts.llm.columns import free_names, group_key, small, staged

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
# Vectors of a batch that are compared at once: 64 of 8,192 long values are 4 MB.
_ROWS_AT_ONCE = 8192
# Beyond this, sums of squares could leave a long and Python's integers are used.
_SAFE = 1 << 61
OWN = ["code", "error", "label_error", "codebooks_sha256"]


def walsh_hadamard(rows: np.ndarray) -> np.ndarray:
    """Integer Walsh-Hadamard transform of each row, in sequency order.

    ``rows`` has a power of two of columns. Column ``s`` of the result belongs to
    the Walsh function of ``s`` sign changes. Squared lengths grow by the number
    of columns.
    """
    width = rows.shape[1]
    out = rows
    step = 1
    while step < width:
        pairs = out.reshape(len(rows), -1, 2, step)
        out = np.concatenate(
            [pairs[:, :, :1] + pairs[:, :, 1:], pairs[:, :, :1] - pairs[:, :, 1:]], axis=2,
        ).reshape(len(rows), width)
        step *= 2
    return out[:, sequency_order(width)]


def sequency_order(width: int) -> list[int]:
    """Where the plain transform holds the function of 0, 1, 2, ... sign changes:
    the bit-reversed Gray code."""
    bits = width.bit_length() - 1
    gray = [s ^ (s >> 1) for s in range(width)]
    return [int(format(g, f"0{bits}b")[::-1], 2) if bits else 0 for g in gray]


def padded_width(size: int) -> int:
    """The least power of two that holds ``size`` values."""
    return 1 << max(0, (size - 1).bit_length())


def _transformed(rows: np.ndarray) -> np.ndarray:
    width = padded_width(rows.shape[1])
    padded = np.zeros((len(rows), width), dtype=rows.dtype)
    padded[:, :rows.shape[1]] = rows
    return walsh_hadamard(padded)


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(index of the nearest entry, squared distance)`` of each row of
    ``parts``; ties go to the lower index."""
    if not parts.shape[1]:
        return np.zeros(len(parts), dtype=np.int64), np.zeros(len(parts), dtype=np.int64)
    at, book = _transformed(parts), _transformed(entries)
    width = at.shape[1]
    best = np.empty(len(at), dtype=np.int64)
    scaled = np.empty(len(at), dtype=at.dtype)
    for a in range(0, len(at), _ROWS_AT_ONCE):
        rows = at[a:a + _ROWS_AT_ONCE]
        first = (rows[:, :1] - book[:, 0]) ** 2
        # The entry that leads after one coefficient sets the bar for all others.
        lead = first.argmin(axis=1)
        bar = ((rows - book[lead]) ** 2).sum(axis=1)
        row, entry = np.nonzero(first <= bar[:, None])
        total = first[row, entry]
        for s in range(1, width):
            total = total + (rows[row, s] - book[entry, s]) ** 2
            stays = total <= bar[row]
            row, entry, total = row[stays], entry[stays], total[stays]
        # Rows come in order, each with its entries in order: the first of the least.
        begins = np.searchsorted(row, np.arange(len(rows)))
        least = np.minimum.reduceat(total, begins)
        is_least = np.nonzero(total == least[row])[0]
        chosen = is_least[np.searchsorted(row[is_least], np.arange(len(rows)))]
        best[a:a + len(rows)] = entry[chosen]
        scaled[a:a + len(rows)] = least
    # The scale is a power of two and divides every scaled distance.
    return best, scaled // width


def whole_numbers(vector: Column, scale: int = SCALE) -> Column:
    """``floor(scale * x)`` of each component; null if the vector or any
    component is null or not finite."""
    x = vector.cast("array<double>")
    usable = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return F.when(usable, F.transform(x, lambda v: F.floor(v * scale).cast("long")))


@dataclass(frozen=True)
class Codebooks:
    """``entries[p, e]`` is entry ``e`` of part position ``p``."""

    entries: np.ndarray

    @property
    def parts(self) -> int:
        return self.entries.shape[0]

    @property
    def width(self) -> int:
        return self.entries.shape[2]

    def sha256(self) -> str:
        """Digest of all components in decimal, by part, entry and place."""
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def _matrix(column: pa.ChunkedArray | pa.Array, columns: int) -> np.ndarray:
    """Lists of long as rows, shorter ones followed by zeros."""
    whole = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = whole.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = whole.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(sizes), columns), dtype=np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _fitting(values: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as they are, or as Python's integers where a long might not hold the
    sums: a coefficient is at most the width times a component."""
    width = padded_width(entries.shape[2])
    most = max(int(np.abs(x, dtype=object).max()) if x.dtype == object else max(-int(x.min()), int(x.max()))
               for x in (values, entries) if x.size) if values.size or entries.size else 0
    if 4 * width ** 3 * most ** 2 < _SAFE:
        return values, entries
    return values.astype(object), entries.astype(object)


def assign(values: np.ndarray, books: Codebooks) -> tuple[np.ndarray, np.ndarray]:
    """``(codes, distances)`` by row and part position."""
    values, entries = _fitting(values, books.entries)
    codes = np.zeros((len(values), books.parts), dtype=np.int64)
    errors = np.zeros((len(values), books.parts), dtype=values.dtype)
    for p in range(books.parts):
        codes[:, p], errors[:, p] = nearest(
            values[:, p * books.width:(p + 1) * books.width], entries[p])
    return codes, errors


def first_codebooks(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES) -> Codebooks:
    """The parts of the ``entries`` vectors of smallest id; fewer rows give fewer entries."""
    longest = rows.agg(F.max(F.size("values"))).first()[0] or 0
    width = -(-longest // parts)
    seeds = rows.orderBy(F.col("vec_id").asc_nulls_last(), "values").limit(entries).collect()
    books = np.zeros((parts, len(seeds), width), dtype=np.int64)
    for e, r in enumerate(seeds):
        whole = np.zeros(parts * width, dtype=np.int64)
        whole[:len(r["values"])] = r["values"]
        books[:, e] = whole.reshape(parts, width)
    return Codebooks(books)


def moved(rows: DataFrame, books: Codebooks) -> Codebooks:
    """Each entry at the floored mean of the parts that are nearest to it;
    entries without parts stay."""
    parts, n, width = books.entries.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros((parts, n), dtype=np.int64)
        total = np.zeros((parts, n, width), dtype=object)
        for batch in batches:
            values = _matrix(batch.column(0), parts * width)
            codes, _ = assign(values, books)
            for p in range(parts):
                own = codes[:, p]
                count[p] += np.bincount(own, minlength=n)
                order = np.argsort(own, kind="stable")
                used, begins = np.unique(own[order], return_index=True)
                part = values[order, p * width:(p + 1) * width]
                if len(used) and np.abs(part).max(initial=0) < _SAFE // (len(part) + 1):
                    total[p, used] += np.add.reduceat(part, begins, axis=0)
                else:
                    for e in used:
                        total[p, e] += part[own[order] == e].astype(object).sum(axis=0)
        p, e = np.nonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(p, pa.int32()), pa.array(e, pa.int32()), pa.array(count[p, e], pa.int64()),
             pa.array([[int(x) for x in t] for t in total[p, e]], pa.list_(pa.decimal128(38, 0)))],
            ["part", "entry", "n", "total"])

    schema = "part int, entry int, n long, total array<decimal(38,0)>"
    found = (
        rows.select("values").mapInArrow(sums, schema)
        .select("part", "entry", "n", F.posexplode("total").alias("place", "x"))
        .groupBy("part", "entry", "place").agg(F.sum("n").alias("n"), F.sum("x").alias("x")))
    entries = books.entries.copy()
    # At most parts * entries * width rows, whatever the table.
    for r in found.collect():
        entries[r["part"], r["entry"], r["place"]] = int(r["x"]) // r["n"]
    return Codebooks(entries)


def fit_codebooks(
    rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
) -> Codebooks:
    """Codebooks of ``(vec_id, values)`` rows after ``rounds`` rounds over all of them."""
    books = first_codebooks(rows, parts, entries)
    for _ in range(rounds if books.entries.size else 0):
        books = moved(rows, books)
    return books


def encode(rows: DataFrame, books: Codebooks) -> DataFrame:
    """``rows`` with ``code`` (two hexadecimal digits a part) and ``error``
    (squared distances of all parts); narrow, other columns are kept."""
    if books.entries.shape[1] > 256:
        raise ValueError("a code has two hexadecimal digits: at most 256 entries")
    fields = [f for f in rows.schema.fields if f.name != "values"]
    kept = [f.name for f in fields]
    length = books.parts * books.width

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            codes, errors = assign(_matrix(table["values"], length), books)
            digits = codes.astype(np.uint8).tobytes().hex()
            size = 2 * books.parts
            yield from (
                table.select(kept)
                .append_column("code", pa.array([digits[i:i + size] for i in range(0, len(digits), size)],
                                                pa.string()))
                .append_column("error", pa.array([int(x) for x in errors.sum(axis=1)], pa.int64()))
                .to_batches())

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    return rows.mapInArrow(run, f"{types}, code string, error long")


def compress(
    vectors: DataFrame, vector: str = "embedding", vec_id: str = "vec_id", label: str = "label",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
) -> DataFrame:
    """``vectors`` that are usable, without the vector and with ``code``,
    ``error``, ``label_error`` (errors summed over equal labels) and
    ``codebooks_sha256``.

    Defined cases: a vector that is null or holds a null or non-finite component
    is left out; vectors are followed by zeros up to the longest one, and that up
    to a multiple of ``parts``; fewer than ``entries`` vectors give as many
    entries as there are; rows that repeat an id are rows of their own, and the
    smaller vector comes first among the seeds; a null id is last; null labels
    are one label; an empty table gives an empty table; input columns called as
    one of the new columns are replaced. A scaled component must fit a long, and
    so must the errors summed over a label, or the job fails.
    """
    kept = free_names(vectors, [*OWN, "values", vector])
    values = staged(
        vectors.select(*[F.col(f"`{c}`") for c in kept], whole_numbers(F.col(vector), scale).alias("values"))
        .where(F.col("values").isNotNull()).withColumnRenamed(vec_id, "vec_id"))
    books = fit_codebooks(values.select("vec_id", "values"), parts, entries, rounds)
    coded = staged(encode(values, books).withColumnRenamed("vec_id", vec_id))
    key = group_key(F.col(label))
    sums = small(coded.groupBy(key.alias("_label")).agg(F.sum("error").alias("label_error")))
    return (
        coded.withColumn("_label", key).join(sums, "_label")
        .withColumn("codebooks_sha256", F.lit(books.sha256()))
        .select(*[F.col(f"`{c}`") for c in kept], *OWN))
