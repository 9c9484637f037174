"""Token files compressed by Re-Pair grammars.

The ids of the documents, in the order of their doc_id, are written in shards.
Each shard is compressed by itself: the most frequent pairs of neighbouring
symbols are replaced by new symbols, round after round, and the rules are
stored beside the sequence with the number of ids every new symbol stands for.
Pairs never reach over the end of a document, so any document, and by the
expansion lengths any span of one, is decoded without the rest of its shard.

A shard is one row of the files (Parquet, in any folder Spark can write):

    part, shard          place in the order
    before               ids of the part before the shard
    doc_ids, n_tokens    documents of the shard and their numbers of ids
    symbols              symbols of each document in ``sequence``
    rules                pairs of symbols, little-endian unsigned 32-bit
    lengths              ids behind each new symbol, in the same form
    sequence, width      the symbols, ``width`` bytes each
    first_new            number of the first new symbol
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from webfacts.llm.columns import small
from webfacts.llm.ranges import cut_points, in_ranges, range_of
from webfacts.llm.tokens import encoder

SHARD_TOKENS = 1 << 19
# The grammar grows while pairs occur this often, so many new symbols a round.
LEAST_COUNT = 24
PAIRS_PER_ROUND = 4000
# Encoded together, as each distinct word among them is looked up once.
_TEXTS_AT_ONCE = 4096
_BUCKET_BITS = 19

FILE_SCHEMA = (
    "part int, shard int, before long, doc_ids array<long>, n_tokens array<long>, "
    "symbols array<long>, rules binary, lengths binary, sequence binary, width int, first_new long")


def _ranks(
    sequence: np.ndarray, may: np.ndarray, kind: np.ndarray, least: int, most: int,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The most frequent pairs, best first, as ``left << 32 | right``, places in
    ascending order and the rank of the pair that begins at each: ``most`` for
    frequent pairs beyond the best, more for rare ones. Pairs at places that
    ``may`` leaves out, and at those not returned, are rare.

    Exact: one kind of each hash bucket is counted by bucket, and the other
    kinds of the buckets that are full enough are sorted.
    """
    at = np.flatnonzero(may)
    left, right = sequence[at], sequence[at + 1]
    bits = min(_BUCKET_BITS, max(8, len(at).bit_length()))
    buckets = 1 << bits
    bucket = ((left * np.uint32(0x9E3779B1)) ^ (right * np.uint32(0x85EBCA77))) >> np.uint32(32 - bits)
    heavy = np.flatnonzero((np.bincount(bucket, minlength=buckets) >= least)[bucket])
    at, bucket = at[heavy], bucket[heavy]
    pairs = (left[heavy].astype(np.uint64) << np.uint64(32)) | right[heavy]
    kind[bucket] = pairs
    own = kind[bucket] == pairs
    counts = np.bincount(bucket[own], minlength=buckets)
    often = np.flatnonzero(counts >= least)
    others, which, sums = np.unique(pairs[~own], return_inverse=True, return_counts=True)
    rare = np.flatnonzero(sums >= least)
    kinds = np.concatenate([kind[often], others[rare]])
    best = np.argsort(-np.concatenate([counts[often], sums[rare]]), kind="stable")[:most]
    order = np.full(len(often) + len(rare), most, dtype=np.int32)
    order[best] = np.arange(len(best), dtype=np.int32)
    by_bucket = np.full(buckets, most + 1, dtype=np.int32)
    by_bucket[often] = order[:len(often)]
    by_other = np.full(len(others), most + 1, dtype=np.int32)
    by_other[rare] = order[len(often):]
    rank = by_bucket[bucket]
    rank[~own] = by_other[which]
    return kinds[best], at, rank


def compress(
    ids: np.ndarray, sizes: np.ndarray, first_new: int, least: int = LEAST_COUNT,
    per_round: int = PAIRS_PER_ROUND,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(sequence, symbols per document, rules)`` of documents of ``sizes`` ids.

    Rounds go on until no pair occurs ``least`` times or none can be replaced
    twice. After the first, a round counts pairs with a symbol of the round before and
    those that were frequent then, as no other pair can have become frequent. In a round, places where chosen pairs overlap go to the more frequent
    pair, and among equals, as in a row of one id, to every other one from the left.
    """
    sequence = ids.astype(np.uint32)
    closes = np.zeros(len(sequence), dtype=bool)
    closes[np.cumsum(sizes) - 1] = True
    rules: list[np.ndarray] = []
    known = 0
    kind = np.zeros(1 << _BUCKET_BITS, dtype=np.uint64)
    may = ~closes[:-1]
    while len(sequence) >= 2:
        chosen, at, here = _ranks(sequence, may, kind, least, per_round)
        if not len(chosen):
            break
        # Places in a row of one rank are counted from the first that is free.
        some, rank = at[here < per_round], here[here < per_round]
        still = np.zeros(len(sequence), dtype=bool)
        still[at[here <= per_round]] = True
        follows = np.diff(some, prepend=-2) == 1
        ahead = np.where(follows, np.roll(rank, 1), per_round)
        behind = np.where(np.append(follows[1:], False), np.roll(rank, -1), per_round)
        equal = ahead == rank
        free = (rank <= ahead) & (rank <= behind)
        if equal.any():
            free |= equal & (rank <= behind)
            begins = np.flatnonzero(~equal)
            nth = np.arange(len(some)) - np.repeat(begins, np.diff(np.append(begins, len(some))))
            late = np.repeat(ahead[begins] < rank[begins], np.diff(np.append(begins, len(some))))
            free &= (nth + late) % 2 == 0
        place, here = some[free], rank[free]
        used = np.bincount(here, minlength=len(chosen))
        worth = used >= 2
        kept = worth[here]
        place, here = place[kept], here[kept]
        if not len(place):
            break
        number = np.cumsum(worth) - 1
        rules.append(chosen[worth])
        sequence[place] = (first_new + known + number[here]).astype(np.uint32)
        known += int(worth.sum())
        closes[place] = closes[place + 1]
        keep = np.ones(len(sequence), dtype=bool)
        keep[place + 1] = False
        # Pairs with a new symbol; one place before the first would be the last.
        still[place] = still[place[place > 0] - 1] = True
        sequence, closes, still = sequence[keep], closes[keep], still[keep]
        may = still[:-1] & ~closes[:-1]
    flat = np.concatenate(rules) if rules else np.empty(0, dtype=np.uint64)
    pairs = np.column_stack([flat >> np.uint64(32), flat & np.uint64(0xFFFFFFFF)]).astype(np.uint32)
    return sequence, np.diff(np.flatnonzero(closes), prepend=-1), pairs


def expansion_lengths(rules: np.ndarray, first_new: int) -> np.ndarray:
    """Ids behind each new symbol; a rule refers to earlier ones only."""
    lengths: list[int] = []
    for left, right in rules.tolist():
        lengths.append((lengths[left - first_new] if left >= first_new else 1)
                       + (lengths[right - first_new] if right >= first_new else 1))
    return np.asarray(lengths, dtype=np.uint32)


def expand(symbols: np.ndarray, rules: np.ndarray, first_new: int) -> np.ndarray:
    """The ids a row of symbols stands for."""
    symbols = symbols.astype(np.int64)
    new = symbols >= first_new
    if not new.any():
        return symbols.astype(np.uint32)
    # The ids of each new symbol, one after the other; a rule refers to earlier ones.
    texts: list[list[int]] = []
    for left, right in rules[:int(symbols.max()) - first_new + 1].tolist():
        texts.append((texts[left - first_new] if left >= first_new else [left])
                     + (texts[right - first_new] if right >= first_new else [right]))
    sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    flat = np.fromiter(chain.from_iterable(texts), dtype=np.uint32, count=int(sizes.sum()))
    begins = np.cumsum(sizes) - sizes
    size = np.ones(len(symbols), dtype=np.int64)
    size[new] = sizes[symbols[new] - first_new]
    out = np.repeat(symbols.astype(np.uint32), size)
    # Where the ids of each new symbol lie in ``flat``, from where they go.
    many = size[new]
    source = np.repeat(begins[symbols[new] - first_new] - (np.cumsum(many) - many), many)
    source += np.arange(len(source))
    out[np.repeat(new, size)] = flat[source]
    return out


class Shard:
    """A shard of the files, for random access."""

    def __init__(self, rules: bytes, lengths: bytes, sequence: bytes, width: int, first_new: int,
                 symbols: np.ndarray):
        self.first_new = first_new
        self.rules = np.frombuffer(rules, dtype="<u4").reshape(-1, 2)
        self.lengths = np.frombuffer(lengths, dtype="<u4")
        self.sequence = np.frombuffer(sequence, dtype=f"<u{width}")
        self.ends = np.cumsum(symbols)

    def ids(self) -> np.ndarray:
        return expand(self.sequence, self.rules, self.first_new)

    def span(self, document: int, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop`` of one document; only symbols that reach
        into the span are expanded."""
        begin = self.ends[document - 1] if document else 0
        symbols = self.sequence[begin:self.ends[document]].astype(np.int64)
        size = np.ones(len(symbols), dtype=np.int64)
        new = symbols >= self.first_new
        size[new] = self.lengths[symbols[new] - self.first_new]
        ends = np.cumsum(size)
        first = int(np.searchsorted(ends, start, side="right"))
        last = int(np.searchsorted(ends, stop, side="left")) + 1
        skipped = int(ends[first - 1]) if first else 0
        some = expand(symbols[first:last], self.rules, self.first_new)
        return some[start - skipped:stop - skipped]


def write_shards(
    docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, vocabulary: int = 49408,
    text: str = "text", doc_id: str = "doc_id", shard_tokens: int = SHARD_TOKENS,
    ranges: int | None = None,
) -> None:
    """Encodes ``docs`` and writes them as shards below ``path``.

    Ids come from a word vocabulary of ``vocabulary`` ids, with ``end_id`` after
    each document. The texts are shuffled once, into ranges of the doc_id.
    Defined cases: a null or empty text is its end id alone; null ids come
    first; rows of one id stand in order of text, null before empty; a document
    longer than a shard is a shard of its own; an empty table writes no shard;
    other columns are left out.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("_id"), F.col(text).alias("_text"))
    placed = rows.withColumn("_part", range_of(F.col("_id"), cut_points(rows, "_id", ranges)))
    ordered = in_ranges(placed, "_part", F.asc_nulls_first("_id"), F.asc_nulls_first("_text"))
    end = int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with encoder(tokenizer, False, keep=True) as words:
            yield from shards(batches, words.encode)

    def shards(batches: Iterator[pa.RecordBatch], encode: Callable) -> Iterator[pa.RecordBatch]:
        part, shard, before = None, 0, 0
        keys: list = []
        ids: list[bytes] = []
        waiting = 0

        def closed() -> pa.RecordBatch:
            nonlocal keys, ids, waiting, shard, before
            sizes = np.array([len(i) // 4 for i in ids], dtype=np.int64)
            flat = np.frombuffer(b"".join(ids), dtype="<u4")
            sequence, symbols, rules = compress(flat, sizes, vocabulary)
            width = 2 if vocabulary + len(rules) <= 1 << 16 else 4
            row = (part, shard, before, keys, sizes.tolist(), symbols.tolist(),
                   rules.astype("<u4").tobytes(),
                   expansion_lengths(rules, vocabulary).astype("<u4").tobytes(),
                   sequence.astype(f"<u{width}").tobytes(), width, vocabulary)
            shard += 1
            before += int(sizes.sum())
            keys, ids, waiting = [], [], 0
            many = pa.list_(pa.int64())
            kinds = [pa.int32(), pa.int32(), pa.int64(), many, many, many,
                     pa.binary(), pa.binary(), pa.binary(), pa.int32(), pa.int64()]
            names = [f.split()[0] for f in FILE_SCHEMA.split(", ")]
            return pa.RecordBatch.from_arrays(
                [pa.array([v], type=k) for v, k in zip(row, kinds)], names=names)

        for arrow in batches:
            for at in range(0, arrow.num_rows, _TEXTS_AT_ONCE):
                some = arrow.slice(at, _TEXTS_AT_ONCE)
                texts = [t or "" for t in some.column(1).to_pylist()]
                for key, place, found in zip(
                        some.column(0).to_pylist(), some.column(2).to_pylist(), encode(texts)):
                    size = len(found) // 4 + 1
                    if keys and (place != part or waiting + size > shard_tokens):
                        yield closed()
                    if place != part:
                        part, shard, before = place, 0, 0
                    keys.append(key)
                    ids.append(found + end)
                    waiting += size
        if keys:
            yield closed()

    ordered.select("_id", "_text", "_part").mapInArrow(run, FILE_SCHEMA).write.parquet(path)


def read_shards(spark: SparkSession, path: str, keep_ids: bool = False) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document in the files
    and, if asked for, ``ids`` (little-endian unsigned 32-bit); ``start`` counts
    the ids of all documents before it."""
    shards = spark.read.schema(FILE_SCHEMA).parquet(path)
    parts = shards.groupBy("part").agg(
        F.sum(F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, n: a + n)).alias("_tokens"))
    # One row for each range; the session's partitions bound their number.
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = small(parts.select("part", F.coalesce(F.sum("_tokens").over(order), F.lit(0)).alias("_start")))
    placed = shards.join(starts, "part").select(
        (F.col("_start") + F.col("before")).alias("start"), "doc_ids", "n_tokens", "symbols",
        "rules", "lengths", "sequence", "width", "first_new")
    names = ["doc_id long", "start long", "n_tokens long", "ids_crc32 long"] + ["ids binary"] * keep_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                start, keys, sizes, symbols, rules, lengths, sequence, width, first = (
                    c[i].as_py() for c in batch.columns)
                ids = Shard(rules, lengths, sequence, width, first, np.array(symbols)).ids()
                raw = ids.astype("<u4").tobytes()
                ends = np.cumsum(sizes).tolist()
                begins = [0, *ends[:-1]]
                cut = [raw[4 * a:4 * b] for a, b in zip(begins, ends)]
                columns = [
                    pa.array(keys, pa.int64()), pa.array([start + b for b in begins], pa.int64()),
                    pa.array(sizes, pa.int64()), pa.array([zlib.crc32(c) for c in cut], pa.int64())]
                columns += [pa.array(cut, pa.binary())] * keep_ids
                yield pa.RecordBatch.from_arrays(columns, names=[n.split()[0] for n in names])

    return placed.mapInArrow(run, ", ".join(names))
