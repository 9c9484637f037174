"""Packing token rows into sequences by Karmarkar-Karp multiway differencing.

Full windows of a document are sequences of their own; what is left of each
document is cut into pieces of ``PIECE`` tokens, as whole rests of up to a window
cannot be balanced closely. Pieces of a batch are dealt to windows by differencing:
every piece starts as a partial partition, and the two partitions of the largest
imbalance are merged with their sums opposed, the largest of one with the
smallest of the other, until one is left. Its windows have near-equal sums. The
number of windows starts at the least that could hold the tokens and rises while
a window is over capacity.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from webfacts.llm.tokens import CACHE_WORDS, encoder

CAPACITY = 2048
# Pieces that are balanced together; a documented size, every piece is in one batch.
BATCH = 1024
PIECE = 512
_TEXTS_AT_ONCE = 256
# Encoded together, as each distinct word among them is looked up once.
_ENCODED_AT_ONCE = 1024


def differencing(sizes: list[int], windows: int) -> list[list[int]]:
    """Items of each window, by index; the Karmarkar-Karp multiway heuristic.

    A partition is kept as its sums above zero in descending order, with a tree
    of the merges for each; windows not listed are empty.
    """
    # Nodes of the trees: below len(sizes) an item, above it a merge of two.
    merges: list[tuple[int, int]] = []
    heap = [(-size, i, (np.array([size]), np.array([i]))) for i, size in enumerate(sizes)]
    heapq.heapify(heap)
    serial = len(sizes)
    while len(heap) > 1:
        (one, one_at), (two, two_at) = heapq.heappop(heap)[2], heapq.heappop(heap)[2]
        if len(one) < len(two):
            one, one_at, two, two_at = two, two_at, one, one_at
        # With empty windows filling up, the largest sums meet nothing; only so
        # many of the smallest of both have to share a window.
        shared = max(0, len(one) + len(two) - windows)
        alone, rest = len(one) - shared, len(two) - shared
        sums = np.concatenate([one[:alone], one[alone:] + two[rest:][::-1], two[:rest]])
        made = np.arange(shared) + len(sizes) + len(merges)
        merges.extend(zip(one_at[alone:].tolist(), two_at[rest:][::-1].tolist()))
        nodes = np.concatenate([one_at[:alone], made, two_at[:rest]])
        order = np.argsort(-sums, kind="stable")
        sums, nodes = sums[order], nodes[order]
        spread = sums[0] - (sums[-1] if len(sums) == windows else 0)
        heapq.heappush(heap, (-int(spread), serial, (sums, nodes)))
        serial += 1
    out = []
    for root in (heap[0][2][1].tolist() if heap else []):
        items, todo = [], [root]
        while todo:
            node = todo.pop()
            if node < len(sizes):
                items.append(node)
            else:
                todo.extend(merges[node - len(sizes)])
        out.append(sorted(items))
    return out


def near_equal_windows(sizes: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Windows within capacity; their number rises whenever it is exceeded."""
    windows = max(1, -(-sum(sizes) // capacity))
    while sizes:
        found = differencing(sizes, windows)
        most = max(sum(sizes[i] for i in w) for w in found)
        if most <= capacity:
            return found
        # A small part of what is over, so that few windows too many are opened.
        windows += max(1, int(windows * (most / capacity - 1) / 5))
    return []


def pack(
    docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = CAPACITY,
    text: str = "text", doc_id: str = "doc_id", batch: int = BATCH, piece: int = PIECE,
    keep_ids: bool = False, keep_words: int = 0,
) -> DataFrame:
    """One row per piece: ``(doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset)`` and, if asked for, ``ids`` (little-endian unsigned
    32-bit).

    ``tokenizer`` is the file of a byte-level vocabulary on every machine. Each
    task packs the rows it reads, without a shuffle; sequence numbers begin with
    the task's partition, so a task that runs again gives the same rows. Defined
    cases: a null or empty text is its end id alone; null ids stay null;
    repeated rows are packed each; an empty table gives an empty table; other
    columns are left out. A worker keeps up to ``keep_words`` words with their ids
    for its next task (some 200 bytes each), so that they are encoded once; with 0 none.
    """
    names = ["doc_id long", "start long", "length long", "ids_crc32 long", "doc_tokens long",
             "sequence_id long", "offset long"] + ["ids binary"] * keep_ids
    schema = pa.schema(
        [(n.split()[0], pa.binary() if n.endswith("binary") else pa.int64()) for n in names])
    end = int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with encoder(tokenizer, True, keep_words > 0, keep_words or CACHE_WORDS) as words:
            yield from packed_pieces(batches, words.encode)

    def encoded_texts(batches: Iterator[pa.RecordBatch], encode: Callable) -> Iterator[tuple[list, list[bytes]]]:
        for arrow in batches:
            for at in range(0, arrow.num_rows, _ENCODED_AT_ONCE):
                some = arrow.slice(at, _ENCODED_AT_ONCE)
                yield some.column(0).to_pylist(), encode([t or "" for t in some.column(1).to_pylist()])

    def packed_pieces(batches: Iterator[pa.RecordBatch], encode: Callable) -> Iterator[pa.RecordBatch]:
        sequence = TaskContext.get().partitionId() << 33
        pieces: list[tuple] = []

        def rows(items: list[tuple], sequences: list[tuple[int, int]]) -> pa.RecordBatch:
            columns = [*zip(*[
                (key, start, len(ids) // 4, zlib.crc32(ids), total, number, offset, ids)
                for (key, start, ids, total), (number, offset) in zip(items, sequences)])]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema)

        def packed() -> pa.RecordBatch:
            nonlocal sequence, pieces
            places: list = [None] * len(pieces)
            sizes = [len(p[2]) // 4 for p in pieces]
            for window in near_equal_windows(sizes, capacity):
                offset = 0
                for i in window:
                    places[i] = (sequence, offset)
                    offset += sizes[i]
                sequence += 1
            out, pieces = rows(pieces, places), []
            return out

        for keys, encoded in encoded_texts(batches, encode):
            for at in range(0, len(keys), _TEXTS_AT_ONCE):
                full: list[tuple] = []
                for key, ids in zip(keys[at:at + _TEXTS_AT_ONCE], encoded[at:at + _TEXTS_AT_ONCE]):
                    ids += end
                    total = len(ids) // 4
                    rest = total - total % capacity
                    for start in range(0, rest, capacity):
                        full.append((key, start, ids[4 * start:4 * (start + capacity)], total))
                    for start in range(rest, total, piece):
                        pieces.append((key, start, ids[4 * start:4 * (start + piece)], total))
                if full:
                    yield rows(full, [(sequence + i, 0) for i in range(len(full))])
                    sequence += len(full)
                if len(pieces) >= batch:
                    yield packed()
        if pieces:
            yield packed()

    return docs.select(f"`{doc_id}`", f"`{text}`").mapInArrow(run, ", ".join(names))
