"""N-gram Jaccard join by prefix filters under several global orders.

A document is its set of word shingles. Two sets of similarity ``t`` share a
token in their prefixes of ``n - ceil(t n) + 1`` tokens under *any* order of all
tokens that both follow. Here three orders are used: by document frequency, and
twice by its magnitude with different hashes. Pairs come from the first order;
those that do not share a prefix token under the others as well are dropped
before sets are compared.

0. Of equal texts only the first is looked at; the others share its fate.
1. Documents are dealt into blocks. A block counts its tokens and sends them, one
   packed list for each range of tokens, to be counted over all blocks; what comes
   back to a block are the frequencies of its tokens that are not unique.
   A frequent token costs a range one entry per block, never one per document.
2. A document whose prefix has only unique tokens has no partner. Of all others,
   one for each distinct set, prefixes and sets are stored.
3. Every prefix token compares its documents with one central document of them.
   Links found merge documents into components, and documents of one component
   need not meet any more, so large groups of copies cost about their size.
   Rounds go on while they merge and much is left; then all documents of
   different components that still share a prefix token are compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webfacts.llm.columns import staged
from webfacts.llm.ranges import in_ranges, shuffle_partitions

# Characters of text that a block should hold.
BLOCK_CHARACTERS = 6_000_000
# Tokens are counted by their leading bits; tokens that agree there only look
# more frequent, alike in all documents, which no order minds.
_COUNTED_BITS = 40
_WORD_CACHE = 100_000
# Rows that are handed back together.
_ROWS_AT_ONCE = 500
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
ORDERS = 3
# Star rounds end when pairs left are within so many times the prefix tokens.
_FEW = 4


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Sets of word shingles as sorted 64-bit tokens.

    Words are runs without ASCII white space, A to Z in lower case. A text of
    fewer words than ``k`` is one shingle of them all; one without words has none.
    """

    def __init__(self, k: int):
        self.k = k
        self.words = _Words()
        seed = np.arange(1, k + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        self.factors = _mixed(seed) | np.uint64(1)

    def tokens(self, text: str | None) -> np.ndarray:
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        if not words:
            return np.empty(0, dtype=np.uint64)
        if len(self.words) > _WORD_CACHE:
            self.words.clear()
        hashed = np.fromiter(map(self.words.__getitem__, words), dtype=np.uint64, count=len(words))
        width = min(self.k, len(words))
        last = len(words) - width + 1
        # Texts of few words must not meet shingles of other widths.
        total = np.full(last, width, dtype=np.uint64)
        for i in range(width):
            total += hashed[i:i + last] * self.factors[i]
        return np.unique(_mixed(total))


def _packed(sorted_values: np.ndarray) -> tuple[int, bytes]:
    """The first of ascending numbers, then their differences in the fewest bytes
    that hold them all."""
    steps = np.diff(sorted_values)
    width = max(1, (int(steps.max(initial=0)).bit_length() + 7) // 8)
    packed = steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()
    return width, sorted_values[:1].astype("<u8").tobytes() + packed


def _unpacked(width: int, data: bytes) -> np.ndarray:
    steps = np.frombuffer(data, dtype=np.uint8, offset=8).reshape(-1, width)
    whole = np.zeros((len(steps) + 1, 8), dtype=np.uint8)
    whole[0] = np.frombuffer(data, dtype=np.uint8, count=8)
    whole[1:, :width] = steps
    return np.cumsum(whole.view("<u8").ravel(), dtype=np.uint64)


_LISTS = "_range long, _block long, width int, tokens binary, counts binary"
_LIST_FIELDS = [("_range", pa.int64()), ("_block", pa.int64()), ("width", pa.int32()),
                ("tokens", pa.binary()), ("counts", pa.binary())]


def _list_rows(rows: list[tuple]) -> pa.RecordBatch:
    schema = pa.schema(_LIST_FIELDS)
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


def _count_blocks(k: int, ranges: int):
    """Keys of copies, then texts, in order of their block to one list per block
    and range of tokens."""
    shift = np.uint64(64 - _COUNTED_BITS)

    def lists(block: int, sets: list[np.ndarray]) -> pa.RecordBatch:
        values, counts = np.unique(np.concatenate(sets), return_counts=True)
        where = (values * np.uint64(ranges)) >> np.uint64(_COUNTED_BITS)
        ends = np.flatnonzero(np.diff(where, append=np.uint64(ranges))) + 1
        rows, begin = [], 0
        for end in ends.tolist():
            rows.append((int(where[begin]), block, *_packed(values[begin:end]),
                         counts[begin:end].astype("<u4").tobytes()))
            begin = end
        return _list_rows(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(k)
        block, sets, copies = None, [], set()
        for batch in batches:
            for place, key, digest, copy, text in zip(
                    *(batch.column(i).to_pylist() for i in range(4)), batch.column(4)):
                if place != block:
                    if sets:
                        yield lists(block, sets)
                    block, sets, copies = place, [], set()
                if copy:
                    copies.add((key, digest))
                    continue
                if (key, digest) in copies:
                    continue
                found = shingler.tokens(text.as_py()) >> shift
                if len(found):
                    sets.append(found)
        if sets:
            yield lists(block, sets)

    return run


def _count_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lists in order of their range to lists of the tokens that occur again,
    with their frequency over all blocks, for each block that has them."""
    def shared(place: int, lists: list[tuple]) -> pa.RecordBatch | None:
        values = np.concatenate([v for _, v, _ in lists])
        counts = np.concatenate([c for _, _, c in lists]).astype(np.int64)
        owner = np.repeat(np.arange(len(lists)), [len(v) for _, v, _ in lists])
        kinds, which = np.unique(values, return_inverse=True)
        total = np.bincount(which, weights=counts, minlength=len(kinds)).astype(np.uint32)[which]
        again = total >= 2
        rows = []
        for i, (block, own, _) in enumerate(lists):
            begin = np.searchsorted(owner, i)
            hit = again[begin:begin + len(own)]
            if hit.any():
                rows.append((place, block, *_packed(own[hit]),
                             total[begin:begin + len(own)][hit].astype("<u4").tobytes()))
        return _list_rows(rows) if rows else None

    place, lists = None, []
    for batch in batches:
        for now, block, width, tokens, counts in zip(*(c.to_pylist() for c in batch.columns)):
            if now != place:
                if lists and (out := shared(place, lists)):
                    yield out
                place, lists = now, []
            lists.append((block, _unpacked(width, tokens), np.frombuffer(counts, dtype="<u4")))
    if lists and (out := shared(place, lists)):
        yield out


_SETS = ("doc_id long, digest binary, n_shingles long, node string, prefix array<long>, places array<int>, "
         "second array<long>, third array<long>, tokens array<long>")


def _prefixes(k: int, numerator: int, denominator: int):
    """Lists of a block and keys of copies, then its texts, to one row per text
    that is no copy, with what the join needs of it; prefixes are null where no
    partner is possible."""
    import xxhash

    shift = np.uint64(64 - _COUNTED_BITS)
    longs = pa.list_(pa.int64())
    schema = pa.schema([
        ("doc_id", pa.int64()), ("digest", pa.binary()), ("n_shingles", pa.int64()),
        ("node", pa.string()), ("prefix", longs),
        ("places", pa.list_(pa.int32())), ("second", longs), ("third", longs), ("tokens", longs)])

    def row(key: tuple, tokens: np.ndarray, known: np.ndarray, often: np.ndarray) -> tuple:
        n = len(tokens)
        if not n:
            return *key, 0, None, None, None, None, None, None
        node = xxhash.xxh3_128_hexdigest(tokens.tobytes())
        need = n + (-n * numerator) // denominator + 1
        df = np.ones(n, dtype=np.int64)
        if len(known):
            short = tokens >> shift
            at = np.minimum(np.searchsorted(known, short), len(known) - 1)
            hit = known[at] == short
            df[hit] = often[at[hit]]
        unique = int((df == 1).sum())
        if unique >= need:
            return *key, n, node, None, None, None, None, None
        # Unique tokens come first in every order, so only the others are sorted.
        rest, often_rest = tokens[df > 1], df[df > 1]
        magnitude = np.log2(often_rest).astype(np.int64)
        orders = [often_rest, magnitude, magnitude]
        taken = []
        for i, rank in enumerate(orders):
            tie = _mixed(rest + np.uint64((i + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
            taken.append(rest[np.lexsort((tie, rank))[:need - unique]].view(np.int64))
        places = np.arange(unique + 1, unique + 1 + len(taken[0]), dtype=np.int32)
        return *key, n, node, taken[0], places, taken[1], taken[2], tokens.view(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(k)
        block, parts, known, often, copies = None, [], None, None, set()
        def rows(out: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], f.type) for i, f in enumerate(schema)], schema=schema)

        out: list[tuple] = []
        for batch in batches:
            for place, key, digest, copy, text, width, tokens, counts in zip(
                    *(batch.column(i).to_pylist() for i in range(4)), batch.column(4),
                    batch.column(5).to_pylist(), batch.column(6), batch.column(7)):
                if place != block:
                    block, parts, known, copies = place, [], None, set()
                if width is not None:
                    parts.append((_unpacked(width, tokens.as_py()),
                                  np.frombuffer(counts.as_py(), dtype="<u4")))
                    continue
                if copy:
                    copies.add((key, digest))
                    continue
                if (key, digest) in copies:
                    continue
                if known is None:
                    known = np.concatenate([p[0] for p in parts] or [np.empty(0, np.uint64)])
                    often = np.concatenate([p[1] for p in parts] or [np.empty(0, np.uint32)])
                    order = np.argsort(known)
                    known, often, parts = known[order], often[order], []
                out.append(row((key, digest), shingler.tokens(text.as_py()), known, often))
                if len(out) >= _ROWS_AT_ONCE:
                    yield rows(out)
                    out = []
        if out:
            yield rows(out)

    return run


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for the nodes of ``links (a, b)``; the root is the
    smallest node reachable.

    Large-star and small-star steps in turn until nothing changes, which takes
    about the logarithm of the longest chain; every step is stored.
    """
    def pairs(df: DataFrame, a: Column, b: Column) -> DataFrame:
        return df.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v")

    edges = staged(pairs(links, F.col("a"), F.col("b")).distinct())
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = pairs(both.where("v > u").join(least, "u"), F.col("v"), F.col("m")).distinct()
        large = staged(large)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        edges = staged(
            pairs(large.join(least, "u"), F.col("v"), F.col("m"))
            .unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return (edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct())


def _verified(pairs: DataFrame, sets: DataFrame, numerator: int, denominator: int) -> DataFrame:
    """Pairs that share prefix tokens under the other orders too, and are
    similar."""
    def side(name: str, *columns: str) -> DataFrame:
        return sets.select(F.col("node").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in columns])

    near = (
        pairs.join(side("a", "second", "third"), "a").join(side("b", "second", "third"), "b")
        .where(F.arrays_overlap("second_a", "second_b") & F.arrays_overlap("third_a", "third_b"))
        .select("a", "b"))
    common = F.size(F.array_intersect("tokens_a", "tokens_b"))
    whole = F.size("tokens_a") + F.size("tokens_b") - common
    return (near.join(side("a", "tokens"), "a").join(side("b", "tokens"), "b")
            .where(common * denominator >= whole * numerator).select("a", "b"))


def _linked(sets: DataFrame, numerator: int, denominator: int) -> DataFrame:
    """``(node, root)`` of the distinct sets that are linked to others."""
    postings = staged(
        sets.select("node", "n_shingles", F.explode(F.arrays_zip("prefix", "places")).alias("_p"))
        .select(F.col("_p.prefix").alias("token"), "node", F.col("n_shingles").alias("n"),
                F.col("_p.places").alias("place")))
    roots: DataFrame | None = None
    entries = postings.count()
    merged, step = True, 0
    while True:
        held = postings.withColumn("root", F.col("node")) if roots is None else (
            postings.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")))
        groups = held.groupBy("token", "root").agg(F.count(F.lit(1)).cast("double").alias("rows"))
        mixed = staged(
            groups.groupBy("token").agg(
                F.sum("rows").alias("rows"), F.sum(F.col("rows") * F.col("rows")).alias("squares"),
                F.count(F.lit(1)).alias("roots")).where("roots > 1"))
        left_over = mixed.agg(F.sum(F.col("rows") * F.col("rows") - F.col("squares"))).first()[0] or 0
        held = staged(held.join(mixed.select("token"), "token", "left_semi"))
        if step and (left_over <= 2 * _FEW * entries or not merged):
            break
        # The document with the fewest rarer tokens is the one most like the
        # others; later steps take it from another component each.
        rank = F.struct("place", "node") if not step else F.struct(
            F.xxhash64("root", F.lit(step)), "place", "node")
        centre = held.groupBy("token").agg(F.min_by(F.struct("node", "root", "n"), rank).alias("c"))
        star = (
            held.join(centre, "token").where("root <> c.root")
            .where(_sizes(F.col("n"), F.col("c.n"), numerator, denominator))
            .select(F.greatest("node", "c.node").alias("a"), F.least("node", "c.node").alias("b"))
            .distinct())
        found = staged(_verified(star, sets, numerator, denominator))
        merged = found.limit(1).count() > 0
        step += 1
        if merged:
            roots = _merged(found, roots)
    left, right = held.alias("x"), held.alias("y")
    needed = F.ceil((F.col("x.n") + F.col("y.n")) * numerator / F.lit(numerator + denominator))
    reach = 1 + F.least(F.col("x.n") - F.col("x.place"), F.col("y.n") - F.col("y.place"))
    meeting = (
        left.join(right, F.col("x.token") == F.col("y.token"))
        .where((F.col("x.node") > F.col("y.node")) & (F.col("x.root") != F.col("y.root"))
               & _sizes(F.col("x.n"), F.col("y.n"), numerator, denominator) & (reach >= needed))
        .select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct())
    found = staged(_verified(meeting, sets, numerator, denominator))
    if found.limit(1).count():
        roots = _merged(found, roots)
    if roots is None:
        return sets.select("node", F.col("node").alias("root")).limit(0)
    return roots


def _sizes(n: Column, m: Column, numerator: int, denominator: int) -> Column:
    return F.least(n, m) * denominator >= F.greatest(n, m) * numerator


def _merged(links: DataFrame, roots: DataFrame | None) -> DataFrame:
    """Components after new links between members of earlier ones."""
    every = links
    if roots is not None:
        every = every.unionByName(roots.where("node <> root").select(
            F.col("node").alias("a"), F.col("root").alias("b")))
    return staged(components(every))


def join_shingles(
    docs: DataFrame, k: int = 5, similarity: tuple[int, int] = (80, 100), text: str = "text",
    doc_id: str = "doc_id", block_characters: int = BLOCK_CHARACTERS,
) -> DataFrame:
    """``(doc_id, n_shingles, component_id, n_copies, digest, component)``, one row
    per input row.

    Two documents link when the Jaccard similarity of their sets is at least
    ``similarity``, a fraction; ``component_id`` is the smallest doc_id that links
    lead to, itself included, ``n_copies`` the number of rows with the same set,
    ``digest`` the MD5 of the text and ``component`` a key of the component (null
    without shingles or id), which tells components apart where rows share ids.

    Defined cases: null and empty texts and texts without words have no shingle and link with
    nothing; a row without id has no part in any component and null for it;
    repeated rows, and rows of one id with different texts, count as documents
    of their own that share their id; an empty table gives an empty table; other
    columns are left out. Texts may be of any length.
    """
    numerator, denominator = similarity
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).select(
        "doc_id", "text", F.unhex(F.md5("text")).alias("digest"))
    spark = docs.sparkSession
    keys = staged(rows.select("doc_id", "digest", F.length("text").alias("size")))
    size = keys.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    blocks = max(shuffle_partitions(spark), -(-size // block_characters))
    block = F.pmod(F.xxhash64("doc_id", "digest"), F.lit(blocks)).cast("long")
    firsts = keys.where("doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("first_id"))
    copies = staged(keys.where("doc_id IS NOT NULL").select("doc_id", "digest").join(firsts, "digest")
                    .where("doc_id <> first_id"))
    nothing = lambda kind: F.lit(None).cast(kind)
    # Keys of copies come before the texts of their block.
    placed = rows.select(
        block.alias("_block"), "doc_id", "digest", F.lit(False).alias("copy"), "text").unionByName(
        copies.select(block.alias("_block"), "doc_id", "digest", F.lit(True).alias("copy"),
                      nothing("string").alias("text")))
    counted = in_ranges(placed, "_block", F.desc("copy"), partitions=blocks).mapInArrow(_count_blocks(k, blocks), _LISTS)
    frequent = staged(in_ranges(counted, "_range", partitions=blocks).mapInArrow(_count_ranges, _LISTS))
    both = (
        placed.select("*", nothing("int").alias("width"), nothing("binary").alias("tokens"),
                      nothing("binary").alias("counts"))
        .unionByName(frequent.select(
            "_block", nothing("long").alias("doc_id"), nothing("binary").alias("digest"),
            F.lit(True).alias("copy"), nothing("string").alias("text"), "width", "tokens", "counts")))
    # The lists of a block come before its texts as well.
    found = staged(in_ranges(both, "_block", F.desc("copy"), partitions=blocks).mapInArrow(
        _prefixes(k, numerator, denominator), _SETS))
    light = found.select("doc_id", "digest", "n_shingles", "node")
    shared = light.dropDuplicates(["doc_id", "digest"]).withColumnRenamed("doc_id", "first_id")
    names = ["doc_id", "digest", "n_shingles", "node"]
    every = staged(light.select(*names).unionByName(
        copies.join(shared, ["first_id", "digest"]).select(*names)))
    classes = staged(
        every.where("node IS NOT NULL AND doc_id IS NOT NULL").groupBy("node")
        .agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n_copies")))
    sets = staged(
        found.where("prefix IS NOT NULL").drop("digest")
        .join(classes.select("node", F.col("first_id").alias("doc_id")), ["node", "doc_id"], "left_semi")
        .dropDuplicates(["node"]))
    roots = _linked(sets, numerator, denominator)
    rooted = classes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = rooted.join(smallest, "root").select("node", "root", "component_id", "n_copies")
    return (
        every.join(named, "node", "left")
        .select(
            "doc_id", "n_shingles",
            F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
            F.coalesce(F.when(F.col("doc_id").isNotNull(), F.col("n_copies")), F.lit(1)).alias("n_copies"),
            "digest", F.when(F.col("doc_id").isNotNull(), F.col("root")).alias("component")))
