"""SimHash near-duplicates by anchor-point covering.

The 64 bits are cut into blocks with small thresholds: if two fingerprints
differ in at most t bits, they differ in at most the block's threshold in one
block (the thresholds plus one sum to t + 1).  The anchors of a block are
the words of a covering code of radius R: in a block with threshold 1 the
Hamming code over its first 15 bits next to all values of the rest (R = 1),
in a block with threshold 0 all values (R = 0).  A fingerprint is sent to
every anchor within R plus the threshold: one of two linked fingerprints has
an anchor within R, and the other then lies within R plus the threshold of
the same anchor, so every link meets at an anchor.  There the whole 64 bits
are compared.  An anchor with very many fingerprints is cut into tiles that
together hold every pair, none larger than ``HOT`` times two.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import partitions, stored
from mercato.llm.components import connected_components
from mercato.plans.ranges import attach_lookup

SHINGLE, MAX_BITS, SEED = 4, 4, 42
#: Fingerprints of an anchor that are compared in one piece.
HOT = 20_000
#: Rows of neighbouring anchors that are compared at once, and pairs.
ROWS, PAIRS = 200_000, 2_000_000


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Bits set in over half of the hashes of the shingles; no words: zero."""
    words = (text or "").encode().lower().split()  # of bytes: A-Z alone, and the six ASCII separators
    if not words:
        return 0
    size = min(shingle, len(words))
    joined = memoryview(b" ".join(words))
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
    ends = (starts + lengths)[size - 1:]
    starts = starts[:len(ends)]
    digest, counts = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for lo in range(0, len(starts), 1 << 15):
        hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts[lo:lo + (1 << 15)].tolist(), ends[lo:lo + (1 << 15)].tolist())], dtype="<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(counts * 2 > len(starts), bitorder="little")
    return int(bits.view("<u8")[0])


class Cover:
    """Blocks, thresholds and anchors for links of at most ``max_bits`` bits."""

    def __init__(self, max_bits: int = MAX_BITS):
        if not 0 <= max_bits < 64:
            raise ValueError("the threshold is a number of bits from 0 to 63")
        count = (max_bits + 2) // 2
        thresholds = [1] * count
        if (max_bits + 1) % 2:
            thresholds[-1] = 0
        share = [23 if t else 18 for t in thresholds]
        cuts = [round(64 * sum(share[:k]) / sum(share)) for k in range(count + 1)]
        self.blocks = [(a, b - a, t) for a, b, t in zip(cuts, cuts[1:], thresholds)]
        self.max_bits = max_bits

    @staticmethod
    def syndrome(values: np.ndarray, width: int) -> np.ndarray:
        """Of the Hamming code over the first 15 (7, 3, 1) bits: the xor of the places of set bits."""
        out = np.zeros(len(values), np.uint64)
        for k in range(Cover.coded(width)):
            out ^= np.where((values >> np.uint64(k)) & np.uint64(1), np.uint64(k + 1), np.uint64(0))
        return out

    @staticmethod
    def coded(width: int) -> int:
        return max(n for n in (0, 1, 3, 7, 15) if n <= width)

    def anchors(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in ``prints``, anchor) for every anchor within radius plus threshold."""
        places, found = [], []
        for number, (low, width, threshold) in enumerate(self.blocks):
            values = (prints >> np.uint64(low)) & np.uint64((1 << width) - 1)
            tag = np.uint64(number << 48) if width <= 48 else np.uint64(0)
            if not threshold:
                places.append(np.arange(len(prints)))
                found.append(values | tag)
                continue
            reach = 1 + threshold
            errors = np.array([sum(1 << b for b in c) for w in range(reach + 1) for c in combinations(range(width), w)], np.uint64)
            own, of = self.syndrome(values, width), self.syndrome(errors, width)
            for s in np.unique(own):
                at, moves = np.flatnonzero(own == s), errors[of == s]
                places.append(np.repeat(at, len(moves)))
                found.append((values[at][:, None] ^ moves[None, :]).ravel() | tag)
        return np.concatenate(places), np.concatenate(found)


def forest(pairs: tuple[np.ndarray, np.ndarray], size: int) -> np.ndarray:
    """For each of ``size`` nodes the smallest node it is connected with by the pairs."""
    label = np.arange(size)
    a, b = pairs
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def links_of_run(keys: np.ndarray, prints: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links inside the groups of equal neighbouring keys, as one link from each print to its component's first."""
    n = len(keys)
    parent = np.arange(n)
    at = np.arange(n - 1)
    at = at[keys[at] == keys[at + 1]]
    step, left, right, held = 1, [], [], 0
    edges = (keys[1:] != keys[:-1]).nonzero()[0] + 1
    bounds = np.concatenate([[0], edges, [n]])
    large = np.flatnonzero(np.diff(bounds) > 2000)
    skip = np.zeros(n, bool)
    for g in large:  # visit a large group breadth first; what is reached needs no further comparison
        lo, hi = int(bounds[g]), int(bounds[g + 1])
        skip[lo:hi] = True
        rest = np.arange(lo, hi)
        while len(rest):
            root, rest = rest[0], rest[1:]
            queue = [root]
            while queue and len(rest):
                near = np.bitwise_count(prints[rest] ^ prints[queue.pop()]) <= max_bits
                got, rest = rest[near], rest[~near]
                parent[got] = root
                queue += got.tolist()
    at = at[~skip[at]]
    while len(at):
        near = at[np.bitwise_count(prints[at] ^ prints[at + step]) <= max_bits]
        left.append(near)
        right.append(near + step)
        held += len(near)
        if held > PAIRS:
            label = forest((np.concatenate(left), np.concatenate(right)), n)
            left, right = [label], [np.arange(n)]
            held = 0
        step += 1
        at = at[at + step < n]
        at = at[keys[at] == keys[at + step]]
    if left:
        label = forest((np.concatenate(left), np.concatenate(right)), n)
        parent = np.minimum(parent, label)
    child = np.flatnonzero((parent != np.arange(n)) & (prints[parent] != prints))
    return prints[parent[child]], prints[child]


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, print`` (the 64 bits as a signed long) of every whole text, in one pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got)], names=["doc_id", "print"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "doc_id long, print long")


def links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links (a, b) that connect all of the distinct values of ``print`` that differ in at most ``max_bits`` bits."""
    cover = Cover(max_bits)
    n = partitions(prints.sparkSession)

    def replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 5_000):
                own = batch.column(0).to_numpy(zero_copy_only=False)[lo:lo + 5_000].view(np.uint64)
                place, anchor = cover.anchors(own)
                yield pa.RecordBatch.from_arrays([pa.array(anchor.view(np.int64)), pa.array(own[place].view(np.int64))], names=["anchor", "print"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, val = np.zeros((0, 2), np.int64), np.zeros(0, np.uint64)

        def linked(keys, values):
            same = np.concatenate([[0], np.cumsum((keys[1:] != keys[:-1]).any(axis=1))])
            a, b = links_of_run(same, values, max_bits)
            a, b = a.view(np.int64), b.view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            more = np.stack([batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False)], axis=1)
            key, val = np.concatenate([key, more]), np.concatenate([val, batch.column(2).to_numpy(zero_copy_only=False).view(np.uint64)])
            if len(key) >= ROWS:
                start = np.flatnonzero((key != key[-1]).any(axis=1))  # the last group may go on
                cut = int(start[-1]) + 1 if len(start) else 0
                if cut:
                    yield linked(key[:cut], val[:cut])
                    key, val = key[cut:].copy(), val[cut:].copy()
        if len(key):
            yield linked(key, val)

    # few bytes make many replicas: dealt out evenly, else the small table would be replicated by a few tasks
    replicas = prints.select("print").distinct().repartition(n).mapInArrow(replicate, "anchor long, print long")
    hot = replicas.groupBy("anchor").count().where(F.col("count") > HOT).select("anchor", F.ceil(F.col("count") / HOT).cast("int").alias("cuts"))
    tiled = attach_lookup(replicas, hot, ["anchor"], F.col("print"))
    row = F.pmod(F.xxhash64("print"), F.col("cuts")).cast("int")
    tiles = F.when(F.col("cuts").isNull(), F.array(F.lit(0))).otherwise(
        F.transform(F.sequence(F.lit(0), F.col("cuts") - 1), lambda k: F.least(k, row) * F.col("cuts") + F.greatest(k, row)))
    return (tiled.select("anchor", F.explode(tiles).alias("tile"), "print")
            .repartition(n, "anchor", "tile").sortWithinPartitions("anchor", "tile")
            .select("anchor", F.col("tile").cast("long").alias("tile"), "print")
            .mapInArrow(compare, "a long, b long").distinct())


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, print, component_id``: the smallest id reachable over links of at most ``max_bits`` bits.

    Null, empty and blank texts have fingerprint zero and are linked like any
    other; fewer words than a shingle are hashed as one.  Equal fingerprints
    are one class before any comparison, so exact copies cost nothing.  Rows
    with a null id are linked too but never name a component (null only if
    all its ids are null); repeated rows each give a row; an empty table
    gives none; other columns are not read.
    """
    return with_roots(docs, shingle, max_bits, id_col, text_col).drop("root")


def with_roots(docs: DataFrame, shingle: int, max_bits: int, id_col: str, text_col: str) -> DataFrame:
    """``near_duplicates`` with the fingerprint ``root`` that tells components apart (their ids may not: rows can share one)."""
    prints = stored(fingerprints(docs, shingle, id_col, text_col))
    roots = stored(connected_components(links(prints, max_bits)))
    classes = prints.groupBy("print").agg(F.min("doc_id").alias("first"))
    rooted = classes.join(roots.withColumnRenamed("node", "print"), "print", "left").withColumn("root", F.coalesce("root", "print"))
    names = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = stored(rooted.join(names, "root").select("print", "component_id", "root"))
    # a hot class is spread over salts; there is one row for each class on the other side
    return salted_join(prints, named, "print", "doc_id")


def salted_join(rows: DataFrame, table: DataFrame, key: str, salt_by: str, salts: int = 8) -> DataFrame:
    left = rows.withColumn("_salt", F.pmod(F.xxhash64(salt_by), F.lit(salts)).cast("int"))
    right = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, [key, "_salt"]).drop("_salt")


def keep_representatives(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with one row left of each component: that with the smallest id; all columns as they are.

    Of rows that share that id and its fingerprint the one with the smallest
    text stays (none first), of those with the same text the one with the
    smallest hash of all columns.  A component without any id keeps one of its
    rows, by its smallest fingerprint and then alike.
    """
    found = with_roots(docs, shingle, max_bits, id_col, text_col)
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "print")
    best = found.groupBy("root").agg(F.min(order).alias("best"))
    # plain keys, none of them null: what the join deals the whole rows by then serves the grouping too
    keys = lambda of: [F.coalesce(of, F.lit(0).cast("long")).alias("_keep_id"), of.isNull().alias("_keep_none")]
    keep = best.select(F.col("best.print").alias("_print"), *keys(F.col("best.doc_id")))
    at = docs.columns.index(text_col)
    base = docs.withColumn("_print", F.lit(0).cast("long"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(at)], np.uint64).view(np.int64)
            yield batch.set_column(batch.num_columns - 1, "_print", pa.array(got))

    printed = base.mapInArrow(run, base.schema)
    kept = printed.select("*", *keys(F.col(id_col).cast("long"))).join(keep, ["_print", "_keep_id", "_keep_none"])
    # rows that share an id are reduced in their tasks first
    tie = F.struct(F.col(text_col).cast("string"), F.xxhash64(*docs.columns))
    return kept.groupBy("_print", "_keep_id", "_keep_none").agg(F.min_by(F.struct(*docs.columns), tie).alias("_row")).select("_row.*")
