"""Document fingerprints by content-defined chunking.

A gear hash runs over the UTF-8 bytes of a text; bits above the top drop
out, so each value depends on the 32 bytes before it alone and boundaries
move with the text.  Chunking is normalised: before the usual size a
boundary needs a strict mask, behind it a lax one, between a least and a
largest size.  The fingerprint is the set of chunk digests, each with its
length; likeness is the share of a text's (distinct) chunk bytes that the
other text also has.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import partitions
from mercato.plans.ranges import range_bucket

#: Bytes of a chunk: least, usual, largest.
LEAST, USUAL, LARGEST = 24, 64, 256
STRICT, LAX = np.uint32(0xFE000000), np.uint32(0xF0000000)
#: Bytes hashed at once.
BLOCK = 1 << 20
GEAR = np.array([xxhash.xxh32_intdigest(bytes([b]), 2024) for b in range(256)], dtype=np.uint32)

RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """For every byte the gear hash behind it: the last 32 table values, each shifted by its age."""
    h = GEAR[data]
    for step in (1, 2, 4, 8, 16):
        if len(h) > step:
            older = h[:-step] << np.uint32(step)
            h = h.copy()
            h[step:] += older
    return h


def candidates(data: bytes) -> tuple[list[int], list[bool]]:
    """Ends of possible chunks, and whether the strict mask allows each."""
    ends, strict = [], []
    raw = np.frombuffer(data, np.uint8)
    for at in range(0, len(raw), BLOCK):
        back = min(at, 31)
        h = gear_hashes(raw[at - back:at + BLOCK])[back:]
        found = np.flatnonzero((h & LAX) == 0)
        ends += (found + (at + 1)).tolist()
        strict += ((h[found] & STRICT) == 0).tolist()
    return ends, strict


def chunks(data: bytes) -> Iterator[tuple[int, int]]:
    start, n = 0, len(data)
    for end, strict in zip(*candidates(data)):
        while end - start > LARGEST:
            yield start, start + LARGEST
            start += LARGEST
        size = end - start
        if size >= LEAST and (strict or size >= USUAL):
            yield start, end
            start = end
    while n - start > LARGEST:
        yield start, start + LARGEST
        start += LARGEST
    if start < n:
        yield start, n


def fingerprint(text: str | None) -> dict[int, int]:
    """Digest and length of each distinct chunk; an empty text has none."""
    data = (text or "").encode()
    view = memoryview(data)
    return {xxhash.xxh64_intdigest(view[a:b]): b - a for a, b in chunks(data)}


def shown(chunks_of: dict[int, int]) -> str:
    """The set as text: 16 hex digits of digest and 3 of length for each chunk, ascending."""
    return "".join([f"{d:016x}{n:03x}" for d, n in sorted(chunks_of.items())])


def parse(fingerprint: str) -> dict[int, int]:
    return {int(fingerprint[k:k + 16], 16): int(fingerprint[k + 16:k + 19], 16) for k in range(0, len(fingerprint), 19)}


def containment(a: dict[int, int], b: dict[int, int]) -> float:
    """Share of a's chunk bytes that b has as well; 1 for equal sets, so for two empty ones."""
    if a == b:
        return 1.0
    total = sum(a.values())
    return sum([n for d, n in a.items() if d in b]) / total if total else 0.0


def edited_text(text: str, following: str) -> str:
    """The last quarter of the code points replaced by the first as many of the following text."""
    k = len(text) // 4
    return text[:len(text) - k] + following[:k]


def fingerprint_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints every whole text and its edited version, and compares it with the next document.

    Documents are put in order of id by one range shuffle; the first document
    of each range is also sent to the range before (the first of all to the
    last), so every row meets its successor inside one task, which reads its
    rows in order and holds two at a time.  The ranges are cut at ids that
    occur, from one aggregate of bounded size.

    Null text: the empty text, with no chunks.  A null id sorts first.  Rows
    that share an id are ordered by text.  A single row is its own successor;
    an empty table gives no rows.  Other columns are not read.
    """
    n = partitions(docs.sparkSession)
    key = F.coalesce(F.col("doc_id"), F.lit(-(1 << 63)))
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    marks = slim.select(key.alias("k")).agg(F.min("k").alias("first"), F.percentile_approx("k", [i / n for i in range(1, n)] or [0.5], 20 * n + 1000).alias("at")).first()
    first = marks["first"]
    splits = sorted({s for s in marks["at"] or [] if s > first})
    bucket = range_bucket(key, [F.lit(s).cast("long") for s in splits])
    heads = F.array(*[F.lit(s).cast("long") for s in splits]) if splits else F.array().cast("array<long>")
    guest = F.when(key == F.lit(first), F.lit(len(splits))).when(F.array_contains(heads, key), F.col("bucket") - 1)
    placed = slim.withColumn("bucket", bucket)
    rows = (placed.withColumn("to", F.explode(F.array_compact(F.array(
                F.struct(F.col("bucket").alias("part"), F.lit(0).alias("guest")),
                F.when(guest.isNotNull(), F.struct(guest.alias("part"), F.lit(1).alias("guest")))))))
            .select("doc_id", "text", "to.part", "to.guest")
            .repartitionById(len(splits) + 1, F.col("part"))
            .sortWithinPartitions("part", "guest", F.col("doc_id").asc_nulls_first(), "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the row whose successor is awaited: id, text, part, fingerprint
        for batch in batches:
            out: list[tuple] = []
            for doc_id, text, part, is_guest in zip(*(batch.column(k) for k in range(4))):
                doc_id, text, part, is_guest = doc_id.as_py(), text.as_py(), part.as_py(), is_guest.as_py()
                own = fingerprint(text)
                if held is not None and held[2] == part:
                    edited = edited_text(held[1], text)
                    marks = fingerprint(edited)
                    out.append((held[0], len(held[1]), hashlib.sha256(edited.encode()).hexdigest(), shown(held[3]), shown(marks), containment(held[3], marks), containment(held[3], own)))
                held = None if is_guest else (doc_id, text, part, own)
            names = [f.split()[0] for f in RESULT.split(", ")]
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], kinds[k]) for k in range(7)], names=names)

    return rows.mapInArrow(run, RESULT)
