"""Substring dedup over word windows, with a count-min prefilter.

A word is removed if it lies in a window of ``WINDOW`` words that also starts
in a document with a smaller id.  Documents are dealt to blocks by one
shuffle, and the windows of a block are reduced to the distinct ones first,
so a thousand copies cost a block no more than one.

*First pass.*  Every block sketches its windows: ``DEPTH`` rows of cells, cut
into shards by the window's hash so that the whole sketch grows with the
corpus and no task holds more than a shard.  Blocks send the cells they touch
(packed, sorted); a shard adds them up and answers each block with one bit
per cell: touched by another block as well, or not.  Two windows may share a
cell, so this overestimates and never misses a repeated one.

*Second pass.*  Only windows all of whose cells were answered yes are grouped
exactly, by 128 bits of hash, across blocks; each block learns whether a
smaller id has the window elsewhere.  What repeats inside a block it sees
itself.  The last step marks and drops the words.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import partitions

WINDOW = 13
#: Characters of a block, about: it is what one task holds at a time.
BLOCK_CHARS = 8_000_000
DEPTH, CELL_BITS = 2, 22
CELLS = 1 << CELL_BITS
NO_ID = np.iinfo(np.int64).max
FACTORS = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
MIXERS = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)

MESSAGE = "shard int, block int, kind int, a binary, b binary"
RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string"


class Block:
    """The windows of a block of documents, which are taken in order of id."""

    def __init__(self, table: pa.Table, window: int):
        ids = table.column("doc_id").to_pylist()
        texts = table.column("text").to_pylist()
        order = sorted(range(len(ids)), key=lambda k: NO_ID if ids[k] is None else ids[k])
        self.ids = [ids[k] for k in order]
        self.texts = [texts[k] or "" for k in order]
        digest = xxhash.xxh3_64_intdigest
        hashes = [np.fromiter(map(digest, w), np.uint64, len(w)) for t in self.texts for w in [t.encode().split()]]
        self.sizes = np.array([len(h) for h in hashes], np.int64)
        self.words = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        self.window = window
        owner = np.repeat(np.arange(len(hashes), dtype=np.int32), self.sizes)
        n = max(len(self.words) - window + 1, 0)
        whole = owner[:n] == owner[window - 1:window - 1 + n]
        self.starts = np.flatnonzero(whole)
        self.owner = owner[:n][whole]
        first, self.first, self.which = np.unique(self.rolled(0), return_index=True, return_inverse=True)
        #: The distinct windows' hashes, ascending; the smallest id that has each (documents are in order of id).
        self.hash = first
        numbers = np.array([NO_ID if x is None else x for x in self.ids], np.int64)
        self.number = numbers
        self.least = numbers[self.owner[self.first]] if len(first) else np.zeros(0, np.int64)

    def rolled(self, k: int) -> np.ndarray:
        """A polynomial in the window's word hashes, for every window."""
        n = max(len(self.words) - self.window + 1, 0)
        h = np.zeros(n, np.uint64)
        for at in range(self.window):
            h = h * np.uint64(FACTORS[k]) + self.words[at:at + n]
        return h[self.starts]

    def shards(self, count: int) -> list[tuple[int, slice]]:
        """Shards that the distinct windows fall into: equal ranges of the hash, so slices."""
        of = ((self.hash >> np.uint64(40)) * np.uint64(count)) >> np.uint64(24)
        edges = np.searchsorted(of, np.arange(count + 1, dtype=np.uint64))
        return [(s, slice(int(a), int(b))) for s, (a, b) in enumerate(zip(edges, edges[1:])) if b > a]


def cells_of(hashes: np.ndarray, row: int) -> np.ndarray:
    """The cell of each window in a row of its shard's sketch."""
    mixed = (hashes ^ (hashes >> np.uint64(29))) * np.uint64(MIXERS[row])
    return (mixed >> np.uint64(64 - CELL_BITS)).astype(np.uint32)


def pack(cells: np.ndarray) -> bytes:
    """Ascending cells: the low bits as they are, the high ones as a run-length bitmap."""
    low = 8 if len(cells) >= CELLS >> 10 else 16
    bits = np.zeros((CELLS >> low) + len(cells), np.uint8)
    bits[(cells >> np.uint32(low)) + np.arange(len(cells), dtype=np.uint32)] = 1
    return bytes([low]) + len(cells).to_bytes(4, "little") + (cells & np.uint32((1 << low) - 1)).astype(f"<u{low // 8}").tobytes() + np.packbits(bits).tobytes()


def unpack(data: bytes) -> np.ndarray:
    low, n = data[0], int.from_bytes(data[1:5], "little")
    end = 5 + n * low // 8
    rest = np.frombuffer(data, f"<u{low // 8}", n, 5).astype(np.uint32)
    high = np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8, offset=end)))[:n] - np.arange(n)
    return (high.astype(np.uint32) << np.uint32(low)) | rest


def messages(rows: list[tuple]) -> pa.Table:
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
    return pa.table({name: pa.array([r[k] for r in rows], kinds[k]) for k, name in enumerate(("shard", "block", "kind", "a", "b"))})


def sketch(block: Block, number: int, shards: int) -> list[tuple]:
    """For each shard the cells that the block's windows touch."""
    return [(s, number, 0, *(pack(np.sort(cells_of(block.hash[at], row))) for row in range(DEPTH))) for s, at in block.shards(shards)]


def merge(table: pa.Table) -> list[tuple]:
    """Adds up the sketches of a shard; for each block and row one bit a cell: whether two blocks or more touch it."""
    sent = [(s, b, (a, c)) for s, b, a, c in zip(*(table.column(x).to_pylist() for x in ("shard", "block", "a", "b")))]
    bits: list[list[bytes]] = [[] for _ in sent]
    for row in range(DEPTH):
        count = np.zeros(CELLS, np.uint8)
        for _, _, parts in sent:
            cells = unpack(parts[row])
            count[cells] = np.minimum(count[cells], 1) + 1
        for k, (_, _, parts) in enumerate(sent):
            bits[k].append(np.packbits(count[unpack(parts[row])] >= 2).tobytes())
    return [(s, b, 0, *bits[k]) for k, (s, b, _) in enumerate(sent)]


def answers(table: pa.Table, kind: int) -> dict[int, tuple[bytes, bytes]]:
    rows = zip(*(table.column(x).to_pylist() for x in ("shard", "kind", "a", "b")))
    return {s: (a, b) for s, k, a, b in rows if k == kind}


def estimated(block: Block, table: pa.Table, shards: int) -> np.ndarray:
    """Which distinct windows the sketch estimates to be in another block as well."""
    out = np.zeros(len(block.hash), bool)
    known = answers(table, 0)
    for s, at in block.shards(shards):
        size, yes = at.stop - at.start, np.ones(at.stop - at.start, bool)
        for row in range(DEPTH):
            order = np.argsort(cells_of(block.hash[at], row), kind="stable")
            bits = np.unpackbits(np.frombuffer(known[s][row], np.uint8))[:size].astype(bool)
            yes[order] &= bits
        out[at] = yes
    return out


def exact(block: Block, number: int, table: pa.Table, shards: int) -> list[tuple]:
    """For each shard the 128-bit hashes of the windows estimated repeated, and the block's smallest id of each."""
    likely = estimated(block, table, shards)
    second = block.rolled(1)[block.first] if likely.any() else None
    rows = []
    for s, at in block.shards(shards):
        pick = np.flatnonzero(likely[at]) + at.start
        if len(pick):
            rows.append((s, number, 1, np.concatenate([block.hash[pick], second[pick]]).tobytes(), block.least[pick].tobytes()))
    return rows


def group(table: pa.Table) -> list[tuple]:
    """Groups a shard's windows by their 128 bits; for each one sent, whether another block has a smaller id."""
    numbers, blocks = table.column("shard").to_pylist(), table.column("block").to_pylist()
    hashes = [np.frombuffer(x, np.uint64).reshape(2, -1) for x in table.column("a").to_pylist()]
    least = np.concatenate([np.frombuffer(x, np.int64) for x in table.column("b").to_pylist()])
    first, second = np.concatenate([h[0] for h in hashes]), np.concatenate([h[1] for h in hashes])
    order = np.lexsort((least, second, first))
    new = np.ones(len(order), bool)
    new[1:] = (first[order][1:] != first[order][:-1]) | (second[order][1:] != second[order][:-1])
    smallest = np.empty(len(order), np.int64)
    smallest[order] = least[order][np.flatnonzero(new)][np.cumsum(new) - 1]
    smaller, out, at = smallest < least, [], 0
    for s, b, h in zip(numbers, blocks, hashes):
        out.append((s, b, 1, np.packbits(smaller[at:at + h.shape[1]]).tobytes(), b""))
        at += h.shape[1]
    return out


def removed_words(block: Block, table: pa.Table, shards: int) -> np.ndarray:
    """Which words of the block lie in a window that a smaller id has as well."""
    elsewhere = np.zeros(len(block.hash), bool)
    likely, known = estimated(block, table, shards), answers(table, 1)
    for s, at in block.shards(shards):
        pick = np.flatnonzero(likely[at]) + at.start
        if len(pick):
            elsewhere[pick] = np.unpackbits(np.frombuffer(known[s][0], np.uint8))[:len(pick)].astype(bool)
    hit = elsewhere[block.which] | (block.number[block.owner] > block.least[block.which])
    edge = np.zeros(len(block.words) + 1, np.int32)
    np.add.at(edge, block.starts[hit], 1)
    np.add.at(edge, block.starts[hit] + block.window, -1)
    return np.cumsum(edge[:-1]) > 0


def kept(block: Block, removed: np.ndarray) -> pa.Table:
    n_removed, digests, at = [], [], 0
    for text, size in zip(block.texts, block.sizes.tolist()):
        gone = removed[at:at + size]
        words = text.encode().split()
        n = int(gone.sum())
        if n:
            words = [w for w, g in zip(words, gone.tolist()) if not g]
        n_removed.append(n)
        digests.append(hashlib.sha256(b" ".join(words)).hexdigest())
        at += size
    return pa.table({"doc_id": pa.array(block.ids, pa.int64()), "n_words": pa.array(block.sizes.tolist(), pa.int64()), "n_removed": pa.array(n_removed, pa.int64()), "kept_sha256": pa.array(digests, pa.string())})


def drop_repeated_substrings(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` for every document.

    Null and blank texts have no words; texts shorter than a window lose
    none.  A null id counts as larger than all others (so such rows never
    make another's words repeated).  Rows that share an id do not repeat each
    other; each gives a row.  An empty table gives none; other columns are
    not read.
    """
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    total = slim.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, math.ceil(total / block_chars))  # blocks, and as many shards
    parts = partitions(docs.sparkSession)
    dealt = slim.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(n)).cast("int")).repartition(parts, "block")

    def number(table: pa.Table) -> int:
        return table.column("block")[0].as_py()

    first = dealt.groupBy("block").applyInArrow(lambda t: messages(sketch(Block(t, window), number(t), n)), MESSAGE)
    seen = first.groupBy("shard").applyInArrow(lambda t: messages(merge(t)), MESSAGE)
    second = dealt.groupBy("block").cogroup(seen.groupBy("block")).applyInArrow(
        lambda t, told: messages(exact(Block(t, window), number(t), told, n) if t.num_rows and told.num_rows else []), MESSAGE)
    grouped = second.groupBy("shard").applyInArrow(lambda t: messages(group(t)), MESSAGE)

    def finish(t: pa.Table, told: pa.Table) -> pa.Table:
        block = Block(t, window)
        return kept(block, removed_words(block, told, n))

    return dealt.groupBy("block").cogroup(seen.unionByName(grouped).groupBy("block")).applyInArrow(finish, RESULT)


def oracle_sql(window: int = WINDOW) -> str:
    """DuckDB SQL for ``drop_repeated_substrings`` over the documents table."""
    return f"""
    with w as (select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[ \\t-\\r]+'), lambda x: x <> '') as ws from documents),
    win as (select doc_id, i, array_to_string(ws[i:i + {window - 1}], ' ') as seq from (
        select doc_id, ws, unnest(range(1, len(ws) - {window - 2})) as i from w where len(ws) >= {window})),
    least as (select seq, min(doc_id) as m from win group by 1),
    gone as (select distinct doc_id, j from (select doc_id, unnest(range(i, i + {window})) as j from win join least using (seq) where doc_id > m)),
    tok as (select doc_id, unnest(ws) as word, unnest(range(1, len(ws) + 1)) as j from w),
    kept as (select t.doc_id, string_agg(word, ' ' order by j) as k from tok t anti join gone g on t.doc_id = g.doc_id and t.j = g.j group by 1),
    n as (select doc_id, count(*) as n_removed from gone group by 1)
    select doc_id, len(ws)::bigint as n_words, coalesce(n_removed, 0)::bigint as n_removed, sha256(coalesce(k, '')) as kept_sha256
    from w left join kept using (doc_id) left join n using (doc_id)
    """
