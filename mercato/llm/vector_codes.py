"""Vector code compression: product quantisation trained with adaptive distance bounds (Drake and Hamerly).

A vector's components become integers and are cut into parts; each part is
coded by the number of its nearest entry in that part position's codebook.
The first assignment measures every distance.  After it, each part keeps its
entry with an upper bound of its distance, its ``b`` next entries in order
with a lower bound each, and one lower bound for all other entries.  When the
entries move, bounds move by as much; a part is looked at again only if its
upper bound reaches its lowest lower bound, and then only at the entries whose
bounds its exact distance reaches.  Those are compared by exact integer
distances, so the codes are those of plain search, ties included.  From how
far parts had to look, ``b`` is set anew for the next round.

The bounds are persisted with the parts in the shared checkpoint folder each
round; what comes to the driver are the sums of each entry's parts.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.plans.lineage import materialize
from mercato.plans.ranges import attach_lookup

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Bounds kept at first and at least, as shares of the entries; share of the parts that may have to look further than b.
FIRST_SHARE, LEAST_SHARE, BEYOND = 4, 8, 0.05
#: Vectors of a batch; bounds the memory of a task.
BATCH = 1024


def largest(size: int) -> int:
    """Components are held to this magnitude: then no sum of ``size`` squared differences leaves 63 bits."""
    return 1 << ((62 - max(0, size - 1).bit_length()) // 2 - 1)


def usable(vectors: DataFrame, parts: int, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """``vec_id, label, v`` of the vectors without missing or infinite components that can be cut into equal parts."""
    v = F.col(vector_col).cast("array<double>")
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(math.inf)))
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), v.alias("v"))
    return rows.where(F.col("v").isNotNull() & (F.size("v") > 0) & (F.size("v") % parts == 0) & ~bad)


def whole(v: np.ndarray, scale: int) -> np.ndarray:
    """The integer components."""
    most = largest(v.shape[1])
    return np.clip(np.floor(v * float(scale)), -most, most).astype(np.int64)


def squared(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of each row of ``x`` (n, w) to each of ``entries`` (k, w)."""
    peak = max(int(np.abs(x).max(initial=0)), int(np.abs(entries).max(initial=0)))
    if 4 * x.shape[1] * peak * peak < 2**53:  # then every number on the way is an integer that a double holds
        f, e = x.astype(np.float64), entries.astype(np.float64)
        return ((f * f).sum(1)[:, None] - 2.0 * (f @ e.T) + (e * e).sum(1)[None, :]).astype(np.int64)
    out = np.zeros((len(x), len(entries)), np.int64)
    for k in range(x.shape[1]):
        out += np.square(x[:, k, None] - entries[None, :, k])
    return out


def below(x) -> np.ndarray:
    """Single precision, not above x."""
    x = np.asarray(x, np.float64)
    x = np.where(np.isinf(x), x, x - np.abs(np.where(np.isinf(x), 0.0, x)) * 1e-12 - 1e-12)
    y = x.astype(np.float32)
    return np.where(y > x, np.nextafter(y, np.float32(-np.inf)), y)


def above(x) -> np.ndarray:
    """Single precision, not below x."""
    return -below(-np.asarray(x, np.float64))


class Bounds:
    """The parts of a batch at one position: ``own`` entry and its upper bound, ``near`` entries and their lower bounds, ``outer`` bound."""

    def __init__(self, own, upper, near, lower, outer):
        self.own, self.upper, self.near, self.lower, self.outer = own, upper, near, lower, outer

    @staticmethod
    def measured(x: np.ndarray, entries: np.ndarray, b: int) -> Bounds:
        d = squared(x, entries)
        order = np.argsort(d, axis=1, kind="stable")[:, :b + 2]
        at = np.take_along_axis(d, order, 1)
        root = np.sqrt(at.astype(np.float64))
        outer = below(root[:, b + 1]) if order.shape[1] > b + 1 else np.full(len(x), np.inf, np.float32)
        return Bounds(order[:, 0].astype(np.uint8), above(root[:, 0]), order[:, 1:b + 1].astype(np.uint8), below(root[:, 1:b + 1]), outer)

    def moved(self, moves: np.ndarray, b: int) -> Bounds:
        """After the entries moved; bounds beyond the first ``b`` join the outer one."""
        far = float(moves.max(initial=0.0))
        lower, outer = below(self.lower - moves[self.near]), below(self.outer.astype(np.float64) - far)
        if b < lower.shape[1]:
            outer = np.minimum(outer, lower[:, b:].min(1))
        return Bounds(self.own.copy(), above(self.upper + moves[self.own]), self.near[:, :b].copy(), lower[:, :b].copy(), outer)

    def settle(self, x: np.ndarray, entries: np.ndarray) -> np.ndarray:
        """Bring ``own`` up to date; returns how many bounds each part had to look at (the number of bounds plus one: all entries)."""
        b = self.near.shape[1]
        # the lowest bound of this and all later places: from there on nothing is nearer
        rest = np.minimum.accumulate(np.concatenate([self.lower, self.outer[:, None]], 1)[:, ::-1], axis=1)[:, ::-1]
        looked = np.zeros(len(x), np.uint8)
        unsure = np.flatnonzero(self.upper >= rest[:, 0])
        if not len(unsure):
            return looked
        d = np.square(x[unsure] - entries[self.own[unsure]]).sum(1)
        self.upper[unsure] = above(np.sqrt(d.astype(np.float64)))
        clear = rest[unsure] > self.upper[unsure, None]
        looked[unsure] = np.where(clear.any(1), clear.argmax(1), b + 1)
        for z in range(1, b + 1):
            at = np.flatnonzero(looked == z)
            if not len(at):
                continue
            these = np.concatenate([self.own[at, None], self.near[at, :z]], 1)
            d = np.square(x[at, None, :] - entries[these]).sum(2)
            order = np.lexsort((these, d), axis=1)
            these, d = np.take_along_axis(these, order, 1), np.sqrt(np.take_along_axis(d, order, 1).astype(np.float64))
            self.own[at], self.upper[at] = these[:, 0], above(d[:, 0])
            self.near[at, :z], self.lower[at, :z] = these[:, 1:], below(d[:, 1:])
        at = np.flatnonzero(looked > b)
        if len(at):
            new = Bounds.measured(x[at], entries, b)
            self.own[at], self.upper[at], self.near[at], self.lower[at], self.outer[at] = new.own, new.upper, new.near, new.lower, new.outer
        return looked


#: Columns of the persisted state: name, type, numbers for each part (0: as many as bounds are kept).
STATE = [("own", np.uint8, 1), ("upper", np.float32, 1), ("near", np.uint8, 0), ("lower", np.float32, 0), ("outer", np.float32, 1), ("looked", np.uint8, 1)]


def packed(a: np.ndarray) -> pa.Array:
    a = np.ascontiguousarray(a)
    return pa.array([r.tobytes() for r in a], pa.binary())


def unpacked(column: pa.ChunkedArray | pa.Array, kind, n: int, width: int) -> np.ndarray:
    flat = np.frombuffer(b"".join(column.to_pylist()), kind)
    return flat.reshape(n, width).copy()


def parts_of(batch: pa.RecordBatch, size: int) -> np.ndarray:
    return unpacked(batch.column("x"), np.int32, batch.num_rows, size).astype(np.int64)


def small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, b.num_rows, BATCH):
            yield b.slice(at, BATCH)


def state_of(batch: pa.RecordBatch, parts: int, b: int) -> list[Bounds]:
    n = batch.num_rows
    read = {name: unpacked(batch.column(name), kind, n, parts * (each or b)).reshape(n, parts, each or b) for name, kind, each in STATE if name != "looked"}
    return [Bounds(read["own"][:, p, 0], read["upper"][:, p, 0], read["near"][:, p], read["lower"][:, p], read["outer"][:, p, 0]) for p in range(parts)]


def written(bounds: list[Bounds], looked: np.ndarray) -> dict[str, pa.Array]:
    stack = {name: np.stack([getattr(x, name) for x in bounds], 1) for name, _, _ in STATE if name != "looked"} | {"looked": looked}
    return {name: packed(stack[name].astype(kind).reshape(len(looked), -1)) for name, kind, _ in STATE}


def schema(rows: DataFrame, *more: str) -> str:
    return ", ".join(["vec_id " + rows.schema["vec_id"].dataType.simpleString(), "label " + rows.schema["label"].dataType.simpleString(), *more])


def assign(rows: DataFrame, books: np.ndarray, b: int, b_before: int | None, moves: np.ndarray | None, last: bool) -> DataFrame:
    """``rows`` (vec_id, label, x and the state, if any) with the state under the codebooks; ``last``: code and error instead."""
    parts, _, width = books.shape

    def work(batches):
        for batch in small(batches):
            n = batch.num_rows
            x = parts_of(batch, parts * width).reshape(n, parts, width)
            if moves is None:
                looked = np.zeros((n, parts), np.uint8)
                bounds = [Bounds.measured(x[:, p], books[p], b) for p in range(parts)]
            else:
                bounds = [s.moved(moves[p], b) for p, s in enumerate(state_of(batch, parts, b_before))]
                looked = np.stack([s.settle(x[:, p], books[p]) for p, s in enumerate(bounds)], 1)
            own = {"vec_id": batch.column("vec_id"), "label": batch.column("label")}
            if last:
                codes = np.stack([s.own for s in bounds], 1)
                error = sum(np.square(x[:, p] - books[p][codes[:, p]]).sum(1) for p in range(parts))
                yield pa.RecordBatch.from_pydict(own | {"code": pa.array([r.tobytes().hex() for r in codes]), "error": pa.array(error, pa.int64())})
            else:
                yield pa.RecordBatch.from_pydict(own | {"x": batch.column("x")} | written(bounds, looked))

    names = ["code string", "error long"] if last else ["x binary", *[f"{name} binary" for name, _, _ in STATE]]
    return rows.mapInArrow(work, schema(rows, *names))


def gathered(state: DataFrame, books: np.ndarray) -> tuple[dict, dict]:
    """Sums and counts of the parts of each entry, {(part * entries + entry, position): sum} with the count at -1, and {bounds looked at: parts}."""
    parts, k, width = books.shape

    def work(batches):
        sums, counts, looks = np.zeros((parts, k, width), np.int64), np.zeros((parts, k), np.int64), np.zeros(256, np.int64)
        for batch in small(batches):
            n = batch.num_rows
            x = parts_of(batch, parts * width).reshape(n, parts, width)
            own = unpacked(batch.column("own"), np.uint8, n, parts)
            looks += np.bincount(unpacked(batch.column("looked"), np.uint8, n, parts).ravel(), minlength=256)
            for p in range(parts):
                np.add.at(sums[p], own[:, p], x[:, p])
                counts[p] += np.bincount(own[:, p], minlength=k)
        slot, used = np.arange(parts * k), np.flatnonzero(counts.ravel())
        rows = [(np.repeat(slot[used], width), np.tile(np.arange(width), len(used)), sums.reshape(-1, width)[used].ravel()),
                (slot[used], np.full(len(used), -1), counts.ravel()[used]),
                (np.full(256, -1), np.arange(256), looks)]
        out = [np.concatenate(c) for c in zip(*rows)]
        yield pa.RecordBatch.from_pydict(dict(zip(("slot", "pos", "total"), (pa.array(c, pa.int64()) for c in out))))

    found = state.mapInArrow(work, "slot long, pos long, total long").groupBy("slot", "pos").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
    # at most a row for each component of the codebooks and each number of bounds
    sums = {(r["slot"], r["pos"]): int(r["total"]) for r in found if r["slot"] >= 0}
    return sums, {r["pos"]: int(r["total"]) for r in found if r["slot"] < 0}


def renewed(books: np.ndarray, sums: dict) -> np.ndarray:
    """The entries replaced by the floored means of their parts; unused ones stay."""
    out, (parts, k, width) = books.copy(), books.shape
    for p in range(parts):
        for e in range(k):
            n = sums.get((p * k + e, -1), 0)
            if n:
                out[p, e] = [sums[p * k + e, w] // n for w in range(width)]
    return out


def adapted(looks: dict[int, int], b: int, entries: int) -> int:
    """The fewest bounds, at least an eighth of the entries, that all but a few of the parts that had to look got along with."""
    had_to = sum(n for z, n in looks.items() if z > 0)
    for c in range(min(b, max(1, entries // LEAST_SHARE)), b):
        if sum(n for z, n in looks.items() if z > c) <= BEYOND * had_to:
            return c
    return b


def compress(
    vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
) -> tuple[DataFrame, np.ndarray]:
    """``vec_id, label, code, error`` of every usable vector, and the codebooks (parts, entries, components).

    Vectors that are null, empty, hold a null, NaN or infinite component, or
    can't be cut into equal parts are dropped; so are those of another length
    than the vector of the smallest id.  The codebooks start from the smallest
    ids, equal ids by their vectors, null ids last; with fewer vectors than
    entries they have fewer entries.  Components beyond ``largest`` are held to
    it.  At most 256 entries.  Rows with the same id are coded each.  Without a
    usable vector the result is empty, and so are the codebooks.
    """
    if not 1 <= entries <= 256:
        raise ValueError("1 to 256 entries")
    kept = usable(vectors, parts, id_col, vector_col, label_col)
    first = kept.orderBy(F.col("vec_id").asc_nulls_last(), "v").select("v").limit(1).collect()
    if not first:
        return kept.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")), np.zeros((parts, 0, 0), np.int64)
    size = len(first[0]["v"])
    kept = kept.where(F.size("v") == size)
    seeds = kept.orderBy(F.col("vec_id").asc_nulls_last(), "v").select("v").limit(entries).collect()
    books = whole(np.array([r["v"] for r in seeds], np.float64), scale).reshape(len(seeds), parts, -1).transpose(1, 0, 2).copy()

    def integers(batches):
        for batch in batches:
            v = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, size)
            yield pa.RecordBatch.from_pydict({"vec_id": batch.column("vec_id"), "label": batch.column("label"), "x": packed(whole(v, scale).astype(np.int32))})

    rows = kept.mapInArrow(integers, schema(kept, "x binary"))
    k = len(seeds)
    b = b_before = min(max(1, k // FIRST_SHARE), k - 1)
    moves = None
    for _ in range(rounds):
        rows = materialize(assign(rows, books, b, b_before, moves, last=False))
        sums, looks = gathered(rows, books)
        new = renewed(books, sums)
        moves = above(np.sqrt(np.square((new - books).astype(np.float64)).sum(2))).astype(np.float64)
        books, b_before = new, b
        b = adapted(looks, b, k)
    return materialize(assign(rows, books, b, b_before, moves, last=True)), books


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def summary(vectors: DataFrame, **how) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256``; ``label_error`` is the error summed over equal labels."""
    coded, books = compress(vectors, **how)
    per_label = coded.groupBy("label").agg(F.sum("error").alias("label_error"))
    joined = attach_lookup(coded, per_label, ["label"], F.col("code"))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def oracle_sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> str:
    def nearest(n: int) -> str:
        """Entry and distance of every part under the n-th codebooks."""
        return f"""
d{n} as (select x.row_no, x.part, b.entry, sum((x.c - b.c) * (x.c - b.c))::bigint as d from x join b{n} b on x.part = b.part and x.pos = b.pos group by all),
a{n} as (select row_no, part, entry, d from d{n} qualify row_number() over (partition by row_no, part order by d, entry) = 1)"""

    def renew(n: int) -> str:
        return f"""
m{n} as (select a.part, a.entry, x.pos, floor(sum(x.c)::double / count(*))::bigint as c from a{n} a join x on x.row_no = a.row_no and x.part = a.part group by all),
b{n + 1} as (select b.part, b.entry, b.pos, coalesce(m.c, b.c) as c from b{n} b left join m{n} m on m.part = b.part and m.entry = b.entry and m.pos = b.pos)"""

    chain = ",".join(s for n in range(rounds) for s in (nearest(n), renew(n))) + "," + nearest(rounds)
    return f"""
with kept as (
  select row_number() over (order by vec_id nulls last, embedding) as row_no, vec_id, label, embedding from embeddings
  where embedding is not null and len(embedding) > 0 and len(embedding) % {parts} = 0
    and len(list_filter(embedding, lambda v: v is null or not isfinite(v))) = 0),
numbered as (select * from kept where len(embedding) = (select len(embedding) from kept where row_no = 1)),
x as (
  select row_no, (i * {parts}) // len(embedding) as part, i % (len(embedding) // {parts}) as pos, floor(embedding[i + 1]::double * {scale})::bigint as c
  from (select row_no, embedding, unnest(range(len(embedding))) as i from numbered)),
seeds as (select row_no, row_number() over (order by row_no) - 1 as entry from numbered order by row_no limit {entries}),
b0 as (select x.part, s.entry, x.pos, x.c from x join seeds s on s.row_no = x.row_no),{chain},
book as (select sha256(string_agg(c::varchar, ',' order by part, entry, pos)) as codebooks_sha256 from b{rounds}),
coded as (select row_no, string_agg(printf('%02x', entry::int), '' order by part) as code, sum(d)::bigint as error from a{rounds} group by row_no)
select n.vec_id, c.code, c.error, (sum(c.error) over (partition by n.label))::bigint as label_error, book.codebooks_sha256
from numbered n join coded c on c.row_no = n.row_no, book
"""
