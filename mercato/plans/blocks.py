"""Matrix-valued aggregates: one mergeable state a task instead of one aggregate a number.

A table's numeric columns are read in blocks of rows.  A block becomes a small
state of matrices, states of the same task are merged as they come, the
states of all tasks are merged in a second step by a number of tasks, and
what those leave comes to the driver: a few matrices as wide as the table has
columns.  So the plan and the generated code don't grow with the square of the
columns, and a block costs a few matrix products.

* ``Moments``: for every pair of columns the rows where both are present, and
  of these rows the means, the centred squares and the centred product
  (merged as by Chan, Golub and LeVeque).
* ``Triangle``: the triangular factor of the columns after a column of ones, by
  a tree of QR factorisations, so nothing is squared and columns that are
  nearly multiples of each other stay apart.
"""

from __future__ import annotations

import math
import pickle
import sys
from dataclasses import dataclass

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass
class Moments:
    """``n``, ``mean``, ``square``: [i, j] is about column i over the rows where j is there, too; ``product`` is centred."""

    rows: int
    n: np.ndarray
    mean: np.ndarray
    square: np.ndarray
    product: np.ndarray

    @staticmethod
    def of(x: np.ndarray) -> Moments:
        there = ~np.isnan(x)
        m = there.astype(float)
        # columns are moved by a value of their own first, so a constant column has exactly no spread
        first = np.where(there.any(0), x[there.argmax(0), np.arange(x.shape[1])], 0.0) if len(x) else np.zeros(x.shape[1])
        z = np.where(there, x - first, 0.0)
        center = z.sum(0) / np.maximum(m.sum(0), 1.0)
        z = np.where(there, z - center, 0.0)
        n = m.T @ m
        some = np.maximum(n, 1.0)
        s = z.T @ m
        return Moments(len(x), n, s / some + (center + first)[:, None], (z * z).T @ m - s * s / some, z.T @ z - s * s.T / some)

    def merged(self, other: Moments) -> Moments:
        n = self.n + other.n
        some = np.maximum(n, 1.0)
        d = np.where((self.n > 0) & (other.n > 0), other.mean - self.mean, 0.0)
        both = self.n * other.n / some
        mean = np.where(self.n > 0, self.mean + d * other.n / some, other.mean)
        return Moments(self.rows + other.rows, n, mean, self.square + other.square + d * d * both, self.product + other.product + d * d.T * both)


@dataclass
class Triangle:
    """``r``: upper triangular, r'r = a'a of a = [1, x - shift] over the rows without a missing value."""

    n: int
    shift: np.ndarray
    r: np.ndarray

    @staticmethod
    def of(x: np.ndarray) -> Triangle:
        x = x[~np.isnan(x).any(1)]
        shift = x.mean(0) if len(x) else np.zeros(x.shape[1])
        return Triangle(len(x), shift, Triangle.upper(np.column_stack([np.ones(len(x)), x - shift])))

    @staticmethod
    def upper(a: np.ndarray) -> np.ndarray:
        r = np.linalg.qr(a, mode="r")
        r = np.vstack([r, np.zeros((max(0, a.shape[1] - len(r)), a.shape[1]))])
        return r * np.where(np.diag(r) < 0, -1.0, 1.0)[:, None]

    def moved(self, shift: np.ndarray) -> np.ndarray:
        """``r`` for another shift: multiples of the first column are added to the others."""
        r = self.r.copy()
        r[:, 1:] += r[:, :1] * (self.shift - shift)[None, :]
        return r

    def merged(self, other: Triangle) -> Triangle:
        if not self.n or not other.n:
            return self if self.n else other
        return Triangle(self.n + other.n, self.shift, Triangle.upper(np.vstack([self.r, other.moved(self.shift)])))

    @property
    def means(self) -> np.ndarray:
        return self.shift + self.r[0, 1:] / math.sqrt(self.n) if self.n else self.shift

    @property
    def centred(self) -> np.ndarray:
        """The triangular factor of the centred columns."""
        return self.r[1:, 1:]


@dataclass
class Range:
    """The least and largest value of every column over the rows without a missing value (NaN without such rows)."""

    lo: np.ndarray
    hi: np.ndarray

    @staticmethod
    def of(x: np.ndarray) -> Range:
        x = x[~np.isnan(x).any(1)]
        none = np.full(x.shape[1], np.nan)
        return Range(x.min(0), x.max(0)) if len(x) else Range(none, none)

    def merged(self, other: Range) -> Range:
        return Range(np.fmin(self.lo, other.lo), np.fmax(self.hi, other.hi))


def block_states(df: DataFrame, columns: list[str], kinds: list[tuple[type, list[int]]]) -> list:
    """The merged state of every kind over the columns (numbers; null and NaN are missing) that it names by number.

    Of an empty table the states are those of no rows.
    """
    numbers = df.select(*[F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))).alias(f"c{i}") for i, c in enumerate(columns)])
    width = len(columns)

    def merge(a, b):
        return b if a is None else [x.merged(y) for x, y in zip(a, b)]

    def told(state):
        import pyarrow as pa

        return pa.RecordBatch.from_pydict({"state": pa.array([pickle.dumps([tuple(vars(x).values()) for x in state])] if state else [], pa.binary())})

    def heard(told):
        return [kind(*fields) for (kind, _), fields in zip(kinds, pickle.loads(told))]

    def read(batches):
        state = None
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]) if batch.num_rows else np.zeros((0, width))
            state = merge(state, [kind.of(x[:, use]) for kind, use in kinds])
        yield told(state)

    def joined(batches):
        state = None
        for batch in batches:
            for b in batch.column("state").to_pylist():
                state = merge(state, heard(b))
        yield told(state)

    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    states = numbers.mapInArrow(read, "state binary").repartition(max(1, math.isqrt(tasks))).mapInArrow(joined, "state binary")
    out = None
    for r in states.collect():  # at most the root of the number of tasks
        out = merge(out, heard(r["state"]))
    return out or [kind.of(np.zeros((0, len(use)))) for kind, use in kinds]


# Workers get the functions and classes above by value: they need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
