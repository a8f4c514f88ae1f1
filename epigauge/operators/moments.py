"""Moments of several columns in one pass, which can be merged: scaling, components and cost follow from them.

New windows are added to the moments of the old ones; the old windows are not read again.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F, types as T

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need not have this package

#: Tasks that merge the partial moments of all others before the last one does.
MERGERS = 32


@dataclass(frozen=True)
class Moments:
    """Of ``n`` rows the means, the sums of products of the deviations from them, and the ends."""

    names: tuple[str, ...]
    n: int
    mean: np.ndarray
    cross: np.ndarray
    low: np.ndarray
    high: np.ndarray

    @classmethod
    def of(cls, names: Sequence[str], rows: np.ndarray) -> Moments:
        """The moments of some rows (a matrix), worked out around their own means."""
        k = len(names)
        if not len(rows):
            return cls(tuple(names), 0, np.zeros(k), np.zeros((k, k)), np.full(k, np.inf), np.full(k, -np.inf))
        mean = rows.mean(axis=0)
        away = rows - mean
        return cls(tuple(names), len(rows), mean, away.T @ away, rows.min(axis=0), rows.max(axis=0))

    def merged(self, other: Moments) -> Moments:
        """The moments of both sets of rows together, without cancellation between large sums."""
        if self.names != other.names:
            raise ValueError("moments of different columns cannot be merged")
        n = self.n + other.n
        if not n:
            return self
        apart = other.mean - self.mean
        mean = self.mean + apart * (other.n / n)
        cross = self.cross + other.cross + np.outer(apart, apart) * (self.n * other.n / n)
        return Moments(self.names, n, mean, cross, np.minimum(self.low, other.low), np.maximum(self.high, other.high))

    @property
    def covariance(self) -> np.ndarray:
        """Sample covariance; zeros for a single row."""
        return self.cross / max(self.n - 1, 1)

    @property
    def deviation(self) -> np.ndarray:
        return np.sqrt(np.diag(self.covariance))

    @property
    def correlation(self) -> np.ndarray:
        """Correlation matrix; a constant column is related to nothing."""
        s = self.deviation
        scale = np.divide(1.0, s, out=np.zeros_like(s), where=s > 0)
        return self.covariance * scale[:, None] * scale[None, :]

    def components(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The first ``k`` components of the scaled columns (one a row, loadings summing to zero or more) and the
        share of the variance that each explains."""
        values, vectors = np.linalg.eigh(self.correlation)
        order = np.argsort(-values)[:k]
        found = vectors[:, order].T
        return np.where(found.sum(axis=1) < 0, -1.0, 1.0)[:, None] * found, values[order] / values.sum()

    def scaled(self, name: str) -> Column:
        """The z-score of a column; 0 where all values are the same."""
        i = self.names.index(name)
        s = float(self.deviation[i])
        return (F.col(name) - F.lit(float(self.mean[i]))) / F.lit(s) if s > 0 else F.lit(0.0)

    def component(self, loadings: Sequence[float]) -> Column:
        """A row's place on a component: plain arithmetic, without vectors."""
        return reduce(add, [F.lit(float(w)) * self.scaled(name) for w, name in zip(loadings, self.names, strict=True)])

    def row(self) -> tuple:
        return self.n, self.mean.tolist(), self.cross.ravel().tolist(), self.low.tolist(), self.high.tolist()

    @classmethod
    def from_row(cls, names: Sequence[str], row: Sequence) -> Moments:
        n, mean, cross, low, high = row
        k = len(names)
        return cls(tuple(names), n, np.array(mean), np.array(cross).reshape(k, k), np.array(low), np.array(high))


_KINDS = {"n": pa.int64(), **dict.fromkeys(("mean", "cross", "low", "high"), pa.list_(pa.float64()))}


def _schema(df: DataFrame, by: Sequence[str]) -> T.StructType:
    schema = T.StructType([df.schema[c] for c in by]).add("n", "long")
    for name in ("mean", "cross", "low", "high"):
        schema = schema.add(name, T.ArrayType(T.DoubleType()))
    return schema


def _batch(found: dict[tuple, Moments], by: Sequence[str], kinds: Sequence[pa.DataType]) -> pa.RecordBatch:
    rows = [(*key, *m.row()) for key, m in found.items()]
    columns = list(zip(*rows, strict=True)) or [[]] * (len(by) + len(_KINDS))
    arrays = [pa.array(c, k) for c, k in zip(columns, (*kinds, *_KINDS.values()), strict=True)]
    return pa.RecordBatch.from_arrays(arrays, [*by, *_KINDS])


def moments(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """One row of moments (per group ``by``, of which there may be as many as fit a task): a table that can be kept and merged.

    One scan, matrix products within tasks, and a merge of the tasks' results. Rows with a null, NaN or infinite value in one
    of the columns are left out; no rows give no moments. Columns are read as doubles.
    """
    names, by = tuple(columns), list(by)
    rows = df.select(*by, *[F.col(c).cast("double").alias(c) for c in names])
    schema = _schema(rows, by)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple, Moments] = {}
        kinds: list[pa.DataType] = []
        for batch in batches:
            kinds = [batch.column(c).type for c in by]
            x = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in names])
            whole = np.isfinite(x).all(axis=1)
            if not by:
                parts = {(): x[whole]}
            else:
                keys = list(zip(*(batch.column(c).to_pylist() for c in by), strict=True))
                places: dict[tuple, list[int]] = {}
                for i in np.flatnonzero(whole).tolist():
                    places.setdefault(keys[i], []).append(i)
                parts = {key: x[at] for key, at in places.items()}
            for key, part in parts.items():
                if len(part):
                    m = Moments.of(names, part)
                    found[key] = found[key].merged(m) if key in found else m
        if found:
            yield _batch(found, by, kinds)

    return merged_moments(rows.mapInArrow(partial, schema), names, by)


def merged_moments(parts: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Rows of moments merged into one (per group): those of tasks, of batches, or of old and new windows."""
    names, by, schema = tuple(columns), list(by), parts.schema

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple, Moments] = {}
        kinds: list[pa.DataType] = []
        for batch in batches:
            kinds = [batch.column(c).type for c in by]
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                key, m = row[: len(by)], Moments.from_row(names, row[len(by) :])
                found[key] = found[key].merged(m) if key in found else m
        if found:
            yield _batch(found, by, kinds)

    some = parts.repartition(MERGERS, *by) if by else parts.repartition(MERGERS).mapInArrow(merge, schema).repartition(1)
    return some.mapInArrow(merge, schema)


def read_moments(table: DataFrame, columns: Sequence[str]) -> Moments | None:
    """The one row of a moments table as numbers on the driver: as many as columns, squared; None for no rows."""
    row = table.select("n", "mean", "cross", "low", "high").first()
    return None if row is None else Moments.from_row(columns, row)


def within_cost(by_label: DataFrame, size: int) -> DataFrame:
    """Sum of squared distances to the mean of the own group, from moments by group."""
    squares = reduce(add, [F.col("cross")[i * size + i] for i in range(size)])
    return by_label.agg(F.sum(squares).alias("cost"), F.sum("n").alias("rows"))
