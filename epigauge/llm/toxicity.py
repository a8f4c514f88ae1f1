"""Toxicity by character n-grams scaled by naive Bayes log-count ratios, weighed by a linear classifier."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from epigauge.llm.common import text_of
from epigauge.llm.quality import clean_labels
from epigauge.session import materialise

#: Labelled rows that a fit uses at most (those with the smallest hash of their id).
SAMPLE = 20_000
#: n-grams of 3 to 5 characters go to 2 ** BITS bins; the FEATURES that tell most about the label are used.
BITS = 20
LENGTHS = (3, 4, 5)
FEATURES = 2048
SMOOTH = 1.0
#: Weight of a row with label 1 in the fit; such rows are the rare ones.
WEIGHT = 3.0


def bins(text: str) -> np.ndarray:
    """The bin of every n-gram of the lower-cased text between two spaces."""
    a = np.frombuffer(f" {text.lower()} ".encode("utf-32-le"), np.uint32)
    out, total = [], np.zeros(len(a), np.uint32)
    for n in range(1, LENGTHS[-1] + 1):
        if len(a) < n:
            break
        # One odd multiplier per position of the n-gram.
        odd = np.uint32((0x9E3779B1 * (2 * n + 1) ** 5 + 2 * n) & 0xFFFFFFFF | 1)
        total = total[: len(a) - n + 1] + a[n - 1 :] * odd
        if n in LENGTHS:
            h = (total ^ (total >> np.uint32(15))) * np.uint32(0x85EBCA6B) + np.uint32(n * 0x27D4EB2F & 0xFFFFFFFF)
            h = (h ^ (h >> np.uint32(13))) * np.uint32(0xC2B2AE35)
            out.append(h >> np.uint32(32 - BITS))
    return np.concatenate(out) if out else np.zeros(0, np.uint32)


def amounts(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different values and how much each counts: log2(1 + occurrences)."""
    values, times = np.unique(found, return_counts=True)
    return values, np.log2(1.0 + times)


@dataclass(frozen=True)
class Toxicity:
    """Weights (already times the log-count ratios) of the chosen bins."""

    chosen: np.ndarray
    weights: np.ndarray
    intercept: float

    def score(self, text: Column) -> Column:
        """0 to 1; the empty text has the score of a text without any chosen n-gram."""
        chosen, weights, intercept = self.chosen, self.weights, self.intercept

        @pandas_udf("double")
        def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            table = np.zeros(1 << BITS)
            table[chosen] = weights
            hit = np.zeros(1 << BITS, bool)
            hit[chosen] = True
            for texts in batches:
                sums = np.empty(len(texts))
                for i, t in enumerate(texts):
                    found = bins(t)
                    values, much = amounts(found[hit[found]])
                    sums[i] = table[values] @ much
                yield pd.Series(1.0 / (1.0 + np.exp(-np.clip(sums + intercept, -500, 500))))

        return of(text_of(text))


def label_counts(rows: DataFrame) -> DataFrame:
    """``bin, ones, zeros``: in how many rows of either label a bin occurs; summed within each task first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, 1 << BITS), np.int64)
        for rows in batches:
            for t, label in zip(rows.column("text").to_pylist(), rows.column("label").to_pylist(), strict=True):
                sums[label, np.unique(bins(t))] += 1
        used = np.flatnonzero(sums.any(axis=0))
        for k in range(0, len(used), 100_000):
            u = used[k : k + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(sums[1, u]), pa.array(sums[0, u])], ["bin", "ones", "zeros"])

    parts = rows.select("text", "label").mapInArrow(count, "bin long, ones long, zeros long")
    return parts.groupBy("bin").agg(F.sum("ones").alias("ones"), F.sum("zeros").alias("zeros"))


def fit(
    docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text"
) -> Toxicity:
    """Count n-grams by label, scale by log-count ratios, fit a logistic model on the scaled amounts.

    Of the bins the FEATURES with the largest likelihood ratio are used; at most so many come to the driver.
    Without both labels all weights are zero. Only ``text_col`` is looked at; ids link labels to texts.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    known = texts.join(F.broadcast(clean_labels(labels, label_col, sample=SAMPLE)), "doc_id")  # SAMPLE rows
    rows = materialise(known.select("text", "label"), "labelled-texts")
    totals = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    if not (totals.get(0) and totals.get(1)):
        return Toxicity(np.zeros(0, np.int64), np.zeros(0), 0.0)
    one, zero = float(totals[1]), float(totals[0])

    def part(here: Column, of: Column, total: float) -> Column:
        """here * log(here / expected here), zero for none."""
        return F.when(here > 0, here * F.log(here * (one + zero) / (of * F.lit(total)))).otherwise(0.0)

    a, b = F.col("ones"), F.col("zeros")
    tells = part(a, a + b, one) + part(b, a + b, zero)
    tells = tells + part(one - a, one + zero - a - b, one) + part(zero - b, one + zero - a - b, zero)
    ratio = F.log((a + SMOOTH) / (one + 2 * SMOOTH)) - F.log((b + SMOOTH) / (zero + 2 * SMOOTH))
    counted = label_counts(rows).filter(a + b > 1).select("bin", ratio.alias("ratio"), tells.alias("tells"))
    best = counted.orderBy(F.desc("tells"), "bin").limit(FEATURES).toPandas().sort_values("bin")
    chosen, ratios = best["bin"].to_numpy(np.int64), best["ratio"].to_numpy(float)
    if not len(chosen):
        return Toxicity(np.zeros(0, np.int64), np.zeros(0), 0.0)

    @pandas_udf("places array<int>, much array<double>")
    def present(texts: pd.Series) -> pd.DataFrame:
        place = np.full(1 << BITS, -1, np.int32)
        place[chosen] = np.arange(len(chosen))
        found = (place[bins(t)] for t in texts)
        return pd.DataFrame([amounts(p[p >= 0]) for p in found], columns=["places", "much"])

    size = len(chosen)

    @F.udf(VectorUDT())
    def scaled(present):
        return Vectors.sparse(size, [(p, float(ratios[p]) * m) for p, m in zip(present["places"], present["much"], strict=True)])

    train = materialise(rows.select(present("text").alias("present"), "label"), "present")
    weight = F.when(F.col("label") == 1, F.lit(WEIGHT)).otherwise(F.lit(1.0))
    train = train.select(
        scaled("present").alias("features"), F.col("label").cast("double").alias("label"), weight.alias("weight")
    ).persist()
    try:
        model = LogisticRegression(weightCol="weight", regParam=1e-3, standardization=False, maxIter=100).fit(train)
    finally:
        train.unpersist()
    return Toxicity(chosen, model.coefficients.toArray() * ratios, float(model.intercept))
