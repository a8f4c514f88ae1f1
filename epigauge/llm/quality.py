"""Quality by Bradley-Terry ranking: scores learned from preference pairs, cut at a score quantile."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from epigauge.llm.common import number_within, text_of
from epigauge.session import materialise

#: Labelled rows that a fit uses at most (those with the smallest hash of their id).
SAMPLE = 20_000
#: Opponents drawn for each labelled row.
OPPONENTS = 8

#: Classes of ASCII bytes whose shares are features.
CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "digit": b"0123456789",
    "stop": b".,;:?'\"-",
    "shout": b"!",
    "bracket": b"()[]{}<>",
    "bar": b"|/\\_~^`",
    "symbol": b"#$%&*+=@",
    "line": b"\n\r",
    "blank": b" \t",
}
N_FEATURES = len(CLASSES) + 11


def _class_matrix() -> np.ndarray:
    out = np.zeros((256, len(CLASSES)))
    for i, members in enumerate(CLASSES.values()):
        out[list(members), i] = 1.0
    return out


def shape(text: str, classes: np.ndarray) -> np.ndarray:
    """Features of one whole text: byte classes, word lengths, repetition of words, word pairs and lines."""
    raw = text.encode()
    words, n = raw.split(), max(len(raw), 1)
    out = np.zeros(N_FEATURES)
    out[: len(CLASSES)] = np.bincount(np.frombuffer(raw, np.uint8), minlength=256) @ classes / n
    if not words:
        return out
    lengths = np.fromiter(map(len, words), float, len(words))
    counts = Counter(words)
    lines = [line for line in raw.split(b"\n") if line.strip()]
    many = len(words)
    ends = Counter(w[-1] for w in words)
    odd = sum(c for b, c in ends.items() if chr(b) in "#$%&*!|+=@<>")
    out[len(CLASSES) :] = (
        np.log1p(len(raw)),
        np.log1p(many),
        lengths.mean(),
        np.log1p(lengths.max()),
        lengths.std(),
        np.log(len(counts)) / np.log1p(many),
        max(counts.values()) / many,
        len(set(zip(words, words[1:], strict=False))) / max(many - 1, 1),
        len(set(lines)) / len(lines),
        odd / many,
        sum(c for w, c in counts.items() if w.isupper()) / many,
    )
    return out


def features(text: Column) -> Column:
    """The features of a text as an array; a null text is empty."""

    @pandas_udf("array<double>")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        classes = _class_matrix()
        for texts in batches:
            yield pd.Series([shape(t, classes) for t in texts], dtype=object)

    return of(text_of(text))


@dataclass(frozen=True)
class Ranking:
    """Strength of a text is ``weights`` times features; ``cut`` is the strength at the quantile of bad labels."""

    weights: tuple[float, ...]
    cut: float

    def score(self, text: Column) -> Column:
        """0 to 1; 0.5 at the cut."""
        weights, cut = np.array(self.weights), self.cut

        @pandas_udf("double")
        def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            classes = _class_matrix()
            for texts in batches:
                strength = np.array([shape(t, classes) @ weights for t in texts]) - cut
                yield pd.Series(1.0 / (1.0 + np.exp(-np.clip(strength, -500, 500))))

        return of(text_of(text))


def clean_labels(labels: DataFrame, label_col: str, id_col: str = "doc_id", sample: int = SAMPLE) -> DataFrame:
    """``doc_id, label``: one row per labelled document, at most ``sample``, those with the smallest id hash.

    Rows without id or label and documents whose labels disagree are left out.
    """
    rows = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).alias("label")).dropna()
    one = rows.groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("most"))
    one = one.filter("label = most and label in (0, 1)").select("doc_id", F.col("label").cast("int").alias("label"))
    return one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)


def preference_pairs(rows: DataFrame, counts: dict[int, int], opponents: int = OPPONENTS) -> DataFrame:
    """``won, lost`` (features): every row of either label against ``opponents`` drawn rows of the other.

    Rows are numbered within their label and meet on drawn numbers, so the pairs grow with the rows.
    """
    numbered = number_within(rows, ["label"], ["doc_id"], "slot", sum(counts.values()))
    sides = []
    for label in (1, 0):
        own = numbered.filter(F.col("label") == label).withColumn("draw", F.explode(F.sequence(F.lit(1), F.lit(opponents))))
        own = own.select(F.col("features").alias("own"), F.pmod(F.xxhash64("doc_id", "draw"), F.lit(counts[1 - label])).alias("slot"))
        other = numbered.filter(F.col("label") == 1 - label).select("slot", F.col("features").alias("other"))
        pair = own.join(other, "slot")
        sides.append(pair.select(F.col("own" if label else "other").alias("won"), F.col("other" if label else "own").alias("lost")))
    return sides[0].unionByName(sides[1])


def fit(
    docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text"
) -> Ranking:
    """Learn strengths from pairs of a good and a bad document by logistic loss on their feature difference.

    The cut is the quantile of the labelled strengths at the share of bad labels. Without both labels every
    strength is zero. Only ``text_col`` is looked at; ids link labels to texts.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    known = texts.join(F.broadcast(clean_labels(labels, label_col)), "doc_id")  # SAMPLE rows
    rows = materialise(known.select("doc_id", "label", features(F.col("text")).alias("features")), "labelled")
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    if not (counts.get(0) and counts.get(1)):
        return Ranking((0.0,) * N_FEATURES, 0.0)
    pairs = preference_pairs(rows, counts)
    # Half of the pairs are turned round, so that both outcomes occur: the same loss.
    turned = F.xxhash64("won", "lost") % 2 == 0
    difference = F.zip_with("won", "lost", lambda a, b: F.when(turned, b - a).otherwise(a - b))
    games = pairs.select(array_to_vector(difference).alias("features"), F.when(turned, 0.0).otherwise(1.0).alias("label"))
    games = materialise(games, "games")
    logistic = LogisticRegression(fitIntercept=False, regParam=1e-4, maxIter=100, tol=1e-7)
    weights = logistic.fit(games).coefficients.toArray()
    strength = F.aggregate(
        F.zip_with("features", F.array(*map(F.lit, map(float, weights))), lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b
    )
    share = counts[0] / (counts[0] + counts[1])
    cut = rows.select(F.percentile(strength, F.lit(share)).alias("cut")).first()["cut"]
    return Ranking(tuple(map(float, weights)), float(cut))
