"""Feature vectors and the fitted scalers, as ``pyspark.ml`` stages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import (
    PCA,
    ElementwiseProduct,
    MinMaxScaler,
    MinMaxScalerModel,
    PCAModel,
    StandardScaler,
    StandardScalerModel,
    StringIndexer,
    StringIndexerModel,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, functions as F


def index_labels(df: DataFrame, column: str, output: str) -> StringIndexerModel:
    """Labels to 0, 1, ... by falling frequency, equal ones by name."""
    return StringIndexer(inputCol=column, outputCol=output, stringOrderType="frequencyDesc").fit(df)


def assembler(columns: Sequence[str], output: str, invalid: str = "error") -> VectorAssembler:
    """``invalid`` is ``error`` for training and ``skip`` for scoring (drops null and NaN rows)."""
    return VectorAssembler(inputCols=list(columns), outputCol=output, handleInvalid=invalid)


def fit_zscore(df: DataFrame, vector: str, output: str) -> StandardScalerModel:
    return StandardScaler(inputCol=vector, outputCol=output, withMean=True, withStd=True).fit(df)


def fit_minmax(df: DataFrame, vector: str, output: str) -> MinMaxScalerModel:
    """To 1..100 over the range seen in the fit; later values may fall outside."""
    return MinMaxScaler(inputCol=vector, outputCol=output, min=1.0, max=100.0).fit(df)


def fit_components(df: DataFrame, vector: str, output: str, k: int) -> PCAModel:
    return PCA(k=k, inputCol=vector, outputCol=output).fit(df)


def loadings(model: PCAModel) -> list[list[float]]:
    """One list per component."""
    matrix = model.pc.toArray()
    return [matrix[:, j].tolist() for j in range(matrix.shape[1])]


def orientation(model: PCAModel) -> list[float]:
    """+1 or -1 per component, so that its loadings sum to zero or more.

    The sign of a principal component is arbitrary; this makes it a property of the data. For
    burden metrics it means: more burden, higher score.
    """
    return [1.0 if sum(component) >= 0 else -1.0 for component in loadings(model)]


def flip(signs: Sequence[float], vector: str, output: str) -> ElementwiseProduct:
    return ElementwiseProduct(scalingVec=Vectors.dense(list(signs)), inputCol=vector, outputCol=output)


def spread_vector(df: DataFrame, vector: str, names: Sequence[str]) -> DataFrame:
    """The elements of a vector column as columns ``names``, replacing columns of that name."""
    values = df.withColumn("_values", vector_to_array(vector))
    return values.withColumns({n: F.col("_values")[i] for i, n in enumerate(names)}).drop("_values")
